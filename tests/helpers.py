from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orderflow import schemas as S

T0 = datetime(2024, 1, 1, 0, 0, 0)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def orders_df(spark, rows):
    """rows: (id, customerId, product, quantity, price, seconds, seq[, state])."""
    full = [(r[0], r[1], r[7] if len(r) > 7 else "CREATED", r[2], r[3], r[4], at(r[5]), r[6])
            for r in rows]
    return spark.createDataFrame(full, S.ORDER)


def validations_df(spark, rows):
    """rows: (orderId, checkType, result, seconds, seq)."""
    return spark.createDataFrame([(a, b, c, at(t), s) for a, b, c, t, s in rows], S.ORDER_VALIDATION)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def multiset(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v) for v in t))


def ts_col(df, c="ts"):
    return df.withColumn(c, F.col(c).cast("timestamp"))
