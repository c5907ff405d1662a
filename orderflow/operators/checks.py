"""The three order validators, batch form.

Each check takes the orders relation and returns verdict rows
``orderId, checkType, validationResult, ts, seq``.  Verdict times are
deterministic offsets of the order time (details +1 s, fraud +2 s,
inventory +3 s) with ``seq = order seq * 3 + {0,1,2}``: the reference's
verdict times depend on processing, ours must be reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.expressions import amount, limit_branch, odd_amounts, order_value
from orderflow.operators.sessions import sessionize

VERDICT_COLUMNS = ["orderId", "checkType", "validationResult", "ts", "seq"]


def created(orders: DataFrame) -> DataFrame:
    """Only newly created orders enter the validators."""
    return orders.where(F.col("state") == "CREATED")


def _verdict(orders: DataFrame, check: str, result: Column, offset_s: int, slot: int) -> DataFrame:
    return orders.select(
        F.col("id").alias("orderId"),
        F.lit(check).alias("checkType"),
        result.alias("validationResult"),
        (F.col("ts") + F.expr(f"INTERVAL '{offset_s}' SECOND")).alias("ts"),
        (F.col("seq") * 3 + slot).alias("seq"),
    )


def order_is_valid(quantity: str = "quantity", price: str = "price", product: str = "product") -> Column:
    """Quantity and price not negative, product present (zero passes)."""
    bad = (F.col(quantity) < 0) | (F.col(price) < 0) | F.col(product).isNull()
    return ~F.coalesce(bad, F.lit(False))


def details_check(orders: DataFrame) -> DataFrame:
    res = F.when(order_is_valid(), F.lit("PASS")).otherwise(F.lit("FAIL"))
    return _verdict(created(orders), "ORDER_DETAILS_CHECK", res, 1, 0)


def fraud_session_totals(orders: DataFrame, gap: str = S.FRAUD_SESSION_GAP,
                         split: str | None = None) -> DataFrame:
    """Per-customer session running total of ``quantity * price``.

    One row per created order: the session it falls in and the session
    total including this order.  The products are summed as exact decimals of
    the unrounded price; a NaN makes the rest of its session's totals NaN.
    """
    o = created(orders).select("id", "customerId", "quantity", "price", "ts", "seq")
    odd = odd_amounts()
    o = o.select("*", order_value().alias("value"), *[c.alias(f"value_{n}") for n, c in odd.items()])
    rows = sessionize(o, "customerId", "ts", ["seq"], gap,
                      {"sum": F.col("value"), **{f"sum_{n}": F.col(f"value_{n}") for n in odd}}, split=split)
    return rows.select(
        "id", "customerId", "ts", "seq", "session_start",
        amount("value", *[f"value_{n}" for n in odd]).alias("order_value"),
        amount("sum", *[f"sum_{n}" for n in odd]).alias("total"),
    )


def fraud_check(orders: DataFrame, limit: float = S.FRAUD_LIMIT, gap: str = S.FRAUD_SESSION_GAP,
                split: str | None = None) -> DataFrame:
    """FAIL when the running session total is at or above ``limit``, else PASS."""
    t = fraud_session_totals(orders, gap, split)
    v = t.select(F.col("id"), F.col("ts"), F.col("seq"),
                 limit_branch(F.col("total"), float(limit)).alias("r"))
    v = v.where(F.col("r").isNotNull())  # no default branch
    return _verdict(v, "FRAUD_CHECK", F.col("r"), 2, 1)
