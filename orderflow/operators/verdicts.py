"""Verdict fan-in and the aggregator that turns verdicts into order states.

* ``validations_union``: the three validators write one channel (UNION ALL).
* ``pass_counts``: per order, 5-minute sessions of verdicts with the number
  of PASS verdicts (any check type by default, as the reference).
* ``orders_validated``: sessions reaching ``n_rules`` PASSes joined back to
  the created order within +-5 minutes -> order with state VALIDATED, once
  per (order, session).  The reference re-emits the session count on every
  verdict; a VALIDATED order results whenever one of those emissions with
  count >= n_rules lies within the join window of the order.  Emission times
  are the session's event times from the one that reached ``n_rules`` to the
  last, spaced at most one gap (5 min <= 2 x join window) apart, so that is
  exactly ``order.ts BETWEEN reach_ts - window AND session_end + window``.
* ``orders_failed``: FAIL verdicts joined to the created order within the
  window, collapsed to one FAILED order per order id (the first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.expressions import interval
from orderflow.operators.sessions import sessionize

ORDER_COLUMNS = ["id", "customerId", "state", "product", "quantity", "price"]


def validations_union(*verdicts: DataFrame) -> DataFrame:
    out = verdicts[0]
    for v in verdicts[1:]:
        out = out.unionByName(v)
    return out


def pass_counts(validations: DataFrame, gap: str = S.VALIDATION_SESSION_GAP,
                n_rules: int = S.NUMBER_OF_RULES, distinct_checks: bool = False,
                split: str | None = None) -> DataFrame:
    """One row per (orderId, verdict session): verdicts, passes, reach and end time."""
    v = validations.select("orderId", "checkType", "validationResult", "ts", "seq")
    is_pass = F.col("validationResult") == "PASS"
    rows = sessionize(v, "orderId", "ts", ["seq"], gap,
                      {"run_passes": F.when(is_pass, 1).otherwise(0)}, split=split)
    if distinct_checks:
        w = Window.partitionBy("orderId", "session_start", "checkType", "validationResult") \
            .orderBy("ts", "seq")
        first_of_type = is_pass & (F.row_number().over(w) == 1)
        rows = rows.withColumn("__first", F.when(first_of_type, 1).otherwise(0))
        ws = Window.partitionBy("orderId", "session_start").orderBy("ts", "seq") \
            .rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("run_passes", F.sum("__first").over(ws))
    return rows.groupBy("orderId", "session_start").agg(
        F.max("ts").alias("session_end"),
        F.count(F.lit(1)).alias("verdicts"),
        F.max("run_passes").cast("bigint").alias("passes"),
        F.min(F.when(F.col("run_passes") >= n_rules, F.col("ts"))).alias("reach_ts"),
    )


def pass_updates(validations: DataFrame, gap: str = S.VALIDATION_SESSION_GAP,
                 n_rules: int = S.NUMBER_OF_RULES, split: str | None = None) -> DataFrame:
    """One row after every verdict: its session's start, the verdict's time, verdicts and PASSes so far,
    and the time of the ``n_rules``-th PASS if it has come."""
    is_pass = F.when(F.col("validationResult") == "PASS", 1).otherwise(0)
    rows = sessionize(validations.select("orderId", "validationResult", "ts", "seq"), "orderId", "ts", ["seq"], gap,
                      {"passes": is_pass, "verdicts": F.lit(1)}, split=split)
    w = "PARTITION BY orderId, session_start ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return rows.selectExpr("orderId", "session_start", "ts AS session_end", "CAST(verdicts AS BIGINT) AS verdicts",
                           "CAST(passes AS BIGINT) AS passes",
                           f"min(CASE WHEN passes >= {n_rules} THEN ts END) OVER ({w}) AS reach_ts")


def orders_validated(counts: DataFrame, orders: DataFrame, n_rules: int = S.NUMBER_OF_RULES,
                     window: str = S.VALIDATION_JOIN_WINDOW) -> DataFrame:
    ok = counts.where(F.col("passes") >= n_rules).alias("c")
    o = orders.where(F.col("state") == "CREATED").alias("o")
    w = interval(window)
    cond = ((F.col("c.orderId") == F.col("o.id"))
            & (F.col("o.ts") >= F.col("c.reach_ts") - w)
            & (F.col("o.ts") <= F.col("c.session_end") + w))
    j = ok.join(o, cond, "inner")
    return j.select(*[F.col(f"o.{c}") for c in ORDER_COLUMNS if c != "state"],
                    F.lit("VALIDATED").alias("state"), F.col("c.session_start")) \
        .select(*ORDER_COLUMNS, "session_start")


def orders_failed(validations: DataFrame, orders: DataFrame,
                  window: str = S.VALIDATION_JOIN_WINDOW) -> DataFrame:
    f = validations.where(F.col("validationResult") == "FAIL").alias("v")
    o = orders.where(F.col("state") == "CREATED").alias("o")
    w = interval(window)
    cond = ((F.col("v.orderId") == F.col("o.id"))
            & (F.col("v.ts") >= F.col("o.ts") - w) & (F.col("v.ts") <= F.col("o.ts") + w))
    j = f.join(o, cond, "inner")
    # keep the first joined record per order: an aggregate (map-side combined),
    # not a window, so a hot order id never gathers in one task
    first = j.groupBy(F.col("o.id").alias("id")).agg(
        F.min_by(F.struct(*[F.col(f"o.{c}").alias(c) for c in ORDER_COLUMNS if c != "id"]),
                 F.struct(F.col("v.ts"), F.col("v.seq"), F.col("o.ts"), F.col("o.seq"))).alias("o"))
    return first.select("id", "o.customerId", F.lit("FAILED").alias("state"), "o.product",
                        "o.quantity", "o.price")


def order_states(created: DataFrame, validated: DataFrame, failed: DataFrame) -> DataFrame:
    """Every writer of the orders channel: submitted, VALIDATED and FAILED orders."""
    return (created.select(*ORDER_COLUMNS)
            .unionByName(validated.select(*ORDER_COLUMNS))
            .unionByName(failed.select(*ORDER_COLUMNS)))
