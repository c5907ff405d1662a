"""Hand-computed cases for the three validators (FIXTURES §5)."""

import math

from helpers import at, by, orders_df

from orderflow.functions.expressions import limit_branch
from orderflow.operators import checks


def test_details_boundaries(spark):
    o = orders_df(spark, [
        ("q0", 1, "JUMPERS", 0, 1.0, 0, 1),
        ("q-1", 1, "JUMPERS", -1, 1.0, 1, 2),
        ("p0", 1, "JUMPERS", 1, 0.0, 2, 3),
        ("p-", 1, "JUMPERS", 1, -0.01, 3, 4),
        ("nop", 1, None, 1, 1.0, 4, 5),
        ("old", 1, "JUMPERS", -5, 1.0, 5, 6, "VALIDATED"),
    ])
    v = by(checks.details_check(o), "orderId")
    assert {k: r["validationResult"] for k, r in v.items()} == {
        "q0": "PASS", "q-1": "FAIL", "p0": "PASS", "p-": "FAIL", "nop": "FAIL"}
    assert v["q0"]["checkType"] == "ORDER_DETAILS_CHECK"
    assert v["q0"]["ts"] == at(1) and v["q0"]["seq"] == 3


def test_session_gap_is_inclusive(spark):
    # 0:00, 0:05, 0:10:01 with a 5 minute gap: {0:00, 0:05}, {0:10:01}
    o = orders_df(spark, [("a", 7, "JUMPERS", 1, 1.0, 0, 1), ("b", 7, "JUMPERS", 1, 2.0, 300, 2),
                          ("c", 7, "JUMPERS", 1, 4.0, 601, 3)])
    t = by(checks.fraud_session_totals(o, gap="5 minutes"), "id")
    assert t["a"]["session_start"] == t["b"]["session_start"] == at(0)
    assert t["c"]["session_start"] == at(601)
    assert (t["a"]["total"], t["b"]["total"], t["c"]["total"]) == (1.0, 3.0, 4.0)


def test_running_total_limit_is_inclusive(spark):
    # totals 1500, 1999.99, 2000.00 in one session: PASS, PASS, FAIL
    o = orders_df(spark, [("a", 1, "JUMPERS", 1, 1500.0, 0, 1), ("b", 1, "JUMPERS", 1, 499.99, 60, 2),
                          ("c", 1, "JUMPERS", 1, 0.01, 120, 3)])
    v = by(checks.fraud_check(o), "orderId")
    assert [v[k]["validationResult"] for k in "abc"] == ["PASS", "PASS", "FAIL"]


def test_fraud_uses_quantity_times_price_and_keeps_failing(spark):
    o = orders_df(spark, [("a", 1, "JUMPERS", 5, 500.0, 0, 1), ("b", 1, "JUMPERS", 1, 1.0, 10, 2),
                          ("c", 2, "JUMPERS", 1, 1.0, 10, 3)])
    v = by(checks.fraud_check(o), "orderId")
    assert v["a"]["validationResult"] == "FAIL" and v["b"]["validationResult"] == "FAIL"
    assert v["c"]["validationResult"] == "PASS"


def test_nan_takes_neither_branch(spark):
    df = spark.createDataFrame([(float("nan"),), (2000.0,), (1.0,), (None,)], "v double")
    got = [r[0] for r in df.select(limit_branch("v", 2000.0)).collect()]
    assert got == [None, "FAIL", "PASS", None]
    assert math.isnan(float("nan"))


def test_sessions_split_across_buckets_match_single_bucket(spark):
    # one customer, events every 50 minutes for two days: one long session
    rows = [(str(i), 1, "JUMPERS", 1, 1.0, i * 3000, i) for i in range(60)]
    rows += [("late", 1, "JUMPERS", 1, 1.0, 60 * 3000 + 7200, 99)]
    o = orders_df(spark, rows)
    fine = by(checks.fraud_session_totals(o, split="30 minutes"), "id")
    coarse = by(checks.fraud_session_totals(o, split="30 days"), "id")
    assert {k: (r["total"], r["session_start"]) for k, r in fine.items()} == \
        {k: (r["total"], r["session_start"]) for k, r in coarse.items()}
    assert fine["59"]["total"] == 60.0 and fine["59"]["session_start"] == at(0)
    assert fine["late"]["total"] == 1.0


def test_hot_keys_split_on_bursts_and_on_equal_times(spark):
    from pyspark.sql import functions as F
    from orderflow.operators.hotkeys import split_hot
    # 20,000 rows of one key, 95 % of them within one hour, half of those at one time
    rows = spark.range(20_000).selectExpr(
        "1 AS k", "CASE WHEN id < 1000 THEN id * 86400 WHEN id < 10000 THEN 5000 ELSE 5000 + id % 3600 END AS t", "id AS seq")
    rows = rows.unionByName(spark.range(50).selectExpr("2 AS k", "id AS t", "id AS seq"))
    cold, hot = split_hot(rows, ["k"], ["t", "seq"], target_rows=1000)
    assert [r[0] for r in cold.select("k").distinct().collect()] == [2]
    sizes = [r["count"] for r in hot.groupBy("__b").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 4000 and len(sizes) >= 8
    assert split_hot(rows, ["k"], ["t", "seq"], target_rows=1_000_000)[1] is None


def test_hot_keys_keep_sessions_whole(spark):
    o = orders_df(spark, [(str(i), i % 2, "JUMPERS", 1, 1.0, (i // 40) * 1900 + i % 40, i) for i in range(4000)])
    from pyspark.sql import functions as F
    from orderflow.operators.sessions import sessionize
    def run(target):
        r = sessionize(o, "customerId", "ts", ["seq"], "30 minutes", {"run": F.col("quantity")}, target_rows=target)
        return sorted((x["id"], x["session_start"], x["run"]) for x in r.collect())
    assert run(300) == run(10 ** 9)


def test_one_shuffle_without_hot_keys(spark):
    from orderflow.sources import fixtures as fx
    from conftest import SF001
    plan = checks.fraud_check(fx.orders(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_price_is_not_rounded_before_multiplying(spark):
    # 1,000 * 1.999 = 1999 passes; 1,000 * 2.0 fails
    o = orders_df(spark, [("a", 1, "JUMPERS", 1000, 1.999, 0, 1), ("b", 2, "JUMPERS", 1000, 1.996, 0, 2),
                          ("c", 3, "JUMPERS", 1000, 2.0, 0, 3)])
    v = by(checks.fraud_check(o), "orderId")
    assert [v[k]["validationResult"] for k in "abc"] == ["PASS", "PASS", "FAIL"]


def test_nan_and_infinite_prices_do_not_stop_the_job(spark):
    inf = float("inf")
    o = orders_df(spark, [("a", 1, "JUMPERS", 1, 1.0, 0, 1), ("b", 1, "JUMPERS", 1, float("nan"), 1, 2),
                          ("c", 1, "JUMPERS", 1, 5000.0, 2, 3), ("d", 2, "JUMPERS", 1, inf, 0, 4),
                          ("e", 3, "JUMPERS", 1, -inf, 0, 5)])
    v = by(checks.fraud_check(o), "orderId")
    assert {k: r["validationResult"] for k, r in v.items()} == {"a": "PASS", "d": "FAIL", "e": "PASS"}


def test_amounts_beyond_1e17_add_up(spark):
    from orderflow.operators import checks
    o = orders_df(spark, [("a", 1, "JUMPERS", 1, 1e18, 0, 1), ("b", 1, "JUMPERS", 1, -1e18, 1, 2),
                          ("c", 1, "JUMPERS", 2, 2.5, 2, 3), ("d", 1, "JUMPERS", 1, 3e20, 90_000, 4),
                          ("e", 1, "JUMPERS", 1, 1.0, 90_001, 5)])
    got = {r.id: r.total for r in checks.fraud_session_totals(o).collect()}
    assert got == {"a": 1e18, "b": 0.0, "c": 5.0, "d": 3e20, "e": 3e20 + 1.0}
    v = {r.orderId: r.validationResult for r in checks.fraud_check(o).collect()}
    assert v == {"a": "FAIL", "b": "PASS", "c": "PASS", "d": "FAIL", "e": "FAIL"}
