"""Joins with payments/customers, routing, windows, latest view, lookups."""

from datetime import timedelta

from helpers import T0, at, multiset, orders_df

from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import enrich, reports
from orderflow.plans import sql as sqlplan
from orderflow.sinks import files as sinks


def _payments(spark, rows):
    return spark.createDataFrame([(i, o, "CZK", a, T0 + timedelta(seconds=t)) for i, o, a, t in rows],
                                 S.PAYMENT)


def _customers(spark):
    return spark.createDataFrame(
        [(1, "Ann", "A", "a@x", "Street 1, Town", "gold"), (2, "Bob", "B", "b@x", "Road 2", "silver")],
        S.CUSTOMER)


def test_payment_window_is_inclusive(spark):
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 100, 1)])
    p = _payments(spark, [("a", "1", 1.0, 40), ("b", "1", 1.0, 160), ("c", "1", 1.0, 160.000001),
                          ("d", "1", 1.0, 39.999999), ("e", "2", 1.0, 100)])
    got = sorted(r["paymentId"] for r in enrich.orders_payments(o, p).collect())
    assert got == ["a", "b"]


def test_notifications_and_levels(spark):
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1), ("2", 3, "JUMPERS", 1, 1.0, 0, 2)])
    p = _payments(spark, [("a", "1", 5.0, 10), ("b", "2", 5.0, 10)])
    n = enrich.notifications(enrich.orders_payments(o, p), _customers(spark)).collect()
    assert [(r["orderId"], r["email"], r["level"]) for r in n] == [("1", "a@x", "gold")]
    lv = multiset(enrich.orders_by_level(o, _customers(spark)))
    assert lv == [("1", 1, "gold")]


def test_missing_level_defaults_to_bronze(spark):
    c = spark.createDataFrame([(1, "A", "B", "e", "x")], "id long, firstName string, lastName string, "
                              "email string, address string")
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1)])
    assert enrich.orders_by_level(o, c).collect()[0]["customerLevel"] == "bronze"


def test_routing_writes_one_folder_per_level(spark):
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1), ("2", 2, "JUMPERS", 1, 1.0, 0, 2),
                          ("3", 1, "JUMPERS", 1, 1.0, 0, 3)])
    path = sinks.route_by_field(spark, enrich.orders_by_level(o, _customers(spark)), "customerLevel", "t")
    gold = spark.read.parquet(path).where(F.col("customerLevel") == "gold")
    assert sorted(r["id"] for r in gold.collect()) == ["1", "3"]
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "customerLevel" in plan


def test_tumbling_windows_are_epoch_aligned(spark):
    # three orders at :00, :29.999, :30 -> counts 2 and 1; none passes > 2
    enr = spark.createDataFrame([(1, "L", "F", at(0)), (1, "L", "F", at(29.999)), (1, "L", "F", at(30))],
                                "customerId long, lastName string, firstName string, ts timestamp")
    assert reports.tumbling_counts(enr).count() == 0
    got = multiset(reports.tumbling_counts(enr, min_count=0).select("window_start", "counts"))
    assert got == [(at(0), 2), (at(30), 1)]


def test_sql_views_left_join_keeps_unknown_customers(spark):
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1), ("2", 9, "JUMPERS", 1, 1.0, 0, 2)])
    views = sqlplan.register_views(spark, o, _customers(spark))
    rows = multiset(sqlplan.enriched_projection(views[sqlplan.ORDERS_ENRICHED_STREAM])
                    .select("customerId", "level"))
    assert rows == [(None, None), (1, "gold")]


def test_latest_view_put_delete_put(spark):
    ch = spark.createDataFrame([("k", 1.0, 1), ("k", None, 2), ("k", 3.0, 3), ("j", 1.0, 4), ("j", None, 5)],
                               "key string, v double, seq long")
    got = multiset(reports.latest(ch, "key", value="v").select("key", "v"))
    assert got == [("k", 3.0)]


def test_lookup_pending_and_terminal(spark):
    view = spark.createDataFrame([("1", "CREATED", 5), ("2", "VALIDATED", 6)],
                                 "id string, state string, customerId long")
    req = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    got = {r["id"]: r["answered"] for r in reports.lookup(req, view).collect()}
    assert got == {"1": True, "2": True, "3": False}
    got = {r["id"]: r["answered"] for r in reports.lookup(req, view, terminal_only=True).collect()}
    assert got == {"1": False, "2": True, "3": False}


def test_enum_parse_fails_on_unknown(spark):
    import pytest
    o = orders_df(spark, [("1", 1, "SOCKS", 1, 1.0, 0, 1)])
    with pytest.raises(Exception):
        reports.typed_orders(o).collect()
    ok = orders_df(spark, [("1", 1, "STOCKINGS", 1, 1.0, 0, 1)])
    assert reports.submit(spark, ok).collect()[0]["location"] == "/v1/orders/1"


def test_submit_checks_and_appends(spark):
    import pytest
    from orderflow.session import scratch_path
    channel = scratch_path(spark, "channel")
    reports.submit(spark, orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1)]), channel)
    reports.submit(spark, orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 2, "VALIDATED")]), channel)
    for bad in (("2", 1, "SOCKS", 1, 1.0, 0, 3), ("2", 1, "JUMPERS", 1, 1.0, 0, 3, "BOGUS")):
        with pytest.raises(Exception, match="No enum constant"):
            reports.submit(spark, orders_df(spark, [bad]), channel)
    rows = reports.read_channel(spark, channel)
    assert rows.count() == 2
    assert [r["state"] for r in reports.latest(rows, "id").collect()] == ["VALIDATED"]


def test_newest_customer_row_holds_everywhere(spark):
    two = spark.createDataFrame(
        [(1, "Ann", "A", "old@x", "Street 1", "gold", 1), (1, "Ann", "A", "new@x", "Street 2", "silver", 2)],
        "id long, firstName string, lastName string, email string, address string, level string, seq long")
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1)])
    p = _payments(spark, [("a", "1", 5.0, 10)])
    views = sqlplan.register_views(spark, o, two, prefix="two_")
    assert [r["level"] for r in views[sqlplan.ORDERS_ENRICHED_STREAM].collect()] == ["silver"]
    assert [r["email"] for r in enrich.notifications(enrich.orders_payments(o, p), two).collect()] == ["new@x"]
    assert multiset(enrich.orders_by_level(o, two)) == [("1", 1, "silver")]


def test_existing_views_are_kept_without_replace(spark):
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 1.0, 0, 1)])
    sqlplan.register_views(spark, o, _customers(spark), prefix="keep_")
    views = sqlplan.register_views(spark, o.limit(0), _customers(spark), replace=False, prefix="keep_")
    assert views[sqlplan.ORDERS_STREAM].count() == 1


def test_search_documents_truncate_price(spark):
    o = orders_df(spark, [("1", 1, "JUMPERS", 1, 9.99, 0, 1), ("2", 1, "JUMPERS", 1, -1.5, 0, 2)])
    assert multiset(reports.search_documents(o).select("id", "price")) == [("1", 9), ("2", -1)]
