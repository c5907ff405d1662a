"""Processors on named state: event order, waiting lookups, long sessions, state by name, retention."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at
from orderflow import schemas as S
from orderflow.operators import checks, inventory, reports, verdicts
from orderflow.session import scratch_path
from orderflow.streaming import processors, twins
from orderflow.streaming.twins import EndOfInput, drop_sentinel, run_available_now

@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


VERSION = "id string, state string, customerId long, ts timestamp, seq long"
REQUEST = "request string, id string, terminal_only boolean, wait_us long, ts timestamp"


def _stream(spark, rows, schema, files, end=None):
    """The rows as a stream of ``files`` files, one a trigger, then the control records of ``end``."""
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, schema)
    d, rows = scratch_path(spark, "rows"), df.collect()
    for i in range(files):
        spark.createDataFrame(rows[i::files], df.schema).coalesce(1).write.mode("append").parquet(d)
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d)
    return s if end is None else end.follow(s, "t")


def _watermarked(s, lateness):
    return drop_sentinel(s.withWatermark("ts", lateness))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_waiting_lookups_by_hand(spark):
    versions = [("a", "CREATED", 7, at(10), 1), ("a", "FAILED", 7, at(12), 2), ("b", "CREATED", 8, at(20), 3),
                ("b", "VALIDATED", 8, at(23), 4), ("c", "CREATED", 9, at(30), 5)]
    requests = [("r1", "a", False, 2_000_000, at(11)),    # there is a version
                ("r2", "a", False, 2_000_000, at(8)),     # the version comes exactly at the deadline
                ("r3", "a", False, 1_999_999, at(8)),     # one microsecond too late
                ("r4", "a", True, 2_000_000, at(10.5)),   # waits for a terminal state
                ("r5", "b", True, 2_000_000, at(20.5)),   # which comes too late
                ("r6", "b", True, 2_000_000, at(23)),     # at the same time: seen
                ("r7", "none", False, 2_000_000, at(5)), ("r8", "c", True, 2_000_000, at(100))]
    exp = {"r1": ("ANSWERED", at(11), "CREATED"), "r2": ("LATE", at(10), "CREATED"),
           "r3": ("TIMEOUT", at(9.999999), None), "r4": ("LATE", at(12), "FAILED"), "r5": ("TIMEOUT", at(22.5), None),
           "r6": ("ANSWERED", at(23), "VALIDATED"), "r7": ("TIMEOUT", at(7), None), "r8": ("TIMEOUT", at(102), None)}
    batch = reports.answer_requests(spark.createDataFrame(requests, REQUEST), spark.createDataFrame(versions, VERSION))
    random.Random(3).shuffle(versions)
    end = EndOfInput(spark)
    r = _watermarked(_stream(spark, requests[::-1], REQUEST, 2, end), "1 hour")
    v = _watermarked(_stream(spark, versions, VERSION, 3, end), "1 hour")
    got = spark.read.parquet(run_available_now(processors.order_requests(r, v), "t-requests", end=end))
    for df in (batch, got):
        assert {x.request: (x.outcome, x.answered_ts, x.state) for x in df.collect()} == exp
    assert _rows(batch) == _rows(got.select(*batch.columns))


def test_sessions_longer_than_a_day_validate_in_the_stream(spark):
    # verdicts of order A every four minutes for two days: one session; its order lies near the start
    checks = ["FRAUD_CHECK", "ORDER_DETAILS_CHECK", "INVENTORY_CHECK"]
    vals = [("A", checks[i % 3], "PASS", at(240 * i), i) for i in range(720)]
    vals += [("B", c, "PASS", at(10 + i), 1000 + i) for i, c in enumerate(checks)]
    vals += [("B", "FRAUD_CHECK", "PASS", at(2000), 1004), ("C", "FRAUD_CHECK", "PASS", at(3), 1005)]
    orders = [("A", 1, "CREATED", "JUMPERS", 1, 1.0, at(600), 1), ("A", 1, "CREATED", "JUMPERS", 1, 1.0, at(170_000), 2),
              ("B", 2, "CREATED", "JUMPERS", 1, 1.0, at(12), 3), ("C", 3, "CREATED", "JUMPERS", 1, 1.0, at(3), 4)]
    v, o = spark.createDataFrame(vals, S.ORDER_VALIDATION), spark.createDataFrame(orders, S.ORDER)
    batch = verdicts.orders_validated(verdicts.pass_counts(v), o)
    assert [r.id for r in batch.orderBy("id").collect()] == ["A", "A", "B"]
    end = EndOfInput(spark)
    s = _watermarked(_stream(spark, v, None, 3, end), "3 days")
    updates = run_available_now(processors.verdict_sessions(s, updates=True), "t-updates", end=end)
    assert _rows(spark.read.parquet(updates)) == _rows(verdicts.pass_updates(v))
    out = twins.validated_stream(spark, updates, _stream(spark, o, None, 2), "t-validated")
    assert _rows(out) == _rows(batch.select(*out.columns))


def test_reservation_in_event_order_over_any_batches_and_its_state_by_name(spark):
    rnd = random.Random(5)
    orders = [(f"o{i}", 1, "CREATED", rnd.choice("PQ"), rnd.choice([None, 0, 1, 2, 5, 9]), 1.0, at(i // 2), i) for i in range(120)]
    changes = [(rnd.choice("PQ"), rnd.randint(20, 160), at(13 * i + 6), 1000 + i) for i in range(4)]
    kind = "product string, stock int, ts timestamp, seq long"
    o, c = spark.createDataFrame(orders, S.ORDER), spark.createDataFrame(changes, kind)
    batch = inventory.reserve_stock(inventory.asof_join(o, c, "product"))
    rnd.shuffle(orders)
    ck, end = scratch_path(spark, "t-reserve-ck"), EndOfInput(spark)
    s = processors.reserve_in_order(_watermarked(_stream(spark, orders, S.ORDER, 4, end), "1 hour"),
                                    _watermarked(_stream(spark, changes, kind, 2, end), "1 hour"))
    out = spark.read.parquet(run_available_now(s, "t-reserve", checkpoint=ck, end=end))
    cols = ["id", "stock", "validationResult", "reserved"]
    assert _rows(out.select(*cols)) == _rows(batch.select(*cols))
    last = {r.product: r.r for r in batch.groupBy("product").agg(F.max_by("reserved", F.struct("ts", "seq")).alias("r")).collect()}
    assert {r.product: r.units for r in processors.state_table(spark, ck, "reserved").collect()} == last
    newest = {p: s for p, s, _, _ in changes}
    assert {r.product: r.units for r in processors.state_table(spark, ck, "stock").collect()} == newest
    assert processors.state_table(spark, ck, "waiting").count() == 0


def test_null_and_negative_seq_rows_count(spark):
    vals = [("A", "FRAUD_CHECK", "PASS", at(1), None), ("A", "INVENTORY_CHECK", "PASS", at(1), -1),
            ("A", "ORDER_DETAILS_CHECK", "PASS", at(3), 5)]
    end = EndOfInput(spark)
    s = _watermarked(_stream(spark, vals, "orderId string, checkType string, validationResult string, ts timestamp, seq long",
                             1, end), "1 hour")
    out = spark.read.parquet(run_available_now(processors.verdict_sessions(s), "t-null-seq", end=end)).collect()
    assert [(r.verdicts, r.passes, r.session_start) for r in out] == [(3, 3, at(1))]


def test_state_is_dropped_once_the_watermark_has_passed(spark):
    vals = [(f"o{i}", "FRAUD_CHECK", "PASS", at(60 * i), i) for i in range(200)]
    ck = scratch_path(spark, "t-keep-ck")
    # files in time order: by the last one only sessions near the newest verdicts are open
    d = scratch_path(spark, "in-order")
    for i in range(4):
        spark.createDataFrame(vals[50 * i:50 * (i + 1)], S.ORDER_VALIDATION).coalesce(1).write.mode("append").parquet(d)
    s = spark.readStream.schema(S.ORDER_VALIDATION).option("maxFilesPerTrigger", 1).parquet(d).withWatermark("ts", "1 minute")
    run_available_now(processors.verdict_sessions(s), "t-keep", checkpoint=ck)
    held = processors.state_table(spark, ck, "session").count() + processors.state_table(spark, ck, "waiting").count()
    assert 0 < held < 120  # of 200 orders; the rest has left the state


def test_changelog_with_retractions_folds_to_the_sessions(spark):
    rnd = random.Random(9)
    rows = [(f"o{i}", i % 3, "CREATED", "JUMPERS", 1 + i % 4, 2.5, at(rnd.randint(0, 60_000)), i) for i in range(150)]
    # one customer whose two sessions are bridged by the last row to come
    rows += [("x", 9, "CREATED", "JUMPERS", 1, 1.0, at(0), 200), ("y", 9, "CREATED", "JUMPERS", 1, 2.0, at(5000), 201)]
    orders = spark.createDataFrame(rows, S.ORDER)
    bridge = spark.createDataFrame([("z", 9, "CREATED", "JUMPERS", 1, 4.0, at(2500), 202)], S.ORDER)
    d = scratch_path(spark, "changelog")
    for part in (orders.where("seq % 2 = 0"), orders.where("seq % 2 = 1"), bridge):
        part.orderBy(F.rand(3)).coalesce(1).write.mode("append").parquet(d)
    s = spark.readStream.schema(S.ORDER).option("maxFilesPerTrigger", 1).parquet(d).withWatermark("ts", "1 day")
    log = spark.read.parquet(run_available_now(processors.session_changelog(s), "t-changelog"))
    key = ["customerId", "session_start", "session_end"]
    got = reports.latest(log, key, seq="version", value="orders")
    every = orders.unionByName(bridge)
    exp = checks.fraud_session_totals(every).groupBy("customerId", "session_start").agg(
        F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("total"))
    cols = [*key, "orders", "total"]
    assert _rows(got.select(*cols)) == _rows(exp.select(*cols))
    nine = [(r.orders, r.total) for r in got.where("customerId = 9").collect()]
    assert nine == [(3, 7.0)]
    deleted = log.where("customerId = 9 AND orders IS NULL").count()
    assert deleted == 2   # both sessions that the last row merged


def test_a_customer_updated_between_two_batches_shows_in_later_rows_only(spark):
    from orderflow.sinks import files as sinks
    from orderflow.sources.versions import VersionedTable, joined_batches
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    path = scratch_path(spark, "versions-out")
    write = joined_batches(table, lambda o, c: o.join(c, "customerId"), path)

    def customers(level):
        return spark.createDataFrame([(1, level), (2, "gold")], "customerId long, level string")

    def batch(*ids):
        return spark.createDataFrame([(i, 1 + i % 2) for i in ids], "id long, customerId long")

    assert table.publish(customers("silver")) == 1
    write(batch(2, 3), 0)
    assert table.publish(customers("platinum")) == 2
    write(batch(4, 5), 1)
    write(batch(2, 3), 0)   # replayed: keeps what it met
    got = {r.id: r.level for r in sinks.read_idempotent(spark, path).collect()}
    assert got == {2: "silver", 3: "gold", 4: "platinum", 5: "gold"}
