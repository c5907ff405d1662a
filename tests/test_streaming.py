"""Batch = stream, several micro-batches, restart on the same checkpoint."""

import os

from pyspark.sql import functions as F

from conftest import SF01
from orderflow.operators import checks, inventory
from orderflow.session import scratch_path
from orderflow.sinks import files as sinks
from orderflow.sources import fixtures as fx
from orderflow.sources.readers import stream_table
from orderflow.streaming import stateful
from orderflow.streaming.twins import run_available_now


def _split_events(spark, parts, shuffle_within=False, limit_id=None):
    """Copy events into ``parts`` files by event-time range (in order across files)."""
    e = fx.table(spark, SF01, "events")
    if limit_id is not None:
        e = e.where(F.col("event_id") < limit_id)
    d = scratch_path(spark, "events-split")
    n = e.count()
    step = n // parts + 1
    for i in range(parts):
        chunk = e.where((F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step))
        if shuffle_within:
            chunk = chunk.orderBy(F.rand(7))
        chunk.coalesce(1).write.mode("overwrite").parquet(f"{d}/p{i:02d}")
    return d, e.schema


def _move_into(src_dirs, dst):
    os.makedirs(dst, exist_ok=True)
    for i, s in enumerate(src_dirs):
        for f in os.listdir(s):
            if f.endswith(".parquet"):
                os.link(os.path.join(s, f), os.path.join(dst, f"f{i:02d}-{f}"))


def _stream_dir(spark, d, schema, parts):
    flat = scratch_path(spark, "events-flat")
    _move_into([f"{d}/p{i:02d}" for i in range(parts)], flat)
    return stream_table(spark, schema, flat, "*.parquet", max_files_per_trigger=1), flat


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_fraud_stream_over_many_batches_equals_batch(spark):
    d, schema = _split_events(spark, 4, shuffle_within=True)
    src, _ = _stream_dir(spark, d, schema, 4)
    out = spark.read.parquet(run_available_now(stateful.fraud_sessions(fx.orders(spark, SF01, src=src)),
                                               "t-fraud"))
    cols = ["id", "session_start", "total"]
    assert _rows(out, cols) == _rows(checks.fraud_session_totals(fx.orders(spark, SF01)), cols)


def test_reservation_stream_equals_batch_with_unordered_batches(spark):
    d, schema = _split_events(spark, 3, shuffle_within=True)
    src, _ = _stream_dir(spark, d, schema, 3)
    inv = spark.createDataFrame([("JUMPERS", 400), ("UNDERPANTS", 900), ("STOCKINGS", 10_000)],
                                "product string, stock int")
    rows = fx.orders(spark, SF01, src=src).join(inv, "product")
    out = spark.read.parquet(run_available_now(stateful.reserve_stock(rows), "t-reserve"))
    batch = inventory.reserve_stock(fx.orders(spark, SF01).join(inv, "product"))
    cols = ["id", "validationResult", "reserved"]
    assert _rows(out, cols) == _rows(batch, cols)


def test_restart_resumes_from_checkpoint(spark):
    d, schema = _split_events(spark, 3)
    flat = scratch_path(spark, "events-restart")
    _move_into([f"{d}/p00", f"{d}/p01"], flat)
    sink = scratch_path(spark, "restart-sink")
    ck = scratch_path(spark, "restart-ck")

    def run():
        src = stream_table(spark, schema, flat, "*.parquet", max_files_per_trigger=1)
        q = (stateful.fraud_sessions(fx.orders(spark, SF01, src=src)).writeStream
             .option("checkpointLocation", ck).option("path", sink).format("parquet")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    first = spark.read.parquet(sink).count()
    for f in os.listdir(f"{d}/p02"):
        if f.endswith(".parquet"):
            os.link(os.path.join(f"{d}/p02", f), os.path.join(flat, f"f99-{f}"))
    run()
    out = spark.read.parquet(sink)
    assert out.count() == 10_000 and first < 10_000
    assert out.select("id").distinct().count() == 10_000
    batch = checks.fraud_session_totals(fx.orders(spark, SF01))
    exp = sorted((r["id"], r["total"]) for r in batch.collect())
    assert sorted((r["id"], r["total"]) for r in out.collect()) == exp


def test_idempotent_foreach_batch_skips_replayed_batch(spark):
    path = scratch_path(spark, "idem")
    write = sinks.idempotent_batches(path)
    df = spark.range(5)
    write(df, 0)
    write(df, 0)  # a replay of the same batch id
    write(spark.range(5, 8), 1)
    assert sinks.read_idempotent(spark, path).count() == 8


def test_pass_sessions_merge_when_a_late_event_bridges_two(spark):
    from datetime import timedelta

    from helpers import T0
    from orderflow import schemas as S
    from orderflow.operators.verdicts import pass_counts
    from orderflow.streaming.twins import SENTINEL_US, drop_sentinel

    def rows(spec):
        return spark.createDataFrame(
            [("1", c, r, T0 + timedelta(seconds=t), q) for c, r, t, q in spec], S.ORDER_VALIDATION)

    first = [("FRAUD_CHECK", "PASS", 0, 1), ("INVENTORY_CHECK", "PASS", 500, 2)]  # two sessions
    late = [("ORDER_DETAILS_CHECK", "PASS", 250, 3)]                             # bridges them
    far = T0 + timedelta(microseconds=SENTINEL_US) - (T0 - T0.replace(year=1970, month=1, day=1))
    d = scratch_path(spark, "pass-merge")
    rows(first).coalesce(1).write.parquet(f"{d}/b1")
    rows(late).coalesce(1).write.parquet(f"{d}/b2")
    sentinel = spark.createDataFrame([("s", "FRAUD_CHECK", "PASS", far, -1)], S.ORDER_VALIDATION)
    sentinel.coalesce(1).write.parquet(f"{d}/b3")
    sentinel.coalesce(1).write.parquet(f"{d}/b4")
    flat = scratch_path(spark, "pass-merge-flat")
    _move_into([f"{d}/b1", f"{d}/b2", f"{d}/b3", f"{d}/b4"], flat)
    src = spark.readStream.schema(S.ORDER_VALIDATION).option("maxFilesPerTrigger", 1) \
        .option("pathGlobFilter", "*.parquet").parquet(flat)
    src = src.withColumn("__control", F.col("orderId") == "s")
    v = drop_sentinel(src.withWatermark("ts", "0 seconds"))
    out = spark.read.parquet(run_available_now(stateful.pass_sessions(v), "t-pass-merge"))
    got = [(r["session_start"], r["session_end"], r["verdicts"], r["passes"], r["reach_ts"])
           for r in out.collect()]
    batch = pass_counts(rows(first + late))
    exp = [(r["session_start"], r["session_end"], r["verdicts"], r["passes"], r["reach_ts"])
           for r in batch.collect()]
    assert got == exp == [(T0, T0 + timedelta(seconds=500), 3, 3, T0 + timedelta(seconds=500))]


def _order_file(spark, folder, name, rows):
    from helpers import orders_df
    orders_df(spark, rows).coalesce(1).write.parquet(f"{folder}/{name}")


def _orders_stream(spark, dirs, limit=1):
    from orderflow import schemas as S
    flat = scratch_path(spark, "orders-flat")
    _move_into(dirs, flat)
    return spark.readStream.schema(S.ORDER).option("maxFilesPerTrigger", limit) \
        .option("pathGlobFilter", "*.parquet").parquet(flat)


def test_late_row_within_the_gap_is_kept_three_batches_later(spark):
    # event at 0 s; stream time 3001 s; then, late, an event at 1800 s: its one-hour session is open
    d = scratch_path(spark, "late")
    for i, (id_, at_s) in enumerate([("a", 0), ("x", 3000), ("y", 3001), ("b", 1800)]):
        _order_file(spark, d, f"f{i}", [(id_, 1 if id_ in "ab" else 2, "JUMPERS", 1, 1.0, at_s, i)])
    src = _orders_stream(spark, [f"{d}/f{i}" for i in range(4)])
    out = spark.read.parquet(run_available_now(stateful.fraud_sessions(src), "t-late"))
    assert {r["id"]: r["total"] for r in out.collect()}["b"] == 2.0


def test_nan_price_gives_no_streaming_verdict(spark):
    d = scratch_path(spark, "nan")
    _order_file(spark, d, "f", [("a", 1, "JUMPERS", 1, 1.0, 0, 1), ("b", 1, "JUMPERS", 1, float("nan"), 1, 2),
                                ("c", 1, "JUMPERS", 1, 1.0, 2, 3)])
    v = stateful.fraud_verdicts(stateful.fraud_sessions(_orders_stream(spark, [f"{d}/f"])))
    out = spark.read.parquet(run_available_now(v, "t-nan"))
    assert [(r["orderId"], r["validationResult"]) for r in out.collect()] == [("a", "PASS")]


def test_amounts_beyond_1e17_add_up_in_the_stream(spark):
    d = scratch_path(spark, "big")
    _order_file(spark, d, "f", [("a", 1, "JUMPERS", 1, 1e18, 0, 1), ("b", 1, "JUMPERS", 1, -1e18, 1, 2),
                                ("c", 1, "JUMPERS", 2, 2.5, 2, 3)])
    out = spark.read.parquet(run_available_now(stateful.fraud_sessions(_orders_stream(spark, [f"{d}/f"])), "t-big"))
    assert {r["id"]: r["total"] for r in out.collect()} == {"a": 1e18, "b": 0.0, "c": 5.0}


def test_sentinel_is_dropped_by_its_mark_whatever_the_data_bear(spark):
    from datetime import datetime

    from orderflow.streaming.twins import drop_sentinel
    df = spark.createDataFrame([(datetime(9999, 12, 31), 5, False), (datetime(2024, 1, 1), -1, False),
                                (datetime(2024, 1, 1), None, False), (datetime(2255, 1, 1), 7, True)],
                               "ts timestamp, seq long, __control boolean")
    assert sorted(str(r["seq"]) for r in drop_sentinel(df).collect()) == ["-1", "5", "None"]


def test_stock_in_state_follows_changes_and_survives_a_restart(spark):
    from helpers import at
    from orderflow import schemas as S
    change = "product string, stock int, ts timestamp, seq long"
    d = scratch_path(spark, "evolving")
    _order_file(spark, d, "o0", [("early", 1, "P", 1, 1.0, 0, 1), ("a", 1, "P", 4, 1.0, 20, 2)])
    _order_file(spark, d, "o1", [("b", 1, "P", 4, 1.0, 40, 3), ("c", 1, "P", 1, 1.0, 41, 4)])
    spark.createDataFrame([("P", 5, at(10), 1)], change).coalesce(1).write.parquet(f"{d}/c0")
    spark.createDataFrame([("P", 8, at(30), 2)], change).coalesce(1).write.parquet(f"{d}/c1")
    orders, changes = scratch_path(spark, "evolving-o"), scratch_path(spark, "evolving-c")
    sink, ck = scratch_path(spark, "evolving-sink"), scratch_path(spark, "evolving-ck")
    for i in (0, 1):  # the second run resumes from the first one's checkpoint
        for kind, flat in (("o", orders), ("c", changes)):
            os.makedirs(flat, exist_ok=True)
            src = f"{d}/{kind}{i}"
            for f in os.listdir(src):
                if f.endswith(".parquet"):
                    os.link(os.path.join(src, f), os.path.join(flat, f"{i}-{f}"))
        o = spark.readStream.schema(S.ORDER).parquet(orders)
        c = spark.readStream.schema(change).parquet(changes)
        run_available_now(stateful.reserve_evolving_stock(o, c), "t-evolving", path=sink, checkpoint=ck)
    got = {r["id"]: (r["stock"], r["validationResult"], r["reserved"]) for r in spark.read.parquet(sink).collect()}
    assert got == {"a": (5, "PASS", 4), "b": (8, "PASS", 8), "c": (8, "FAIL", 8)}


def test_replayed_document_batch_does_not_add_documents(spark):
    path = scratch_path(spark, "docs")
    for _ in range(2):
        sinks.document_index(spark.range(3), f"{path}/batch_id=0")
    assert spark.read.text(f"{path}/batch_id=*").count() == 3


def test_side_effect_runs_for_every_batch_and_not_for_a_replayed_one(spark):
    path, told = scratch_path(spark, "effect"), []
    write = sinks.idempotent_batches(path, side_effect=lambda b: told.append(sorted(r.id for r in b.collect())))
    write(spark.range(3), 0)
    write(spark.range(3), 0)     # replayed: written already, nobody is told again
    write(spark.range(3, 5), 1)
    assert told == [[0, 1, 2], [3, 4]] and sinks.read_idempotent(spark, path).count() == 5

    def fails(batch):
        raise RuntimeError("the mail server is down")

    try:
        sinks.idempotent_batches(path, side_effect=fails)(spark.range(9), 2)
    except RuntimeError:
        pass
    assert sinks.read_idempotent(spark, path).count() == 5   # nothing written, so the batch comes again
    sinks.idempotent_batches(path, side_effect=lambda b: told.append("again"))(spark.range(9), 2)
    assert told[-1] == "again" and sinks.read_idempotent(spark, path).count() == 14
