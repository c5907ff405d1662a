"""The compacted view: bounded reads, tombstones, replays, pruning."""

from orderflow.operators.reports import latest
from orderflow.session import scratch_path
from orderflow.sinks.view import CompactedView

SCHEMA = "id long, v string, seq long"


def _rows(df):
    return sorted((r.id, r.v, r.seq) for r in df.collect())


def _batch(spark, i):
    """Keys written again and again; every seventh batch deletes one for good."""
    rows = [(k, f"b{i}", 10 * i + k) for k in (i % 9, (i * 4) % 9)]
    if i % 7 == 6:
        rows.append((100 + i - 3, None, 10 * i + 9))
    rows.append((100 + i, f"own{i}", 10 * i + 8))
    return spark.createDataFrame(rows, SCHEMA)


def test_read_cost_is_bounded_and_tombstones_vanish(spark):
    view = CompactedView(spark, scratch_path(spark, "view"), "id", SCHEMA, value="v", buckets=4, merge_every=3)
    log = None
    for i in range(10):
        b = _batch(spark, i)
        log = b if log is None else log.unionByName(b)
        view.apply(b, i)
        view.apply(b, i)                     # replayed
        assert len(view._folders()) <= 4     # a snapshot and three batches
    assert _rows(view.current()) == _rows(latest(log, "id", value="v"))
    view.merge()
    assert len(view._folders()) == 1
    assert view._read().where("v IS NULL").count() == 0
    assert _rows(view.current()) == _rows(latest(log, "id", value="v"))


def test_point_reads_prune_to_their_buckets(spark):
    view = CompactedView(spark, scratch_path(spark, "view-point"), "id", SCHEMA, value="v", buckets=8)
    view.apply(spark.createDataFrame([(i, f"v{i}", i) for i in range(200)], SCHEMA), 0)
    view.apply(spark.createDataFrame([(7, "new", 900), (8, None, 901)], SCHEMA), 1)
    got = view.lookup([7, 8, 9, 1000])
    assert _rows(got) == [(7, "new", 900), (9, "v9", 9)]
    one = view.lookup([7])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan or "PartitionFilters: [(__bucket" in plan
    files = {f.split("__bucket=")[1].split("/")[0] for f in one.inputFiles()}
    assert len(files) <= 1 or "PartitionFilters" in plan


def test_an_empty_view(spark):
    view = CompactedView(spark, scratch_path(spark, "view-empty"), "id", SCHEMA)
    assert view.current().count() == 0 and view.lookup([1]).count() == 0
