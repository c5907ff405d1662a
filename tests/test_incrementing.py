"""The incrementing source: batch ranges, stream offsets, restart behind the committed id."""

from orderflow.session import scratch_path
from orderflow.sources.incrementing import largest_id, read_incrementing
from orderflow.streaming.twins import run_available_now

SCHEMA = "id long, name string"


def _table(spark, ids, path=None):
    path = path or scratch_path(spark, "inc-table")
    df = spark.createDataFrame([(i, f"n{i}") for i in ids], SCHEMA)
    df.repartition(3).write.mode("append").parquet(path)
    return path, df.schema


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_batches_do_not_overlap_and_miss_nothing(spark):
    path, schema = _table(spark, [*range(-5, 60), 900, 10 ** 12])
    assert largest_id(path, "id") == 10 ** 12
    parts = [read_incrementing(spark, path, "id", schema, a, b, partitions=4) for a, b in ((None, 7), (7, 58), (58, None))]
    got = [_ids(p) for p in parts]
    assert got[0] == list(range(-5, 8)) and sum(got, []) == [*range(-5, 60), 900, 10 ** 12]
    assert parts[1].rdd.getNumPartitions() == 4
    assert _ids(read_incrementing(spark, path, "id", schema, 10 ** 12)) == []
    assert {r.name for r in read_incrementing(spark, path, "id", schema, 57, 59).collect()} == {"n58", "n59"}


def test_null_ids_and_an_empty_table(spark):
    path, schema = _table(spark, [1, None, 3])
    assert _ids(read_incrementing(spark, path, "id", schema)) == [1, 3]
    empty, _ = _table(spark, [])
    assert _ids(read_incrementing(spark, empty, "id", schema)) == []


def test_a_stream_goes_on_behind_the_committed_id(spark):
    path, schema = _table(spark, range(1, 41))
    sink, ck = scratch_path(spark, "inc-sink"), scratch_path(spark, "inc-ck")

    def run(upto=None):
        s = read_incrementing(spark, path, "id", schema, upto=upto, stream=True)
        run_available_now(s, "t-inc", path=sink, checkpoint=ck)
        return _ids(spark.read.parquet(sink))

    assert run(upto=25) == list(range(1, 26))
    assert run(upto=25) == list(range(1, 26))   # nothing new
    assert run() == list(range(1, 41))          # the rest, once
    _table(spark, range(41, 51), path)          # the table grows
    assert run() == list(range(1, 51))
