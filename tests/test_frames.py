"""Rows reach the stateful processors in data frames, with their nulls and whole numbers as they are."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import at
from orderflow import schemas as S
from orderflow.session import scratch_path
from orderflow.sources import fixtures as fx
from orderflow.streaming import processors, twins
from orderflow.streaming.processors import Framed, Reservation
from test_state_calls import FakeState

BIG = 2 ** 53 + 1


def test_a_frame_keeps_nulls_and_whole_numbers_and_comes_back_as_a_frame():
    inner, handle = Reservation(), FakeState()
    inner.key = "product string"
    p = Framed(inner, "id string, product string, quantity int, stock int, at bigint, seq bigint, "
                      "validationResult string, reserved bigint")
    p.init(handle)
    # at, kind, seq, product, id, quantity, stock, nulls (bits in this order), behind whatever Spark puts before them
    rows = [(0, 7, 0, 1, "P", "", 0, 5, 1 << 4 | 1 << 5), (0, 8, 1, BIG, "P", "a", 2, 0, 1 << 6),
            (0, 8, 1, 0, "P", "b", 0, 0, 1 << 2 | 1 << 5 | 1 << 6), (0, 9, 1, 3, "P", "", 4, 0, 1 << 4 | 1 << 6)]
    assert list(p.handleInputRows((0,), iter([pd.DataFrame(rows[:3]), pd.DataFrame(rows[3:])]), handle)) == []
    out = pd.concat(handle.advance(p, 10 ** 9))
    assert [tuple(r) for r in out.itertuples(index=False)] == [
        ("b", "P", None, 5, 8, None, "PASS", 0), ("a", "P", 2, 5, 8, BIG, "PASS", 2), (None, "P", 4, 5, 9, 3, "FAIL", 2)]


@pytest.mark.parametrize("kind, mode", [("string", "pandas"), ("bigint", "pandas"), ("decimal(10,2)", "row")])
def test_in_order_rows_stream_in_frames(spark, kind, mode):
    """Products, a null one among them, by plain keys in frames; a key of another type goes row by row."""
    end = twins.EndOfInput(spark)

    def stream(rows, schema):
        df = spark.createDataFrame(rows, schema)
        df, d = df.withColumn("product", F.col("product").cast(kind)), scratch_path(spark, "frames")
        df.write.parquet(d)
        s = end.follow(spark.readStream.schema(df.schema).parquet(d), "t")
        return twins.drop_sentinel(s.withWatermark("ts", "1 hour"))

    orders = [("a", 1, "CREATED", "1", 2, 1.0, at(5), BIG), ("b", 1, "CREATED", None, None, 1.0, at(6), None)]
    stock = [("1", 5, at(1), 0), (None, None, at(2), 1)]
    out = processors.reserve_in_order(stream(orders, S.ORDER), stream(stock, "product string, stock int, ts timestamp, seq long"))
    assert ("EventTime, pandas" in out._jdf.queryExecution().logical().toString()) == (mode == "pandas")
    got = spark.read.parquet(twins.run_available_now(out, "t-frames", end=end)).collect()
    assert sorted((r.id, r.product is None, r.quantity, r.stock, r.seq, r.validationResult, r.reserved) for r in got) == [
        ("a", False, 2, 5, BIG, "PASS", 2), ("b", True, None, None, None, "FAIL", 0)]


def test_state_partitions_follow_the_rows_that_reach_the_state(spark, monkeypatch):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        monkeypatch.setattr(fx, "table", lambda *_: type("T", (), {"count": lambda self: 200_000})())
        assert twins.state_partitions(spark, "d", "events") == 4
        assert twins.state_partitions(spark, "d", "events", 3) == min(6, spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
