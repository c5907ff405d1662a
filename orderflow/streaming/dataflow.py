"""The whole validation dataflow as a set of streaming queries.

Wired like the reference's services, decoupled by channels (file sinks in
the shared folder, each with its own commit log):

    orders ─► details check ──────────────────────────────► verdicts/details
           └► fraud sessions (state) ──────────────────────► verdicts/fraud
    stock changes + orders ─► reservation (stock and reserved in state) ─► verdicts/inventory
    verdicts/* ─► updates of PASS counts ─► ⋈ created orders (±5 min) ─► VALIDATED
               └► FAIL ⋈ orders (±5 min) ─► first per order ─► FAILED

``stream_order_outcomes`` runs each query with ``availableNow`` in dependency
order; ``stream_order_outcomes_concurrent`` runs them side by side, with the
outcomes fed back into the orders channel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow import schemas as S
from orderflow.operators import checks, verdicts
from orderflow.session import scratch_path
from orderflow.sinks import files as sinks
from orderflow.sources import fixtures as fx
from orderflow.streaming import processors, stateful
from orderflow.streaming.twins import (SESSION_SCHEMA, EndOfInput, _reserve_in_order, drop_sentinel, failed_orders,
                                       run_available_now, table_stream, validated_orders, validated_stream)


def _channel_stream(spark: SparkSession, paths: list[str], end: EndOfInput | None = None) -> DataFrame:
    """The verdict channel: the union of the validators' sink folders, as a stream."""
    streams = [spark.readStream.schema(S.ORDER_VALIDATION).parquet(p) for p in paths]
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out if end is None else end.follow(out, "verdicts")


def inventory_verdicts(reserved: DataFrame) -> DataFrame:
    return reserved.select(
        F.col("id").alias("orderId"), F.lit("INVENTORY_CHECK").alias("checkType"), "validationResult",
        (F.col("ts") + F.expr("INTERVAL '3' SECOND")).alias("ts"), (F.col("seq") * 3 + 2).alias("seq"))


def run_validators(spark: SparkSession, d: str) -> list[str]:
    base = scratch_path(spark, "verdicts")
    details, fraud, inv = f"{base}/details", f"{base}/fraud", f"{base}/inventory"

    orders = fx.orders(spark, d, src=table_stream(spark, d, "events"))
    run_available_now(checks.details_check(orders), "s-v-details", path=details)

    orders = fx.orders(spark, d, src=table_stream(spark, d, "events"))
    f = stateful.fraud_verdicts(stateful.fraud_sessions(orders))
    run_available_now(f, "s-v-fraud", path=fraud)

    end = EndOfInput(spark)
    inv_v = inventory_verdicts(_reserve_in_order(spark, d, end))
    run_available_now(inv_v, "s-v-inventory", path=inv, end=end)
    return [details, fraud, inv]


def run_aggregator(spark: SparkSession, d: str, channel: list[str]) -> DataFrame:
    # VALIDATED: PASS-count updates ⋈ created orders, stream with stream
    end = EndOfInput(spark)
    v = _channel_stream(spark, channel, end).withWatermark("ts", S.VALIDATION_SESSION_GAP)
    updates = run_available_now(processors.verdict_sessions(drop_sentinel(v), updates=True), "s-agg-updates", end=end)
    orders = fx.orders(spark, d, src=table_stream(spark, d, "events"))
    ok = validated_stream(spark, updates, orders, "s-agg-validated")

    # FAILED: FAIL verdicts ⋈ orders within the window, first per order
    fv = _channel_stream(spark, channel).where(F.col("validationResult") == "FAIL").withWatermark("ts", "10 minutes")
    o = fx.orders(spark, d, src=table_stream(spark, d, "events")).withWatermark("ts", "10 minutes")
    bad = spark.read.parquet(run_available_now(failed_orders(fv, o), "s-agg-failed"))
    cols = verdicts.ORDER_COLUMNS
    return ok.select(*cols).unionByName(bad.select(*cols))


def stream_order_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return run_aggregator(spark, d, run_validators(spark, d))


# ---- the queries side by side, with the cycle -----------------------------------------------

class Channel:
    """A shared folder that several queries append to and read as a stream."""

    def __init__(self, spark: SparkSession, name: str, schema):
        self.spark, self.schema, self.path = spark, schema, scratch_path(spark, name)

    def writer(self, name: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` writer; a replayed batch does not append twice.

        A batch without rows appends no file: in a cycle every file would
        make the readers write another.  It is counted over all its
        partitions, as each of them has its state to commit.
        """
        write = sinks.idempotent_batches(f"{self.path}/{name}")
        columns = [f.name for f in self.schema.fields]

        def append(batch: DataFrame, batch_id: int) -> None:
            rows = batch.select(*columns).persist()
            try:
                if rows.count():
                    write(rows, batch_id)
            finally:
                rows.unpersist()
        return append

    def append(self, rows: DataFrame, name: str) -> None:
        rows.select(*[f.name for f in self.schema.fields]).write.parquet(f"{self.path}/{name}/batch_id=0")

    def stream(self, name: str | None = None) -> DataFrame:
        """All records, or those of one writer, as they come."""
        folder = f"{self.path}/{name}" if name else self.path
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(fs_path)
        return (self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet").parquet(folder))

    def read(self, *names: str) -> DataFrame:
        return (self.spark.read.schema(self.schema).option("recursiveFileLookup", "true")
                .parquet(*[f"{self.path}/{n}" for n in names]))


def settle(queries: list[StreamingQuery]) -> None:
    """Wait until no query has anything left to read: a whole round in which none began a batch with input."""
    def done() -> list[int]:
        return [sum(p.numInputRows > 0 for p in q.recentProgress) for q in queries]

    while True:
        before = done()
        for q in queries:
            q.processAllAvailable()
            if q.exception() is not None:
                raise q.exception()
        if done() == before:
            return


def stream_order_outcomes_concurrent(spark: SparkSession, d: str, trigger: dict | None = None) -> DataFrame:
    """The six queries of the dataflow running together over shared channels.

    Outcomes are appended to the orders channel, which all of them read: the
    CREATED filters cut the cycle.  Each validator's verdicts are a stream with
    a watermark of its own, so the slowest validator sets the pace of the
    sessions and joins and nothing it says is late.  ``trigger``: as for
    ``DataStreamWriter.trigger`` (default: every second).  On a finite input the run ends when
    the progress of all queries shows that nothing is left; then the streams are
    closed one after the other, in the order of the dataflow.
    """
    trigger = trigger or {"processingTime": "1 second"}
    orders = Channel(spark, "orders", S.ORDER)
    said = Channel(spark, "verdicts", S.ORDER_VALIDATION)
    updates = Channel(spark, "verdict-updates", spark.createDataFrame([], SESSION_SCHEMA).schema)
    orders.append(fx.orders(spark, d), "submitted")
    stock_end, verdict_end = EndOfInput(spark), EndOfInput(spark)

    def verdict_streams(lateness: str, end: EndOfInput | None = None) -> DataFrame:
        out = None
        for name in ("details", "fraud", "inventory"):
            s = said.stream(name)
            s = (end.follow(s, name) if end else s).withWatermark("ts", lateness)
            s = drop_sentinel(s) if end else s
            out = s if out is None else out.unionByName(s)
        return out

    # the CREATED filter stands before the control records, which have no state
    created = stock_end.follow(checks.created(orders.stream()), "orders").withWatermark("ts", S.ORDER_LATENESS)
    changes = fx.inventory_changes(spark, d, src=table_stream(spark, d, "events", stock_end)) \
        .withWatermark("ts", S.ORDER_LATENESS)
    reserved = processors.reserve_in_order(drop_sentinel(created), drop_sentinel(changes))
    plans = {
        "details": (checks.details_check(orders.stream()), said),
        "fraud": (stateful.fraud_verdicts(stateful.fraud_sessions(orders.stream())), said),
        "inventory": (inventory_verdicts(reserved), said),
        "sessions": (processors.verdict_sessions(verdict_streams(S.VALIDATION_SESSION_GAP, verdict_end), updates=True), updates),
        "validated": (validated_orders(updates.stream(), orders.stream()), orders),
        "failed": (failed_orders(verdict_streams("10 minutes").where(F.col("validationResult") == "FAIL"),
                                 orders.stream().withWatermark("ts", "10 minutes")), orders),
    }
    queries = []
    try:
        for name, (plan, channel) in plans.items():
            queries.append(plan.writeStream.queryName(f"{name}-{orders.path[-12:]}").outputMode("append")
                           .option("checkpointLocation", scratch_path(spark, f"c-{name}"))
                           .trigger(**trigger).foreachBatch(channel.writer(name)).start())
        settle(queries)
        for end in (stock_end, verdict_end):
            end.announce()
            settle(queries)
    finally:
        for q in queries:
            q.stop()
    return orders.read("validated", "failed").select(*verdicts.ORDER_COLUMNS)
