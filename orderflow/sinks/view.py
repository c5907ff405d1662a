"""A latest-value view that stays cheap to read: a bucketed snapshot and the changes since.

Each batch of changes is written as a folder partitioned by a bucket of the
key; when ``merge_every`` of them have come, snapshot and changes are merged
into the next snapshot -- the newest record per key, deleted keys gone -- in one
shuffle by bucket.  A manifest (see :mod:`orderflow.sinks.transaction`) names
the snapshot and the changes behind it, so a reader takes one version of the
view and opens at most one snapshot and ``merge_every`` folders however many
batches there were.  A read of some keys prunes to their buckets.

Changes carry their order in ``seq``; a record whose ``value`` column is null
deletes its key.  A change older than the snapshot's record of its key loses; one that is
older than a deletion already merged would bring its key back, so changes of
a key must not come more than ``merge_every`` batches late.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.reports import latest
from orderflow.sinks.transaction import Ledger

BUCKET = "__bucket"


class CompactedView:
    def __init__(self, spark: SparkSession, root: str, key: str, schema, value: str | None = None,
                 buckets: int = 16, merge_every: int = 20):
        self.spark, self.ledger, self.key, self.value = spark, Ledger(spark, root), key, value
        self.schema = spark.createDataFrame([], schema).schema
        self.buckets, self.merge_every = buckets, merge_every

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str) -> str:
        folder = f"{kind}/{uuid.uuid4().hex[:12]}"
        rows = rows.withColumn(BUCKET, self._bucket(F.col(self.key)))
        # one file per bucket: its rows meet in one task, large buckets in several (AQE splits the rebalance)
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.ledger.root}/{folder}")
        return folder

    def _folders(self) -> list[str]:
        return [e["outputs"]["rows"] for e in self.ledger.entries()]

    def _read(self, keep: Column | None = None) -> DataFrame:
        """The records of the snapshot and of the changes behind it; ``keep`` is on the bucket."""
        out = None
        schema = self.schema.simpleString()[7:-1].replace(":", " ") + f", {BUCKET} int"
        for folder in self._folders():
            df = self.spark.read.schema(schema).parquet(f"{self.ledger.root}/{folder}")
            df = (df if keep is None else df.where(keep)).drop(BUCKET)
            out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], self.schema) if out is None else out

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Add a batch of changes (once, however often it is replayed); merge when enough have come."""
        entries = self.ledger.entries()
        if entries and entries[-1]["position"]["batch"] >= batch_id:
            return
        rows = latest(changes.select(*self.schema.fieldNames()), self.key)  # a batch's own last record per key
        self.ledger.publish(self._next(entries), {"rows": self._write(rows, "changes")}, {"batch": batch_id})
        if len(entries) + 1 > self.merge_every:
            self.merge()

    def merge(self) -> None:
        entries = self.ledger.entries()
        if len(entries) < 2:
            return
        rows = latest(self._read(), self.key, value=self.value)
        self.ledger.publish(self._next(entries), {"rows": self._write(rows, "snapshots")}, entries[-1]["position"],
                            supersede=True)

    def _next(self, entries: list[dict]) -> int:
        return entries[-1]["batch"] + 1 if entries else 0

    def current(self) -> DataFrame:
        return latest(self._read(), self.key, value=self.value)

    def lookup(self, keys: Sequence) -> DataFrame:
        """The records of some keys; only their buckets are read."""
        wanted = self.spark.createDataFrame([(k,) for k in keys], [self.key]).select(
            F.col(self.key).cast(self.schema[self.key].dataType).alias(self.key))
        buckets = [r[0] for r in wanted.select(self._bucket(F.col(self.key))).distinct().collect()]
        rows = self._read(F.col(BUCKET).isin(buckets)).where(F.col(self.key).isin(list(keys)))
        return latest(rows, self.key, value=self.value)
