"""Sinks: append, content-based routing, delimited text, document index,
idempotent micro-batch writes.

Every path defaults to a fresh folder under the shared
``spark.checkpoint.dir`` so executors on any node can reach it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import scratch_path


def route_by_field(spark: SparkSession, df: DataFrame, field: str, name: str,
                   path: str | None = None) -> str:
    """Content-based routing: one write, destination folder = value of ``field``.

    Readers of one destination prune the others (partition filter on
    ``field``).  Rows are rebalanced by ``field`` first: each task writes few
    files, and a destination larger than the advisory partition size is split
    over several tasks instead of gathering in one.
    """
    path = path or scratch_path(spark, name)
    df.hint("rebalance", field).write.mode("append").partitionBy(field).parquet(path)
    return path


def write_delimited(spark: SparkSession, df: DataFrame, name: str, sep: str = "|",
                    path: str | None = None) -> str:
    path = path or scratch_path(spark, name)
    (df.write.mode("overwrite").option("sep", sep).option("quote", '"').option("escape", '"')
     .option("quoteAll", "true").option("header", "false").csv(path))
    return path


def document_index(df: DataFrame, path: str) -> str:
    """One JSON document per record (no upsert: every event is a document).

    ``path`` is the folder of one batch and is replaced as a whole, so a
    replayed batch does not add its documents twice.
    """
    df.select(F.to_json(F.struct(*df.columns)).alias("doc")).write.mode("overwrite").text(path)
    return path


def _written(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def idempotent_batches(path: str, partition_by: list[str] | None = None,
                       side_effect: Callable[[DataFrame], None] | None = None
                       ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer whose rows appear once however often a batch is replayed.

    Each batch lands in ``path/batch_id=<id>``; a replay finds that folder's
    ``_SUCCESS`` file and is skipped, an interrupted write is overwritten.
    The side effect runs before the batch is written, so it happens at least
    once: after a failure between the two it runs again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        if _written(batch.sparkSession, folder):
            return
        if side_effect is not None:
            side_effect(batch)
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(folder)
    return write


def read_idempotent(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*").drop("batch_id")


def outbox(batch: DataFrame, path: str) -> None:
    """The action of a notification: hand every notice of a batch to the outbox, a line each."""
    batch.select(F.to_json(F.struct(*batch.columns)).alias("notice")).write.mode("append").text(path)


def read_outbox(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", schema).alias("n")).select("n.*")
