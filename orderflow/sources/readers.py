"""Readers with a given schema: file streams, delimited files, incremental ingest, record positions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.session import checkpoint_dir


def stream_table(spark: SparkSession, schema: T.StructType, directory: str, file_glob: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of ``directory`` matching ``file_glob`` with a fixed schema."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               stream: bool = True) -> DataFrame:
    """Raw records of a topic (key, value, topic, partition, offset, timestamp).

    Needs the Spark Kafka package on the classpath; decoding the value is the
    caller's (e.g. ``from_avro`` when that package is present too).
    """
    r = (spark.readStream if stream else spark.read).format("kafka")
    return (r.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting).load())


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|") -> DataFrame:
    """A ``sep``-delimited text table; double quotes protect separators and commas."""
    return (spark.read.schema(schema).option("sep", sep).option("quote", '"')
            .option("escape", '"').option("header", "false").csv(path))


def customer_keyed(rows: DataFrame) -> DataFrame:
    """Ingest transforms of the customer connector: key from ``id`` cast to BIGINT."""
    return rows.select(F.col("id").cast("bigint").alias("key"), F.col("id").cast("bigint").alias("id"),
                       "firstName", "lastName", "email", "address",
                       F.coalesce(F.col("level"), F.lit("bronze")).alias("level"))


# ---- incremental ingest ------------------------------------------------------------

def incremental(df: DataFrame, column: str, high_water_mark) -> DataFrame:
    """Rows whose ``column`` exceeds the last ingested value (all rows on the first run)."""
    if high_water_mark is None:
        return df
    return df.where(F.col(column) > F.lit(high_water_mark))


def jdbc_incremental(spark: SparkSession, url: str, table: str, column: str, high_water_mark,
                     properties: dict | None = None, num_partitions: int = 1,
                     upper_bound: int | None = None) -> DataFrame:
    """Incrementing-column JDBC scan: ``SELECT * FROM table WHERE column > hwm``.

    With ``num_partitions > 1`` and a known ``upper_bound`` the scan is split
    into range partitions on ``column`` (parallel reads).
    """
    lo = high_water_mark if high_water_mark is not None else None
    where = f" WHERE {column} > {lo}" if lo is not None else ""
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if num_partitions > 1 and upper_bound is not None:
        sub = f"(SELECT * FROM {table}{where}) t"
        return (reader.option("dbtable", sub).option("partitionColumn", column)
                .option("lowerBound", (lo or 0) + 1).option("upperBound", upper_bound + 1)
                .option("numPartitions", num_partitions).load())
    return reader.option("query", f"SELECT * FROM {table}{where}").load()


class HighWaterMark:
    """The last ingested value of an incrementing column, kept in a folder of the shared checkpoint dir
    (``path`` names another place)."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None):
        self.spark = spark
        self.path = path or f"{checkpoint_dir(spark).rstrip('/')}/hwm/{name}"

    def _last(self):
        try:
            rows = self.spark.read.schema("run long, value long").json(self.path).orderBy(F.desc("run")).limit(1).collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # the first run; anything else is an error
                return None
            raise
        return rows[0] if rows else None

    def get(self):
        last = self._last()
        return last["value"] if last else None

    def commit(self, batch: DataFrame, column: str) -> None:
        """Record the max of ``column`` in ``batch`` (one small row, appended per run)."""
        m = batch.agg(F.max(column).alias("value")).first()["value"]
        if m is None:
            return
        last = self._last()
        run = last["run"] + 1 if last else 1
        self.spark.createDataFrame([(run, m)], "run long, value long").coalesce(1) \
            .write.mode("append").json(self.path)


def with_position(df: DataFrame) -> DataFrame:
    """Where each record was read: its file, and its row number in the file (the offset)."""
    return df.select("*", F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.row_index").alias("source_offset"))
