"""Readers and sinks: delimited files, incremental ingest, positions, observation."""

from pyspark.sql import functions as F

from conftest import SF001
from orderflow import schemas as S
from orderflow.session import scratch_path
from orderflow.sinks import files as sinks
from orderflow.sources import fixtures as fx
from orderflow.sources import readers
from orderflow.streaming import twins


def test_delimited_round_trip_keeps_quoted_commas_and_pipes(spark):
    rows = [(1, "Ann", "Lee", "a@x", "12 Main St, Springfield", "platinum"),
            (2, "Bo", "Ng", "b@x", 'Flat 3 | "Rear"', None)]
    df = spark.createDataFrame(rows, S.CUSTOMER)
    path = sinks.write_delimited(spark, df, "delim")
    back = readers.read_delimited(spark, path, S.CUSTOMER)
    assert sorted(back.collect()) == sorted(df.collect())
    keyed = readers.customer_keyed(back).where("id = 2").collect()[0]
    assert keyed["key"] == 2 and keyed["level"] == "bronze"


def test_incremental_ingest_reads_only_new_ids(spark):
    hwm = readers.HighWaterMark(spark, scratch_path(spark, "hwm").rsplit("/", 1)[-1])
    customers = fx.customers(spark, SF001)
    first = readers.incremental(customers.where("id < 100"), "id", hwm.get())
    assert first.count() == customers.where("id < 100").count()
    hwm.commit(first, "id")
    assert hwm.get() == 99
    second = readers.incremental(customers, "id", hwm.get())
    assert second.count() == customers.where("id > 99").count()
    assert second.agg(F.min("id")).collect()[0][0] > 99


def test_record_position_is_exposed(spark):
    df = readers.with_position(spark.read.parquet(f"{SF001}/events.parquet")).limit(1).collect()[0]
    assert df["source_file"].endswith("events.parquet")


def test_stream_observes_stage_counts(spark):
    twins.stream_details_check(spark, SF001)
    n = twins.observed_rows(twins.LAST_RUN["progress"], "s-details-out")
    assert n == fx.raw_orders(spark, SF001).where("state = 'CREATED'").count()


def test_relation_registry(spark):
    r = S.relation("orders")
    assert r.key == ("id",) and r.schema["price"].dataType.typeName() == "double"


def test_record_offsets_count_from_zero_in_each_file(spark):
    rows = readers.with_position(spark.read.parquet(f"{SF001}/orders.parquet")).select("source_offset").collect()
    assert sorted(r[0] for r in rows) == list(range(len(rows)))


def test_an_unreadable_mark_is_an_error_not_a_first_run(spark, tmp_path):
    import pytest
    mark = readers.HighWaterMark(spark, "x", f"nofs://{tmp_path}/mark")
    with pytest.raises(Exception, match="(?i)filesystem|scheme"):
        mark.get()


def test_tables_are_listed_anew(spark):
    d = scratch_path(spark, "grows")
    for n in (10, 20):
        spark.range(n).write.mode("append").parquet(f"{d}/t.parquet")
        last = fx.table(spark, d, "t").count()
    assert last == 30


def test_a_large_destination_is_written_by_several_tasks(spark):
    df = spark.range(400_000).selectExpr("id", "uuid() AS filler", "'gold' AS level")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        path = sinks.route_by_field(spark, df, "level", "large-level")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 400_000
