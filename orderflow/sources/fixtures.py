"""Adapters that derive the dataflow's relations from the driver tables.

The test tables are TPC-H-like plus an ``events`` stream; the functions
below map them onto orders, payments, customers, inventory, validations
and changelogs.  Each mapping is a plain projection/filter so Catalyst
prunes columns and pushes filters into the parquet scan.  The same
mappings are written as SQL for the oracle in ``orderflow.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schemas import PRODUCTS, REQUEST_WAIT_US


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, listed anew at every use (files may have been added)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(c: str = "ts") -> Column:
    # Driver tables store timestamps without zone (TIMESTAMP_NTZ); the
    # dataflow works in session-UTC TIMESTAMP so watermarks accept it.
    return F.col(c).cast("timestamp")


def carried(src: DataFrame) -> list[Column]:
    """Marks that a stream puts on its records (``__`` columns) go through every mapping."""
    return [F.col(c) for c in src.columns if c.startswith("__")]


def product_of(event_id: Column) -> Column:
    m = event_id % 3
    return (F.when(m == 0, F.lit(PRODUCTS[0]))
            .when(m == 1, F.lit(PRODUCTS[1]))
            .otherwise(F.lit(PRODUCTS[2])))


def plus_seconds(ts: Column, secs: Column) -> Column:
    # control records of a stream have a time and no numbers: theirs stays as it is
    secs = F.coalesce(secs.cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def orders(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """One CREATED order per event; customer = user, product by id."""
    e = src if src is not None else table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").alias("customerId"),
        F.lit("CREATED").alias("state"),
        product_of(F.col("event_id")).alias("product"),
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("quantity"),
        F.col("value").alias("price"),
        _ts().alias("ts"),
        F.col("event_id").alias("seq"),
        *carried(e),
    )


def raw_orders(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Orders as clients may send them: every state, now and then a negative quantity or price, or no product."""
    o = orders(spark, sf_dir, src)
    n = F.col("seq")
    state = (F.when(n % 7 == 3, "VALIDATED").when(n % 11 == 5, "FAILED").when(n % 13 == 6, "SHIPPED")
             .otherwise("CREATED"))
    return (o.withColumn("state", state)
            .withColumn("quantity", F.when(n % 17 == 2, -F.col("quantity")).otherwise(F.col("quantity")))
            .withColumn("price", F.when(n % 19 == 4, -F.col("price")).otherwise(F.col("price")))
            .withColumn("product", F.when(n % 23 != 8, F.col("product"))))


def burst_orders(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """The orders of a day crowded into its first 40 seconds, so short windows hold several of a customer."""
    o = orders(spark, sf_dir, src)
    return o.withColumn("ts", plus_seconds(F.date_trunc("day", "ts"), F.col("seq") % 40))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer changelog: every customer as first written, then each third one at a new level and address."""
    c = customers(spark, sf_dir).withColumn("seq", F.col("id"))
    again = (c.where(F.col("id") % 3 == 0).withColumn("level", F.lit("platinum"))
             .withColumn("address", F.concat(F.lit("Moved "), F.col("address")))
             .withColumn("seq", F.col("id") + 1_000_000_000))
    return c.unionByName(again)


def half_of_events(events: DataFrame) -> int:
    """The event id from which the later half of the events begins."""
    return ((events.agg(F.max("event_id")).first()[0] or 0) + 1) // 2


def payments(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Payments from -120 s to +120 s around their order, so about half miss its window."""
    e = src if src is not None else table(spark, sf_dir, "events")
    shift = (F.col("event_id") * 37) % 241 - 120
    return e.select(
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("id"),
        F.col("event_id").cast("string").alias("orderId"),
        F.lit("CZK").alias("ccy"),
        (F.col("value") * (F.lit(1) + F.col("event_id") % 5)).alias("amount"),
        plus_seconds(_ts(), shift).alias("ts"),
    )


def customers(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Customers, numbered from 1: orders of customer 0 find none, so inner and left joins differ."""
    c = src if src is not None else table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    level = (F.when(seg == "AUTOMOBILE", "platinum")
             .when(seg == "BUILDING", "gold")
             .when(seg == "FURNITURE", "silver")
             .otherwise("bronze"))
    return c.select(
        (F.col("c_custkey") + 1).alias("id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("firstName"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("lastName"),
        F.concat(F.lit("c"), (F.col("c_custkey") + 1).cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("address"),
        level.alias("level"),
    )


def line_orders(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Demand at scale: one order per line item, product = part key.

    Arrival order per product is (ship date, order key, line number); the
    line number is below 8, so ``seq = orderkey * 8 + linenumber`` keeps
    that order in a single column.
    """
    li = src if src is not None else table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string")).alias("id"),
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _ts("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


def part_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static warehouse stock per part."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product"), (F.col("p_size") * 20).cast("int").alias("stock"))


def inventory_changes(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Changing warehouse stock for the three products (a changelog)."""
    e = src if src is not None else table(spark, sf_dir, "events")
    changes = F.col("event_type") == "signup"
    for mark in carried(e):  # marked records pass
        changes = changes | mark
    e = e.where(changes)
    return e.select(
        product_of(F.col("event_id")).alias("product"),
        (F.col("event_id") % 50).cast("int").alias("stock"),
        _ts().alias("ts"),
        F.col("event_id").alias("seq"),
        *carried(e),
    )


def validations(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Verdicts independent of the checks: three consecutive events judge one order."""
    e = src if src is not None else table(spark, sf_dir, "events")
    m = F.col("event_id") % 3
    check = (F.when(m == 0, "ORDER_DETAILS_CHECK").when(m == 1, "FRAUD_CHECK")
             .otherwise("INVENTORY_CHECK"))
    return e.select(
        ((F.col("event_id") - m) / 3).cast("bigint").cast("string").alias("orderId"),
        check.alias("checkType"),
        F.when(F.col("event_type") == "error", "FAIL").otherwise("PASS").alias("validationResult"),
        _ts().alias("ts"),
        F.col("event_id").alias("seq"),
        *carried(e),
    )


def validated_orders_source(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """The CREATED orders the ``validations`` adapter refers to: each is the basket of its three events -- customer
    of the first, pieces and amount of all, at the time of the first.

    A stream of events cannot close a basket; it reads the table of orders that is derived from the events.
    """
    e = src if src is not None else table(spark, sf_dir, "events")
    n = F.col("event_id")
    first = F.min(F.struct(n.alias("n"), F.col("user_id").alias("u"), _ts().alias("t")))
    pieces = F.sum(F.lit(1) + n % 5).cast("int")
    g = e.groupBy(((n - n % 3) / 3).cast("bigint").alias("k")).agg(
        first.alias("f"), pieces.alias("quantity"), F.max("value").alias("price"))
    return g.select(
        F.col("k").cast("string").alias("id"), F.col("f.u").alias("customerId"), F.lit("CREATED").alias("state"),
        product_of(F.col("k")).alias("product"), "quantity", "price", F.col("f.t").alias("ts"), F.col("f.n").alias("seq"))


def order_states(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Order state records for the latest-value view."""
    o = src if src is not None else table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").alias("customerId"),
        F.when(st == "F", "FAILED").when(st == "P", "VALIDATED").otherwise("CREATED").alias("state"),
        _ts("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
    )


def order_versions(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """The life of the event orders: CREATED, and up to four seconds later VALIDATED or FAILED."""
    e = src if src is not None else table(spark, sf_dir, "events")
    n = F.col("event_id")
    end = F.when(F.col("event_type") == "error", "FAILED").otherwise("VALIDATED")
    life = F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("ms"), F.lit("CREATED").alias("state")),
        F.struct((n * 7919 % 4001).cast("bigint").alias("ms"), end.alias("state"))))
    e = e.select(n.cast("string").alias("id"), F.col("user_id").alias("customerId"), _ts().alias("t"), n.alias("n"),
                 *carried(e), life.alias("x"))
    return e.select("id", "x.state", "customerId", plus_seconds(F.col("t"), F.col("x.ms") / 1000).alias("ts"),
                    (F.col("n") * 2 + F.when(F.col("x.state") == "CREATED", 0).otherwise(1)).alias("seq"), *carried(e))


def order_requests(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """A lookup per event around the time of its order, half of them for terminal states only; every tenth
    asks for an order that does not exist."""
    e = src if src is not None else table(spark, sf_dir, "events")
    n = F.col("event_id")
    return e.select(
        F.concat(F.lit("R"), n).alias("request"),
        F.concat(F.when(n % 10 == 9, "no-").otherwise(""), n).alias("id"),
        (n % 2 == 0).alias("terminal_only"), F.lit(REQUEST_WAIT_US).cast("bigint").alias("wait_us"),
        plus_seconds(_ts(), (n * 104729 % 3001 - 1000) / 1000).alias("ts"), *carried(e))


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed changelog with deletes: a null value is a tombstone."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("k"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("v"),
        _ts().alias("ts"),
        F.col("event_id").alias("seq"),
        *carried(e),
    )
