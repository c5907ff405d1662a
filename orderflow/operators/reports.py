"""Views and reports: latest value per key, lookups, windows, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.expressions import enum_ordinal, micros, parse_enum
from orderflow.session import scratch_path


def latest(changelog: DataFrame, key: str | Sequence[str], seq: str = "seq",
           value: str | None = None) -> DataFrame:
    """Latest record per key (a changelog read as a table).

    ``value``: when given, a latest record whose ``value`` is null is a
    tombstone and the key is absent.  Done as an aggregate (``max_by``), so
    partial aggregation runs before the shuffle and a hot key is cheap.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in changelog.columns if c not in keys]
    agg = changelog.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(seq)).alias("__last"))
    out = agg.select(*keys, *[F.col("__last")[c].alias(c) for c in rest])
    if value is not None:
        out = out.where(F.col(value).isNotNull())
    return out


def keyed_table(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """A changelog as the table it stands for: the newest row per key when it carries its order
    (``seq``), as it is otherwise."""
    return latest(df, key, seq).drop(seq) if seq in df.columns else df


def lookup(requests: DataFrame, view: DataFrame, req_key: str = "id", view_key: str = "id",
           terminal_only: bool = False) -> DataFrame:
    """Answer a set of key lookups against a latest view, as one join.

    A request is answered when the key exists (and, with ``terminal_only``,
    its state is VALIDATED or FAILED); otherwise it stays pending.
    """
    v = view.select(F.col(view_key).alias("__k"), "state", "customerId")
    j = requests.join(v, requests[req_key] == v["__k"], "left")
    hit = F.col("__k").isNotNull()
    if terminal_only:
        hit = hit & F.col("state").isin("VALIDATED", "FAILED")
    return j.select(F.col(req_key).alias("id"), hit.alias("answered"),
                    F.when(hit, F.col("state")).alias("state"),
                    F.when(hit, F.col("customerId")).alias("customerId"))


def answer_requests(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """Lookups that wait for their order: request, id, asked_ts, outcome, answered_ts, state, customerId.

    ``requests``: request, id, terminal_only, wait_us, ts; ``versions``: id,
    state, customerId, ts, seq (the order's changelog).  With the version
    that holds at the request in a wanted state it is ANSWERED at once; else LATE by the
    first later version in a wanted state up to ``wait_us`` after the request; else
    TIMEOUT at that time.  One join and one aggregate by request; only
    versions up to the deadline are joined.
    """
    v = versions.select(F.col("id").alias("__k"), F.struct(micros("ts").alias("t"), F.col("seq").alias("s")).alias("__at"),
                        F.struct("state", "customerId", "ts").alias("__v"))
    asked = micros("ts")
    r = requests.withColumn("__until", asked + F.col("wait_us"))
    j = r.join(v, (F.col("id") == F.col("__k")) & (F.col("__at.t") <= F.col("__until")), "left")
    wanted = ~F.col("terminal_only") | F.col("__v.state").isin("VALIDATED", "FAILED")
    then = F.col("__at.t") <= asked
    g = j.groupBy("request", "id", "ts", "terminal_only", "__until").agg(
        F.max_by(F.when(then, F.struct(F.col("__v").alias("v"), wanted.alias("ok"))),
                 F.when(then, F.col("__at"))).alias("now"),
        F.min_by(F.when(~then & wanted, F.col("__v")), F.when(~then & wanted, F.col("__at"))).alias("later"))
    at_once = F.coalesce(F.col("now.ok"), F.lit(False))
    got = F.when(at_once, F.col("now.v")).otherwise(F.col("later"))
    return g.select(
        "request", "id", F.col("ts").alias("asked_ts"),
        F.when(at_once, "ANSWERED").when(F.col("later").isNotNull(), "LATE").otherwise("TIMEOUT").alias("outcome"),
        F.when(at_once, F.col("ts")).when(F.col("later").isNotNull(), F.col("later.ts"))
        .otherwise(F.timestamp_micros("__until")).alias("answered_ts"),
        got["state"].alias("state"), got["customerId"].alias("customerId"))


def with_rejections(verdicts: DataFrame, rejected: DataFrame) -> DataFrame:
    """Verdicts with the customer (as text) of the order they reject."""
    r = rejected.select(F.col("id").alias("__k"), F.col("customerId").cast("string").alias("rejectedCustomer"))
    return verdicts.join(r, F.col("orderId") == F.col("__k"), "left").select(
        "orderId", "checkType", "validationResult", "rejectedCustomer")


def stuck_orders(orders: DataFrame, inventory_changes: DataFrame) -> DataFrame:
    """Created orders that never get an inventory verdict: no stock row known at their time.

    Only the first stock time of each product matters, a small aggregate.
    """
    o = orders.where(F.col("state") == "CREATED")
    first = inventory_changes.groupBy("product").agg(F.min("ts").alias("__first"))
    j = o.join(first, "product", "left").where(F.col("__first").isNull() | (F.col("ts") < F.col("__first")))
    return j.select("id", "customerId", "product", "quantity", "ts")


def tumbling_counts(enriched: DataFrame, window: str = S.FRAUD_TUMBLING_WINDOW,
                    min_count: int = S.FRAUD_MIN_COUNT, keep_null_keys: bool = False) -> DataFrame:
    """COUNT(*) per epoch-aligned tumbling window and customer, HAVING count > min."""
    df = enriched if keep_null_keys else enriched.where(F.col("customerId").isNotNull())
    g = df.groupBy(F.window("ts", window).alias("w"), "customerId", "lastName", "firstName") \
        .agg(F.count(F.lit(1)).alias("counts"))
    return g.where(F.col("counts") > min_count).select(
        "customerId", "lastName", "firstName", F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"), "counts")


def pull_limit(fraud_order: DataFrame, n: int = S.FRAUD_PULL_LIMIT) -> DataFrame:
    """``SELECT * ... LIMIT n`` made deterministic by a total order (top-k, not a sort)."""
    return (fraud_order.orderBy(F.desc("counts"), "customerId", "window_start")
            .limit(n).select("customerId", "lastName", "firstName", "counts"))


def top_terms(docs: DataFrame, field: str = "product", n: int = S.TOP_PRODUCTS) -> DataFrame:
    """Top-n values of ``field`` by document count (ties by value)."""
    return (docs.groupBy(field).agg(F.count(F.lit(1)).alias("doc_count"))
            .orderBy(F.desc("doc_count"), field).limit(n))


def search_documents(orders: DataFrame) -> DataFrame:
    """Orders as search documents typed like the index mapping (price integer, truncated)."""
    return orders.select("id", "customerId", "state", "product", "quantity",
                         F.col("price").cast("int").alias("price"))


def typed_orders(orders: DataFrame) -> DataFrame:
    """Enum-checked orders: unknown state/product names fail the job."""
    return orders.select(
        "id", parse_enum("state", S.ORDER_STATES, "OrderState").alias("state"),
        parse_enum("product", S.PRODUCTS, "Product").alias("product"),
        enum_ordinal("state", S.ORDER_STATES).alias("state_ordinal"),
        enum_ordinal("product", S.PRODUCTS).alias("product_ordinal"))


def submit(spark: SparkSession, orders: DataFrame, channel: str | None = None) -> DataFrame:
    """Accept submitted orders: check them, append them to the orders channel (a folder), and answer
    each one's resource location.

    An unknown state or product name fails the write, so nothing is accepted.
    """
    channel = channel or scratch_path(spark, "orders-channel")
    checked = orders.withColumn("state", parse_enum("state", S.ORDER_STATES, "OrderState")) \
        .withColumn("product", parse_enum("product", S.PRODUCTS, "Product"))
    batch = f"{channel}/submitted={scratch_path(spark, 'batch').rsplit('/', 1)[1]}"
    checked.write.parquet(batch)
    return spark.read.parquet(batch).select(
        "id", F.concat(F.lit(S.ORDER_LOCATION_PREFIX), F.col("id")).alias("location"))


def read_channel(spark: SparkSession, channel: str) -> DataFrame:
    """All orders appended to a channel so far."""
    return spark.read.option("basePath", channel).parquet(f"{channel}/submitted=*").drop("submitted")


def sample(df: DataFrame, n: int = 5, order: str = "seq") -> DataFrame:
    """The first ``n`` records of a channel in arrival order."""
    return df.orderBy(order).limit(n)
