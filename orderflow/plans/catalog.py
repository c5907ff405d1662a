"""Registered batch queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through the adapters in
:mod:`orderflow.sources.fixtures` and applies the operators; its SQL twin
lives in :mod:`orderflow.plans.oracle` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import checks, enrich, inventory, reports, verdicts
from orderflow.plans import sql as sqlplan
from orderflow.sinks import files as sinks
from orderflow.sources import fixtures as fx
from orderflow.sources import readers
from orderflow.sources.incrementing import largest_id, read_incrementing
from orderflow.session import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
ORDER_COLS = verdicts.ORDER_COLUMNS


# ---- the validators on the event orders ----------------------------------------

def own_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Details + fraud + inventory (as-of stock, greedy fold) verdicts, one channel."""
    orders = fx.orders(spark, d)
    inv_rows = inventory.asof_join(checks.created(orders), fx.inventory_changes(spark, d), "product")
    return verdicts.validations_union(
        checks.details_check(orders),
        checks.fraud_check(orders),
        inventory.inventory_check(inv_rows, materialize_input=True),
    )


def order_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: submitted orders -> three validators -> aggregator -> VALIDATED / FAILED.

    The verdict channel is written once (as the validators' shared topic is)
    and read by both aggregator branches.
    """
    orders = fx.orders(spark, d)
    v = materialize(own_verdicts(spark, d), "order-validations")
    counts = verdicts.pass_counts(v)
    ok = verdicts.orders_validated(counts, orders)
    bad = verdicts.orders_failed(v, orders)
    return ok.select(*ORDER_COLS).unionByName(bad.select(*ORDER_COLS))


def _line_stock(spark: SparkSession, d: str) -> DataFrame:
    return inventory.join_stock(fx.line_orders(spark, d), fx.part_inventory(spark, d))


def _asof_stock(spark: SparkSession, d: str) -> DataFrame:
    o = checks.created(fx.orders(spark, d))
    return inventory.asof_join(o, fx.inventory_changes(spark, d), "product")


def _fold_cols(df: DataFrame) -> DataFrame:
    return df.select("id", "product", "quantity", "stock", "validationResult", "reserved")


def _agg_validated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    v = fx.validations(spark, d)
    o = fx.validated_orders_source(spark, d)
    ok = verdicts.orders_validated(verdicts.pass_counts(v), o)
    bad = verdicts.orders_failed(v, o)
    return o, ok, bad


def _enriched(spark: SparkSession, d: str, window: str = S.FRAUD_TUMBLING_WINDOW) -> dict:
    return sqlplan.register_views(spark, fx.orders(spark, d), fx.customers(spark, d), window=window)


def _tumbling(window: str) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        return _enriched(spark, d, window)[sqlplan.FRAUD_ORDER_TABLE]
    return q


def _level_routing_counts(spark: SparkSession, d: str) -> DataFrame:
    by_level = enrich.orders_by_level(fx.orders(spark, d), fx.customers(spark, d))
    path = sinks.route_by_field(spark, by_level, "customerLevel", "orders_by_level")
    return (spark.read.parquet(path).groupBy("customerLevel")
            .agg(F.count(F.lit(1)).alias("orders")))


def _customers_delimited(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.write_delimited(spark, fx.customers(spark, d), "customers_table")
    return readers.read_delimited(spark, path, S.CUSTOMER)


def _customers_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Two ingest runs with a mark of their own: the table up to half its ids, then what is new."""
    state = readers.HighWaterMark(spark, "customers", scratch_path(spark, "hwm-customers"))
    source = fx.customers(spark, d)
    half = (source.agg(F.max("id")).first()[0] or 0) // 2
    runs = []
    for seen in (source.where(F.col("id") <= half), source):  # the source grows between the runs
        rows = materialize(readers.incremental(seen, "id", state.get()), "customers-run")
        state.commit(rows, "id")
        runs.append(rows)
    return readers.customer_keyed(runs[0].unionByName(runs[1]))


def _customers_incremental_source(spark: SparkSession, d: str) -> DataFrame:
    """Two batch reads of the incrementing source, the second behind the last id of the first."""
    path, schema = f"{d.rstrip('/')}/customer.parquet", fx.table(spark, d, "customer").schema
    half = largest_id(path, "c_custkey") // 2
    runs = [read_incrementing(spark, path, "c_custkey", schema, after=a, upto=b) for a, b in ((None, half), (half, None))]
    return readers.customer_keyed(fx.customers(spark, d, src=runs[0].unionByName(runs[1])))


def _orders_by_level_versions(spark: SparkSession, d: str) -> DataFrame:
    """Orders of the first half of the events at the customers' first level, later ones at their newest."""
    events = fx.table(spark, d, "events")
    half = fx.half_of_events(events)
    first = enrich.orders_by_level(fx.orders(spark, d, src=events.where(F.col("event_id") < half)), fx.customers(spark, d))
    later = enrich.orders_by_level(fx.orders(spark, d, src=events.where(F.col("event_id") >= half)), fx.customer_changes(spark, d))
    return first.unionByName(later)


def _details_rejections(spark: SparkSession, d: str) -> DataFrame:
    orders = fx.raw_orders(spark, d)
    rejected = checks.created(orders).where(~checks.order_is_valid()).select("id", "customerId")
    return reports.with_rejections(checks.details_check(orders), rejected)


def _submit(spark: SparkSession, d: str) -> DataFrame:
    return reports.submit(spark, fx.orders(spark, d))


def _orders_channel(spark: SparkSession, d: str) -> DataFrame:
    """The orders channel: submitted orders and, after them, the outcomes its aggregator writes back."""
    created, ok, bad = _agg_validated(spark, d)
    channel = scratch_path(spark, "orders-channel")
    reports.submit(spark, created.select(*ORDER_COLS, F.lit(0).alias("seq")), channel)
    reports.submit(spark, ok.select(*ORDER_COLS, F.lit(1).alias("seq")), channel)
    reports.submit(spark, bad.select(*ORDER_COLS, F.lit(2).alias("seq")), channel)
    return reports.read_channel(spark, channel)


def _channel_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every order of the channel and as many ids it has not got, asked for by terminal state."""
    channel = materialize(_orders_channel(spark, d), "channel")
    asked = channel.select("id").distinct().select(
        F.explode(F.array(F.col("id"), F.concat(F.lit("no-"), F.col("id")))).alias("id"))
    return nullable_id_as_text(reports.lookup(asked, reports.latest(channel, "id"), terminal_only=True))


def _position(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.with_position(fx.table(spark, d, "orders"))
    return rows.select(F.col("o_orderkey").cast("string").alias("id"), "source_file", "source_offset")


def _sql_changelog(spark: SparkSession, d: str) -> DataFrame:
    views = sqlplan.register_views(spark, fx.orders(spark, d), fx.customer_changes(spark, d), prefix="changelog_")
    return sqlplan.enriched_projection(views[sqlplan.ORDERS_ENRICHED_STREAM]).where("customerId IS NOT NULL")


def nullable_id_as_text(df: DataFrame, col: str = "customerId") -> DataFrame:
    """Emit a nullable BIGINT id as text in a registered result.

    Engines hand nullable integers to pandas differently (float with NaN vs.
    a nullable integer type); text keeps every value and null identical.
    """
    return df.withColumn(col, F.col(col).cast("string"))


def _lookup(terminal_only: bool) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        view = reports.latest(fx.order_states(spark, d), "id")
        # every second order id, up to twice as far as there are events: some are unknown
        req = fx.payments(spark, d).select((F.col("orderId").cast("bigint") * 2).cast("string").alias("id")).distinct()
        return nullable_id_as_text(reports.lookup(req, view, terminal_only=terminal_only))
    return q


QUERIES: dict[str, Query] = {
    "orders_created": lambda s, d: checks.created(fx.raw_orders(s, d)),
    "orders_typed_enum": lambda s, d: reports.typed_orders(fx.raw_orders(s, d)).select(
        "id", "state", F.coalesce("product", F.lit("-")).alias("product"), "state_ordinal",
        F.coalesce("product_ordinal", F.lit(-1)).alias("product_ordinal")),
    "details_check": lambda s, d: checks.details_check(fx.raw_orders(s, d)),
    "fraud_session_totals": lambda s, d: checks.fraud_session_totals(fx.orders(s, d)),
    "fraud_session_totals_12h": lambda s, d: checks.fraud_session_totals(fx.orders(s, d), "12 hours"),
    "fraud_check": lambda s, d: checks.fraud_check(fx.orders(s, d)),
    "fraud_check_12h_1000": lambda s, d: checks.fraud_check(fx.orders(s, d), 1000, "12 hours"),
    "fraud_check_1h_500": lambda s, d: checks.fraud_check(fx.orders(s, d), 500, "1 hour"),
    "fraud_session_summary": lambda s, d: checks.fraud_session_totals(fx.orders(s, d))
        .groupBy("customerId", "session_start")
        .agg(F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("orders"),
             F.sum(F.col("order_value").cast("decimal(28,10)")).cast("double").alias("total")),
    "inventory_join": lambda s, d: _line_stock(s, d).select("id", "product", "quantity", "stock"),
    "inventory_asof": lambda s, d: _asof_stock(s, d).select("id", "product", "quantity", "stock", "ts"),
    # the line input is a scan + small join (cheap to read again); the as-of
    # input needs a shuffle and is written once
    "inventory_check": lambda s, d: _fold_cols(inventory.reserve_stock(_line_stock(s, d))),
    "inventory_check_asof": lambda s, d: _fold_cols(
        inventory.reserve_stock(_asof_stock(s, d), materialize_input=True)),
    "reserved_stock": lambda s, d: inventory.reserve_stock(_line_stock(s, d)).groupBy("product").agg(
        F.max("stock").alias("stock"),
        F.sum(F.when(F.col("validationResult") == "PASS", F.col("quantity")).otherwise(0))
        .cast("bigint").alias("reserved"),
        F.count(F.when(F.col("validationResult") == "PASS", 1)).alias("passed"),
        F.count(F.when(F.col("validationResult") == "FAIL", 1)).alias("failed")),
    "reserved_stock_state": lambda s, d: inventory.reserve_stock(_line_stock(s, d))
        .groupBy("product").agg(F.max("reserved").alias("reserved")),
    "reserved_asof_state": lambda s, d: inventory.reserve_stock(_asof_stock(s, d), materialize_input=True)
        .groupBy("product").agg(F.max("reserved").alias("reserved")),
    "order_requests": lambda s, d: nullable_id_as_text(
        reports.answer_requests(fx.order_requests(s, d), fx.order_versions(s, d))),
    "verdict_updates": lambda s, d: verdicts.pass_updates(fx.validations(s, d)),
    "stuck_orders": lambda s, d: reports.stuck_orders(fx.orders(s, d), fx.inventory_changes(s, d)),
    "validations_union": own_verdicts,
    "validation_pass_counts": lambda s, d: verdicts.pass_counts(fx.validations(s, d)),
    "orders_validated": lambda s, d: _agg_validated(s, d)[1],
    "orders_failed": lambda s, d: _agg_validated(s, d)[2],
    "order_states": lambda s, d: verdicts.order_states(*_agg_validated(s, d)),
    "order_outcomes": order_outcomes,
    "orders_latest": lambda s, d: reports.latest(fx.order_states(s, d), "id")
        .select("id", "customerId", "state", "ts"),
    "orders_latest_tombstones": lambda s, d: reports.latest(fx.changelog(s, d), "k", value="v"),
    "order_lookup": _lookup(False),
    "order_lookup_validated": _lookup(True),
    "orders_payments": lambda s, d: enrich.orders_payments(fx.orders(s, d), fx.payments(s, d)),
    "notifications": lambda s, d: enrich.notifications(
        enrich.orders_payments(fx.orders(s, d), fx.payments(s, d)), fx.customers(s, d)),
    "orders_by_level": lambda s, d: enrich.orders_by_level(fx.orders(s, d), fx.customers(s, d)),
    "level_routing_counts": _level_routing_counts,
    "orders_enriched_sql": lambda s, d: nullable_id_as_text(sqlplan.enriched_projection(
        _enriched(s, d)[sqlplan.ORDERS_ENRICHED_STREAM])),
    "orders_enriched_sql_changelog": _sql_changelog,
    "fraud_orders_tumbling": lambda s, d: sqlplan.register_views(
        s, fx.burst_orders(s, d), fx.customers(s, d), prefix="burst_")[sqlplan.FRAUD_ORDER_TABLE],
    "fraud_orders_tumbling_1h": _tumbling("1 hour"),
    "fraud_orders_tumbling_1d": _tumbling("1 day"),
    "fraud_orders_limit": lambda s, d: reports.pull_limit(_tumbling("1 day")(s, d)),
    "product_by_count": lambda s, d: reports.top_terms(fx.orders(s, d)),
    "product_by_count_lines": lambda s, d: reports.top_terms(fx.line_orders(s, d)),
    "search_documents": lambda s, d: reports.search_documents(fx.orders(s, d)),
    "customers_incremental": _customers_incremental,
    "customers_incremental_source": _customers_incremental_source,
    "details_rejections": _details_rejections,
    "orders_by_level_versions": _orders_by_level_versions,
    "customers_delimited": _customers_delimited,
    "topic_sample": lambda s, d: reports.sample(fx.orders(s, d)),
    "submit_orders": _submit,
    "orders_channel_latest": lambda s, d: reports.latest(_orders_channel(s, d), "id").select(*ORDER_COLS),
    "orders_channel_lookup": _channel_lookup,
    "orders_with_position": _position,
}
