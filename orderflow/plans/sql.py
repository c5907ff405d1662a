"""The SQL side of the dataflow as Spark SQL views.

Four statements, created in dependency order (streams, tables, then the
stream-as-select, then the table-as-select), each a named view so later
statements and pull queries can refer to it by name.  Catalyst plans the
whole chain at query time; nothing is materialised unless a sink asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow import schemas as S
from orderflow.operators.enrich import with_default_level

ORDERS_STREAM = "orders_stream"
CUSTOMERS_TABLE = "customers_table"
ORDERS_ENRICHED_STREAM = "orders_enriched_stream"
FRAUD_ORDER_TABLE = "fraud_order"

ENRICHED_SQL = f"""
SELECT {CUSTOMERS_TABLE}.CUSTOMERID AS customerId,
       {CUSTOMERS_TABLE}.FIRSTNAME AS firstName,
       {CUSTOMERS_TABLE}.LASTNAME AS lastName,
       {CUSTOMERS_TABLE}.LEVEL AS level,
       {ORDERS_STREAM}.PRODUCT AS product,
       {ORDERS_STREAM}.QUANTITY AS quantity,
       {ORDERS_STREAM}.PRICE AS price,
       {ORDERS_STREAM}.TS AS ts
FROM {ORDERS_STREAM}
LEFT JOIN {CUSTOMERS_TABLE} ON {ORDERS_STREAM}.CUSTOMERID = {CUSTOMERS_TABLE}.CUSTOMERID
"""


def fraud_sql(window: str = S.FRAUD_TUMBLING_WINDOW, min_count: int = S.FRAUD_MIN_COUNT) -> str:
    # customers missing from the table give a null key; those groups are dropped
    return f"""
SELECT customerId, lastName, firstName, window.start AS window_start,
       window.end AS window_end, COUNT(*) AS counts
FROM {ORDERS_ENRICHED_STREAM}
WHERE customerId IS NOT NULL
GROUP BY window(ts, '{window}'), customerId, lastName, firstName
HAVING COUNT(*) > {min_count}
"""


def _create(spark: SparkSession, name: str, df: DataFrame, replace: bool) -> None:
    if replace or not spark.catalog.tableExists(name):
        df.createOrReplaceTempView(name)


def register_views(spark: SparkSession, orders: DataFrame, customers: DataFrame,
                   window: str = S.FRAUD_TUMBLING_WINDOW, min_count: int = S.FRAUD_MIN_COUNT,
                   replace: bool = True, prefix: str = "") -> dict[str, DataFrame]:
    """Create the four views in order; with ``replace=False`` existing ones are kept.

    View names are those of the session; ``prefix`` keeps several sets apart.
    The customers table is keyed: of several rows of an id the newest (by
    ``seq``) holds.
    """
    o = orders.select(
        "id", orders["customerId"].alias("CUSTOMERID"), "state", "product", "quantity", "price", "ts")
    c = with_default_level(customers).selectExpr(
        "id AS CUSTOMERID", "firstName", "lastName", "email", "address", "level")

    def named(sql: str) -> str:
        for n in (ORDERS_STREAM, CUSTOMERS_TABLE, ORDERS_ENRICHED_STREAM):
            sql = sql.replace(n, prefix + n)
        return sql

    _create(spark, prefix + ORDERS_STREAM, o, replace)
    _create(spark, prefix + CUSTOMERS_TABLE, c, replace)
    _create(spark, prefix + ORDERS_ENRICHED_STREAM, spark.sql(named(ENRICHED_SQL)), replace)
    _create(spark, prefix + FRAUD_ORDER_TABLE, spark.sql(named(fraud_sql(window, min_count))), replace)
    return {n: spark.table(prefix + n) for n in
            (ORDERS_STREAM, CUSTOMERS_TABLE, ORDERS_ENRICHED_STREAM, FRAUD_ORDER_TABLE)}


def enriched_projection(df: DataFrame) -> DataFrame:
    """The columns the enriched stream exposes (its time column stays internal)."""
    return df.select("customerId", "firstName", "lastName", "level", "product", "quantity", "price")
