"""Record types of the order dataflow and the relation registry.

Every relation carries explicit ``ts`` (event time) and ``seq`` (arrival
order, a total order per key) next to its business columns: the records
themselves have no time field, the channel supplies it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for identical results) ------
# Order states, in declaration order.
ORDER_STATES = ("CREATED", "VALIDATED", "FAILED", "SHIPPED")
# Products, in declaration order.
PRODUCTS = ("JUMPERS", "UNDERPANTS", "STOCKINGS")
# Validation check types, in declaration order.
CHECK_TYPES = ("INVENTORY_CHECK", "FRAUD_CHECK", "ORDER_DETAILS_CHECK")
# Validation results, in declaration order.
RESULTS = ("PASS", "FAIL", "ERROR")
# Customer levels (routing destinations); absent level means "bronze".
LEVELS = ("platinum", "gold", "silver", "bronze")
DEFAULT_LEVEL = "bronze"
# Operator constants.
FRAUD_LIMIT = 2000            # session total at or above this fails
FRAUD_SESSION_GAP = "1 hour"  # inactivity gap of the per-customer session
VALIDATION_SESSION_GAP = "5 minutes"
VALIDATION_JOIN_WINDOW = "5 minutes"
PAYMENT_JOIN_WINDOW = "1 minute"
NUMBER_OF_RULES = 3           # PASS verdicts needed to validate an order
FRAUD_TUMBLING_WINDOW = "30 seconds"
FRAUD_MIN_COUNT = 2           # HAVING COUNT(*) > 2
FRAUD_PULL_LIMIT = 10
ORDER_LATENESS = "10 seconds"  # streams of order records: rows this late still count
SQL_GRACE = "24 hours"        # rows this late still enter an SQL window without a grace clause
TOP_PRODUCTS = 20
REQUEST_WAIT_US = 2_000_000   # a lookup waits so long for its order
ORDER_LOCATION_PREFIX = "/v1/orders/"
# --------------------------------------------------------------------------

ORDER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("customerId", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

PAYMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("orderId", T.StringType()),
    T.StructField("ccy", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])

CUSTOMER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("level", T.StringType()),
])

INVENTORY = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("stock", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
])

ORDER_VALIDATION = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("checkType", T.StringType()),
    T.StructField("validationResult", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

ORDER_ENRICHED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("customerId", T.LongType()),
    T.StructField("customerLevel", T.StringType()),
])

FRAUD_ORDER = T.StructType([
    T.StructField("customerId", T.LongType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("counts", T.LongType()),
])


@dataclass(frozen=True)
class Relation:
    """A named typed channel: schema, key columns and time column."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    time: str | None = "ts"


REGISTRY: dict[str, Relation] = {
    r.name: r
    for r in (
        Relation("orders", ORDER, ("id",)),
        Relation("payments", PAYMENT, ("orderId",)),
        Relation("customers", CUSTOMER, ("id",), None),
        Relation("warehouse_inventory", INVENTORY, ("product",)),
        Relation("order_validations", ORDER_VALIDATION, ("orderId",)),
        Relation("orders_enriched", ORDER_ENRICHED, ("id",), None),
        Relation("fraud_order", FRAUD_ORDER, ("customerId",), None),
    )
}


def relation(name: str) -> Relation:
    try:
        return REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown relation {name!r}; known: {sorted(REGISTRY)}") from None
