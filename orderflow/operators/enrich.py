"""Enrichment: payments within a time bound, customers, level routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.joins import replicated, within
from orderflow.operators.reports import keyed_table


def with_default_level(customers: DataFrame) -> DataFrame:
    """The customers table: newest row per id, with the declared default level when it is missing."""
    customers = keyed_table(customers, "id")
    if "level" not in customers.columns:
        return customers.withColumn("level", F.lit(S.DEFAULT_LEVEL))
    return customers


def orders_payments(orders: DataFrame, payments: DataFrame,
                    window: str = S.PAYMENT_JOIN_WINDOW) -> DataFrame:
    """Orders ⋈ payments on order id, payment time within +-window (inclusive).

    Payments are joined on ``orderId`` -- never on their own key, which the
    reference's generator sets to one constant value (a single hot key).
    """
    o = orders.alias("o")
    p = payments.alias("p")
    cond = (F.col("o.id") == F.col("p.orderId")) & within(F.col("o.ts"), F.col("p.ts"), window)
    return o.join(p, cond, "inner").select(
        F.col("o.id").alias("orderId"), F.col("p.id").alias("paymentId"),
        F.col("o.customerId"), F.col("o.state"), F.col("o.product"), F.col("o.quantity"),
        F.col("o.price"), F.col("p.ccy"), F.col("p.amount"),
        F.col("o.ts").alias("order_ts"), F.col("p.ts").alias("payment_ts"))


def notifications(order_payments: DataFrame, customers: DataFrame) -> DataFrame:
    """(order, payment) ⋈ customers on the order's customer: one notice per tuple."""
    c = replicated(with_default_level(customers).select(
        F.col("id").alias("c_id"), "firstName", "lastName", "email", "address", "level"))
    j = order_payments.join(c, order_payments["customerId"] == c["c_id"], "inner")
    return j.select("orderId", "paymentId", "customerId", "state", "product", "quantity", "price",
                    "ccy", "amount", "firstName", "lastName", "email", "level")


def orders_by_level(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders ⋈ customers -> (id, customerId, customerLevel)."""
    c = replicated(with_default_level(customers).select(F.col("id").alias("c_id"), "level"))
    j = orders.join(c, orders["customerId"] == c["c_id"], "inner")
    return j.select("id", "customerId", F.col("level").alias("customerLevel"))
