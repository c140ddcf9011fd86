"""Staging models: latest batch, trimmed and typed, deduplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.operators import quality
from shelfline.operators.rows import distinct_on_email
from shelfline.schemas import EXEC_DATE
from shelfline.sources.batches import BatchTable, RawTables

#: The part of its product that an order is in, and their number: a product with most of the orders is not one task's.
PART = "_part"
PARTS = 8


def guarded(raw: RawTables) -> RawTables:
    """The raw tables without the rows the guardrails reject."""
    return RawTables(
        raw.customers.where(quality.passing(quality.customer_guardrail())),
        raw.products.where(quality.passing(quality.product_guardrail())),
        raw.orders.where(quality.passing(quality.order_guardrail())),
    )


def clean_customers(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.lower(F.trim("email")).alias("email"),
        F.trim("country").alias("country"),
        F.trim("city").alias("city"),
        F.col("signup_date").cast("date").alias("signup_date"),
        "age",
        F.trim("gender").alias("gender"),
        EXEC_DATE,
    )


def stg_customers(raw: BatchTable) -> DataFrame:
    """One row per email in the latest batch."""
    return distinct_on_email(clean_customers(raw.latest()))


def customer_batches(raw: BatchTable) -> DataFrame:
    """The same staging applied to every batch on its own."""
    return distinct_on_email(clean_customers(raw.frame), EXEC_DATE)


def stg_products(raw: BatchTable) -> DataFrame:
    return (
        raw.latest()
        .where(F.col("product_id").isNotNull() & (F.col("price_cents") > 0))
        .select(
            "product_id",
            F.trim("name").alias("product_name"),
            F.trim("category").alias("category"),
            "price_cents",
            "stock_quantity",
            F.trim("supplier_country").alias("supplier_country"),
        )
        .distinct()
    )


def clean_orders(rows: DataFrame) -> DataFrame:
    keys = ("customer_id", "product_id", "order_id")
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows.select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "discount_pct",
        F.col("order_date").cast("date").alias("order_date"),
        F.lower(F.trim("status")).alias("status"),
        "shipping_days",
    )


def placed_orders(raw: BatchTable) -> DataFrame:
    """``stg_orders`` by product and ``PART``: the shuffle that finds equal rows also serves a join with products."""
    part = F.pmod(F.xxhash64("order_id"), F.lit(PARTS)).cast("int")
    return clean_orders(raw.latest()).withColumn(PART, part).repartition("product_id", PART).distinct()


def with_products(orders: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Each order with its product, if there is one. ``key`` names the id in ``products``.

    Placed orders stay where they are; a product goes to all parts, once each.
    """
    on = orders["product_id"] == products[key]
    if PART not in orders.columns:
        return orders.join(products, on, "left")
    part = F.explode(F.array(*(F.lit(k) for k in range(PARTS))))
    in_parts = products.withColumn("_in_part", part)
    return orders.join(
        in_parts, (orders["product_id"] == in_parts[key]) & (orders[PART] == in_parts["_in_part"]), "left"
    ).drop(PART, "_in_part")


def stg_orders(raw: BatchTable) -> DataFrame:
    return placed_orders(raw).drop(PART)
