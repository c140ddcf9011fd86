"""One table of all sales, online and in store."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

COLUMNS = (
    "transaction_id", "source_system", "product_id", "quantity", "transaction_date", "total_amount",
    "store_id", "customer_id", "status", "payment_method", "discount_pct", "shipping_days",
    "ingested_at",
)


def online_sales(orders: DataFrame) -> DataFrame:
    """Online orders; their amount, store and payment method are unknown."""
    return orders.select(
        F.col("order_id").alias("transaction_id"),
        F.lit("online").alias("source_system"),
        "product_id",
        "quantity",
        F.col("order_date").cast("date").alias("transaction_date"),
        F.lit(None).cast("decimal(18,2)").alias("total_amount"),
        F.lit(None).cast("string").alias("store_id"),
        "customer_id",
        "status",
        F.lit(None).cast("string").alias("payment_method"),
        "discount_pct",
        "shipping_days",
    )


def store_sales(pos: DataFrame) -> DataFrame:
    """Store sales; the amount is in cents, as the tills report it."""
    return pos.select(
        F.col("sale_id").alias("transaction_id"),
        F.lit("pos").alias("source_system"),
        "product_id",
        "quantity",
        F.col("transaction_timestamp").cast("date").alias("transaction_date"),
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
        "store_id",
        F.lit(None).cast("string").alias("customer_id"),
        F.lit("completed").alias("status"),
        "payment_method",
        F.lit(None).cast("int").alias("discount_pct"),
        F.lit(None).cast("int").alias("shipping_days"),
    )


def unified_transactions(
    orders: DataFrame | None, pos: DataFrame | None, ingested_at: dt.datetime | None = None
) -> DataFrame | None:
    """Both sources, either of which may be missing; None when both are. Rows carry the moment they were taken in, by default now."""
    parts = [online_sales(orders)] if orders is not None else []
    if pos is not None:
        parts.append(store_sales(pos))
    if not parts:
        return None
    moment = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return reduce(DataFrame.unionByName, parts).withColumn("ingested_at", moment)
