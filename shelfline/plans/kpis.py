"""Dashboard measures over the marts, optionally for one country.

The country filter is applied to the customers before anything is aggregated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfline.functions import money_sum, ratio
from shelfline.plans.analytics import completed, monthly_revenue
from shelfline.plans.marts import Marts


def _orders_of(orders: DataFrame, marts: Marts, country: str | None) -> DataFrame:
    """The orders of a country's current customers; all orders without a country."""
    if country is None:
        return orders
    people = marts.current_customers.where(F.col("country") == country).select("customer_id")
    return orders.join(people, "customer_id")


def kpis(marts: Marts, country: str | None = None, approximate: bool = False) -> DataFrame:
    """Orders, revenue and active customers. ``approximate`` estimates the distinct counts,
    which then need no shuffle of the keys."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return _orders_of(completed(marts), marts, country).agg(
        distinct("order_id").alias("total_orders"),
        F.round(money_sum(F.col("net_revenue_dollars")), 2).alias("total_net_revenue"),
        distinct("customer_id").alias("active_customers"),
    )


def kpis_by_country(marts: Marts) -> DataFrame:
    """The same measures for every country at once."""
    people = marts.current_customers.select("customer_id", "country")
    return completed(marts).join(people, "customer_id").groupBy("country").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.round(money_sum(F.col("net_revenue_dollars")), 2).alias("total_net_revenue"),
        F.count_distinct("customer_id").alias("active_customers"),
    )


def extra_kpis(marts: Marts, country: str | None = None) -> DataFrame:
    """Average order value over all statuses, open or returned orders, and their rate."""
    orders = _orders_of(marts.fct_orders, marts, country)
    # Rolled up per order first: both distinct counts are then plain counts, and one
    # shuffle of partial sums replaces an expansion of every row.
    per_order = orders.groupBy("order_id").agg(
        F.max(F.col("status") != "completed").alias("open"),
        money_sum(F.col("net_revenue_dollars")).alias("revenue"),
    )
    known = F.col("order_id").isNotNull()
    counted = per_order.agg(
        money_sum(F.col("revenue")).alias("revenue"),
        F.count_if(known & F.col("open")).alias("non_completed"),
        F.count_if(known).alias("all_orders"),
    )
    rate = F.col("non_completed") / F.nullif(F.col("all_orders").cast("double"), F.lit(0.0)) * 100
    return counted.select(
        ratio(F.col("revenue"), F.col("all_orders").cast("decimal(20,0)")).alias("avg_order_value"),
        "non_completed",
        "all_orders",
        F.coalesce(rate, F.lit(0.0)).alias("return_rate_pct"),
    )


def monthly_sales(marts: Marts, country: str | None = None) -> DataFrame:
    orders = _orders_of(completed(marts), marts, country)
    return monthly_revenue(orders).withColumn("net_revenue", F.round("net_revenue", 2)).orderBy("month")


def category_revenue(marts: Marts, categories: Sequence[str] | None = None) -> DataFrame:
    """Revenue and units per category. Lines are summed per product before the join."""
    products = marts.products.select("product_id", "category")
    if categories is not None:
        products = products.where(F.col("category").isin(*categories))
    sold = completed(marts).groupBy("product_id").agg(
        money_sum(F.col("net_revenue_dollars")).alias("revenue"), F.sum("quantity").alias("units")
    )
    return (
        sold.join(products, "product_id").groupBy("category")
        .agg(
            F.round(money_sum(F.col("revenue")), 2).alias("total_net_revenue"),
            F.sum("units").alias("total_units_sold"),
        )
        .orderBy(F.desc("total_net_revenue"), "category")
    )


def customer_geography(
    marts: Marts, n: int = 15, all_versions: bool = False, country: str | None = None
) -> DataFrame:
    """Countries by completed revenue."""
    people = marts.customers if all_versions else marts.current_customers
    if country is not None:
        people = people.where(F.col("country") == country)
    revenue = completed(marts).groupBy("customer_id").agg(
        money_sum(F.col("net_revenue_dollars")).alias("revenue")
    )
    return (
        people.select("customer_id", "country").join(revenue, "customer_id")
        .groupBy("country")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            F.round(money_sum(F.col("revenue")), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "country")
        .limit(n)
    )


def categories(marts: Marts) -> DataFrame:
    return marts.products.select("category").distinct().orderBy("category")


def freshness(marts: Marts) -> DataFrame:
    return marts.fct_orders.agg(F.max("order_date").alias("last_order_date"))


def daily_category_revenue(marts: Marts, since: dt.date | None = None) -> DataFrame:
    """Completed revenue per day and category.

    Lines are summed per day and product before the product join.
    """
    lines = completed(marts)
    if since is not None:
        lines = lines.where(F.col("order_date") >= F.lit(since))
    daily = lines.groupBy("order_date", "product_id").agg(
        money_sum(F.col("net_revenue_dollars")).alias("revenue")
    )
    products = marts.products.select("product_id", F.col("category").alias("product_category"))
    return daily.join(products, "product_id").groupBy("order_date", "product_category").agg(
        money_sum(F.col("revenue")).alias("daily_net_revenue")
    )


def recent_category_revenue(marts: Marts, as_of: dt.date, days: int = 90) -> DataFrame:
    return daily_category_revenue(marts, as_of - dt.timedelta(days=days))
