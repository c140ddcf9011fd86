"""The analytics queries over the marts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from shelfline.functions import money_sum, month_component, month_of, percent, ratio
from shelfline.plans.marts import Marts


def _previous(column: str):
    """The month before. Runs on an aggregate of one row per month."""
    return F.lag(column).over(Window.orderBy("month"))


def completed(marts: Marts) -> DataFrame:
    return marts.fct_orders.where(F.col("status") == "completed")


@contextmanager
def completed_once(marts: Marts) -> Iterator[Marts]:
    """The same marts with the completed orders alone, kept while several reports read them."""
    kept = completed(marts).drop("shipping_days", "gross_revenue_dollars").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Marts(lambda: kept, lambda: marts.customers, lambda: marts.products)
    finally:
        kept.unpersist()


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy(month_of(F.col("order_date")).alias("month")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum(F.col("net_revenue_dollars")).alias("net_revenue"),
    )


def monthly_sales_trend(marts: Marts) -> DataFrame:
    """Revenue per month and its growth on the rounded amounts."""
    monthly = monthly_revenue(completed(marts)).withColumn("net_revenue", F.round("net_revenue", 2))
    before = _previous("net_revenue")
    return monthly.withColumn(
        "month_over_month_growth_pct", percent(F.col("net_revenue") - before, before)
    ).orderBy("month")


def monthly_sales_export(marts: Marts) -> DataFrame:
    """The exported form: growth on the amounts before rounding."""
    before = _previous("net_revenue")
    return (
        monthly_revenue(completed(marts))
        .withColumn("month_over_month_growth_pct", percent(F.col("net_revenue") - before, before))
        .withColumn("net_revenue", F.round("net_revenue", 2))
        .orderBy("month")
    )


def _category_totals(marts: Marts) -> DataFrame:
    lines = completed(marts).select("product_id", "order_id", "quantity", "net_revenue_dollars", "discount_pct")
    products = marts.products.select("product_id", "category")
    return lines.join(products, "product_id").groupBy("category").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        money_sum(F.col("net_revenue_dollars")).alias("total_net_revenue"),
        F.sum("discount_pct").cast("decimal(20,0)").alias("_discounts"),
        F.count("discount_pct").cast("decimal(20,0)").alias("_lines"),
    )


def _category_report(totals: DataFrame) -> DataFrame:
    revenue = F.col("total_net_revenue")
    # The window over everything sees one row per category.
    return totals.select(
        "category",
        "total_orders",
        "total_units_sold",
        F.round(revenue, 2).alias("total_net_revenue"),
        ratio(F.col("_discounts"), F.col("_lines")).alias("avg_discount_pct"),
        percent(revenue, F.sum(revenue).over(Window.partitionBy())).alias("revenue_share_pct"),
    ).orderBy(F.desc("total_net_revenue"), "category")


def category_performance(marts: Marts) -> DataFrame:
    """Revenue per category and its share of the rounded total."""
    totals = _category_totals(marts)
    return _category_report(totals.withColumn("total_net_revenue", F.round("total_net_revenue", 2)))


def category_performance_export(marts: Marts) -> DataFrame:
    """The exported form: share of the total before rounding."""
    return _category_report(_category_totals(marts))


def top_customers(marts: Marts, n: int = 10, all_versions: bool = False, country: str | None = None) -> DataFrame:
    """Customers with the most completed revenue.

    Revenue is summed per customer_id before the customers are joined. With
    ``all_versions`` every stored version of a customer counts, so an id with several
    versions of the same attributes adds its revenue once per version.
    """
    revenue = completed(marts).groupBy("customer_id").agg(
        money_sum(F.col("net_revenue_dollars")).alias("revenue")
    )
    people = marts.customers if all_versions else marts.current_customers
    if country is not None:
        people = people.where(F.col("country") == country)
    shown = ("first_name", "last_name", "email", "country", "city")
    return (
        people.select("customer_id", *shown).join(revenue, "customer_id")
        .groupBy("customer_id", *shown)
        .agg(F.round(money_sum(F.col("revenue")), 2).alias("total_net_revenue"))
        .orderBy(F.desc("total_net_revenue"), "customer_id", *shown)
        .limit(n)
        .select(*shown, "total_net_revenue")
    )


def _cohort_report(orders: DataFrame, index=None) -> DataFrame:
    """Completed order rows carrying ``cohort_month``, rolled up by cohort and month index."""
    if index is None:
        index = month_component(F.col("order_date"), F.col("cohort_month"))
    amount = F.col("net_revenue_dollars")
    return (
        orders.groupBy("cohort_month", index.alias("cohort_index"))
        .agg(
            F.count_distinct("customer_id").alias("active_customers"),
            money_sum(amount).alias("total_revenue"),
            F.count(amount).cast("decimal(20,0)").alias("_rows"),
        )
        # The average is per order row, whatever its name says.
        .withColumn("avg_revenue_per_customer", ratio(F.col("total_revenue"), F.col("_rows")))
        .withColumn("total_revenue", F.round("total_revenue", 2))
        .drop("_rows")
        .orderBy("cohort_month", "cohort_index")
    )


def _cohort_lines(marts: Marts) -> DataFrame:
    return completed(marts).select("customer_id", "order_date", "net_revenue_dollars")


def cohort_signup(marts: Marts, all_versions: bool = True) -> DataFrame:
    """Cohorts by the month of signing up."""
    people = marts.customers if all_versions else marts.current_customers
    cohorts = people.select("customer_id", month_of(F.col("signup_date")).alias("cohort_month"))
    return _cohort_report(_cohort_lines(marts).join(cohorts, "customer_id"))


def _first_purchase(marts: Marts) -> DataFrame:
    return _cohort_lines(marts).groupBy("customer_id").agg(
        month_of(F.min("order_date")).alias("cohort_month")
    )


def cohort_first_order(marts: Marts) -> DataFrame:
    """Cohorts by the month of the first completed order."""
    return _cohort_report(_cohort_lines(marts).join(_first_purchase(marts), "customer_id"))


REPORTS = {
    "top_customers": top_customers,
    "monthly_sales": monthly_sales_export,
    "category_performance": category_performance_export,
    "cohort_analysis": cohort_first_order,
}
