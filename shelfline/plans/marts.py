"""Enriched orders, dimensions and the order fact."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions import cents_to_dollars, mask_email, mask_string, net_cents
from shelfline.operators import scd
from shelfline.plans import staging
from shelfline.sources.batches import RawTables

FACT_COLUMNS = (
    "order_id", "customer_id", "product_id", "order_date", "quantity", "discount_pct", "status",
    "shipping_days", "gross_revenue_dollars", "net_revenue_dollars",
)


def int_orders_enriched(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with their customer and product. Keys come from the dimension side, so an
    unmatched order keeps its row and has NULL there."""
    c = customers.select(
        F.col("customer_id").alias("c_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_full_name"),
        F.col("email").alias("customer_email"),
        F.col("country").alias("customer_country"),
        F.col("city").alias("customer_city"),
        F.col("age").alias("customer_age"),
        F.col("gender").alias("customer_gender"),
        F.col("signup_date").alias("customer_signup_date"),
    )
    p = products.select(
        F.col("product_id").alias("p_id"),
        "product_name",
        F.col("category").alias("product_category"),
        "price_cents",
        "stock_quantity",
        F.col("supplier_country").alias("product_supplier_country"),
    )
    gross = F.col("quantity").cast("bigint") * F.col("price_cents")
    joined = staging.with_products(orders, p, "p_id").join(c, F.col("customer_id") == F.col("c_id"), "left")
    return joined.select(
        "order_id", "order_date", "quantity", "discount_pct", "status", "shipping_days",
        F.col("c_id").alias("customer_id"),
        "customer_full_name", "customer_email", "customer_country", "customer_city", "customer_age",
        "customer_gender", "customer_signup_date",
        F.col("p_id").alias("product_id"),
        "product_name", "product_category", "price_cents", "stock_quantity",
        "product_supplier_country",
        gross.alias("gross_revenue_cents"),
        net_cents(gross, F.col("discount_pct")).alias("net_revenue_cents"),
    )


def fct_orders(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn(
        "gross_revenue_dollars", cents_to_dollars(F.col("gross_revenue_cents"))
    ).withColumn(
        "net_revenue_dollars", cents_to_dollars(F.col("net_revenue_cents"))
    ).select(*FACT_COLUMNS)


def customer_attributes(history: DataFrame, mask: bool = False) -> DataFrame:
    """Customer versions without measures."""
    def shown(column: str, masked):
        return (masked(F.col(column)) if mask else F.col(column)).alias(column)

    return history.select(
        F.col("dbt_scd_id").alias("customer_key"),
        "customer_id",
        shown("first_name", mask_string),
        shown("last_name", mask_string),
        shown("email", mask_email),
        "country", "city", "signup_date", "age", "gender",
        "dbt_valid_from", "dbt_valid_to",
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )


def dim_customers(
    history: DataFrame, orders: DataFrame, products: DataFrame, mask: bool = False
) -> DataFrame:
    """Every customer version with the order measures of its customer_id.

    Measures depend on customer_id alone, so they are aggregated before the versions
    are joined: the versions never multiply the orders.
    """
    prices = products.select(F.col("product_id").alias("p_id"), "price_cents")
    worth = F.col("quantity").cast("bigint") * F.col("price_cents")
    measures = staging.with_products(orders, prices, "p_id").groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("n"), F.sum(worth).alias("value")
    )
    return (
        customer_attributes(history, mask)
        .join(measures, "customer_id", "left")
        .withColumn("total_orders", F.coalesce("n", F.lit(0)))
        .withColumn("lifetime_value_cents", F.coalesce("value", F.lit(0)))
        .select(
            "customer_key", "customer_id", "first_name", "last_name", "email", "country", "city",
            "signup_date", "age", "gender", "dbt_valid_from", "dbt_valid_to", "is_current",
            "total_orders", "lifetime_value_cents",
        )
    )


def dim_products(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Products with their order measures, aggregated per product before the join.

    An order id is in one part of its product, so placed orders are counted where they are and the counts of
    the parts add up.
    """
    placed = [c for c in (staging.PART,) if c in orders.columns]
    sold = orders.groupBy("product_id", *placed).agg(
        F.count_distinct("order_id").alias("n"), F.sum("quantity").alias("units")
    )
    if placed:
        sold = sold.groupBy("product_id").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
    units = F.coalesce("units", F.lit(0))
    return products.join(sold, "product_id", "left").select(
        "product_id", "product_name", "category", "price_cents", "stock_quantity",
        "supplier_country",
        F.coalesce("n", F.lit(0)).alias("total_orders"),
        units.alias("total_units_sold"),
        (units * F.col("price_cents")).alias("total_revenue_cents"),
    )


class Marts:
    """What the analytics read: the fact, customer versions and products.

    ``Models.marts`` composes them lazily from the raw batches; ``read`` takes the tables
    that ``Models.write`` stored. Each is only built when a query asks for it, and analytics
    never ask for dimension measures they do not use.
    """

    def __init__(
        self, fct_orders: Callable[[], DataFrame], customers: Callable[[], DataFrame],
        products: Callable[[], DataFrame],
    ):
        self._makers = (fct_orders, customers, products)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._makers[0]()

    @cached_property
    def customers(self) -> DataFrame:
        return self._makers[1]()

    @cached_property
    def products(self) -> DataFrame:
        return self._makers[2]()

    @property
    def current_customers(self) -> DataFrame:
        return self.customers.where("is_current")

    @staticmethod
    def read(spark: SparkSession, root: str) -> "Marts":
        return Marts(
            lambda: spark.read.parquet(f"{root}/fct_orders"),
            lambda: spark.read.parquet(f"{root}/dim_customers"),
            lambda: spark.read.parquet(f"{root}/dim_products"),
        )


class Models:
    """All models over one set of raw tables, each built once and shared by the others."""

    def __init__(self, raw: RawTables):
        self.raw = staging.guarded(raw)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def placed_orders(self) -> DataFrame:
        return staging.placed_orders(self.raw.orders)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self.placed_orders.drop(staging.PART)

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return int_orders_enriched(self.placed_orders, self.stg_customers, self.stg_products)

    @cached_property
    def scd_customers(self) -> DataFrame:
        return scd.versions(staging.customer_batches(self.raw.customers), self.calendar)

    @cached_property
    def calendar(self) -> DataFrame:
        """The batch dates of the customer table with their successors."""
        table = self.raw.customers
        if not table.dates:
            return scd.batch_calendar(table.frame)
        days = sorted(table.dates)
        rows = list(zip(days, [*days[1:], None]))
        return table.frame.sparkSession.createDataFrame(
            rows, "_execution_date date, next_batch date"
        )

    @cached_property
    def fct_orders(self) -> DataFrame:
        return fct_orders(self.int_orders_enriched)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dim_customers(self.scd_customers, self.placed_orders, self.stg_products)

    @cached_property
    def dim_customers_masked(self) -> DataFrame:
        return dim_customers(self.scd_customers, self.placed_orders, self.stg_products, mask=True)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dim_products(self.stg_products, self.placed_orders)

    @cached_property
    def marts(self) -> Marts:
        return Marts(
            lambda: self.fct_orders,
            lambda: customer_attributes(self.scd_customers),
            lambda: self.stg_products,
        )

    def tested(self) -> dict[str, DataFrame]:
        names = (
            "stg_customers", "stg_products", "stg_orders", "int_orders_enriched", "dim_customers",
            "dim_products", "fct_orders",
        )
        return {name: getattr(self, name) for name in names}

    def stored(self, name: str) -> DataFrame:
        """A mart as it is written. The fact has files as even as AQE makes the parts of its last
        join; evening them out would shuffle all orders once more."""
        table = getattr(self, name)
        return table if name == "fct_orders" else table.hint("rebalance")

    def write(self, root: str) -> None:
        """Materialise the marts. Staging stays lazy, except that the staged orders, which all
        three marts read, are kept while they are written: in memory, as far as they fit. Others are made
        again from the files of their shuffle, which are there anyway, and not written a second time."""
        self.placed_orders.persist(StorageLevel.MEMORY_ONLY)
        try:
            for name in ("dim_customers", "dim_products", "fct_orders"):
                self.stored(name).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")
        finally:
            self.placed_orders.unpersist()
