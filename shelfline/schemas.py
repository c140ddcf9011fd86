"""Entity schemas, value domains and the layouts of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

EXEC_DATE = "_execution_date"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()

CUSTOMERS = _struct(
    customer_id=_S, first_name=_S, last_name=_S, email=_S, country=_S, city=_S,
    signup_date=_S, age=_I, gender=_S,
)
PRODUCTS = _struct(
    product_id=_S, name=_S, category=_S, price_cents=_L, stock_quantity=_I, supplier_country=_S,
)
ORDERS = _struct(
    order_id=_S, customer_id=_S, product_id=_S, quantity=_I, order_date=_S, status=_S,
    discount_pct=_I, shipping_days=_I,
)
POS_SALES = _struct(
    sale_id=_S, store_id=_S, product_id=_S, quantity=_I, unit_price_cents=_L, total_amount=_L,
    transaction_timestamp=_S, payment_method=_S,
)

ENTITIES: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "pos_store_sales": POS_SALES,
}

# Source files, their entity and format.
SOURCE_FORMATS = {
    "customers": "csv",
    "products": "csv",
    "orders": "csv",
    "pos_store_sales": "json",
}

# Natural key and source-system name of each entity in the operational store.
ODS_KEYS = {
    "customers": ("customers", "customer_id"),
    "products": ("products", "product_id"),
    "orders": ("orders", "order_id"),
    "pos_store_sales": ("pos", "sale_id"),
}

# Domains checked by contracts, data tests and the generator.
GENDERS = ("Male", "Female", "Other")
CATEGORIES = ("Electronics", "Clothing", "Food", "Home")
STATUSES = ("completed", "returned", "pending")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Money: one order line, and sums over any number of lines.
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(22, 2)

FACT = _struct(
    order_id=_S, customer_id=_S, product_id=_S, order_date=T.DateType(), quantity=_I, discount_pct=_I,
    status=_S, shipping_days=_I, gross_revenue_dollars=MONEY, net_revenue_dollars=MONEY,
)

ODS = _struct(
    record_id=_S, source_system=_S, source_key=_S, payload=_S,
    upsert_at=T.TimestampType(), batch_id=_S,
)

AUDIT_RUNS = _struct(
    run_id=_S, start_time=T.TimestampType(), end_time=T.TimestampType(), status=_S,
    records_ingested=_L, records_rejected=_L, parquet_file_path=_S,
    duration_seconds=T.DoubleType(), sla_breached=T.BooleanType(), error_message=_S, created_at=T.TimestampType(),
)
