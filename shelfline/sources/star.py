"""Adapter: retail source entities derived from a TPC-H-like star schema plus events.

Every batch after the first repeats and extends the one before, and some keys carry
planted faults, so that history, quality and reload jobs have something to find.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.sources.batches import BatchTable, RawTables

DAILY = (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3))
# Batch dates spread over the period of the orders, for point-in-time lookups.
YEARLY = (dt.date(1995, 1, 1), dt.date(1997, 6, 1), dt.date(1999, 6, 1))


# The columns the adapter reads. Declared, so that opening a table needs no look at its files.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_discount double, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


class Star:
    """Reads the star tables of one folder and derives the retail entities."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(COLUMNS[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def raw(self) -> RawTables:
        return RawTables(self.customers(), self.products(), self.orders())

    def customers(self, dates: tuple[dt.date, ...] = DAILY) -> BatchTable:
        placed = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

        def batch(day: dt.date) -> DataFrame:
            number = dates.index(day) + 1
            present = {1: "c_custkey % 50 <> 2", 2: "true", 3: "c_custkey % 50 <> 1"}[number]
            moved = "CASE WHEN c_custkey % 10 = 0 THEN 'Moved' ELSE r_name END"
            return placed.where(present).selectExpr(
                "CAST(c_custkey AS STRING) AS customer_id",
                "CASE WHEN c_custkey % 11 = 0 THEN '  Customer ' ELSE 'Customer' END AS first_name",
                "substr(c_name, 10) AS last_name",
                """CASE
                WHEN c_custkey % 97 = 5 THEN concat('customer.', lpad(CAST(c_custkey AS STRING), 9, '0'))
                WHEN c_custkey % 13 = 0
                THEN concat('CUSTOMER.', lpad(CAST(c_custkey AS STRING), 9, '0'), '@EXAMPLE.COM ')
                WHEN c_custkey % 40 = 7
                THEN concat('customer.', lpad(CAST(c_custkey - 1 AS STRING), 9, '0'), '@example.com')
                ELSE concat('customer.', lpad(CAST(c_custkey AS STRING), 9, '0'), '@example.com')
                END AS email""",
                "n_name AS country",
                f"{moved if number >= 2 else 'r_name'} AS city",
                "CAST(date_add(DATE'1995-01-01', CAST(c_custkey * 37 % 2000 AS INT)) AS STRING) AS signup_date",
                "CAST(CASE WHEN c_custkey % 89 = 3 THEN 17 ELSE 18 + c_custkey * 7 % 60 END AS INT) AS age",
                """CASE WHEN c_custkey % 7 = 0 THEN 'Other' WHEN c_custkey % 7 = 6 THEN 'Non-binary'
                WHEN c_custkey % 7 <= 3 THEN 'Male' ELSE 'Female' END AS gender""",
            )

        return BatchTable.of(dates, batch)

    def products(self) -> BatchTable:
        rows = (
            self.table("part")
            .join(self.table("nation"), F.col("p_partkey") % 25 == F.col("n_nationkey"))
            .selectExpr(
                "CAST(p_partkey AS STRING) AS product_id",
                "concat(' ', p_name, ' ') AS name",
                """CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Food' WHEN p_type = 'LARGE' THEN 'Home'
                WHEN p_type = 'MEDIUM' THEN 'Electronics' ELSE 'Clothing' END AS category""",
                """CAST(CASE WHEN p_partkey % 211 = 4 THEN 0 WHEN p_partkey % 223 = 6 THEN -100
                ELSE round(p_retailprice * 100) END AS BIGINT) AS price_cents""",
                "CAST(p_size * 20 AS INT) AS stock_quantity",
                "n_name AS supplier_country",
            )
        )
        return BatchTable.of(DAILY, lambda day: rows)

    def orders(self) -> BatchTable:
        lines = self.table("lineitem")
        heads = self.table("orders")

        def batch(day: dt.date) -> DataFrame:
            number = DAILY.index(day) + 1
            part = lines if number >= 3 else lines.where(F.col("l_orderkey") % 3 < number)
            return part.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
                """concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
                CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
                CAST(CAST(l_shipdate AS DATE) AS STRING)) AS order_id""",
                "CASE WHEN l_orderkey % 313 <> 1 THEN CAST(o_custkey AS STRING) END AS customer_id",
                "CAST(l_partkey AS STRING) AS product_id",
                "CAST(CASE WHEN l_orderkey % 307 = 2 THEN -1 ELSE l_quantity END AS INT) AS quantity",
                "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date",
                """CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN ' pending'
                ELSE 'returned' END AS status""",
                """CAST(CASE WHEN l_orderkey % 311 = 3 THEN 150 ELSE round(l_discount * 500) END AS INT)
                AS discount_pct""",
                "CAST(1 + l_suppkey % 14 AS INT) AS shipping_days",
            )

        return BatchTable.of(DAILY, batch)

    def pos_sales(self) -> DataFrame:
        return self.table("events").where("event_type = 'purchase'").selectExpr(
            "concat('pos-', CAST(event_id AS STRING)) AS sale_id",
            "concat('STORE_', lpad(CAST(user_id % 10 AS STRING), 3, '0')) AS store_id",
            "CAST(event_id % 200 AS STRING) AS product_id",
            "CAST(1 + event_id % 5 AS INT) AS quantity",
            "CAST(round(value * 100) AS BIGINT) AS unit_price_cents",
            "CAST((1 + event_id % 5) * round(value * 100) AS BIGINT) AS total_amount",
            "ts AS transaction_timestamp",
            """CASE event_id % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'cash'
            ELSE 'mobile_wallet' END AS payment_method""",
        )

    def ods_changes(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_type AS source_system",
            "CAST(user_id AS STRING) AS source_key",
            "props AS payload",
            "ts AS upsert_at",
            "concat('micro_', CAST(CAST(ts AS DATE) AS STRING)) AS batch_id",
            "event_id AS seq",
        )
