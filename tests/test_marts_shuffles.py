import datetime as dt
import re

from shelfline.plans import marts, staging
from shelfline.sources.batches import BatchTable, RawTables

DAY = dt.date(2024, 1, 1)


def raw_tables(spark):
    """400 orders of five products; some rows come twice, some orders have two rows of one product or two products."""
    rows = [(f"o{i % 300}", f"c{i % 40}", f"p{i % 7}", 1 + i % 4, 0, "2024-01-01", "Completed", 3) for i in range(400)]
    rows += rows[:50] + [("o1", "c1", "p1", 9, 0, "2024-01-01", "Completed", 3), (None, "c1", "p1", 9, 0, "2024-01-01", "Completed", 3)]
    orders = spark.createDataFrame(
        rows, "order_id string, customer_id string, product_id string, quantity int, discount_pct int, order_date string, "
        "status string, shipping_days int"
    )
    products = spark.createDataFrame(
        [(f"p{k}", "name", "Food", 100 + k, 5, "X") for k in range(5)],
        "product_id string, name string, category string, price_cents bigint, stock_quantity int, supplier_country string",
    )
    customers = spark.createDataFrame(
        [(f"c{k}", "A", "B", f"c{k}@x.com", "X", "Y", "2020-01-01", 30, "Male") for k in range(30)],
        "customer_id string, first_name string, last_name string, email string, country string, city string, signup_date string, "
        "age int, gender string",
    )
    tables = [BatchTable.of((DAY,), lambda day, df=df: df) for df in (customers, products, orders)]
    return RawTables(*tables), {r for r in rows if r[0] is not None}


def test_orders_of_a_product_are_counted_where_they_are(spark):
    raw, rows = raw_tables(spark)
    models = marts.Models(raw)
    got = {r.product_id: (r.total_orders, r.total_units_sold) for r in models.dim_products.collect()}
    assert got == {
        p: (len({r[0] for r in rows if r[2] == p}), sum(r[3] for r in rows if r[2] == p)) for p in (f"p{k}" for k in range(5))
    }
    plain = marts.dim_products(models.stg_products, models.stg_orders)
    assert sorted(plain.collect()) == sorted(models.dim_products.collect())
    # no shuffle of products with order ids
    plan = models.dim_products._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(product_id#\d+, order_id#\d+", plan)


def test_kept_orders_are_not_written_to_disk(spark, folder, monkeypatch):
    levels = []
    kind = type(spark.range(1))
    persist = kind.persist

    def noted(df, level):
        levels.append(level)
        return persist(df, level)

    monkeypatch.setattr(kind, "persist", noted)
    raw, rows = raw_tables(spark)
    models = marts.Models(raw)
    models.write(f"{folder}/marts")
    assert len(levels) == 1 and levels[0].useMemory and not levels[0].useDisk
    stored = marts.Marts.read(spark, f"{folder}/marts")
    assert stored.fct_orders.count() == len(rows) == models.placed_orders.count()
    assert staging.PART not in stored.fct_orders.columns
    assert sorted(stored.products.select("product_id", "total_orders").collect()) == sorted(
        models.dim_products.select("product_id", "total_orders").collect()
    )
