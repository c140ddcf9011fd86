"""A third of the rows on one customer and product, and a third copies of one row."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline import schemas as S
from shelfline.operators import quality, upsert
from shelfline.plans import analytics, kpis, staging
from shelfline.plans.marts import Models
from shelfline.sources.batches import BatchTable, RawTables

DAY = dt.date(2024, 1, 3)
N = 9000


@pytest.fixture(scope="module")
def tables():
    rng = np.random.default_rng(3)
    people = pd.DataFrame([
        (f"c{i}", "A", f"L{i}", f"u{i // 2 if i > 290 else i}@x.com", f"N{i % 5}", "X", "2023-01-01", 30, "Other")
        for i in range(300)
    ], columns=S.CUSTOMERS.names)
    goods = pd.DataFrame([
        (f"p{i}", f"n{i}", S.CATEGORIES[i % 4], 100 + 7 * i, 5, "X") for i in range(50)
    ], columns=S.PRODUCTS.names)
    lines = pd.DataFrame({
        "order_id": [f"o{i}" for i in range(N)],
        "customer_id": [f"c{k}" for k in rng.integers(0, 320, N)],
        "product_id": [f"p{k}" for k in rng.integers(0, 55, N)],
        "quantity": rng.integers(1, 10, N),
        "order_date": [str(dt.date(2023, 1, 1) + dt.timedelta(int(d))) for d in rng.integers(0, 360, N)],
        "status": rng.choice([" Completed", "pending", "returned"], N),
        "discount_pct": rng.integers(0, 50, N),
        "shipping_days": 3,
    })
    lines.loc[: N // 3, ["customer_id", "product_id"]] = ["c7", "p7"]
    lines.loc[2 * N // 3 :, lines.columns] = lines.iloc[0].to_list()
    return people, goods, lines


@pytest.fixture(scope="module")
def models(spark, tables):
    def batches(pdf, schema):
        df = spark.createDataFrame(pdf.astype(object), schema).withColumn(S.EXEC_DATE, F.lit(DAY)).repartition(8)
        return BatchTable(lambda: df, (DAY,))

    return Models(RawTables(*(batches(p, s) for p, s in zip(tables, (S.CUSTOMERS, S.PRODUCTS, S.ORDERS)))))


@pytest.fixture(scope="module")
def fact(tables):
    people, goods, lines = tables
    people = people.sort_values("customer_id").drop_duplicates("email")
    lines = lines.drop_duplicates().copy()
    lines["status"] = lines["status"].str.strip().str.lower()
    f = lines.merge(people[["customer_id", "country"]], on="customer_id", how="left", indicator="known")
    f = f.merge(goods[["product_id", "category", "price_cents"]], on="product_id", how="left")
    f["gross"] = f.quantity.astype(int) * f.price_cents
    scaled = f.gross * (100 - f.discount_pct.astype(int))
    f["net"] = (scaled + 50) // 100
    return people, f


def test_monthly_revenue(models, fact):
    _, f = fact
    done = f[f.status == "completed"]
    want = done.groupby(done.order_date.str[:7]).agg(n=("order_id", "nunique"), cents=("net", "sum"))
    got = {str(r.month)[:7]: (r.total_orders, round(float(r.net_revenue) * 100)) for r in
           analytics.monthly_sales_trend(models.marts).collect()}
    assert got == {m: (r.n, round(r.cents)) for m, r in want.iterrows()}


def test_dimension_measures(models, fact):
    people, f = fact
    got = {r.customer_id: (r.total_orders, r.lifetime_value_cents) for r in models.dim_customers.collect()}
    assert set(got) == set(people.customer_id)
    mine = f[f.known == "both"]
    for customer, rows in mine.groupby("customer_id"):
        assert got[customer] == (rows.order_id.nunique(), int(rows.gross.sum()))
    sold = {r.product_id: r.total_units_sold for r in models.dim_products.collect()}
    assert sold["p7"] == int(f[f.product_id == "p7"].quantity.sum())


def test_country_kpis(models, fact):
    _, f = fact
    done = f[(f.status == "completed") & (f.known == "both")]
    want = {c: (r.order_id.nunique(), r.customer_id.nunique()) for c, r in done.groupby("country")}
    got = {r.country: (r.total_orders, r.active_customers) for r in kpis.kpis_by_country(models.marts).collect()}
    assert got == want
    everything = kpis.extra_kpis(models.marts).first()
    assert everything.all_orders == f.order_id.nunique()
    assert everything.non_completed == f[f.status != "completed"].order_id.nunique()


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_orders_meet_their_products_in_all_parts(spark, models, fact, broadcast):
    _, f = fact
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows = models.int_orders_enriched.select("order_id", "product_id", "customer_id", "price_cents").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert staging.PART not in models.stg_orders.columns and models.stg_orders.count() == len(f)
    assert len({r.order_id for r in rows if r.product_id == "p7"}) > staging.PARTS
    want = {(o, p if cents == cents else None, c if known == "both" else None, None if cents != cents else int(cents))
            for o, p, c, known, cents in zip(f.order_id, f.product_id, f.customer_id, f.known, f.price_cents)}
    assert len(rows) == len(f) and {tuple(r) for r in rows} == want


def test_repeated_products_and_absent_keys_in_parts(spark):
    schema = "order_id string, customer_id string, product_id string, quantity int, discount_pct int, order_date string, status string, shipping_days int"
    line = ("c1", "p1", 1, 0, "2024-01-01", "pending", 3)
    raw = spark.createDataFrame(
        [("o1", *line), ("o1", *line), ("o2", *line), ("o3", "c1", "p9", *line[2:]), ("o4", "c1", None, *line[2:]), (None, *line)], schema)
    orders = staging.placed_orders(BatchTable(lambda: raw.withColumn(S.EXEC_DATE, F.lit(DAY)), (DAY,)))
    goods = spark.createDataFrame([("p1", 5), ("p1", 6), (None, 7)], "product_id string, price_cents long")
    keyed = goods.withColumnRenamed("product_id", "p_id")
    got = sorted((r.order_id, r.p_id, r.price_cents) for r in staging.with_products(orders, keyed, "p_id").collect() if r.p_id)
    assert got == [("o1", "p1", 5), ("o1", "p1", 6), ("o2", "p1", 5), ("o2", "p1", 6)]
    plain = staging.with_products(orders.drop(staging.PART), keyed, "p_id")
    assert sorted(map(str, plain.collect())) == sorted(map(str, staging.with_products(orders, keyed, "p_id").collect()))
    assert plain.where("order_id = 'o3'").first().p_id is None and plain.count() == 5


def test_duplicates_of_a_hot_id_are_all_held(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("product_id"),
        F.lit("n").alias("name"), F.lit("Food").alias("category"), F.lit(5).cast("bigint").alias("price_cents"))
    clean, held = quality.split(df, quality.product_contract(), "why")
    assert (clean.count(), held.count()) == (4000, 2000)


def test_hot_record_keeps_its_last_change(spark, folder):
    changes = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "0hot").otherwise(F.md5(F.col("id").cast("string"))).alias("record_id"),
        F.col("id").alias("seq"))
    latest = upsert.latest_changes(changes, [F.desc("seq")])
    assert latest.count() == 4001 and latest.where("record_id = '0hot'").first().seq == 5997
