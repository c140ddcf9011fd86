import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfline import schemas as S
from shelfline.operators import drift, ingest, quality, unify
from shelfline.sources import export, files, paths, refused
from shelfline.sources.batches import BatchTable
from shelfline.sources.lake import Lake, replace_batch

DAY = dt.date(2026, 7, 14)
CUSTOMER_CSV = (
    "customer_id,first_name,last_name,email,country,city,signup_date,age,gender\n"
    "c1,Ann,Lee,ann@example.com,USA,Rome,2024-01-01,30,Female\n"
)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_goes_by_header_name_and_keeps_bad_numbers_as_null(spark, folder):
    path = put(f"{folder}/c.csv", "age,customer_id,extra\nold,c1,1\n41,007,2\n")
    schema = S._struct(customer_id=S._S, age=S._I)
    got = sorted(map(tuple, files.read_csv(spark, path, schema).collect()))
    assert got == [("007", 41), ("c1", None)]


def test_csv_files_in_other_orders_with_quotes_and_line_breaks(spark, folder):
    put(f"{folder}/in/a.csv", 'customer_id,name,age\nc1,"Ann ""A"", x",30\nc2,"two\nlines",31\n')
    put(f"{folder}/in/b.csv", "age,customer_id\n40,c3\nforty,c4\n,c5\n")
    schema = S._struct(customer_id=S._S, name=S._S, age=S._I)
    got = files.read_csv(spark, f"{folder}/in", schema, multi_line=True, uncast=True).collect()
    assert sorted(map(tuple, got)) == [
        ("c1", 'Ann "A", x', 30, []), ("c2", "two\nlines", 31, []), ("c3", None, 40, []), ("c4", None, None, ["age"]),
        ("c5", None, None, []),
    ]
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, put(f"{folder}/none.csv", ""), schema)


def test_drift_in_the_last_row(spark, folder):
    head = "order_id,customer_id,product_id,quantity,order_date,status,discount_pct,shipping_days\n"
    rows = [f"o{i},c{i},p{i},{i},2024-01-01,completed,0,1\n" for i in range(3000)]
    path = put(f"{folder}/orders.csv", head + "".join(rows) + "o,c,p,two,2024-01-01,completed,0,1\n")
    assert drift.detect_drift(spark, "orders", path, "csv") == [
        ("orders", "critical", "type_mismatch", "quantity", "int64", "string")
    ]
    tagged = quality.with_outcome(files.read_entity(spark, "orders", path, "csv", uncast=True), "orders")
    counts = quality.outcome_counts(tagged).first()
    assert (counts.loaded, counts.rejected, counts.quarantined) == (3000, 0, 1)
    assert tagged.where("outcome = 'quarantined'").first().quarantine_reason == "quantity: coerce_dtype"


def test_json_array(spark, folder):
    path = put(f"{folder}/p.json", json.dumps([{"sale_id": "1", "quantity": 2}, {"sale_id": "2"}]))
    rows = files.read_json(spark, path, S.POS_SALES).orderBy("sale_id").collect()
    assert [(r.sale_id, r.quantity) for r in rows] == [("1", 2), ("2", None)]
    empty = put(f"{folder}/e.json", "[]")
    assert files.read_json(spark, empty, S.POS_SALES).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_json(spark, f"{folder}/none.json", S.POS_SALES).count()


def test_unsupported_type(spark, folder):
    with pytest.raises(ValueError, match="Unsupported file type"):
        files.read_entity(spark, "orders", folder, "xml")
    with pytest.raises(ValueError, match="Unsupported file type"):
        files.read_inferred(spark, folder, "xml")


@pytest.mark.parametrize("text,severity", [
    (CUSTOMER_CSV, "none"),
    ("customer_id,first_name\nc1,Ann\n", "critical"),
    (CUSTOMER_CSV.replace(",30,", ",thirty,"), "critical"),
    (CUSTOMER_CSV.replace(",30,", ",,"), "none"),
    (CUSTOMER_CSV.replace("gender\n", "gender,extra\n").replace("Female\n", "Female,x\n"), "warning"),
])
def test_csv_drift(spark, folder, text, severity):
    path = put(f"{folder}/customers.csv", text)
    assert drift.severity_of(drift.detect_drift(spark, "customers", path, "csv")) == severity


def test_json_and_unknown_drift(spark, folder):
    for text in ("[]", '[{"sale_id":"1"}]'):
        path = put(f"{folder}/pos.json", text)
        found = drift.detect_drift(spark, "pos_store_sales", path, "json")
        assert drift.severity_of(found) == "critical"
    assert drift.detect_drift(spark, "weather", path, "json") == []
    assert drift.detect_drift(spark, "customers", path, "xml") == []


def test_critical_drift_moves_the_file_and_stops(spark, folder):
    path = put(f"{folder}/raw/customers.csv", "customer_id\nc1\n")
    with pytest.raises(drift.SchemaDriftError):
        drift.stop_on_drift(spark, "customers", path, "csv", f"{folder}/rejected_schemas")
    assert not os.path.exists(path) and os.path.exists(f"{folder}/rejected_schemas/customers.csv")


def test_lake_paths_and_drop(spark, folder):
    lake = Lake(spark, folder)
    assert lake.path("customers", DAY).endswith("customers/year=2026/month=07/day=14")
    df = spark.createDataFrame([("p1", "a", "Food", 5, 1, "X")], S.PRODUCTS)
    assert lake.write_day(df, "products", DAY) == lake.path("products", DAY)
    assert lake.write_day(df.limit(0), "products", DAY + dt.timedelta(1)) == ""
    assert lake.dates("products") == (DAY,)
    assert all(f.endswith(".snappy.parquet") for f in os.listdir(lake.path("products", DAY)) if f.startswith("part"))
    assert lake.drop_day_everywhere(DAY)["products"] is True
    assert lake.drop_day("products", DAY) is False


def test_lake_rewrites_one_day_only_and_prunes(spark, folder):
    lake = Lake(spark, folder)
    next_day = DAY + dt.timedelta(1)
    one = spark.createDataFrame([("p1", "a", "Food", 5, 1, "X")], S.PRODUCTS)
    lake.write_day(one.union(one), "products", DAY)
    lake.write_day(one, "products", next_day)
    lake.write_day(one, "products", DAY)
    assert lake.read("products").count() == 2
    read = lake.read_day("products", DAY)
    assert read.first()._execution_date == DAY
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert lake.batches("products").latest().first()._execution_date == next_day


def test_replace_batch_is_idempotent_and_empty_load_empties_the_day(spark, folder):
    path = f"{folder}/t"
    days = [DAY, DAY + dt.timedelta(1)]
    for day in (*days, *days):
        replace_batch(spark.range(5), path, day)
    assert spark.read.parquet(path).count() == 10
    replace_batch(spark.range(0), path, days[0])
    assert spark.read.parquet(path).count() == 5
    replace_batch(spark.range(0), f"{folder}/absent", days[0])


def test_refused_rows(spark, folder):
    rows = spark.createDataFrame([(" c1 ", None, DAY, "missing email")],
                                 "customer_id string, email string, _execution_date date, rejection_reason string")
    root = f"{folder}/rejected"
    refused.write_refused(rows.limit(0), root, "customers", "s0")
    assert paths.glob(spark, f"{root}/entity=*") == []
    refused.write_refused(rows, root, "customers", "s1")
    refused.write_refused(rows, root, "customers", "s2")
    got = refused.read_refused(spark, root, "customers").collect()
    assert len(got) == 2 and got[0].customer_id == " c1 " and got[0].rejection_reason == "missing email"


def test_latest_without_known_dates(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY + dt.timedelta(1))], "x int, _execution_date date")
    assert [r.x for r in BatchTable(lambda: df).latest().collect()] == [2]


def test_export_placeholder(spark, folder):
    written = export.export_reports({"full": spark.range(3), "none": spark.range(0)}, folder)
    assert spark.read.option("header", True).csv(written["full"]).count() == 3
    assert spark.read.option("header", True).csv(written["none"]).first().message == export.PLACEHOLDER


def test_unified_transactions(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "p1", 1, "2024-01-01", "pending", 5, 2), ("o2", "c1", "p1", 1, "2024-01-02", "completed", 5, 2)],
        S.ORDERS)
    pos = spark.createDataFrame([("s1", "st", "p1", 2, 100, 200, "2024-01-03T10:11:12", "cash")], S.POS_SALES)
    both = unify.unified_transactions(orders, pos)
    assert both.columns == list(unify.COLUMNS) and both.count() == 3
    moment = dt.datetime(2024, 1, 4, 5, tzinfo=dt.timezone.utc)
    stamped = unify.unified_transactions(orders, pos, moment).select(F.unix_seconds("ingested_at").alias("t")).distinct().collect()
    assert [r.t for r in stamped] == [moment.timestamp()] and both.where("ingested_at IS NULL").isEmpty()
    store = both.where("source_system = 'pos'").first()
    assert (store.transaction_date, store.status, store.customer_id) == (dt.date(2024, 1, 3), "completed", None)
    assert unify.unified_transactions(orders, None).count() == 2
    assert unify.unified_transactions(None, None) is None


def test_run_dates():
    assert ingest.parse_day("2024-02-29") == dt.date(2024, 2, 29)
    for text in ("2024-02-30", "29/02/2024", ""):
        with pytest.raises(ValueError):
            ingest.parse_day(text)


def test_a_whole_run(spark, folder):
    put(f"{folder}/raw/customers.csv", CUSTOMER_CSV + "c2,Bo,Li,nobody,USA,Rome,2024-01-01,30,Male\n")
    put(f"{folder}/raw/products.csv",
        "product_id,name,category,price_cents,stock_quantity,supplier_country\np1,a,Food,5,1,X\n")
    put(f"{folder}/raw/orders.csv",
        "order_id,customer_id,product_id,quantity,order_date,status,discount_pct,shipping_days\n"
        "o1,c1,p1,1,2024-01-01,completed,0,1\no2,c1,p1,-1,2024-01-01,completed,0,1\n")
    put(f"{folder}/raw/pos_store_sales.json", json.dumps([{
        "sale_id": "s1", "store_id": "x", "product_id": "p1", "quantity": 1, "unit_price_cents": 5,
        "total_amount": 5, "transaction_timestamp": "2024-01-01T00:00:00", "payment_method": "cash"}]))
    lake = Lake(spark, f"{folder}/lake")
    for _ in range(2):
        got = ingest.load_sources(spark, f"{folder}/raw", DAY, lake, f"{folder}/refused", "s")
        assert got["customers"] == {"loaded": 1, "rejected": 0, "quarantined": 1}
        assert got["orders"] == {"loaded": 1, "rejected": 1, "quarantined": 0}
        assert got["unified_transactions"]["loaded"] == 2
    stored = lake.read("customers").collect()
    assert len(stored) == 1 and len(stored[0].email) == 64 and stored[0].city == "Rome"
    put(f"{folder}/raw/customers.csv", CUSTOMER_CSV.replace(",30,", ",3,"))
    ingest.load_sources(spark, f"{folder}/raw", DAY, lake, f"{folder}/refused", "s2")
    # A day whose rows are all held back loses its partition.
    assert lake.dates("customers") == ()
    assert quality.contract_for("orders") is None
