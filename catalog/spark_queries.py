"""Every registered query: name -> function of (session, table folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline import schemas as S
from shelfline.functions import mask_email, mask_string, pii_hash, record_id
from shelfline.operators import (
    drift, forecast, ingest, profile, quality, runs, scd, scope, unify, upsert,
)
from shelfline.operators.rows import distinct_on_email
from shelfline.plans import analytics, kpis, ods, staging
from shelfline.plans.marts import Models, int_orders_enriched as enrich
from shelfline.session import scratch_path
from shelfline.sources import export, files, paths, records, refused
from shelfline.sources.batches import RawTables
from shelfline.sources.lake import Lake, replace_batch
from shelfline.sources.star import DAILY, YEARLY, Star
from shelfline.streaming import activity, cdc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

FIRST, SECOND, LAST = DAILY
LAST_ORDER_DAY = dt.date(2001, 8, 1)
ODS_NOW = dt.datetime(2024, 1, 31)
# Roles over the countries of the star schema.
ROLES = {"Admin": None, "Nation 7 Analyst": "NATION_7"}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines present the same type."""
    return df.select(*(
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ))


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(function(spark, folder))

    QUERIES[function.__name__] = run
    return run


def _models(spark: SparkSession, folder: str) -> Models:
    return Models(Star(spark, folder).raw())


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header=True, **files.CSV_QUOTING).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def _pos_as_text(pos: DataFrame) -> DataFrame:
    moment = F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return pos.withColumn("transaction_timestamp", moment)


def _write_json_arrays(df: DataFrame, path: str, key: str, chunk: int = 5000) -> None:
    """Files that each hold one JSON array of about ``chunk`` rows."""
    number = F.regexp_extract(key, r"(\d+)$", 1).cast("bigint")
    rows = df.groupBy(F.call_function("div", number, F.lit(chunk)).alias("_chunk")).agg(
        F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")
    )
    rows.select("value").write.option("maxRecordsPerFile", 1).text(path)


# --- sources and sinks ------------------------------------------------------


@query
def scan_csv(spark, folder):
    path = scratch_path(spark, "scan_csv")
    _write_csv(Star(spark, folder).orders().latest().drop(S.EXEC_DATE), path)
    return files.read_csv(spark, path, S.ORDERS)


@query
def scan_json(spark, folder):
    path = scratch_path(spark, "scan_json")
    _write_json_arrays(_pos_as_text(Star(spark, folder).pos_sales()), path, "sale_id")
    return files.read_json(spark, path, S.POS_SALES)


def _in_small_splits(spark: SparkSession, path: str, read, least: int = 1 << 16, most: int = 1 << 24) -> DataFrame:
    """What ``read`` gives when the files at a path are cut into some 64 splits of ``least`` to ``most`` bytes; kept, as splits
    are made when a job runs."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], str(min(max(records.total_bytes(spark, path) // 64, least), most)))
    spark.conf.set(names[1], "0")
    try:
        kept = scratch_path(spark, "split")
        read().write.parquet(kept)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.parquet(kept)


@query
def scan_json_one_file(spark, folder):
    """One file that holds one array, read by many tasks."""
    path = scratch_path(spark, "scan_json_one_file")
    _write_json_arrays(_pos_as_text(Star(spark, folder).pos_sales()), path, "sale_id", chunk=1 << 40)
    return _in_small_splits(spark, path, lambda: files.read_json(spark, path, S.POS_SALES))


@query
def scan_csv_quoted(spark, folder):
    """CSV files with quotes and line breaks in their values, each larger than a split and read by many tasks."""
    path = scratch_path(spark, "scan_csv_quoted")
    orders = Star(spark, folder).orders().latest().drop(S.EXEC_DATE)
    noted = orders.withColumn("status", F.concat("status", F.lit("\n\"so, \n"), "order_id", F.lit('"')))
    _write_csv(noted.hint("rebalance"), path)
    return _in_small_splits(spark, path, lambda: files.read_csv(spark, path, S.ORDERS, multi_line=True))


@query
def lakehouse_roundtrip(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.write_batches(Star(spark, folder).customers().frame, "customers")
    return lake.read("customers")


@query
def lakehouse_partition_read(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.write_batches(Star(spark, folder).customers().frame, "customers")
    return lake.read_day("customers", SECOND)


@query
def latest_batch(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.write_batches(Star(spark, folder).orders().frame, "orders")
    return lake.batches("orders").latest()


@query
def idempotent_reload(spark, folder):
    path = scratch_path(spark, "reload")
    frame = Star(spark, folder).customers().frame
    for day in (FIRST, SECOND, SECOND, FIRST):
        replace_batch(frame.where(F.col(S.EXEC_DATE) == F.lit(day)), path, day)
    return spark.read.parquet(path)


@query
def drop_partition(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.write_batches(Star(spark, folder).customers().frame, "customers")
    dropped = [lake.drop_day("customers", SECOND), lake.drop_day("customers", SECOND)]
    left = lake.read("customers").groupBy(S.EXEC_DATE).agg(F.count("*").alias("row_count"))
    return left.select(
        S.EXEC_DATE, "row_count", F.lit(dropped[0]).alias("first_drop"), F.lit(dropped[1]).alias("second_drop")
    )


@query
def dlq_orders(spark, folder):
    root = scratch_path(spark, "rejected")
    rows = Star(spark, folder).orders().latest()
    _, rejected = quality.split(rows, quality.order_guardrail(), "rejection_reason")
    refused.write_refused(rejected, root, "orders", "20240103_000000")
    return refused.read_refused(spark, root, "orders").select(
        "order_id", "customer_id", "product_id", F.col("quantity").cast("int").alias("quantity"),
        F.col("discount_pct").cast("int").alias("discount_pct"), "rejection_reason",
    )


@query
def quarantine_customers(spark, folder):
    root = scratch_path(spark, "quarantine")
    rows = Star(spark, folder).customers().latest()
    _, held = quality.split(rows, quality.customer_contract(), "quarantine_reason")
    refused.write_refused(held, root, "customers", "20240103_000000")
    return refused.read_refused(spark, root, "customers").select("customer_id", "email", "quarantine_reason")


@query
def layer_row_counts(spark, folder):
    star = Star(spark, folder)
    m = Models(star.raw())
    layers = {
        "raw.customers": star.customers().frame,
        "raw.products": star.products().frame,
        "raw.orders": star.orders().frame,
        "raw.pos_store_sales": star.pos_sales(),
        "raw.missing": runs.table_or_none(spark, f"{folder}/no_such_table.parquet"),
        "staging.stg_customers": m.stg_customers,
        "staging.stg_products": m.stg_products,
        "staging.stg_orders": m.stg_orders,
        "marts.fct_orders": m.fct_orders,
    }
    return runs.row_counts(layers, spark)


@query
def report_export(spark, folder):
    root = scratch_path(spark, "reports")
    with analytics.completed_once(_models(spark, folder).marts) as marts:
        written = export.export_reports({n: f(marts) for n, f in analytics.REPORTS.items()}, root)
    return runs.row_counts(
        {name: spark.read.option("header", True).csv(path) for name, path in written.items()}, spark
    )


# --- schema and row quality -------------------------------------------------


@query
def schema_drift(spark, folder):
    root = scratch_path(spark, "drift")
    star = Star(spark, folder)
    orders = star.orders().latest().drop(S.EXEC_DATE)
    as_text = F.concat(F.lit("id-"), F.col("customer_id"))
    people = star.customers().latest().drop(S.EXEC_DATE, "city", "age")
    goods = star.products().latest().drop(S.EXEC_DATE).withColumn(
        "product_id", F.concat(F.lit("id-"), F.col("product_id"))
    ).withColumn("price_cents", F.col("price_cents") / 100 + F.lit(0.001))
    # one number in words, in the last row
    last = orders.agg(F.max("order_id").alias("last_id"))
    lines = orders.join(F.broadcast(last), F.col("order_id") == F.col("last_id"), "left").withColumn(
        "quantity", F.when(F.col("last_id").isNotNull(), F.lit("two")).otherwise(F.col("quantity").cast("string"))
    ).drop("last_id").withColumn("customer_id", as_text).withColumn(
        "product_id", F.concat(F.lit("id-"), F.col("product_id"))
    )
    _write_csv(people, f"{root}/customers.csv")
    _write_csv(goods, f"{root}/products.csv")
    _write_csv(lines, f"{root}/orders.csv")
    pos = _pos_as_text(star.pos_sales()).withColumn(
        "product_id", F.concat(F.lit("id-"), F.col("product_id"))
    ).withColumn("note", F.lit("extra"))
    _write_json_arrays(pos, f"{root}/pos_store_sales.json", "sale_id")
    return drift.drift_report(
        spark, {e: (f"{root}/{e}.{kind}", kind) for e, kind in S.SOURCE_FORMATS.items()}
    )


@query
def gate_unparseable(spark, folder):
    """Orders whose quantity is a word in every seventh row: nothing is lost on the way through the gates."""
    path = scratch_path(spark, "gate")
    orders = Star(spark, folder).orders().latest().drop(S.EXEC_DATE)
    words = F.when(F.substring("order_id", -1, 1) == "7", F.lit("two, or \"so\"")).otherwise(F.col("quantity").cast("string"))
    _write_csv(orders.withColumn("quantity", words), path)
    tagged = quality.with_outcome(files.read_csv(spark, path, S.ORDERS, uncast=True), "orders")
    return quality.outcome_counts(tagged.withColumn("entity", F.lit("orders")), "entity")


def _failing(rows: DataFrame, rules: quality.RuleSet, key: str) -> DataFrame:
    return quality.split(rows, rules, "reason")[1].select(key, "reason")


@query
def contract_customers(spark, folder):
    return _failing(Star(spark, folder).customers().latest(), quality.customer_contract(), "customer_id")


@query
def contract_products(spark, folder):
    return _failing(Star(spark, folder).products().latest(), quality.product_contract(), "product_id")


@query
def contract_duplicates(spark, folder):
    """Uniqueness over all batches at once: every repeated id fails."""
    rules = quality.customer_contract().only(["customer_id"])
    return _failing(Star(spark, folder).customers().frame, rules, "customer_id")


@query
def contract_split_counts(spark, folder):
    raw = Star(spark, folder).raw()
    parts = []
    for entity, table in (("customers", raw.customers), ("products", raw.products), ("orders", raw.orders)):
        tagged = quality.with_reasons(
            table.frame, quality.contract_for(entity), "reason", within=(S.EXEC_DATE,)
        )
        parts.append(tagged.groupBy(S.EXEC_DATE).agg(
            F.count_if(F.col("reason").isNull()).alias("clean"),
            F.count("reason").alias("quarantined"),
        ).withColumn("entity", F.lit(entity)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def guardrail_customers(spark, folder):
    return _failing(Star(spark, folder).customers().latest(), quality.customer_guardrail(), "customer_id")


@query
def guardrail_products(spark, folder):
    return _failing(Star(spark, folder).products().latest(), quality.product_guardrail(), "product_id")


@query
def guardrail_orders(spark, folder):
    return _failing(Star(spark, folder).orders().latest(), quality.order_guardrail(), "order_id")


@query
def ingest_customers(spark, folder):
    tagged = quality.with_outcome(Star(spark, folder).customers().latest(), "customers")
    return ingest.clean_rows(tagged, "customers")


@query
def ingest_summary(spark, folder):
    star = Star(spark, folder)
    raw = star.raw()
    rows = {
        "customers": raw.customers.latest(),
        "products": raw.products.latest(),
        "orders": raw.orders.latest(),
        "pos_store_sales": star.pos_sales(),
    }
    return ingest.summarise({e: quality.with_outcome(df, e) for e, df in rows.items()})


@query
def test_not_null(spark, folder):
    return quality.not_null_tests(_models(spark, folder).tested())


@query
def test_unique(spark, folder):
    return quality.unique_tests(_models(spark, folder).tested())


@query
def test_accepted_values(spark, folder):
    return quality.accepted_values_tests(_models(spark, folder).tested())


@query
def test_relationships(spark, folder):
    return quality.relationship_tests(_models(spark, folder).tested())


@query
def test_positive_revenue(spark, folder):
    """Run before the guardrails, where negative amounts still exist."""
    star = Star(spark, folder)
    m = Models(star.raw())
    unguarded = staging.stg_orders(star.orders())
    return quality.negative_revenue(enrich(unguarded, m.stg_customers, m.stg_products))


@query
def test_no_null_customer(spark, folder):
    """Run on the raw rows, where missing customers still exist."""
    return quality.missing_customer(Star(spark, folder).orders().latest())


@query
def expectations_orders(spark, folder):
    rows = Star(spark, folder).orders().latest().drop(S.EXEC_DATE)
    return quality.check_expectations(rows, quality.order_expectations(), S.ORDERS.names)


@query
def test_result_summary(spark, folder):
    """Data tests of the models, stored as a result document and read back."""
    models = _models(spark, folder).tested()
    tests = quality.not_null_tests(models).unionByName(quality.singular_tests(models))
    path = scratch_path(spark, "results")
    entry = F.struct(
        F.concat_ws(".", "test", "model", "column_name").alias("unique_id"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
        F.lit(0.0).alias("execution_time"),
        F.col("failures").cast("string").alias("message"),
    )
    # One row per test.
    tests.agg(F.collect_list(entry).alias("results")).coalesce(1).write.json(path)
    results = runs.read_results(spark, path)
    return runs.result_totals(results)


# --- staging, models --------------------------------------------------------


@query
def stg_customers(spark, folder):
    return _models(spark, folder).stg_customers


@query
def stg_products(spark, folder):
    return _models(spark, folder).stg_products


@query
def stg_orders(spark, folder):
    return _models(spark, folder).stg_orders


@query
def distinct_on_email_rows(spark, folder):
    cleaned = staging.clean_customers(staging.guarded(Star(spark, folder).raw()).customers.frame)
    return distinct_on_email(cleaned).select("email", "customer_id", S.EXEC_DATE)


@query
def mask_pii(spark, folder):
    return _models(spark, folder).stg_customers.select(
        "customer_id",
        mask_string(F.col("first_name")).alias("first_name"),
        mask_string(F.col("last_name")).alias("last_name"),
        mask_email(F.col("email")).alias("email"),
        mask_string(F.substring("customer_id", 1, 2)).alias("short_text"),
        mask_email(F.col("country")).alias("not_an_address"),
    )


@query
def pii_hash_customers(spark, folder):
    return Star(spark, folder).customers().latest().select(
        "customer_id", *(pii_hash(F.col(c)).alias(c) for c in ingest.PII_COLUMNS)
    )


@query
def int_orders_enriched(spark, folder):
    return _models(spark, folder).int_orders_enriched


@query
def dim_customers(spark, folder):
    return _models(spark, folder).dim_customers


@query
def dim_customers_masked(spark, folder):
    return _models(spark, folder).dim_customers_masked


@query
def dim_products(spark, folder):
    return _models(spark, folder).dim_products


@query
def fct_orders(spark, folder):
    return _models(spark, folder).fct_orders


# --- analytics and measures -------------------------------------------------


def _on_marts(name: str, function, *args, **kwargs) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(function(_models(spark, folder).marts, *args, **kwargs))

    QUERIES[name] = run


_on_marts("top_customers", analytics.top_customers)
_on_marts("top_customers_all_versions", analytics.top_customers, all_versions=True)
_on_marts("monthly_sales_trend", analytics.monthly_sales_trend)
_on_marts("monthly_sales_export", analytics.monthly_sales_export)
_on_marts("category_performance", analytics.category_performance)
_on_marts("category_performance_export", analytics.category_performance_export)
_on_marts("cohort_signup", analytics.cohort_signup)
_on_marts("cohort_first_order", analytics.cohort_first_order)
_on_marts("kpis", kpis.kpis)
_on_marts("kpis_one_country", kpis.kpis, "NATION_7")
_on_marts("kpis_by_country", kpis.kpis_by_country)
_on_marts("extra_kpis", kpis.extra_kpis)
_on_marts("extra_kpis_one_country", kpis.extra_kpis, "NATION_7")
_on_marts("monthly_sales", kpis.monthly_sales)
_on_marts("monthly_sales_by_country", kpis.monthly_sales, "NATION_7")
_on_marts("category_perf_kpi", kpis.category_revenue)
_on_marts("category_perf_selected", kpis.category_revenue, ["Food", "Home"])
_on_marts("customer_geo", kpis.customer_geography)
_on_marts("customer_geo_all_versions", kpis.customer_geography, all_versions=True)
_on_marts("categories", kpis.categories)
_on_marts("freshness", kpis.freshness)


@query
def rls_scope(spark, folder):
    customers = _models(spark, folder).marts.current_customers.select("customer_id", "country")
    return scope.scoped(customers, "Nation 7 Analyst", ROLES)


@query
def rls_top_customers(spark, folder):
    """A role's top customers: its country is filtered before the ranking."""
    country = scope.country_of("Nation 7 Analyst", ROLES)
    return analytics.top_customers(_models(spark, folder).marts, country=country)


# --- operational store ------------------------------------------------------


def _change_records(star: Star) -> DataFrame:
    return star.ods_changes().withColumn("record_id", record_id(F.col("source_system"), F.col("source_key")))


def _live_records(star: Star) -> DataFrame:
    return upsert.latest_changes(_change_records(star), [F.desc("upsert_at"), F.desc("seq")])


@query
def ods_record_id(spark, folder):
    return _change_records(Star(spark, folder)).select("seq", "record_id")


@query
def ods_upsert(spark, folder):
    """Two merges into a stored table: the first half of the month, then the rest."""
    store = upsert.RecordStore(spark, scratch_path(spark, "ods"), digits=1)
    changes = _change_records(Star(spark, folder))
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (changes.where(F.col("upsert_at") < half), changes.where(F.col("upsert_at") >= half)):
        store.merge(upsert.latest_changes(part, [F.desc("upsert_at"), F.desc("seq")]).drop("seq"))
    return store.read()


@query
def ods_minute_counts(spark, folder):
    return ods.minute_counts(_live_records(Star(spark, folder)), ODS_NOW, hours=24)


@query
def ods_summary(spark, folder):
    return ods.summary(_live_records(Star(spark, folder)))


@query
def ods_latest(spark, folder):
    return ods.latest(_live_records(Star(spark, folder)))


@query
def cdc_micro_batch(spark, folder):
    """Two passes of the change feed over files that arrive between them, the second with other columns."""
    root = scratch_path(spark, "cdc")
    star = Star(spark, folder)
    inbox = {e: f"{root}/inbox/{e}" for e in ("customers", "products", "pos_store_sales")}
    feed = cdc.ChangeFeed(spark, inbox, f"{root}/ods", digits=1)
    people = star.customers()
    goods = star.products().latest().drop(S.EXEC_DATE)
    pos = _pos_as_text(star.pos_sales())
    for n, day in enumerate((FIRST, LAST)):
        batch = people.frame.where(F.col(S.EXEC_DATE) == F.lit(day)).drop(S.EXEC_DATE)
        if n == 0:
            _write_csv(goods, inbox["products"])
            _write_json_arrays(pos, inbox["pos_store_sales"], "sale_id")
        else:
            batch = batch.select(F.lit("a, \"b\"").alias("colour"), *reversed(batch.columns))
        batch.write.mode("append").options(header=True, **files.CSV_QUOTING).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(inbox["customers"])
        feed.micro_batch(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc))

    def field(name: str):
        return F.get_json_object("payload", f"$.{name}")

    return feed.store.read().groupBy("source_system", "batch_id").agg(
        F.count("*").alias("record_count"), F.count_if(field("city") == "Moved").alias("moved"),
        F.count_if(field("colour") == 'a, "b"').alias("coloured"), F.sum(field("age").cast("bigint")).alias("age_total"),
        F.count_if(field("customer_id") == F.col("source_key")).alias("own_key"),
    )


@query
def poll_rewritten_file(spark, folder):
    """Three polling passes over one file name: its first content, no change, and other rows under the same name."""
    root = scratch_path(spark, "poll")
    inbox, star = f"{root}/inbox/customers", Star(spark, folder)
    feed = cdc.ChangeFeed(spark, {"customers": inbox}, f"{root}/ods", digits=1)
    people = star.customers()
    passes = []
    for n, day in enumerate((FIRST, FIRST, LAST)):
        if n != 1:
            batch = people.frame.where(F.col(S.EXEC_DATE) == F.lit(day)).drop(S.EXEC_DATE)
            _write_csv(batch.coalesce(1), f"{root}/draft{n}")
            paths.delete(spark, f"{inbox}/customers.csv")
            paths.move(spark, paths.glob(spark, f"{root}/draft{n}/part-*")[0], f"{inbox}/customers.csv")
        passes += feed.poll_once(dt.datetime(2024, 1, 1, 0, n, tzinfo=dt.timezone.utc))
    counted = feed.store.read().groupBy("batch_id").agg(
        F.count("*").alias("record_count"), F.sum(F.get_json_object("payload", "$.age").cast("bigint")).alias("age_total"),
        F.count_if(F.get_json_object("payload", "$.city") == "Moved").alias("moved"),
    )
    return counted.withColumn("passes", F.lit(len(passes)).cast("bigint"))


@query
def stream_minute_counts(spark, folder):
    root = scratch_path(spark, "activity")
    schema = Star(spark, folder).table("events").schema
    events = activity.event_stream(spark, folder, schema, "events.parquet")
    closed = activity.run_to_table(
        activity.minute_activity(events, "event_type", "ts"), f"{root}/table", f"{root}/progress"
    )
    counted = activity.with_open_minutes(closed, Star(spark, folder).table("events"), "event_type", "ts")
    return counted.withColumn("minute_bucket", F.col("minute_bucket").cast("timestamp_ntz"))


# --- forecast ---------------------------------------------------------------


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.daily_category_revenue(_models(spark, folder).marts)


@query
def daily_category_revenue(spark, folder):
    return _daily(spark, folder)


_on_marts("daily_revenue_90d", kpis.recent_category_revenue, LAST_ORDER_DAY)


@query
def daily_dense(spark, folder):
    return forecast.densify(_daily(spark, folder))


@query
def forecast_ma(spark, folder):
    return forecast.moving_average(forecast.densify(_daily(spark, folder)))


@query
def forecast_table(spark, folder):
    """The stored forecast after a second run; the first one had a category that is gone."""
    table = forecast.ForecastTable(spark, scratch_path(spark, "forecast"))
    made = forecast.moving_average(forecast.densify(_daily(spark, folder)))
    earlier = made.withColumn("product_category", F.lit("gone")).unionByName(made).withColumn("forecasted_net_revenue", F.lit(0.0))
    for hour, rows in ((5, earlier), (6, made), (7, made.limit(0))):
        table.write(rows, dt.datetime(2024, 1, 31, hour, tzinfo=dt.timezone.utc))
    return table.read().withColumn("model_generated_at", F.col("model_generated_at").cast("timestamp_ntz"))


@query
def forecast_arima(spark, folder):
    return forecast.arima(forecast.densify(_daily(spark, folder)))


@query
def forecast_with_history(spark, folder):
    marts = _models(spark, folder).marts
    predicted = forecast.moving_average(forecast.densify(kpis.daily_category_revenue(marts)))
    return forecast.with_history(kpis.recent_category_revenue(marts, LAST_ORDER_DAY), predicted)


# --- profiles ---------------------------------------------------------------


def _profiled(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored marts: a profile reads its table more than once."""
    root = scratch_path(spark, "marts")
    _models(spark, folder).write(root)
    names = ("dim_customers", "dim_products", "fct_orders")
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def _per_table(spark, folder, function) -> DataFrame:
    result = None
    for name, df in _profiled(spark, folder).items():
        part = function(name, df)
        result = part if result is None else result.unionByName(part)
    return result


@query
def profile_numeric(spark, folder):
    def one(name, df):
        p = profile.numeric_profile(df)
        return p.withColumns({c: F.round(c, 2) for c in ("mean", "std")}).withColumn("table_name", F.lit(name))

    return _per_table(spark, folder, one)


@query
def profile_categorical(spark, folder):
    return _per_table(
        spark, folder, lambda name, df: profile.categorical_profile(df).withColumn("table_name", F.lit(name))
    )


@query
def profile_report(spark, folder):
    columns = ("column_name", "null_pct", "constant", "severity", "badge")
    return _per_table(
        spark, folder,
        lambda name, df: profile.column_report(df).select(*columns, F.lit(name).alias("table_name")),
    )


@query
def profile_summary(spark, folder):
    return _per_table(spark, folder, profile.table_summary)


# --- stored tables and history ----------------------------------------------


@query
def backfill_range(spark, folder):
    """Two days of raw orders through the gates: what the lake and the dead letters hold of each."""
    root = scratch_path(spark, "backfill")
    lake = Lake(spark, f"{root}/lake")
    ingest.backfill(Star(spark, folder).orders().frame, "orders", FIRST, SECOND, lake, f"{root}/refused", "s")
    loaded = lake.read("orders").groupBy(S.EXEC_DATE).agg(
        F.count("*").alias("row_count"), F.sum("quantity").alias("units")
    )
    dead = refused.read_refused(spark, f"{root}/refused/rejected", "orders").groupBy(
        F.col(S.EXEC_DATE).cast("date").alias(S.EXEC_DATE)
    ).agg(F.count("*").alias("rejected"))
    return loaded.join(dead, S.EXEC_DATE, "left").select(
        S.EXEC_DATE, "row_count", "units", F.coalesce("rejected", F.lit(0)).alias("rejected")
    )


@query
def date_range(spark, folder):
    bounds = Star(spark, folder).table("orders").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("a"), F.max(F.col("o_orderdate").cast("date")).alias("b")
    )
    return ingest.date_range(bounds, "a", "b")


def _updated_fact(spark: SparkSession, folder: str) -> upsert.MonthlyFact:
    """A stored fact up to 1999 of the second batch, brought forward with the third."""
    raw = Star(spark, folder).raw()
    fact = upsert.MonthlyFact(spark, scratch_path(spark, "fact"))
    fact.refresh(Models(raw.until(SECOND)).fct_orders.where("order_date < DATE'1999-01-15'"))
    fact.update(Models(raw).fct_orders)
    return fact


@query
def fct_orders_incremental(spark, folder):
    return _updated_fact(spark, folder).read()


@query
def fct_orders_key_index(spark, folder):
    """What the index of the updated fact says: orders and bucket hits per month."""
    keys = _updated_fact(spark, folder).table.snapshot().keys()
    return keys.groupBy("order_month").agg(F.count("*").alias("orders"), F.countDistinct("key_hash").alias("different"))


@query
def scd2_customers(spark, folder):
    return _models(spark, folder).scd_customers


@query
def scd2_customers_changed(spark, folder):
    m = _models(spark, folder)
    return scd.changed_versions(staging.customer_batches(m.raw.customers), m.calendar)


def _stored_history(spark, folder, changes_only: bool) -> DataFrame:
    """The history as a stored table that takes one batch after the other."""
    m = _models(spark, folder)
    staged = staging.customer_batches(m.raw.customers)
    table = scd.HistoryTable(spark, scratch_path(spark, "history"), changes_only)
    for day in (*DAILY, LAST):
        table.apply(staged.where(F.col(S.EXEC_DATE) == F.lit(day)), day)
    return table.read()


@query
def scd2_merge(spark, folder):
    return _stored_history(spark, folder, False)


@query
def scd2_merge_changed(spark, folder):
    return _stored_history(spark, folder, True)


@query
def orders_point_in_time(spark, folder):
    """Each order line with the city its customer had on the order date."""
    star = Star(spark, folder)
    m = Models(star.raw())
    dated = Models(RawTables(star.customers(YEARLY), star.products(), star.orders()))
    placed = scd.as_of(m.stg_orders, dated.scd_customers, "customer_id", "order_date", dated.calendar)
    return placed.select(
        "order_id", "customer_id", "order_date", F.col("v_city").alias("city_then"),
        F.col("v_dbt_valid_from").alias("valid_from"),
    )


@query
def orders_point_in_time_changed(spark, folder):
    """The same from a history that opens versions on change only."""
    star = Star(spark, folder)
    m = Models(star.raw())
    dated = Models(RawTables(star.customers(YEARLY), star.products(), star.orders()))
    history = scd.changed_versions(staging.customer_batches(dated.raw.customers), dated.calendar)
    placed = scd.as_of(m.stg_orders, history, "customer_id", "order_date", dated.calendar)
    return placed.select("order_id", "customer_id", "order_date", F.col("v_city").alias("city_then"))


@query
def unified_transactions(spark, folder):
    star = Star(spark, folder)
    both = unify.unified_transactions(
        staging.guarded(star.raw()).orders.latest(), star.pos_sales(), dt.datetime(2024, 1, 3, 6, tzinfo=dt.timezone.utc)
    )
    return both.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


# --- runs -------------------------------------------------------------------


@query
def audit_runs(spark, folder):
    """A whole load over the four source files, with its audit record."""
    root = scratch_path(spark, "run")
    star = Star(spark, folder)
    raw = star.raw()
    # Text made of digits would be inferred as a number.
    digits = ("customer_id", "product_id", "order_id", "last_name")

    def with_text_ids(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.concat(F.lit("id-"), F.col(c)) for c in digits if c in df.columns})

    for entity, table in (("customers", raw.customers), ("products", raw.products), ("orders", raw.orders)):
        _write_csv(with_text_ids(table.latest().drop(S.EXEC_DATE)), f"{root}/raw/{entity}.csv")
    _write_json_arrays(
        with_text_ids(_pos_as_text(star.pos_sales())), f"{root}/raw/pos_store_sales.json", "sale_id"
    )
    lake = Lake(spark, f"{root}/lake")

    def work(record: runs.RunRecord) -> None:
        record.add_counts(
            ingest.load_sources(spark, f"{root}/raw", LAST, lake, f"{root}/refused", "20240103_000000")
        )
        record.add_files(lake.read("orders"))

    runs.audited(spark, f"{root}/audit", work, sla_seconds=86_400.0)
    return spark.read.parquet(f"{root}/audit").select(
        "status", "records_ingested", "records_rejected", "sla_breached", "error_message",
        F.col("parquet_file_path").isNotNull().alias("has_files"),
        (F.col("created_at") >= F.col("end_time")).alias("created_after_end"),
    )


@query
def sla_by_phase(spark, folder):
    """Event values as step times: each event type is a step, and its first letter decides its phase."""
    events = Star(spark, folder).table("events")
    steps = events.select(F.col("event_type").alias("step"), F.col("value").alias("seconds"))
    letter = F.substring("step", 1, 1)
    phases = steps.select("step").distinct().withColumn(
        "phase", F.when(letter < "e", F.lit("early")).when(letter < "s", F.lit("middle"))
    ).where("phase is not null")
    return runs.phase_times(steps, phases)


for _name, _function in (("distinct_on_email", "distinct_on_email_rows"), ("pii_hash", "pii_hash_customers")):
    QUERIES[_name] = QUERIES.pop(_function)
