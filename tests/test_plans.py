"""The shape of the physical plans that matter at scale."""

import pytest

from shelfline.operators import scd
from shelfline.plans import analytics, kpis
from shelfline.plans.marts import Models
from shelfline.sources.batches import RawTables
from shelfline.sources.star import YEARLY, Star

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def models(spark):
    return Models(Star(spark, FOLDER).raw())


def test_dedupe_limits_groups_before_the_shuffle(models):
    text = plan(models.stg_customers)
    assert text.count("WindowGroupLimit") == 2
    before, after = text.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_latest_batch_leaves_other_batches_unread(models):
    text = plan(models.stg_orders)
    assert text.count("FileScan parquet") == 2 and "Union" not in text


@pytest.mark.parametrize("make", [
    analytics.monthly_sales_trend, analytics.top_customers, analytics.cohort_signup, kpis.kpis_by_country,
    kpis.extra_kpis, kpis.daily_category_revenue,
])
def test_no_nested_loop_joins(models, make):
    text = plan(make(models.marts))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_extra_kpis_do_not_expand_rows(models):
    assert "Expand" not in plan(kpis.extra_kpis(models.marts))


def test_stored_marts_are_read_by_column(spark, models, folder):
    from shelfline.plans.marts import Marts

    models.write(folder)
    text = plan(kpis.freshness(Marts.read(spark, folder)))
    assert "ReadSchema: struct<order_date:date>" in text
    text = plan(kpis.kpis(Marts.read(spark, folder)))
    assert "EqualTo(status,completed)" in text and "quantity" not in text
    assert analytics.top_customers(Marts.read(spark, folder)).collect() == analytics.top_customers(models.marts).collect()


def test_stored_fact_is_not_shuffled_to_even_its_files(models):
    assert "REBALANCE" not in plan(models.stored("fct_orders"))
    assert "REBALANCE" in plan(models.stored("dim_customers"))


@pytest.mark.parametrize("make", [lambda m: m.int_orders_enriched, lambda m: m.fct_orders, lambda m: kpis.extra_kpis(m.marts)])
def test_one_shuffle_of_orders_for_distinct_rows_and_products(spark, models, make):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = Models(models.raw)
        lines = [line for line in plan(make(fresh)).splitlines() if "Exchange hashpartitioning(" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    of_products = [line for line in lines if "hashpartitioning(product_id" in line]
    assert len(of_products) == 1 and "_part" in of_products[0] and "REPARTITION_BY_COL" in of_products[0]
    # no other shuffle has whole rows as its key
    assert not any("hashpartitioning(order_id" in line and "shipping_days" in line for line in lines)


def test_point_in_time_makes_its_orders_once(spark, models):
    star = Star(spark, FOLDER)
    dated = Models(RawTables(star.customers(YEARLY), star.products(), star.orders()))
    placed = scd.as_of(models.stg_orders, dated.scd_customers, "customer_id", "order_date", dated.calendar)
    text = placed._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line]
    # the orders meet versions once, and the pairs are taken from the same orders, not from filtered ones
    assert sum("_batch#" in j for j in joins) == 1 and not any("_start#" in j for j in joins)
    assert "isnotnull(order_date" not in text


def test_reports_share_the_completed_orders(models):
    alone = {name: report(models.marts).collect() for name, report in analytics.REPORTS.items()}
    with analytics.completed_once(models.marts) as marts:
        for name, report in analytics.REPORTS.items():
            assert "InMemoryTableScan" in plan(report(marts))
            assert report(marts).collect() == alone[name]
