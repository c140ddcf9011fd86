import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import functions as F

from shelfline import schemas as S
from shelfline.operators import ingest, quality
from shelfline.sources.lake import Lake

PERSON = ("c1", "Ann", "Lee", "ann@example.com", "USA", "Rome", "2024-01-01", 30, "Female")


def people(spark, *rows):
    return spark.createDataFrame(rows, S.CUSTOMERS)


def person(**changes):
    return tuple({**dict(zip(S.CUSTOMERS.names, PERSON)), **changes}.values())


def reasons(df, rules, key):
    return {r[key]: r["reason"] for r in quality.with_reasons(df, rules, "reason").collect()}


def test_customer_contract_collects_every_reason(spark):
    df = people(
        spark, person(), person(customer_id="c2", age=17), person(customer_id="c3", age=101),
        person(customer_id="c4", gender="Non-binary"), person(customer_id="c5", email="x@y"),
        person(customer_id="c6", city=None, age=18, email=None), person(customer_id="c7", age=100),
    )
    got = reasons(df, quality.customer_contract(), "customer_id")
    assert got == {
        "c1": None,
        "c2": "age: greater_than_or_equal_to(18)",
        "c3": "age: less_than_or_equal_to(100)",
        "c4": "gender: isin(['Male', 'Female', 'Other'])",
        "c5": "email: str_matches",
        "c6": "email: not_nullable; city: not_nullable",
        "c7": None,
    }
    assert reasons(df, quality.customer_contract((*S.GENDERS, "Non-binary")), "customer_id")["c4"] is None


def test_contract_fails_every_row_of_a_duplicate(spark):
    df = people(spark, person(), person(first_name="Bob"), person(customer_id="c2"),
                person(customer_id=None), person(customer_id=None))
    clean, held = quality.split(df, quality.customer_contract(), "why")
    assert [r.customer_id for r in clean.collect()] == ["c2"]
    why = sorted((r.customer_id or "", r.why) for r in held.collect())
    assert why == [("", "customer_id: not_nullable")] * 2 + [("c1", "customer_id: field_uniqueness")] * 2


def test_uniqueness_within_batches(spark):
    df = people(spark, person(), person(city="Oslo"))
    tagged = quality.with_reasons(df, quality.customer_contract(), "why", within=["city"])
    assert tagged.where("why IS NULL").count() == 2


def test_contract_subset_and_missing_column(spark):
    df = people(spark, person(age=5, gender="x"))
    only_age = quality.customer_contract().only(["age"])
    assert reasons(df, only_age, "customer_id") == {"c1": "age: greater_than_or_equal_to(18)"}
    whole = quality.with_reasons(df.drop("city"), quality.customer_contract(), "why").first()
    assert whole.why == "city: column_in_dataframe"


def test_product_rules(spark):
    df = spark.createDataFrame(
        [("p1", "a", "Food", 5, 1, "X"), ("p2", "a", "Food", 0, 1, "X"), ("p3", "a", "Food", -100, 1, "X"),
         (None, "a", "Food", None, 1, "X")], S.PRODUCTS)
    contract = reasons(df, quality.product_contract(), "product_id")
    assert contract["p1"] is None and contract["p2"] == "price_cents: greater_than(0)"
    guard = reasons(df, quality.product_guardrail(), "product_id")
    assert guard == {
        "p1": None, "p2": None, "p3": "negative price_cents",
        None: "missing product_id; missing price_cents",
    }


def test_customer_guardrail(spark):
    df = people(spark, person(), person(customer_id=None), person(customer_id="n", email=None),
                person(customer_id="m", email="notanemail"))
    assert reasons(df, quality.customer_guardrail(), "customer_id") == {
        "c1": None, None: "missing customer_id", "n": "missing email", "m": "malformed email (missing @)",
    }


def test_order_guardrail_lets_nulls_pass(spark):
    rows = [("o1", "c", "p", 1, "2024-01-01", "x", 10, 1), ("o2", "c", "p", -1, "d", "x", 0, 1),
            ("o3", "c", "p", 1, "d", "x", 150, 1), ("o4", "c", "p", None, "d", "x", None, 1),
            ("o5", None, None, -2, "d", "x", -1, 1), ("o6", "c", "p", 0, "d", "x", 100, 1)]
    df = spark.createDataFrame(rows, S.ORDERS)
    assert reasons(df, quality.order_guardrail(), "order_id") == {
        "o1": None, "o2": "negative quantity", "o3": "discount_pct out of range [0,100] (150)", "o4": None,
        "o5": "missing customer_id; missing product_id; negative quantity; discount_pct out of range [0,100] (-1)",
        "o6": None,
    }
    assert df.where(quality.passing(quality.order_guardrail())).count() == 3


def test_outcomes_add_up_and_unknown_entity_is_clean(spark):
    df = people(spark, person(), person(customer_id="c2", age=5), person(customer_id="c3", email="nobody"))
    counts = quality.outcome_counts(quality.with_outcome(df, "customers")).first()
    assert (counts.loaded, counts.rejected, counts.quarantined) == (1, 0, 2)
    other = quality.with_outcome(spark.range(3), "weather")
    assert quality.outcome_counts(other).first().loaded == 3


def test_summary_rate(spark):
    orders = spark.createDataFrame(
        [("o1", "c", "p", 1, "d", "x", 0, 1), ("o2", None, "p", 1, "d", "x", 0, 1),
         ("o3", "c", "p", 1, "d", "x", 0, 1)], S.ORDERS)
    got = {r.entity: r for r in ingest.summarise({"orders": quality.with_outcome(orders, "orders")}).collect()}
    assert got["all"].loaded == 2 and got["all"].rejected == 1 and got["orders"].rejection_rate_pct == 33.3


def test_expectations_and_column_set(spark):
    df = spark.createDataFrame([("o1", None, "p", 11, "d", "Completed", 51, 0)], S.ORDERS)
    got = {(r.expectation, r.column_name): r.unexpected_count for r in quality.check_expectations(
        df.drop("order_date"), quality.order_expectations(), S.ORDERS.names).collect()}
    assert got == {
        ("columns_match_set", "*"): 1, ("not_null", "order_id"): 0, ("not_null", "customer_id"): 1,
        ("in_set", "status"): 1, ("between", "quantity"): 1, ("between", "discount_pct"): 1,
        ("between", "shipping_days"): 1,
    }


def test_data_test_counts_match_the_declared_tests():
    assert sum(map(len, quality.NOT_NULL.values())) == 33
    assert sum(map(len, quality.UNIQUE.values())) == 8
    assert len(quality.ACCEPTED) == 3


def test_relationship_counts_child_rows(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert quality.check_relationship("m", child, "k", parent, "id").first().failures == 2
    none = quality.check_relationship("m", child.where("k = 'a'"), "k", parent, "id").first()
    assert none.failures == 0


def test_backfill_goes_through_the_gates(spark, folder):
    with pytest.raises(ValueError):
        ingest.backfill(spark.range(1), "orders", dt.date(2024, 1, 2), dt.date(2024, 1, 1), None, folder, "s")
    lake = Lake(spark, f"{folder}/lake")
    good, minor = person(), person(customer_id="c2", age=3)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]

    def rows(*per_day):
        frames = [people(spark, *p).withColumn("_execution_date", F.lit(d)) for d, p in zip(days, per_day) if p]
        return reduce(lambda a, b: a.unionByName(b), frames)

    first = ingest.backfill(rows([good], [good, minor], [good]), "customers", days[0], days[1], lake, f"{folder}/refused", "a")
    assert sorted((r.loaded, r.rejected, r.quarantined) for r in first.collect()) == [(1, 0, 0), (1, 0, 1)]
    assert lake.dates("customers") == (days[0], days[1])
    assert all(len(r.email) == 64 for r in lake.read("customers").collect())
    # the same id on two days is no duplicate; a day that became empty loses its partition
    ingest.backfill(rows([good], [minor], [good]), "customers", days[0], days[2], lake, f"{folder}/refused", "b")
    assert lake.dates("customers") == (days[0], days[2])
