"""Row rules: contracts, guardrails, expectations and data tests.

A rule is a violation condition with a reason. All rules of a set are evaluated in
one projection, and a row keeps every reason that applies to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfline import schemas as S
from shelfline.sources.files import UNCAST

CLEAN, QUARANTINED, REJECTED = "clean", "quarantined", "rejected"


@dataclass(frozen=True)
class Rule:
    column: str
    broken: Column
    reason: Column


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[Rule, ...]
    unique: tuple[str, ...] = ()

    def only(self, columns: Sequence[str]) -> "RuleSet":
        """The rules that concern a subset of the columns."""
        return RuleSet(
            tuple(r for r in self.rules if r.column in columns),
            tuple(c for c in self.unique if c in columns),
        )


def _rule(column: str, broken: Column, reason: str | Column) -> Rule:
    text = F.lit(reason) if isinstance(reason, str) else reason
    # A comparison with NULL is not a violation.
    return Rule(column, F.coalesce(broken, F.lit(False)), text)


def _required(column: str) -> Rule:
    return _rule(column, F.col(column).isNull(), f"{column}: not_nullable")


def customer_contract(genders: Sequence[str] = S.GENDERS) -> RuleSet:
    listed = ", ".join(f"'{g}'" for g in genders)
    names = ("customer_id", "first_name", "last_name", "email", "country", "city", "age", "gender")
    return RuleSet(
        (
            *map(_required, names),
            _rule("email", ~F.col("email").rlike(S.EMAIL_PATTERN), "email: str_matches"),
            _rule("age", F.col("age") < 18, "age: greater_than_or_equal_to(18)"),
            _rule("age", F.col("age") > 100, "age: less_than_or_equal_to(100)"),
            _rule("gender", ~F.col("gender").isin(*genders), f"gender: isin([{listed}])"),
        ),
        unique=("customer_id",),
    )


def product_contract() -> RuleSet:
    return RuleSet(
        (
            *map(_required, ("product_id", "name", "category", "price_cents")),
            _rule("price_cents", F.col("price_cents") <= 0, "price_cents: greater_than(0)"),
        ),
        unique=("product_id",),
    )


def customer_guardrail() -> RuleSet:
    return RuleSet((
        _rule("customer_id", F.col("customer_id").isNull(), "missing customer_id"),
        _rule("email", F.col("email").isNull(), "missing email"),
        _rule("email", ~F.contains(F.col("email"), F.lit("@")), "malformed email (missing @)"),
    ))


def product_guardrail() -> RuleSet:
    return RuleSet((
        _rule("product_id", F.col("product_id").isNull(), "missing product_id"),
        _rule("price_cents", F.col("price_cents").isNull(), "missing price_cents"),
        _rule("price_cents", F.col("price_cents") < 0, "negative price_cents"),
    ))


def order_guardrail() -> RuleSet:
    discount = F.col("discount_pct")
    out_of_range = F.concat(
        F.lit("discount_pct out of range [0,100] ("), discount.cast("string"), F.lit(")")
    )
    return RuleSet((
        _rule("order_id", F.col("order_id").isNull(), "missing order_id"),
        _rule("customer_id", F.col("customer_id").isNull(), "missing customer_id"),
        _rule("product_id", F.col("product_id").isNull(), "missing product_id"),
        _rule("quantity", F.col("quantity") < 0, "negative quantity"),
        _rule("discount_pct", ~discount.between(0, 100), out_of_range),
    ))


def contract_for(entity: str) -> RuleSet | None:
    """The contract of an entity, or None where rows pass unchecked."""
    makers = {"customers": customer_contract, "products": product_contract}
    return makers[entity]() if entity in makers else None


def guardrail_for(entity: str) -> RuleSet | None:
    makers = {
        "customers": customer_guardrail,
        "products": product_guardrail,
        "orders": order_guardrail,
    }
    return makers[entity]() if entity in makers else None


def _flag_duplicates(df: DataFrame, column: str, within: Sequence[str], flag: str) -> DataFrame:
    """Mark every row whose value occurs more than once.

    The counts combine before the shuffle and the join carries one row per repeated
    value, so a value shared by a third of the rows is never one task's sort.
    """
    keys = [*within, column]
    repeated = (
        df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_n"))
        .where("_n > 1").select(*keys, F.lit(True).alias(flag))
    )
    return df.join(repeated, keys, "left")


def with_reasons(
    df: DataFrame, rules: RuleSet | None, reason_column: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add the joined reasons of all broken rules, NULL for a row that passes.

    ``within`` names columns that separate batches for the uniqueness check.
    """
    if rules is None:
        return df.withColumn(reason_column, F.lit(None).cast("string"))
    columns = df.columns
    missing = [c for c in dict.fromkeys(r.column for r in rules.rules) if c not in columns]
    if missing:
        # A table that lacks a column fails as a whole.
        text = "; ".join(f"{c}: column_in_dataframe" for c in missing)
        return df.withColumn(reason_column, F.lit(text))
    reasons = [F.when(r.broken, r.reason) for r in rules.rules]
    for column in rules.unique:
        flag = f"_repeated_{column}"
        df = _flag_duplicates(df, column, within, flag)
        reasons.append(F.when(F.col(flag), F.lit(f"{column}: field_uniqueness")))
    joined = F.concat_ws("; ", *reasons)
    return df.select(*columns, F.nullif(joined, F.lit("")).alias(reason_column))


def split(df: DataFrame, rules: RuleSet | None, reason_column: str, within: Sequence[str] = ()):
    """(passing rows, failing rows with their reasons)."""
    tagged = with_reasons(df, rules, reason_column, within)
    passed = tagged.where(F.col(reason_column).isNull()).drop(reason_column)
    return passed, tagged.where(F.col(reason_column).isNotNull())


def passing(rules: RuleSet) -> Column:
    """The condition a row meets when it breaks no rule; uniqueness is left out."""
    return ~reduce(lambda a, b: a | b, (r.broken for r in rules.rules))


def with_outcome(df: DataFrame, entity: str, within: Sequence[str] = ()) -> DataFrame:
    """Contract first, guardrail on what it lets through, as one tagged frame.

    Rows that list columns whose text did not fit its type are quarantined for these, too.
    """
    checked = with_reasons(df, contract_for(entity), "quarantine_reason", within)
    if UNCAST in df.columns:
        lost = F.array_join(F.transform(UNCAST, lambda c: F.concat(c, F.lit(": coerce_dtype"))), "; ")
        both = F.concat_ws("; ", F.nullif(lost, F.lit("")), "quarantine_reason")
        checked = checked.withColumn("quarantine_reason", F.nullif(both, F.lit(""))).drop(UNCAST)
    guarded = with_reasons(checked, guardrail_for(entity), "rejection_reason")
    held = F.col("quarantine_reason").isNotNull()
    return guarded.withColumn(
        "rejection_reason", F.when(~held, F.col("rejection_reason"))
    ).withColumn(
        "outcome",
        F.when(held, QUARANTINED).when(F.col("rejection_reason").isNotNull(), REJECTED).otherwise(CLEAN),
    )


def outcome_counts(tagged: DataFrame, *by: str) -> DataFrame:
    return tagged.groupBy(*by).agg(
        F.count_if(F.col("outcome") == CLEAN).alias("loaded"),
        F.count_if(F.col("outcome") == REJECTED).alias("rejected"),
        F.count_if(F.col("outcome") == QUARANTINED).alias("quarantined"),
    )


def rejection_rate(loaded: Column, rejected: Column) -> Column:
    """Percent of loaded plus rejected rows; quarantined rows count in neither."""
    total = (loaded + rejected).cast("double")
    return F.coalesce(F.round(rejected / F.nullif(total, F.lit(0.0)) * 100, 1), F.lit(0.0))


# --- expectations -----------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    broken: Column


def order_expectations() -> tuple[Expectation, ...]:
    # The limits of the order suite.
    ranges = (("quantity", 1, 10), ("discount_pct", 0, 50), ("shipping_days", 1, 14))
    return (
        Expectation("not_null", "order_id", F.col("order_id").isNull()),
        Expectation("not_null", "customer_id", F.col("customer_id").isNull()),
        Expectation("in_set", "status", ~F.col("status").isin(*S.STATUSES)),
        *(Expectation("between", c, ~F.col(c).between(low, high)) for c, low, high in ranges),
    )


def check_expectations(
    df: DataFrame, expectations: Sequence[Expectation], column_set: Sequence[str]
) -> DataFrame:
    """All expectations in one pass: expectation, column_name, unexpected_count, success."""
    strange = len(set(column_set) ^ set(df.columns))
    counted = df.agg(*(F.count_if(e.broken).alias(f"c{i}") for i, e in enumerate(expectations)))
    results = [
        F.struct(F.lit("columns_match_set").alias("expectation"), F.lit("*").alias("column_name"),
                 F.lit(strange).cast("bigint").alias("unexpected_count"))
    ]
    for i, e in enumerate(expectations):
        results.append(F.struct(
            F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column_name"),
            F.col(f"c{i}").alias("unexpected_count"),
        ))
    return counted.select(F.inline(F.array(*results))).withColumn(
        "success", F.col("unexpected_count") == 0
    )


# --- data tests -------------------------------------------------------------

# The columns each model is tested on.
NOT_NULL = {
    "stg_customers": ("customer_id", "first_name", "last_name", "email"),
    "stg_products": ("product_id", "product_name", "category", "price_cents"),
    "stg_orders": ("order_id", "customer_id", "product_id", "quantity", "discount_pct",
                   "order_date", "status", "shipping_days"),
    "int_orders_enriched": ("order_id", "gross_revenue_cents", "net_revenue_cents"),
    "dim_customers": ("customer_key", "customer_id", "first_name", "last_name", "email"),
    "dim_products": ("product_id", "product_name", "category", "price_cents"),
    "fct_orders": ("order_id", "customer_id", "product_id", "gross_revenue_dollars",
                   "net_revenue_dollars"),
}
UNIQUE = {
    "stg_customers": ("customer_id", "email"),
    "stg_products": ("product_id",),
    "stg_orders": ("order_id",),
    "int_orders_enriched": ("order_id",),
    "dim_customers": ("customer_key",),
    "dim_products": ("product_id",),
    "fct_orders": ("order_id",),
}
ACCEPTED = {
    "stg_orders": ("status", S.STATUSES),
    "stg_products": ("category", S.CATEGORIES),
    "dim_products": ("category", S.CATEGORIES),
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _result(test: str, model: str, column: str, failures: Column):
    return (F.lit(test).alias("test"), F.lit(model).alias("model"),
            F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures"))


def check_not_null(model: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass over the model for all its columns."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = [F.struct(*_result("not_null", model, c, F.col(c))) for c in columns]
    return counted.select(F.inline(F.array(*rows)))


def check_unique(model: str, df: DataFrame, column: str) -> DataFrame:
    """Failures are the values that occur more than once; NULL is not a value."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("n")).select(*_result("unique", model, column, F.col("n")))


def check_accepted(model: str, df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Failures are the distinct values outside the list."""
    strange = df.where(~F.col(column).isin(*values)).select(column).distinct()
    return strange.agg(F.count("*").alias("n")).select(
        *_result("accepted_values", model, column, F.col("n"))
    )


def check_relationship(
    model: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Failures are the child rows whose key has no parent.

    Child rows are counted per key first, so the anti join moves one row per key.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_column).alias(column))
    orphans = keys.join(parents, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        *_result("relationships", model, column, F.col("n"))
    )


def not_null_tests(models: dict[str, DataFrame]) -> DataFrame:
    return _union([check_not_null(m, models[m], cols) for m, cols in NOT_NULL.items()])


def unique_tests(models: dict[str, DataFrame]) -> DataFrame:
    return _union([check_unique(m, models[m], c) for m, cols in UNIQUE.items() for c in cols])


def accepted_values_tests(models: dict[str, DataFrame]) -> DataFrame:
    return _union([check_accepted(m, models[m], c, vals) for m, (c, vals) in ACCEPTED.items()])


def relationship_tests(models: dict[str, DataFrame]) -> DataFrame:
    return check_relationship(
        "fct_orders", models["fct_orders"], "product_id", models["dim_products"], "product_id"
    )


def negative_revenue(enriched: DataFrame) -> DataFrame:
    return enriched.where("net_revenue_cents < 0").select("order_id", "net_revenue_cents")


def missing_customer(staged_orders: DataFrame) -> DataFrame:
    return staged_orders.where("customer_id IS NULL").select("order_id", "customer_id")


def singular_tests(models: dict[str, DataFrame]) -> DataFrame:
    checks = (
        ("positive_revenue", "int_orders_enriched", "net_revenue_cents",
         negative_revenue(models["int_orders_enriched"])),
        ("no_null_customer", "stg_orders", "customer_id", missing_customer(models["stg_orders"])),
    )
    return _union([
        rows.agg(F.count("*").alias("n")).select(*_result(test, model, column, F.col("n")))
        for test, model, column, rows in checks
    ])


def run_data_tests(models: dict[str, DataFrame]) -> DataFrame:
    """Every data test as (test, model, column_name, failures, status)."""
    results = _union([
        not_null_tests(models), unique_tests(models), accepted_values_tests(models),
        relationship_tests(models), singular_tests(models),
    ])
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
