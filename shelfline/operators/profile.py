"""Column profiles of a table.

Few passes whatever the number of columns: a wide aggregate for the moments, histograms that are narrowed
for the quantiles, and one melted count per (column, value) for nulls, distinct values and top values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfline.operators.ranks import column_quantiles, exact_quantiles

HIGH_CARDINALITY_PCT = 90.0


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, value as text, n) for every distinct value, NULL included.

    Counts combine before the shuffle, so a value held by most rows is one row per task.
    """
    names = columns or df.columns
    text = df.select(*(F.col(c).cast("string").alias(c) for c in names))
    # Numbers stand for the names until the values are counted.
    cells = F.array(*(F.struct(F.lit(i).alias("number"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(names)))
    counted = text.select(F.inline(cells)).groupBy("number", "value").agg(F.count("*").alias("n"))
    named = F.array(*(F.lit(c) for c in names))
    return counted.select(F.get(named, F.col("number")).alias("column_name"), "value", "n")


def completeness(counts: DataFrame) -> DataFrame:
    """Totals, nulls, distinct values and the most frequent value per column."""
    present = F.col("value").isNotNull()
    grouped = counts.groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("uniques"),
        # Most frequent first, then the smallest text.
        F.min(F.when(present, F.struct((-F.col("n")).alias("minus_n"), "value"))).alias("top"),
    )
    total = F.nullif(F.col("total").cast("double"), F.lit(0.0))
    filled = F.nullif((F.col("total") - F.col("nulls")).cast("double"), F.lit(0.0))
    return grouped.select(
        "column_name", "total", "nulls",
        F.round(F.col("nulls") / total * 100, 2).alias("null_pct"),
        "uniques",
        F.round(F.col("uniques") / total * 100, 2).alias("cardinality_pct"),
        (F.round(F.col("uniques") / total * 100, 2) > HIGH_CARDINALITY_PCT).alias("high_cardinality"),
        (F.col("nulls") == F.col("total")).alias("all_null"),
        F.col("top.value").alias("top_value"),
        (-F.col("top.minus_n")).alias("top_freq"),
        F.round(-F.col("top.minus_n") / filled * 100, 2).alias("top_pct"),
    )


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, maximum, mean, sample deviation and adjusted skewness, one row per column."""
    values = {c: F.col(c).cast("double") for c in columns}
    wide = df.agg(*(
        F.struct(
            F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.skewness(v).alias("g1"),
        ).alias(c)
        for c, v in values.items()
    ))
    tall = wide.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("m")) for c in columns
    )))).select("column_name", "m.*")
    n = F.col("n").cast("double")
    adjusted = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    flat = F.col("min") == F.col("max")
    return tall.select(
        "column_name", "n", "min", "max", "mean", "std",
        F.when(F.col("n") < 3, None).when(flat, 0.0).when(n > 2, adjusted).alias("skew"),
        F.coalesce(F.col("std") == 0, F.lit(False)).alias("constant"),
    )


def _quantiles(df: DataFrame, known: list, probabilities: list[float]) -> DataFrame:
    """column_name, q0, q1 …: by histograms; columns that hold NaN or infinities by their counted values."""
    names = [f"q{i}" for i in range(len(probabilities))]
    finite = {r.column_name: (r.n, r.min, r.max) for r in known if math.isfinite(r.min) and math.isfinite(r.max)}
    doubles = df.select(*(F.col(c).cast("double").alias(c) for c in finite))
    numbers = column_quantiles(doubles, finite, probabilities) if finite else {}
    schema = ", ".join(["column_name string", *(f"{q} double" for q in names)])
    result = df.sparkSession.createDataFrame([(c, *q) for c, q in numbers.items()], schema)
    others = [r.column_name for r in known if r.column_name not in finite]
    if others:
        counted = value_counts(df, others).where("value IS NOT NULL").withColumn("number", F.col("value").cast("double"))
        result = result.unionByName(exact_quantiles(counted, "column_name", "number", "n", probabilities))
    return result


def numeric_profile(df: DataFrame) -> DataFrame:
    """Statistics of the numeric columns, quantiles exact and linearly interpolated."""
    columns = numeric_columns(df)
    # One row per column: the moments of the table, which also bound the first histograms.
    seen = moments(df, columns).where("n > 0")
    known = seen.collect()
    quantiles = _quantiles(df, known, [0.25, 0.5, 0.75])
    return df.sparkSession.createDataFrame(known, seen.schema).join(F.broadcast(quantiles), "column_name").select(
        "column_name", "min", "max", "mean", F.col("q1").alias("median"), "std",
        F.col("q0").alias("p25"), F.col("q2").alias("p75"),
        F.round("skew", 4).alias("skew"), "constant",
    )


def approximate_numeric_profile(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Quantiles from a sketch: one pass, opt-in."""
    columns = numeric_columns(df)
    wide = df.agg(*(
        F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], accuracy).alias(c)
        for c in columns
    ))
    return wide.select(F.inline(F.array(*(
        F.struct(
            F.lit(c).alias("column_name"), F.col(c)[0].alias("p25"), F.col(c)[1].alias("median"),
            F.col(c)[2].alias("p75"),
        )
        for c in columns
    ))))


def approximate_completeness(df: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Totals, nulls and estimated distinct values per column in one pass, opt-in."""
    wide = df.agg(*(
        F.struct(
            F.count("*").alias("total"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.approx_count_distinct(c, rsd).alias("uniques"),
        ).alias(c)
        for c in df.columns
    ))
    return wide.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("p")) for c in df.columns
    )))).select("column_name", "p.*")


def categorical_profile(df: DataFrame) -> DataFrame:
    """Completeness of every column; top values for the columns that are not numeric."""
    numeric = numeric_columns(df)
    profile = completeness(value_counts(df))
    is_numeric = F.col("column_name").isin(*numeric) if numeric else F.lit(False)
    tops = ("top_value", "top_freq", "top_pct")
    return profile.select(
        *(c for c in profile.columns if c not in tops),
        is_numeric.alias("is_numeric"),
        *(F.when(~is_numeric, F.col(c)).alias(c) for c in tops),
    )


def severity(null_pct: Column) -> Column:
    """Colour band of the share of missing values."""
    return F.when(null_pct > 20, "red").when(null_pct > 5, "amber").otherwise("green")


def badge(all_null: Column, high_cardinality: Column, constant: Column) -> Column:
    return (
        F.when(all_null, "all_null").when(high_cardinality, "high_cardinality").when(constant, "constant")
    )


def column_report(df: DataFrame) -> DataFrame:
    """Completeness, constant flag, severity band and badge per column."""
    numeric = numeric_columns(df)
    profile = categorical_profile(df)
    if numeric:
        flags = moments(df, numeric).select("column_name", "constant")
        profile = profile.join(F.broadcast(flags), "column_name", "left")
    else:
        profile = profile.withColumn("constant", F.lit(None).cast("boolean"))
    return profile.withColumn("severity", severity(F.col("null_pct"))).withColumn(
        "badge", badge(F.col("all_null"), F.col("high_cardinality"), F.col("constant"))
    )


def table_summary(table: str, df: DataFrame) -> DataFrame:
    """Rows, columns, kinds, null cells and high-cardinality columns of one table."""
    return categorical_profile(df).agg(
        F.max("total").alias("row_count"),
        F.count("*").alias("column_count"),
        F.count_if("is_numeric").alias("numeric_columns"),
        F.count_if(~F.col("is_numeric")).alias("categorical_columns"),
        F.sum("nulls").alias("null_cells"),
        F.count_if("high_cardinality").alias("high_cardinality_columns"),
    ).withColumn("table_name", F.lit(table))
