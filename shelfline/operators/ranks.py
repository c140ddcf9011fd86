"""Positions and exact quantiles over data of any size.

Positions rest on range partitions: count per partition, and add the counts of the partitions before. Quantiles of
columns come from histograms that are counted, narrowed to the bins that hold a wanted rank, and counted again. No task
ever sorts a whole column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.session import ensure_checkpoint_dir

_PART = "_part"
#: Bins of one histogram.
BINS = 1024


def _placed(df: DataFrame, *order: str) -> DataFrame:
    """Rows with the number of their range partition, fixed by a checkpoint so that counts
    and rows agree on it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id()).checkpoint()


def _offsets(placed: DataFrame, weight: Column, by: Sequence[str] = ()) -> DataFrame:
    """Total weight of the partitions before each one: one row per partition (and group)."""
    before = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*by, _PART).agg(F.sum(weight).alias("_size"))
    return sums.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def dense_position(df: DataFrame, order: str, name: str) -> DataFrame:
    """Number the rows 0, 1, 2 … in the order of a unique column."""
    placed = _placed(df, order)
    within = Window.partitionBy(_PART).orderBy(order)
    start = F.broadcast(_offsets(placed, F.lit(1)).select(_PART, "_start"))
    local = placed.withColumn("_n", F.row_number().over(within) - 1)
    return local.join(start, _PART).withColumn(name, F.col("_start") + F.col("_n")).drop(
        _PART, "_n", "_start"
    )


def exact_quantiles(counts: DataFrame, group: str, value: str, weight: str, probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles per group: (group, q0, q1, …).

    ``counts`` holds one row per group and distinct value with its number of occurrences.
    Only the partitions that contain a wanted rank are looked into.
    """
    placed = _placed(counts.select(group, value, weight), group, value)
    spans = _offsets(placed, F.col(weight), [group])
    totals = spans.groupBy(group).agg(F.sum("_size").alias("_total"))
    wanted = totals.select(
        group,
        F.inline(F.array(*(
            F.struct(
                F.lit(i).alias("_i"),
                ((F.col("_total") - 1) * F.lit(float(p))).alias("_at"),
            )
            for i, p in enumerate(probabilities)
        ))),
    )
    ranks = wanted.select(
        group, "_i",
        (F.col("_at") - F.floor("_at")).alias("_share"),
        F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank"),
    )
    # A handful of ranks per group against one row per partition.
    hits = ranks.join(spans, group).where(
        (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_size"))
    )
    running = Window.partitionBy(group, _PART).orderBy(value)
    touched = placed.join(F.broadcast(hits.select(group, _PART).distinct()), [group, _PART], "left_semi")
    cumulated = touched.withColumn("_upto", F.sum(weight).over(running))
    found = cumulated.join(F.broadcast(hits), [group, _PART]).where(
        (F.col("_rank") < F.col("_start") + F.col("_upto"))
        & (F.col("_rank") >= F.col("_start") + F.col("_upto") - F.col(weight))
    )
    ends = found.groupBy(group, "_i", "_share").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    point = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share")
    return ends.groupBy(group).agg(
        *(F.max(F.when(F.col("_i") == i, point)).alias(f"q{i}") for i in range(len(probabilities)))
    )


@dataclass(frozen=True)
class _Span:
    """Values of a column between two of them, and how many are smaller: where some wanted ranks lie."""

    column: str
    low: float
    high: float
    below: int
    ranks: tuple[int, ...]

    def bin(self, wide: bool) -> Column:
        """The bin of a value between low and high, NULL for others. It never falls as the value grows, low and high differ."""
        value = F.col(self.column)
        # The logarithm of the least positive double is above -745; that of zero is NULL.
        scale = (lambda v: F.signum(v) * F.coalesce(F.log(F.abs(v)) + 746, F.lit(0.0))) if wide else (lambda v: v * 0.5)
        low, high = (scale(F.lit(v)) for v in (self.low, self.high))
        share = F.try_divide(scale(value) - low, high - low)  # NULL where the scale does not tell them apart
        inner = F.least(F.floor(share * BINS), F.lit(BINS - 2)).cast("int")
        # The ends have bins of their own, so every pass splits the span whatever its values are.
        place = F.when(value == self.low, -1).when(value == self.high, BINS - 1).otherwise(F.coalesce(inner, F.lit(0)))
        return F.when((value >= self.low) & (value <= self.high), place)


def _narrowed(df: DataFrame, spans: list[_Span], wide: bool) -> list[_Span]:
    """The spans of the bins that hold the wanted ranks, after one pass over ``df``."""
    cells = F.array(*(
        F.struct(F.lit(i).alias("span"), s.bin(wide).alias("bin"), F.col(s.column).alias("value")) for i, s in enumerate(spans)
    ))
    bins = df.select(F.inline(F.filter(cells, lambda c: c["bin"].isNotNull()))).groupBy("span", "bin").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    upto = F.sum("n").over(Window.partitionBy("span").orderBy("bin"))  # at most BINS + 1 rows a span
    wanted = F.array(*(
        F.struct(F.lit(i).alias("at"), F.lit(rank - s.below).alias("rank")) for i, s in enumerate(spans) for rank in s.ranks
    ))
    hits = bins.withColumn("upto", upto).withColumn("ranks", F.transform(
        F.filter(wanted, lambda w: (w["at"] == F.col("span")) & (w["rank"] < F.col("upto")) & (w["rank"] >= F.col("upto") - F.col("n"))),
        lambda w: w["rank"],
    )).where(F.size("ranks") > 0)
    # at most one row for each wanted rank
    return [
        _Span(spans[r.span].column, r.low, r.high, spans[r.span].below + r.upto - r.n, tuple(k + spans[r.span].below for k in r.ranks))
        for r in hits.collect()
    ]


def column_quantiles(
    df: DataFrame, bounds: dict[str, tuple[int, float, float]], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Exact, linearly interpolated quantiles of double columns: one number for each probability.

    ``bounds`` holds how many values a column has, one at least, and the least and greatest, which are finite; NULL is not counted.
    A pass counts the values of all columns into histograms between known ends, and a span goes on between the least and greatest
    value of its bin until they are the same. Only bin counts are shuffled. Prices, ages and the like take two or three
    passes. Every second pass has logarithmic bins, for values of very different size.
    """
    ranks = {
        c: [((n - 1) * p, math.floor((n - 1) * p), math.ceil((n - 1) * p)) for p in probabilities] for c, (n, _, _) in bounds.items()
    }
    found: dict[tuple[str, int], float] = {}
    spans = [
        _Span(c, low, high, 0, tuple(sorted({k for _, a, b in ranks[c] for k in (a, b)}))) for c, (_, low, high) in bounds.items()
    ]
    wide = False
    while spans:
        for s in spans:
            if s.low == s.high:
                found |= {(s.column, rank): s.low for rank in s.ranks}
        spans = [s for s in spans if s.low != s.high]
        if spans:
            spans = _narrowed(df.select(*sorted({s.column for s in spans})), spans, wide)
            wide = not wide
    return {
        c: [found[c, a] + (found[c, b] - found[c, a]) * (at - a) for at, a, b in ranks[c]] for c in bounds
    }
