"""Loading one batch: contract, guardrail, tag, hash, store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions import pii_hash
from shelfline.operators import quality, unify
from shelfline.operators.drift import stop_on_drift
from shelfline.schemas import EXEC_DATE, SOURCE_FORMATS
from shelfline.sources import files, lake as lakes, paths
from shelfline.sources.lake import Lake
from shelfline.sources.refused import write_refused

PII_COLUMNS = ("first_name", "last_name", "email")


def anonymise(df: DataFrame) -> DataFrame:
    """Hash the personal columns a frame has."""
    present = [c for c in PII_COLUMNS if c in df.columns]
    return df.withColumns({c: pii_hash(F.col(c)) for c in present})


def clean_rows(tagged: DataFrame, entity: str, hash_pii: bool = True) -> DataFrame:
    """The rows both gates let through, hashed where the entity is about people."""
    rows = tagged.where(F.col("outcome") == quality.CLEAN).drop(
        "outcome", "quarantine_reason", "rejection_reason"
    )
    return anonymise(rows) if hash_pii and entity == "customers" else rows


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    held = tagged.where(F.col("outcome") == quality.QUARANTINED)
    return held.drop("outcome", "rejection_reason")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("outcome") == quality.REJECTED).drop("outcome", "quarantine_reason")


def load_batch(
    df: DataFrame, entity: str, day: dt.date, lake: Lake, refused_root: str, stamp: str,
    hash_pii: bool = True,
) -> dict[str, int]:
    """Route one day's rows of an entity to the lake, the quarantine and the dead letters.

    The verdicts are computed once and kept for the three writes. A day without clean rows
    ends up without a partition, also when an earlier load had filled it.
    """
    tagged = lakes.tag(quality.with_outcome(df, entity), day).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = quality.outcome_counts(tagged).first().asDict()
        if counts["loaded"]:
            lake.write_batches(clean_rows(tagged, entity, hash_pii), entity)
        else:
            lake.drop_day(entity, day)
        if counts["quarantined"]:
            write_refused(quarantined_rows(tagged), f"{refused_root}/quarantine", entity, stamp)
        if counts["rejected"]:
            write_refused(rejected_rows(tagged), f"{refused_root}/rejected", entity, stamp)
    finally:
        tagged.unpersist()
    return counts


def load_sources(
    spark: SparkSession, raw_root: str, day: dt.date, lake: Lake, refused_root: str, stamp: str,
    hash_pii: bool = True,
) -> dict[str, dict[str, int]]:
    """One run over the four source files: drift check, load, union of all sales.

    Store sales pass no gate. Returns the counts per entity.
    """
    summary: dict[str, dict[str, int]] = {}
    for entity, file_type in SOURCE_FORMATS.items():
        path = f"{raw_root}/{entity}.{file_type}"
        if not paths.exists(spark, path):
            raise FileNotFoundError(path)
        stop_on_drift(spark, entity, path, file_type, f"{refused_root}/rejected_schemas")
        rows = files.read_entity(spark, entity, path, file_type, uncast=True)
        summary[entity] = load_batch(rows, entity, day, lake, refused_root, stamp, hash_pii)
    summary["unified_transactions"] = {
        "loaded": store_unified(lake, day), "rejected": 0, "quarantined": 0,
    }
    return summary


def store_unified(lake: Lake, day: dt.date) -> int:
    """Rebuild one day of the table of all sales from the lake."""
    def stored(entity: str) -> DataFrame | None:
        return lake.read_day(entity, day) if day in lake.dates(entity) else None

    sales = unify.unified_transactions(stored("orders"), stored("pos_store_sales"))
    if sales is None:
        return 0
    path = lake.path("unified_transactions")
    lakes.replace_batch(sales, path, day)
    spark = lake.spark
    return spark.read.parquet(path).where(F.col(EXEC_DATE) == F.lit(day)).count()


def backfill(
    rows: DataFrame, entity: str, start: dt.date, end: dt.date, lake: Lake, refused_root: str, stamp: str,
    hash_pii: bool = True,
) -> DataFrame:
    """Load every batch dated within the range, both ends included, through the gates, in one job for all days.

    Returns loaded, rejected and quarantined rows per day. A day of the range without clean rows ends up
    without a partition, also when an earlier load had filled it.
    """
    if start > end:
        raise ValueError(f"{start} is after {end}")
    days = rows.where(F.col(EXEC_DATE).between(F.lit(start), F.lit(end)))
    tagged = quality.with_outcome(days, entity, (EXEC_DATE,)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One row per day.
        counts = quality.outcome_counts(tagged, EXEC_DATE).collect()
        lake.write_batches(clean_rows(tagged, entity, hash_pii), entity)
        if any(c["quarantined"] for c in counts):
            write_refused(quarantined_rows(tagged), f"{refused_root}/quarantine", entity, stamp)
        if any(c["rejected"] for c in counts):
            write_refused(rejected_rows(tagged), f"{refused_root}/rejected", entity, stamp)
    finally:
        tagged.unpersist()
    filled = {c[EXEC_DATE] for c in counts if c["loaded"]}
    for day in lake.dates(entity):
        if start <= day <= end and day not in filled:
            lake.drop_day(entity, day)
    return lake.spark.createDataFrame(counts, f"{EXEC_DATE} date, loaded long, rejected long, quarantined long")


def parse_day(text: str) -> dt.date:
    """A run date as YYYY-MM-DD; anything else raises."""
    return dt.datetime.strptime(text, "%Y-%m-%d").date()


def date_range(bounds: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per calendar day between two columns, both ends included."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias(name))


def summarise(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Loaded, rejected and quarantined rows per entity and in total, with the rejection rate.

    ``counts`` holds the tagged rows of each entity.
    """
    columns = ("loaded", "rejected", "quarantined")
    per_entity = None
    for entity, tagged in counts.items():
        row = quality.outcome_counts(tagged).select(F.lit(entity).alias("entity"), *columns)
        per_entity = row if per_entity is None else per_entity.unionByName(row)
    rolled = per_entity.rollup("entity").agg(*(F.sum(c).alias(c) for c in columns))
    return rolled.select(
        F.coalesce("entity", F.lit("all")).alias("entity"),
        *columns,
        quality.rejection_rate(F.col("loaded"), F.col("rejected")).alias("rejection_rate_pct"),
    )


