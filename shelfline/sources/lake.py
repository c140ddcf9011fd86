"""Lake tables: Parquet under ``entity/year=YYYY/month=MM/day=DD``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline.schemas import ENTITIES, EXEC_DATE
from shelfline.sources import paths
from shelfline.sources.batches import BatchTable

PARTS = ("year", "month", "day")


def tag(df: DataFrame, day: dt.date) -> DataFrame:
    return df.withColumn(EXEC_DATE, F.lit(day))


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, entity: str, day: dt.date | None = None) -> str:
        base = f"{self.root}/{entity}"
        return base if day is None else f"{base}/year={day:%Y}/month={day:%m}/day={day:%d}"

    def write_batches(self, df: DataFrame, entity: str) -> None:
        """Replace the day partitions that occur in ``df``, all of them in one job."""
        day = F.col(EXEC_DATE)
        # Zero-padded text keeps the folder names two digits wide.
        dated = df.select(
            *(c for c in df.columns if c != EXEC_DATE),
            F.date_format(day, "yyyy").alias("year"),
            F.date_format(day, "MM").alias("month"),
            F.date_format(day, "dd").alias("day"),
        )
        paths.overwrite_partitions(dated, self.path(entity), *PARTS)

    def write_day(self, df: DataFrame, entity: str, day: dt.date) -> str:
        """Replace one day's partition. Empty input writes nothing and returns an empty path."""
        if df.isEmpty():
            return ""
        self.write_batches(tag(df, day), entity)
        return self.path(entity, day)

    def dates(self, entity: str) -> tuple[dt.date, ...]:
        """The stored days, from folder names."""
        found = paths.partition_values(self.spark, self.path(entity), *PARTS)
        return tuple(dt.date(*(int(p[c]) for c in PARTS)) for p in found)

    def read(self, entity: str, schema: T.StructType | None = None) -> DataFrame:
        """All days. ``_execution_date`` is computed from the partition columns, so a filter on
        it prunes folders."""
        base = schema or ENTITIES[entity]
        full = T.StructType([*base.fields, *(T.StructField(c, T.StringType()) for c in PARTS)])
        rows = self.spark.read.schema(full).parquet(self.path(entity))
        day = F.make_date(*(F.col(c).cast("int") for c in PARTS))
        return rows.withColumn(EXEC_DATE, day).drop(*PARTS)

    def read_day(self, entity: str, day: dt.date, schema: T.StructType | None = None) -> DataFrame:
        return self.read(entity, schema).where(F.col(EXEC_DATE) == F.lit(day))

    def batches(self, entity: str, schema: T.StructType | None = None) -> BatchTable:
        return BatchTable(lambda: self.read(entity, schema), self.dates(entity))

    def drop_day(self, entity: str, day: dt.date) -> bool:
        """Remove one day; tells whether it was there."""
        return paths.delete(self.spark, self.path(entity, day))

    def drop_day_everywhere(self, day: dt.date) -> dict[str, bool]:
        return {entity: self.drop_day(entity, day) for entity in ENTITIES}


def replace_batch(df: DataFrame, path: str, day: dt.date) -> None:
    """Make the rows tagged ``day`` of a table equal ``df``; other days stay untouched.

    Loading a day twice gives the same table, and an empty load empties the day.
    """
    spark = df.sparkSession
    if df.isEmpty():
        paths.delete(spark, f"{path}/{EXEC_DATE}={day:%Y-%m-%d}")
        return
    paths.overwrite_partitions(tag(df, day), path, EXEC_DATE)
