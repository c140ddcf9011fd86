"""Where rows go that a gate holds back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.schemas import EXEC_DATE
from shelfline.sources.files import CSV_QUOTING


def write_refused(df: DataFrame, root: str, entity: str, stamp: str) -> None:
    """Append held-back rows, with their reason, as CSV under entity, run date and stamp.

    Nothing is written for empty input, because files only appear inside partitions.
    """
    (
        df.withColumn("entity", F.lit(entity))
        .withColumn("stamp", F.lit(stamp))
        .write.mode("append")
        .options(header=True, **CSV_QUOTING)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("entity", EXEC_DATE, "stamp")
        .csv(root)
    )


def read_refused(spark, root: str, entity: str) -> DataFrame:
    """Held-back values may hold line breaks, so a file is read by one task."""
    return spark.read.options(header=True, multiLine=True, **CSV_QUOTING).csv(f"{root}/entity={entity}").withColumn(
        "entity", F.lit(entity)
    )
