"""Helpers shared by the operators that are DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.session import ensure_checkpoint_dir, scratch_path
from shelfline.sources import paths

#: A word: a run of characters other than the six ASCII white-space characters.
WORDS = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Tables:
    """Tables of one job in the shared folder. They cut lineage, and each goes when nothing reads it any more."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.made = spark, scratch_path(spark, label), 0

    def put(self, df: DataFrame) -> tuple[str, DataFrame]:
        """The path of a new table with the rows of ``df``, and the table."""
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.parquet(path)
        return path, self.of([path], df)

    def of(self, tables: list[str], like: DataFrame) -> DataFrame:
        """All rows of several tables in one scan."""
        return self.spark.read.schema(like.schema).parquet(*tables)

    def drop(self, *tables: str) -> None:
        for path in tables:
            paths.delete(self.spark, path)
