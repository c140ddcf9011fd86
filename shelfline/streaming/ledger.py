"""Which state of which file has been taken in.

A ledger is an append-only table of (path, modified, size, batch_id). A file whose modification time or size differs from
its newest entry has changed and is taken in again, once; listing and ledger meet in a join, so neither passes the driver.
The write of a batch's entries is its commit: what was taken in without them is not looked at, and taken in anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.session import ensure_checkpoint_dir
from shelfline.sources import paths

_ENTRY = "path string, modified timestamp, size long, at timestamp, batch_id string"


def same_file(path: Column) -> Column:
    """A path as all sources of files write it: without escapes, and without the empty authority of local paths."""
    return F.regexp_replace(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^([a-z][a-z0-9]*):/+", "$1:/")


class FileLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def committed(self) -> set[str]:
        """Batches whose entries are written whole."""
        found = paths.glob(self.spark, f"{self.root}/batch_id=*/_SUCCESS")
        return {p.split("/")[-2].split("=", 1)[1] for p in found}

    def entries(self) -> DataFrame:
        """path, modified, size, at, batch_id: the newest entry of every file."""
        done = sorted(f"{self.root}/batch_id={b}" for b in self.committed())
        if not done:
            return self.spark.createDataFrame([], _ENTRY)
        rows = self.spark.read.schema(_ENTRY).option("basePath", self.root).parquet(*done)
        newest = Window.partitionBy("path").orderBy(F.desc("at"), F.desc("batch_id"))
        return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")

    def listing(self, folder: str) -> DataFrame:
        """path, modified, size of the files below a folder; their contents are not read."""
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(
            "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")
        )

    def changed(self, folder: str) -> DataFrame:
        """Files that are new or differ from their newest entry, as they are now."""
        known = self.entries().select("path", "modified", "size")
        ensure_checkpoint_dir(self.spark)
        return self.listing(folder).join(known, ["path", "modified", "size"], "left_anti").checkpoint()

    def commit(self, batch_id: str, files: DataFrame, now: dt.datetime) -> None:
        entries = files.select("path", "modified", "size", F.lit(now).cast("timestamp").alias("at"))
        entries.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")
