"""Keyed table maintenance without MERGE.

Tables are Parquet partitioned by a column. A merge rewrites only the partitions it
touches, so its cost follows the change and not the table. They change in one step: a run that
breaks off leaves the table as it was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfline.operators.rows import first_per_key
from shelfline.schemas import FACT, ODS
from shelfline.sources.versions import Snapshot, VersionedTable

MONTH = "order_month"
BUCKET = "bucket"
EPOCH = dt.date(1900, 1, 1)


def merged(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``new``, plus ``new``."""
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def new_rows(source: DataFrame, since: dt.date | None) -> DataFrame:
    """Rows dated at or after the bound. NULL dates never pass."""
    return source.where(F.col("order_date") >= F.lit(since or EPOCH))


def incremental_fact(target: DataFrame | None, source: DataFrame, full_refresh: bool = False) -> DataFrame:
    """The fact after one run: rows from the target's newest date on replace theirs by key.

    Late rows with an older date are not seen; a full refresh picks them up.
    """
    if target is None or full_refresh:
        return source
    newest = target.agg(F.coalesce(F.max("order_date"), F.lit(EPOCH))).scalar()
    return merged(target, source.where(F.col("order_date") >= newest), ["order_id"])


def _month() -> Column:
    return F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("none"))


class MonthlyFact:
    """The order fact as a stored table, partitioned by order month, with an index of its order ids.

    An update finds the months of the orders it replaces in the index, in the buckets that their ids fall into.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = FACT, buckets: int = 64):
        self.spark = spark
        self.path = path
        self.schema = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])

        self.table = VersionedTable(spark, path, MONTH, key=["order_id"], buckets=buckets)

    def read(self) -> DataFrame:
        return self.table.read(self.schema).drop(MONTH)

    def newest_date(self) -> dt.date | None:
        """The largest stored order date: only the last month with dates is read."""
        months = sorted(m for m in self.table.partitions() if m != "none")
        if not months:
            return None
        return self.table.read(self.schema, months[-1:]).agg(F.max("order_date")).first()[0]

    def refresh(self, source: DataFrame) -> None:
        self.table.replace(source.withColumn(MONTH, _month()))

    def update(self, source: DataFrame, since: dt.date | None = None) -> dt.date | None:
        """Merge the rows from the bound on and return the bound.

        Months that hold a replaced order are rewritten with it; all others are left
        alone.
        """
        bound = since or self.newest_date()
        if bound is None:
            self.refresh(source)
            return None
        # The increment is used for the keys, the months and the write.
        fresh = new_rows(source, bound).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.table.change(lambda now: self._merge(now, fresh))
        finally:
            fresh.unpersist()
        return bound

    def _merge(self, now: Snapshot, fresh: DataFrame) -> None:
        touched = now.holding(fresh, self.schema).union(fresh.select(_month().alias(MONTH))).distinct()
        # At most one value per calendar month.
        months = {r[0] for r in touched.collect()}
        if not months:
            return
        target = now.read(self.schema, months).drop(MONTH)
        # A month whose last order moved elsewhere is not filled again. The keys of all months were looked at, and another
        # writer may have put one of them into a new one.
        rows = merged(target, fresh, ["order_id"]).withColumn(MONTH, _month())
        now.replace(rows, months, at_all=True)


def latest_changes(changes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The last change of every record."""
    return first_per_key(changes, ["record_id"], order)


class RecordStore:
    """Latest state per record, spread over folders by the first hex digits of the record id:
    16 folders for one digit, 256 for two, 4096 for three. A merge rewrites the folders its
    changes fall into.

    The newest ``upsert_at`` of a record wins, whatever the order of the merges, so a merge may
    be repeated after a failure or come late.
    """

    def __init__(self, spark: SparkSession, path: str, digits: int = 2):
        self.spark = spark
        self.path = path
        self.digits = digits
        self.table = VersionedTable(spark, path, BUCKET)
        self.schema = T.StructType([*ODS.fields, T.StructField(BUCKET, T.StringType())])

    def read(self) -> DataFrame:
        return self.table.read(self.schema).drop(BUCKET)

    def merge(self, changes: DataFrame) -> None:
        """Insert or replace by record_id. ``changes`` holds a record once."""
        spread = changes.select(*ODS.names, F.substring("record_id", 1, self.digits).alias(BUCKET))
        # The changes are used for the list of folders and for the write.
        spread = spread.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            buckets = {r[0] for r in spread.select(BUCKET).distinct().collect()}
            self.table.change(lambda now: self._merge(now, spread, buckets))
        finally:
            spread.unpersist()

    def _merge(self, now: Snapshot, spread: DataFrame, buckets: set[str]) -> None:
        both = now.read(self.schema, buckets).withColumn("_new", F.lit(0)).unionByName(spread.withColumn("_new", F.lit(1)))
        newest = first_per_key(both, ["record_id", BUCKET], [F.desc("upsert_at"), F.desc("_new")])
        now.replace(newest.drop("_new"), buckets)
