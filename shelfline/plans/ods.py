"""Queries over the operational store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _moment(now: dt.datetime, kind: T.DataType) -> Column:
    """A literal of the column's type; a time without zone is taken in the session's."""
    return (F.lit(now) if now.tzinfo else F.lit(now.isoformat(" "))).cast(kind)


def minute_counts(records: DataFrame, now: dt.datetime, hours: int = 1) -> DataFrame:
    """Records per system and minute within the last hours."""
    kind = records.schema["upsert_at"].dataType
    since = _moment(now - dt.timedelta(hours=hours), kind)
    return (
        records.where(F.col("upsert_at") >= since)
        .groupBy("source_system", F.date_trunc("minute", "upsert_at").cast(kind).alias("minute_bucket"))
        .agg(F.count("*").alias("txn_count"))
        .orderBy("minute_bucket", "source_system")
    )


def summary(records: DataFrame) -> DataFrame:
    return records.groupBy("source_system").agg(
        F.count("*").alias("total_records"), F.max("upsert_at").alias("last_upsert")
    ).orderBy("source_system")


def latest(records: DataFrame, n: int = 50) -> DataFrame:
    return records.select("record_id", "source_system", "source_key", "upsert_at", "batch_id").orderBy(
        F.desc("upsert_at"), "record_id"
    ).limit(n)
