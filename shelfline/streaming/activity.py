"""Per-minute activity as an event-time stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def minute_activity(events: DataFrame, system: str, moment: str, delay: str = "10 minutes") -> DataFrame:
    """Events per system and minute. A minute is emitted once the watermark has passed it;
    rows that come later than that are dropped."""
    timed = events.select(
        F.col(system).alias("source_system"), F.col(moment).cast("timestamp").alias("event_time")
    )
    counted = timed.withWatermark("event_time", delay).groupBy(
        F.window("event_time", "1 minute"), "source_system"
    ).agg(F.count("*").alias("txn_count"))
    return counted.select(
        "source_system", F.col("window.start").alias("minute_bucket"), "txn_count"
    )


def run_to_table(stream: DataFrame, path: str, progress: str) -> DataFrame:
    """Process everything that is there, append the closed minutes, return the table."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def with_open_minutes(closed: DataFrame, events: DataFrame, system: str, moment: str) -> DataFrame:
    """The closed minutes, as the stream left them, and the newer ones counted from the events."""
    last = closed.agg(F.max("minute_bucket")).first()[0]
    timed = events.select(
        F.col(system).alias("source_system"), F.date_trunc("minute", F.col(moment).cast("timestamp")).alias("minute_bucket")
    )
    if last is not None:
        timed = timed.where(F.col("minute_bucket") > F.lit(last))
    newer = timed.groupBy("source_system", "minute_bucket").agg(F.count("*").alias("txn_count"))
    return closed.unionByName(newer)


def event_stream(spark: SparkSession, folder: str, schema: T.StructType, names: str = "*.parquet") -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).parquet(folder)
