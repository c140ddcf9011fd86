"""Report export: the analytics results as files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

PLACEHOLDER = "No data available"


def _write(df: DataFrame, target: str, file_format: str) -> None:
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).csv(target)
    else:
        writer.format(file_format).save(target)


def export_reports(reports: Mapping[str, DataFrame], root: str, file_format: str = "csv") -> dict[str, str]:
    """Write each result under its name. An empty result becomes a one-row placeholder."""
    written = {}
    for name, df in reports.items():
        spark = df.sparkSession
        target = f"{root.rstrip('/')}/{name}"
        _write(df, target, file_format)
        # The written files are looked at instead of running the report twice.
        stored = spark.read.schema(df.schema).option("header", True).format(file_format).load(target)
        if stored.isEmpty():
            _write(spark.range(1).select(F.lit(PLACEHOLDER).alias("message")), target, file_format)
        written[name] = target
    return written
