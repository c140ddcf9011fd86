"""Source files: CSV and JSON scans."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfline.schemas import ENTITIES
from shelfline.sources import records

#: Names of the columns of a row whose text does not fit the declared type.
UNCAST = "_uncast"
#: What numbers and booleans can look like in text. A cast of other text costs an exception, for each value.
_LOOKS = {
    T.LongType(): r"[+-]?[0-9]+",
    T.DoubleType(): r"[+-]?(0x[0-9a-f.]+p[+-]?[0-9]+[fd]?|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[fd]?|nan|inf|infinity)",
    T.BooleanType(): r"(t|true|y|yes|1|f|false|n|no|0)",
}
# Quotes inside quotes are doubled, as in RFC 4180; the writer of refused rows uses the same.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns of the files at a path as text, each file by its own header; a column that some files lack is
    NULL there. Headers are found by the tasks that read the files; what comes back is one row for each different one.

    ``multi_line`` is for files with line breaks inside quotes. Files larger than a split are read by several tasks then, too.
    """
    whole = multi_line and not records.in_one_split(spark, path)
    rows, heads = records.csv_records_and_heads(spark, path) if whole else (None, records.csv_headers(spark, path))
    heads = heads.select("file", F.ltrim(F.col("record"), F.lit("\ufeff")).alias("header"))
    names = {r.header: [n.strip() for n in next(csv.reader([r.header]), [])] for r in heads.select("header").distinct().collect()}
    if not names:
        raise FileNotFoundError(f"no CSV file with a header at {path}")
    if len(names) == 1 and not whole:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in next(iter(names.values()))])
        options = {"header": True, "multiLine": multi_line, "recursiveFileLookup": True, **CSV_QUOTING}
        return spark.read.schema(schema).options(**options).csv(path)
    if rows is None:
        rows = records.csv_records(spark, path) if multi_line else records.csv_lines(spark, path)
    return _by_header(rows.where("NOT first AND trim(record) <> ''"), heads, names)


def _by_header(rows: DataFrame, heads: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """CSV records (file, record) as columns of text, by the header of their file."""
    columns = list(dict.fromkeys(n for own in names.values() for n in own))
    places = rows.sparkSession.createDataFrame(
        [(header, [own.index(c) if c in own else None for c in columns]) for header, own in names.items()],
        "header string, places array<int>",
    )
    by_file = heads.join(F.broadcast(places), "header").select("file", "places")  # a row for each different header
    if heads.count() <= records.MOST_SENT:
        by_file = F.broadcast(by_file)
    width = max(map(len, names.values()))
    fields = [f"c{i}" for i in range(width)]
    row = F.from_csv("record", ", ".join(f"{f} string" for f in fields), CSV_QUOTING)
    values = rows.join(by_file, "file").select(row.alias("r"), "places").select(F.array(*(f"r.{f}" for f in fields)).alias("v"), "places")
    return values.select(*(F.get("v", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(columns)))


def typed(text: DataFrame, schema: T.StructType, uncast: bool = False) -> DataFrame:
    """The declared columns in their types. Text that does not fit becomes NULL; with ``uncast``
    the row lists the columns where that happened."""
    values = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if not uncast:
        return text.select(*values)
    lost = [
        F.when(F.trim(F.col(f.name)) != "", F.when(F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)))
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return text.select(*values, F.array_compact(F.array(*lost)).cast("array<string>").alias(UNCAST))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, uncast: bool = False
) -> DataFrame:
    """Declared columns, taken by header name in every file."""
    return typed(read_text_csv(spark, path, multi_line), schema, uncast)


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """JSON arrays or objects. With ``multi_line`` a file is one document; files larger than a split are cut at the borders of their
    objects and read by several tasks. Pass False for files that hold one object or array per line, which Spark splits."""
    if not multi_line or records.in_one_split(spark, path):
        return spark.read.schema(schema).option("multiLine", multi_line).option("recursiveFileLookup", True).json(path)
    return records.json_objects(spark, path).select(F.from_json("record", schema).alias("r")).select("r.*")


def read_entity(
    spark: SparkSession, entity: str, path: str, file_type: str, multi_line: bool | None = None, uncast: bool = False
) -> DataFrame:
    """``multi_line``: line breaks inside CSV quotes (default no), JSON documents over many lines (default yes)."""
    if file_type == "csv":
        return read_csv(spark, path, ENTITIES[entity], bool(multi_line), uncast)
    if file_type == "json":
        return read_json(spark, path, ENTITIES[entity], multi_line is not False)
    raise ValueError(f"Unsupported file type: {file_type}")


def fitted(value: Column, kind: T.DataType) -> Column:
    """Text as a bigint, double or boolean, NULL where it does not fit."""
    return F.when(value.rlike(rf"(?i)^[\x00-\x20\x7f]*{_LOOKS[kind]}[\x00-\x20\x7f]*$"), value.try_cast(kind))


def inferred(text: DataFrame) -> DataFrame:
    """Columns of text in the narrowest of bigint, double, boolean and text that fits all values.

    One aggregate over all rows; what comes back is one row.
    """
    kinds = (T.LongType(), T.DoubleType(), T.BooleanType())
    filled = {c: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c))) for c in text.columns}
    fitting = [
        F.count(fitted(value, kind)).alias(f"{i}_{k}")
        for i, value in enumerate(filled.values())
        for k, kind in enumerate(kinds)
    ]
    counts = text.agg(*(F.count(v).alias(f"{i}_n") for i, v in enumerate(filled.values())), *fitting).first()
    chosen = []
    for i, (name, value) in enumerate(filled.items()):
        n = counts[f"{i}_n"]
        kind = next((kind for k, kind in enumerate(kinds) if n and counts[f"{i}_{k}"] == n), None)
        chosen.append((value.try_cast(kind) if kind is not None else F.col(name) if n else value).alias(name))
    return text.select(*chosen)


def read_inferred(spark: SparkSession, path: str, file_type: str, multi_line: bool | None = None) -> DataFrame:
    """A scan with types inferred from all rows."""
    if file_type == "csv":
        return inferred(read_text_csv(spark, path, bool(multi_line)))
    if file_type == "json":
        return spark.read.option("multiLine", multi_line is not False).json(path)
    raise ValueError(f"Unsupported file type: {file_type}")
