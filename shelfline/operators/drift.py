"""Schema drift: what a source file brings against what is declared."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline.schemas import ENTITIES
from shelfline.sources import paths
from shelfline.sources.files import read_inferred

NONE, WARNING, CRITICAL = "none", "warning", "critical"
REPORT_SCHEMA = (
    "entity string, severity string, kind string, column_name string, expected string, actual string"
)


class SchemaDriftError(RuntimeError):
    """A source lacks a column or has one of another type."""

    def __init__(self, entity: str, findings: list[tuple]):
        super().__init__(f"schema drift in {entity}: {findings}")
        self.entity = entity
        self.findings = findings


def type_class(kind: T.DataType) -> str:
    """Types that count as the same. Dates and times arrive as text in files."""
    if isinstance(kind, T.IntegralType):
        return "int64"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "float64"
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "string"
    return kind.simpleString()


def _all_null(df: DataFrame, columns: list[str]) -> set[str]:
    if not columns:
        return set()
    counted = df.agg(*(F.count(c).alias(c) for c in columns)).first()
    return {c for c in columns if counted[c] == 0}


def find_drift(entity: str, df: DataFrame) -> list[tuple]:
    """(entity, severity, kind, column, expected, actual) rows of the worst level found.

    Missing columns come first, then types, then extra columns. Unknown entities have no
    declaration to drift from.
    """
    declared = ENTITIES.get(entity)
    if declared is None:
        return []
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(set(declared.names) - set(actual))
    if missing:
        return [
            (entity, CRITICAL, "missing_column", c, type_class(declared[c].dataType), None) for c in missing
        ]
    wrong = [
        (f.name, type_class(f.dataType), type_class(actual[f.name]))
        for f in declared.fields
        if type_class(f.dataType) != type_class(actual[f.name])
    ]
    if wrong:
        # A column without a value has no type to compare.
        unknown = _all_null(df, [c for c, _, _ in wrong])
        wrong = [w for w in wrong if w[0] not in unknown]
    if wrong:
        return [(entity, CRITICAL, "type_mismatch", c, want, got) for c, want, got in wrong]
    extra = sorted(set(actual) - set(declared.names))
    return [(entity, WARNING, "extra_column", c, None, type_class(actual[c])) for c in extra]


def severity_of(findings: list[tuple]) -> str:
    levels = {f[1] for f in findings}
    return CRITICAL if CRITICAL in levels else WARNING if levels else NONE


def detect_drift(
    spark: SparkSession, entity: str, path: str, file_type: str, multi_line: bool | None = None
) -> list[tuple]:
    """Drift of a stored source, judged by all of its rows. An unknown file type is not checked;
    an unreadable file raises."""
    if entity not in ENTITIES or file_type not in ("csv", "json"):
        return []
    return find_drift(entity, read_inferred(spark, path, file_type, multi_line))


def drift_report(spark: SparkSession, sources: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Findings of several sources: {entity: (path, file type)}."""
    found = [row for e, (path, kind) in sources.items() for row in detect_drift(spark, e, path, kind)]
    return spark.createDataFrame(found, REPORT_SCHEMA)


def stop_on_drift(
    spark: SparkSession, entity: str, path: str, file_type: str, rejected_root: str | None = None
) -> list[tuple]:
    """Raise before anything is written when drift is critical, after moving the source to the
    rejected folder; return the warnings otherwise."""
    findings = detect_drift(spark, entity, path, file_type)
    if severity_of(findings) == CRITICAL:
        if rejected_root:
            paths.move(spark, path, f"{rejected_root.rstrip('/')}/{path.rstrip('/').rsplit('/', 1)[-1]}")
        raise SchemaDriftError(entity, findings)
    return findings
