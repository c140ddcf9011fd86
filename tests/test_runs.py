import datetime as dt
import json
import os

import pytest

from shelfline.operators import runs, scope
from shelfline.operators.drift import SchemaDriftError
from shelfline.plans import ods
from shelfline.schemas import ODS


def test_audit_on_success_and_failure(spark, folder):
    path = f"{folder}/audit"
    runs.audited(spark, path, lambda r: r.add_counts({
        "orders": {"loaded": 9, "rejected": 2}, "unified_transactions": {"loaded": 9, "rejected": 0}}))
    with pytest.raises(RuntimeError):
        runs.audited(spark, path, lambda r: (_ for _ in ()).throw(RuntimeError("broken")), sla_seconds=-1)
    with pytest.raises(SchemaDriftError):
        runs.audited(spark, path, lambda r: (_ for _ in ()).throw(SchemaDriftError("orders", [])))
    rows = {r.status: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"SUCCESS", "FAILED", "SCHEMA_DRIFT"}
    assert rows["SUCCESS"].records_ingested == 9 and rows["SUCCESS"].records_rejected == 2
    assert rows["SUCCESS"].sla_breached is False and rows["SUCCESS"].error_message is None
    assert all(r.created_at >= r.end_time for r in rows.values())
    assert rows["FAILED"].error_message == "broken" and rows["FAILED"].sla_breached is True


def test_failed_audit_write_does_not_raise(spark, folder):
    blocked = f"{folder}/file"
    open(blocked, "w").close()
    record = runs.RunRecord()
    record.finish("SUCCESS")
    assert record.commit(spark, f"{blocked}/audit") is False


def test_phase_times(spark):
    steps = spark.createDataFrame([("Load", 30.5), ("Generate Data", 10.0), ("Models", 25.0)], "step string, seconds double")
    phases = spark.createDataFrame([("Load", "in"), ("Generate Data", "in"), ("Other step", "out")], "step string, phase string")
    got = {r.phase: r for r in runs.phase_times(steps, phases).collect()}
    assert set(got) == {"in", "Other"}
    assert got["in"].seconds == 40.5 and got["Other"].total_seconds == 65.5
    assert got["in"].sla_breached and not runs.phase_times(steps, phases, 100.0).first().sla_breached


def test_row_counts(spark, folder):
    layers = {"full": spark.range(2), "empty": spark.range(0), "gone": runs.table_or_none(spark, f"{folder}/x")}
    got = {r.layer: (r.row_count, r.status) for r in runs.row_counts(layers, spark).collect()}
    assert got == {"full": (2, "OK"), "empty": (0, "WARNING"), "gone": (None, "WARNING")}


def test_result_documents(spark, folder):
    path = os.path.join(folder, "results.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"results": [
            {"unique_id": "t1", "status": "pass", "execution_time": 0.12345},
            {"unique_id": "t2", "status": "fail", "execution_time": 0.5, "message": "3 rows"},
            {"unique_id": "t3", "status": "error", "execution_time": 1.23456, "message": "boom"},
        ]}, f, indent=1)
    results = runs.read_results(spark, path)
    assert tuple(runs.result_totals(results).first()) == (3, 1, 1)
    broken = {r.unique_id: r for r in runs.broken_results(results).collect()}
    assert broken["t3"].execution_time == 1.235 and broken["t2"].message == "3 rows"
    with open(path, "w", encoding="utf-8") as f:
        f.write("not json {")
    assert tuple(runs.result_totals(runs.read_results(spark, path)).first()) == (0, 0, 0)
    assert tuple(runs.result_totals(runs.read_results(spark, f"{folder}/none.json")).first()) == (0, 0, 0)


def test_scope(spark):
    df = spark.createDataFrame([("USA",), ("Germany",), ("Peru",)], "country string")
    limits = {"all": None, "one": "Peru"}
    assert scope.scoped(df, "all", limits).count() == 3
    assert [r.country for r in scope.scoped(df, "one", limits).collect()] == ["Peru"]
    assert scope.scoped(df.withColumnRenamed("country", "land"), "one", limits).count() == 3
    with pytest.raises(scope.UnknownRole):
        scope.scoped(df, "somebody", limits)


def test_ods_queries(spark):
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [(str(i), "orders" if i % 2 else "pos", str(i), "{}", now - dt.timedelta(minutes=i), "b") for i in range(90)]
    records = spark.createDataFrame(rows, ODS)
    assert sum(r.txn_count for r in ods.minute_counts(records, now).collect()) == 61
    assert [r.source_system for r in ods.summary(records).collect()] == ["orders", "pos"]
    latest = ods.latest(records).collect()
    assert len(latest) == 50 and latest[0].upsert_at == now and "payload" not in latest[0].asDict()
