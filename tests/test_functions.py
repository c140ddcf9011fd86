import datetime as dt
import hashlib
import json
import uuid

import pytest
from pyspark.sql import functions as F

from shelfline.functions import (
    cents_to_dollars, json_payload, mask_email, mask_string, month_component, net_cents, pii_hash, record_id,
)


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_cents_to_dollars(spark):
    got = values(spark, cents_to_dollars(F.col("x")), [(99999,), (199,), (0,), (-5,), (None,)], "x bigint")
    assert [None if g is None else str(g) for g in got] == ["999.99", "1.99", "0.00", "-0.05", None]


def test_net_cents_rounds_halves_away_from_zero(spark):
    rows = [(5000, 10), (4500, 20), (4000, 50), (5997, 50), (1, 50), (-1, 50), (100, 150), (None, 5), (10, None)]
    got = values(spark, net_cents(F.col("g"), F.col("d")), rows, "g bigint, d int")
    assert got == [4500, 3600, 2000, 2999, 1, -1, -50, None, None]


def test_net_cents_overflow_raises(spark):
    with pytest.raises(Exception, match="overflow"):
        values(spark, net_cents(F.col("g"), F.col("d")), [(2**62, 1)], "g bigint, d int")


def test_mask_string(spark):
    rows = [(None,), ("",), ("a",), ("ab",), ("abc",), ("Jane",)]
    assert values(spark, mask_string(F.col("x")), rows) == [None, "", "*", "**", "a*c", "J**e"]


def test_mask_email(spark):
    rows = [(None,), ("nobody",), ("a@x.com",), ("jane@example.com",), ("abc@b@c",), ("@x",)]
    assert values(spark, mask_email(F.col("x")), rows) == [
        None, "nobody", "*@x.com", "j**e@example.com", "a*c@b", "@x",
    ]


def test_pii_hash_strips_all_unicode_space(spark):
    texts = ["John.Doe@Example.COM", "  x ", " 　Ärger\t\x1f", "a b", "", "\x85"]
    got = values(spark, pii_hash(F.col("x")), [(t,) for t in texts] + [(None,)])
    assert got[:-1] == [hashlib.sha256(t.strip().lower().encode()).hexdigest() for t in texts]
    assert got[-1] is None


def test_record_id_is_uuid5(spark):
    namespace = uuid.UUID("6097dbcc-a837-5a4d-a63e-2668d5045ade")
    keys = [f"key-{i}" for i in range(200)] + ["", "ünï"]
    got = values(spark, record_id(F.lit("orders"), F.col("x")), [(k,) for k in keys])
    assert got == [str(uuid.uuid5(namespace, f"orders:{k}")) for k in keys]


def test_payload_keeps_nulls(spark):
    got = values(spark, json_payload(), [("a", None)], "x string, y int")
    assert json.loads(got[0]) == {"x": "a", "y": None}


def test_month_component(spark):
    start = dt.date(2020, 3, 1)
    days = [start + dt.timedelta(days=d) for d in range(-800, 1200, 7)]

    def expected(day):
        # Whole months, towards zero, counted from a first of month.
        months = (day.year - start.year) * 12 + day.month - start.month
        if day < start and day.day > 1:
            months += 1
        return int(abs(months) % 12 * (1 if months >= 0 else -1))

    got = values(spark, month_component(F.col("x"), F.lit(start)), [(d,) for d in days], "x date")
    assert got == [expected(d) for d in days]
