"""Files that several tasks share give the rows that one task gives."""

import csv
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from catalog import spark_queries
from shelfline.schemas import POS_SALES, _S, _I, _struct
from shelfline.sources import files, records

ROW = "id long, name string, note struct<a:string,b:array<string>>, more map<string,string>"


@pytest.fixture(params=[100, 2500, 1 << 20])
def split(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def put(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


TEXTS = ["", "plain", 'quo"te', "back\\slash", "\\", "\\\\\"", "{", "}", "}}{{", "[", "]", "],[", "a\nb", "a\r\nb", "é漢😀", "'", ",", '"', "\t", "},{"]


def objects(rng, n):
    def text():
        return "".join(rng.choice(TEXTS) for _ in range(rng.choice([1, 1, 2, 30])))

    return [
        {"id": i, "name": text(), "note": {"a": text(), "b": [text() for _ in range(rng.choice([0, 1, 4]))]}, "more": {text(): text()}}
        for i in range(n)
    ]


def as_json(df):
    return sorted(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toPandas().iloc[:, 0])


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_json_array_equals_the_plain_read(spark, folder, split, style):
    rng = random.Random(1)
    put(f"{folder}/j/a.json", json.dumps(objects(rng, 25), **style))
    put(f"{folder}/j/b.json", "﻿" + json.dumps(objects(rng, 1), **style) + "\n")
    put(f"{folder}/j/c.json", json.dumps(objects(rng, 1)[0], **style))
    put(f"{folder}/j/d.json", "[]")
    plain = spark.read.schema(ROW).option("multiLine", True).json(f"{folder}/j")
    own = records.json_objects(spark, f"{folder}/j").select(F.from_json("record", ROW).alias("r")).select("r.*")
    assert as_json(own) == as_json(plain) and own.count() == 27
    assert as_json(files.read_json(spark, f"{folder}/j", plain.schema)) == as_json(plain)


def test_unreadable_json_is_one_null_row(spark, folder, split):
    put(f"{folder}/j/good.json", json.dumps([{"id": 1}, {"id": 2}]))
    for n, text in enumerate(('[{"id": 3}, {"id": 4}', '[{"id": 3}, {"id', '[{"id": 3}, {"name": "open}, {"id": 5}]')):
        put(f"{folder}/j/bad{n}.json", text)
    got = records.json_objects(spark, f"{folder}/j").select(F.from_json("record", ROW).alias("r")).select("r.id").collect()
    assert sorted((r.id for r in got), key=lambda v: v or 0) == [None, None, None, 1, 2]


def test_one_json_file_is_read_by_several_tasks(spark, folder, split):
    put(f"{folder}/j/a.json", json.dumps([{"id": i} for i in range(600)]))
    if split != 2500:
        return
    of = records.json_objects(spark, f"{folder}/j").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(of) > 2 and sum(r["count"] for r in of) == 600


def test_compressed_json(spark, folder, split):
    rows = objects(random.Random(3), 20)
    put(f"{folder}/j/a.json.gz", json.dumps(rows), gzip.open)
    got = records.json_objects(spark, f"{folder}/j").select(F.from_json("record", ROW).alias("r")).select("r.id").collect()
    assert sorted(r.id for r in got) == list(range(20))


def csv_text(rows, end="\n"):
    out = []
    for row in rows:
        out.append(",".join('"' + v.replace('"', '""') + '"' if set(v) & set(',"\n\r') else v for v in row))
    return end.join(out) + end


@pytest.mark.parametrize("end,closed", [("\n", True), ("\r\n", True), ("\n", False)])
def test_quoted_csv(spark, folder, split, end, closed):
    rng = random.Random(4)
    texts = ["plain", 'quo"te', "a,b", "two\nlines", "\n", '"\n"', "é漢😀", "x" * 200, "id,name,age", "a b"]
    rows = [(f"c{i}", rng.choice(texts) + rng.choice(texts), str(i)) for i in range(60)]
    text = csv_text([("id", "name", "age"), *rows[:40], ("id", "name", "age")], end)
    put(f"{folder}/in/a.csv", text if closed else text[: -len(end)])
    put(f"{folder}/in/sub/b.csv", "﻿" + csv_text([("age", "id", "name"), *((a, i, n) for i, n, a in rows[40:])], end))
    got = files.read_text_csv(spark, f"{folder}/in", multi_line=True).select("id", "name", "age").collect()
    assert sorted(map(tuple, got)) == sorted([*rows, ("id", "name", "age")])
    if split == 2500:
        of = records.csv_records(spark, f"{folder}/in/a.csv").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(of) > 1


def test_open_quote_goes_to_the_end(spark, folder, split):
    put(f"{folder}/a.csv", 'id,name\n1,x\n2,"open\n3,y\n' + "z" * 900)
    got = records.csv_records(spark, f"{folder}/a.csv").collect()
    assert sorted(r.record for r in got) == sorted(["id,name", "1,x", '2,"open\n3,y\n' + "z" * 900])


def test_headers_of_plain_csv(spark, folder, split):
    lines = "".join(f"{i},n{i}\n" for i in range(60))
    put(f"{folder}/in/a.csv", "id,name\n" + lines + "id,name\n")
    put(f"{folder}/in/b.csv.gz", "name,extra,id\nx,1,900\n\nname,extra,id\n", gzip.open)
    put(f"{folder}/in/c.csv", "id,name\n")
    put(f"{folder}/in/d.csv", "")
    got = files.read_csv(spark, f"{folder}/in", _struct(id=_S, name=_S, extra=_I)).collect()
    want = [(str(i), f"n{i}", None) for i in range(60)] + [("id", "name", None), ("900", "x", 1), ("id", "name", None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    only = files.read_csv(spark, f"{folder}/in/b.csv.gz", _struct(id=_S, name=_S)).collect()
    assert sorted(map(tuple, only)) == [("900", "x"), ("id", "name")]


def test_pos_sales_schema(spark, folder, split):
    rows = [{"sale_id": str(i), "quantity": i, "x": [1, {"y": "}"}]} for i in range(40)]
    path = put(f"{folder}/p.json", json.dumps(rows))
    got = files.read_json(spark, path, POS_SALES).select("sale_id", "quantity").collect()
    assert sorted((int(r.sale_id), r.quantity) for r in got) == [(i, i) for i in range(40)]


def test_csv_module_agrees(spark, folder, split):
    rng = random.Random(5)
    rows = [[rng.choice(['a"b', "c\nd", "e,f", "g", ""]) for _ in range(3)] for _ in range(30)]
    path = f"{folder}/w/a.csv"
    os.makedirs(os.path.dirname(path))
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([["p", "q", "r"], *rows])
    got = files.read_text_csv(spark, f"{folder}/w", multi_line=True).fillna("").collect()
    assert sorted(map(list, got)) == sorted(r for r in rows)


def test_guarded_casts_take_what_plain_casts_take(spark):
    odd = [
        "1", "12.5", "12.", " 7 ", "+5", "-5", "1d", "1F", "0x1p3", "0x1.8p-2", "Infinity", "-inf", "+INF", "nan", "NaN", ".5", "5.", "1e5",
        "1E+5", "1e", "id-1", "1995-01-01", "true", "T", "yes", "Y", "n", "0", "f", "False", "tru", "9223372036854775807",
        "9223372036854775808", "\t8\n", "8\x7f", "\x015", "\xa05", "５", "--1", "+", "", "1\u0085", "TRUE\n", "\x0bno", None,
    ]
    rows = spark.createDataFrame([(o,) for o in odd], "v string")
    for kind in (T.LongType(), T.DoubleType(), T.BooleanType()):
        plain, own = (c.cast("string") for c in (F.col("v").try_cast(kind), files.fitted(F.col("v"), kind)))
        assert rows.where(~plain.eqNullSafe(own)).collect() == []


def test_first_records_are_found_in_first_blocks_or_beyond(spark, folder, split):
    for name, head in (("a", "id,name"), ("b", "name,id"), ("c", f'id,"{"long" * 60}\nname"')):
        put(f"{folder}/h/{name}.csv", f"{head}\r\n" + "".join(f'{i},"x\n{i}"\r\n' for i in range(40)))
    rows, heads = records.csv_records_and_heads(spark, f"{folder}/h")
    assert sorted(r.record for r in heads.collect()) == sorted(["id,name", "name,id", f'id,"{"long" * 60}\nname"'])
    assert rows.where("first").count() == 3 and rows.count() == 3 * 41


def test_splits_grow_with_the_files(spark, folder):
    """A file of megabytes is not cut into hundreds of splits."""
    put(f"{folder}/s/a.csv", "id\n" + "1\n" * 6_000_000)
    used = []

    def read():
        used.append(int(spark.conf.get("spark.sql.files.maxPartitionBytes")))
        return spark.range(1)

    spark_queries._in_small_splits(spark, f"{folder}/s", read)
    assert used == [12_000_003 // 64]
