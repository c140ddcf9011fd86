import math
import random

import pytest
from pyspark.sql import functions as F

from shelfline.llm import topk
from shelfline.llm.oracle import ORACLE

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    """(query_id, rank, vec_id, score) of all queries, by sorting all scores."""
    use = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for n, (i, v) in enumerate(use):
        if i % 50:
            continue
        scored = sorted(
            (-max(-(1 << 61), min(1 << 61, sum(a * b for a, b in zip(v, w)))), j)
            for m, (j, w) in enumerate(use) if m != n and len(w) == len(v)
        )
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def check(spark, rows, **named):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], named.pop("schema", SCHEMA)).repartition(3)
    got = topk.top_k(df.withColumn("q", F.lit(1)).withColumn("block", F.lit("x")), **named)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, named.get("k", 5))


def test_random_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = random.Random(1)
    check(spark, [(i * 10, [round(rng.uniform(-1, 1), 2) for _ in range(6)]) for i in range(200)], k=7)


def test_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 300)
    rng = random.Random(2)
    ids = list(range(150))
    rng.shuffle(ids)
    check(spark, [(i, [rng.choice([0.0, 1.0]), rng.choice([0.0, 1.0])]) for i in ids])
    check(spark, [(i, [0.5, 0.25]) for i in ids])


def test_nulls_repeats_and_lengths(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (5, [3.0, -1.0]), (50, [1.0]), (51, [2.0]), (100, []), (101, []), (150, [1.0, 2.0, 3.0]),
            (-50, [-1.0, -2.0]), (7, [1.0, 2.0])]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(1, [1.0]), (2, [1.0])], [(0, None)]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_large_components(spark):
    rng = random.Random(3)
    for size in (1e3, 1e6, 1e12):
        rows = [(i * 25, [rng.uniform(-size, size) for _ in range(3)]) for i in range(40)]
        check(spark, rows, schema="vec_id long, embedding array<double>, label int")


def test_long_vectors_and_whole_table(spark):
    rng = random.Random(4)
    check(spark, [(i, [rng.uniform(-1, 1) for _ in range(3000)]) for i in range(60)],
          schema="vec_id long, embedding array<double>, label int")


def test_has_sql():
    assert "op11_topk" in ORACLE
