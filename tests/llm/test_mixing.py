import random

from pyspark.sql import functions as F

from shelfline.llm import mixing
from shelfline.llm.oracle import ORACLE


def rows(n, seed=3):
    rng = random.Random(seed)
    sources = ["a", "b", "é", "Z", None, "tiny"]
    return [
        (i, " ".join(["w"] * rng.choice([1, 3, 40, 700])) if i % 11 else None,
         rng.choice(sources[:5]) if i % 50 else "tiny")
        for i in range(n)
    ]


def test_like_sql(documents, against_sql):
    df, table = documents(rows(400) + [(5, "w w", "a")] * 3 + [(None, "w", None)] * 2)
    assert against_sql(mixing.taken(df, 64), ORACLE["op9_mixing"], documents=table) is None


def test_slots_are_spread_and_reach_the_target(documents):
    df, _ = documents(rows(400))
    placed, sources = mixing.streams(df)
    slots = mixing.schedule(sources, 16).toPandas()
    assert slots.slot.is_unique
    for row in sources.collect():
        own = slots[slots.sid == row.sid]
        assert (own.to_word - own.from_word).sum() == int(row.target)
    # in any first part of the schedule a source has its share, but for a few slots
    slots = slots.sort_values("slot").reset_index(drop=True)
    for sid, own in slots.groupby("sid"):
        share = len(own) / len(slots)
        for at in (len(slots) // 4, len(slots) // 2):
            assert abs((slots.sid[:at] == sid).sum() - share * at) < 12


def test_mix_of_whole_rows(documents):
    df, _ = documents([(i, " ".join(["w"] * 20), "ab"[i % 2]) for i in range(100)])
    out = mixing.mixed(df.withColumn("size", F.lit("mine")), 8)
    assert out.columns == [*df.columns, "size"]
    per = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert per == {"a": 100, "b": 50}
    assert max(r["count"] for r in out.groupBy("doc_id").count().collect()) <= 2


def test_no_rows_and_no_words(documents):
    df, _ = documents([])
    assert mixing.taken(df).count() == 0
    df, _ = documents([(1, None, "a"), (2, "  \n", "b"), (3, "", None)])
    assert [tuple(r)[1:] for r in mixing.taken(df).collect()] == [(0, 0, 0.0, 0)] * 3
