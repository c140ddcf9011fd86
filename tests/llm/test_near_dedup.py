import random

import numpy as np
from pyspark.sql import functions as F

from shelfline.llm import arrays, graph, near_dedup
from shelfline.llm.oracle import ORACLE


def rows():
    rng = random.Random(7)
    out, at = [], 0
    for _ in range(30):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 9, 60, 200]))]
        for _ in range(rng.choice([1, 1, 4, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            out.append((at, rng.choice([" ", "\n", "  "]).join(copy)))
            at += 1
    spam = [(at + i, "the " * n) for i, n in enumerate([50, 52, 60, 90, 4, 4, 1])]
    return [*out, *spam, (900, None), (901, ""), (902, " \n"), (903, "one"), (903, "one"), (904, "One"), (None, "a b c d e f"), (None, "a b c d e f"), (905, "a b c d e f")]


def test_like_sql(documents, against_sql):
    df, table = documents(rows())
    assert against_sql(near_dedup.classes(df.withColumn("key", F.lit(1)).withColumn("node", F.lit(2))), ORACLE["op1_near_dedup"], documents=table) is None


def test_hot_groups(spark, documents, against_sql):
    rng = random.Random(1)
    base = [f"v{i}" for i in range(100)]
    near = []
    for i in range(150):
        copy = list(base)
        copy[rng.randrange(100)] = f"y{i}"
        near.append((i, " ".join(copy)))
    # a chain: each link is similar to the next one only
    chain = [(1000 + i, " ".join(f"c{k}" for k in range(8 * i, 8 * i + 100))) for i in range(25)]
    df, table = documents([*near, *((300 + i, "same text of many rows in all") for i in range(200)), *chain])
    got = near_dedup.classes(df)
    assert against_sql(got, ORACLE["op1_near_dedup"], documents=table) is None
    assert got.select("class_id").distinct().count() == 3


def test_loose_group(documents, against_sql):
    """Copies with many edits: most are similar to a few others only, some to none."""
    rng = random.Random(9)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(160):
        copy = list(base)
        for k in range(rng.choice([0, 1, 2, 3, 4, 5, 9])):
            copy[rng.randrange(150)] = f"y{i}-{k}"
        rows.append((i, " ".join(copy)))
    df, table = documents(rows)
    assert against_sql(near_dedup.classes(df), ORACLE["op1_near_dedup"], documents=table) is None


def test_pairs_are_made_about_once(spark):
    """Nodes that share several buckets and many tokens: no similar pair is lost, and none is made for each bucket and token."""
    rng = random.Random(4)
    tokens = {}
    for node in range(60):
        own = set(range(100))
        for _ in range(rng.choice([1, 4, 8, 12])):
            own = own - {rng.randrange(100)} | {rng.choice([100 + rng.randrange(40), 1000 * node + 1000])}
        tokens[node] = own
    n_nodes = {t: sum(t in own for own in tokens.values()) for t in set().union(*tokens.values())}
    held = [(n, t, n_nodes[t]) for n, own in tokens.items() for t in own if n_nodes[t] > 1]
    shared = {n: sum(n == m for m, _, _ in held) for n in tokens}
    buckets = {n: rng.sample(range(6), 3) for n in tokens}
    sizes = spark.createDataFrame([(n, len(own), shared[n]) for n, own in tokens.items()], "node long, n long, shared long")
    prefixes = near_dedup._prefixes(spark.createDataFrame(held, "node long, token long, n_nodes long"), sizes)
    members = spark.createDataFrame(
        [(b, n, len(tokens[n]), shared[n], n % 20) for n, own in buckets.items() for b in own], "bucket long, node long, n long, shared long, component long"
    )
    got = [tuple(r) for r in near_dedup._sharing(members, prefixes).collect()]
    near = {(a, b) for a in tokens for b in tokens if a < b and a % 20 != b % 20 and set(buckets[a]) & set(buckets[b])}
    similar = {(a, b) for a, b in near if 5 * len(tokens[a] & tokens[b]) >= 4 * len(tokens[a] | tokens[b])}
    assert similar and similar <= set(got) <= near
    each = {n: set() for n in tokens}
    for r in prefixes.collect():
        each[r.node].add(r.token)
    before = sum(len(each[a] & each[b]) * len(set(buckets[a]) & set(buckets[b])) for a, b in near)
    assert len(got) <= 1.2 * len(set(got)) < before / 4


def test_keep_one(documents):
    df, _ = documents(rows())
    classes = {r.class_id for r in near_dedup.classes(df.where("text rlike '[^\\\\s]' and doc_id is not null")).collect()}
    kept = near_dedup.keep_one(df.withColumn("component", F.lit("mine")))
    assert kept.columns == [*df.columns, "component"]
    ids = [r.doc_id for r in kept.where("text rlike '[^\\\\s]'").collect()]
    assert sorted(ids) == sorted(classes)
    assert {r.doc_id for r in kept.collect()} - set(ids) == {900, 901, 902}


def test_empty_table(documents):
    df, _ = documents([])
    assert near_dedup.classes(df).count() == 0 and near_dedup.keep_one(df).count() == 0


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    gaps = []
    for k in range(60):
        a = rng.integers(0, 9, 40)
        b = np.maximum(0, a + rng.integers(-3, 4, 40)) if k % 2 else rng.integers(0, 40, 40)
        words = arrays.mix(rng.integers(0, 2**63, 40).astype(np.uint64))
        text = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        times = near_dedup.signatures(text, np.append(words[a > 0], words[b > 0]), np.append(a[a > 0], b[b > 0]), 2, 1000)
        share = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        gaps.append(((times[0] == times[1]).mean() - share) / np.sqrt(share * (1 - share) / 1000))
    assert np.abs(gaps).max() < 4 and abs(np.mean(gaps)) < 0.5


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 999), (5, 5)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 999: 999, 1000: 999}
