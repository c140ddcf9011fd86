import collections
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline.llm import phrases
from shelfline.llm.oracle import ORACLE


def brute(rows, top, least, longest=5):
    """The result by counting all phrases."""
    counts, words = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            words[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    counts[lang, tuple(w[i: i + size])] += 1
    kept = {key: n for key, n in counts.items() if n >= least and len(key[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, w), a in kept.items():
        if any(l == lang and len(v) > len(w) and n >= a and any(v[i: i + len(w)] == w for i in range(len(v) - len(w) + 1))
               for (l, v), n in kept.items()):
            continue
        cuts = [(1000 * a * words[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, words[lang], -s)
        for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    )


def frame(spark, rows):
    schema = "doc_id long, lang string, text string, phrase string, n long, score string"
    return spark.createDataFrame([(i, lang, text, "x", 1, "x") for i, (lang, text) in enumerate(rows)], schema).repartition(3)


def zipf(rng, n, langs=("en", None, "de"), words=60):
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "Ab", "aB", "\U0001f600", "￮"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    ends = [" "] * 12 + [". ", ", ", "\t", "\n", "  ", " . ", "\x0b"]
    rows = []
    for _ in range(n):
        parts = []
        for w in rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40])):
            parts += [w if rng.random() < 0.8 else "fixed phrase of five words", rng.choice(ends)]
        rows.append((rng.choice(langs), "".join(parts)))
    return rows + [("en", None), ("en", ""), (None, "...")]


@pytest.mark.parametrize("top,least,start,step", [(5, 4, 100_000, 3), (30, 3, 20_000, 2), (2000, 2, 1_000_000, 1000), (1, 6, 10**9, 10)])
def test_against_all_counts(spark, monkeypatch, top, least, start, step):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 3000)
    monkeypatch.setattr(phrases, "STEP", step)
    rows = zipf(random.Random(top), 200)
    got = phrases.collocations(frame(spark, rows), top=top, least=least, start=start)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, top, least)


def test_repeated_rows_one_long_text_and_ties(spark):
    rows = [("en", "one two three four five six " * 3000)] + [("de", "alpha beta. gamma delta. " * 5)] * 40
    got = phrases.collocations(frame(spark, rows), top=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 100)


def test_empty_table_and_no_phrase(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [("en", "a b"), (None, None)])).count() == 0


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    counts = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 1)], "lang string, phrase string, size int, f long"
    )
    langs = spark.createDataFrame([("en", 10**14 + 1, 10**15)], "lang string, n long, reach long")
    row = phrases.scored(counts, langs).first()
    assert row.score == 1000 * (big - 1) * (10**14 + 1) // (big * (big + 7))


def test_bitmap_holds_all(spark):
    rows = [("en", f"w{i} x") for i in range(5000)] + [("de", "w1 x y z")]
    df = spark.createDataFrame(rows, "lang string, phrase string")
    bits = phrases.bitmap(df)
    piece = pa.RecordBatch.from_pydict({"lang": ["en", "de", "fr"], "text": ["w77 x", "w1 x y z", "w77 x"]})
    words = phrases._Words(piece)
    part = words.hash[words.code]
    first = phrases._hash_next(part[[0, 2, 6]], part[[1, 3, 7]])
    four = phrases._hash_next(phrases._hash_next(first[1:2], part[4:5]), part[5:6])
    assert bits.has(first).tolist() == [True, False, False] and bits.has(four).all()


def test_has_sql():
    assert "op12_phrases" in ORACLE
