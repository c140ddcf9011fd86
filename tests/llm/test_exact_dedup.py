import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import exact_dedup, suffixes


def brute(rows):
    seen = Counter(b[i: i + 200] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - 199))
    out = []
    for doc_id, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i: i + 200]] > 1:
                gone[i: i + 200] = True
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = random.Random(11)
    letters = "abcdeé \n"

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    passages = [text(n) for n in (150, 199, 200, 201, 230, 400, 900)]
    out = []
    for i in range(60):
        parts = []
        for _ in range(rng.choice([1, 2, 4])):
            parts.append(text(rng.choice([0, 5, 90, 300])))
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randrange(max(1, len(p) - 210))
                parts.append(p[a: a + rng.choice([120, 205, 1000])])
        out.append((i, "".join(parts)))
    same, edge = text(260), "".join(chr(97 + rng.randrange(26)) for _ in range(199))
    out += [(100, same), (101, same), (101, same), (102, same[:199]), (103, same[1:]), (104, None), (105, ""), (None, text(300)), (None, text(300))]
    out += [(110, "ab" * 400), (111, "x" * 199), (112, "y" * 200), (113, "z" * 201), (114, "q" * 900 + text(50)), (115, "abc " * 150 + text(250) + "abc " * 80)]
    out += [(120, edge + "1"), (121, edge + "2"), (122, "3" + edge), (123, edge)]
    return out


def result(df):
    return sorted((tuple(r) for r in exact_dedup.digest(exact_dedup.cut(df)).collect()), key=str)


def test_like_brute_force(documents):
    df, _ = documents(rows())
    assert result(df.withColumn("key", F.lit(1)).withColumn("h", F.lit("x"))) == brute(rows())


def test_hot_groups_and_shuffled_joins(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "GROUP", 3)
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(exact_dedup, "CHUNK_BYTES", 2000)
    rng = random.Random(5)
    passage = "".join(rng.choice("klmnop ") for _ in range(330))
    more = [(500 + i, "".join(rng.choice("abc ") for _ in range(rng.choice([0, 3, 40]))) + passage[rng.randrange(60):]
             + "".join(rng.choice("xyz ") for _ in range(30))) for i in range(25)]
    df, _ = documents(rows() + more)
    assert result(df) == brute(rows() + more)


def test_long_text_and_empty_table(documents):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    df, _ = documents([(1, long), (2, "intro " * 3 + long[1000:1400]), (3, "plain")])
    got = {r.doc_id: r for r in exact_dedup.cut(df).collect()}
    assert [tuple(s) for s in got[1].spans] == [(1000, 1400)] and got[2].kept == b"intro " * 3 and got[3].kept == b"plain"
    df, _ = documents([])
    assert result(df) == []


@pytest.mark.parametrize("n,letters", [(0, 2), (1, 2), (2, 2), (60, 1), (300, 2), (500, 4), (400, 256)])
def test_suffix_array(n, letters):
    data = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    raw = data.tobytes()
    assert suffixes.suffix_array(data, n + 8).tolist() == sorted(range(n), key=lambda i: raw[i:])
    order = suffixes.suffix_array(data, 10)
    assert [raw[i: i + 10] for i in order] == sorted(raw[i: i + 10] for i in range(n))
    order = order[order + 10 <= n]
    common = suffixes.common_prefixes(order, suffixes.eight_bytes(data), 10)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1]: order[k - 1] + 10], raw[order[k]: order[k] + 10]
        assert common[k] == next((j for j in range(10) if a[j] != b[j]), 10)
