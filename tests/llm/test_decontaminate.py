import hashlib
import re

from pyspark.sql import functions as F

from shelfline.llm import decontaminate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, low)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            size = min(10, len(v))
            for i in range(len(v) - size + 1 if v else 0):
                for k in range(len(w) - size + 1):
                    if w[k: k + size] == v[i: i + size]:
                        hit.update(range(k, k + size))
                        ids.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (0, "One two three four five six seven eight nine ten eleven twelve."), (1, "Ähnlich wie 3 andere"), (2, "..."),
    (3, None), (4, "a a a a a a a a a a a a"), (5, "One two three four five six seven eight nine ten"), (None, "nil item"),
    (11, "one TWO three four five six seven eight nine ten eleven twelve"),
]


def cases():
    ten = "one two three four five six seven eight nine ten"
    return [
        (1, ten), (2, f"x {ten.upper()}, eleven -- twelve y"), (3, ten[:-1]), (4, "a " * 31), (5, "ähnlich WIE\n3\tandere!"),
        (6, "Ähnlich wie 3 andere"), (7, None), (8, ""), (9, "?!"), (10, "xähnlich wie 3 andere"), (10, f"{ten} one {ten}"),
        (None, "nil  item"), (12, "w " * 300_000 + ten + " z" * 1000), (13, f"{ten} a a a a a a a a a a nil item"),
    ]


def frames(spark, docs=None, items=None):
    return (
        spark.createDataFrame(cases() if docs is None else docs, "doc_id long, text string").repartition(2),
        spark.createDataFrame(ITEMS if items is None else items, "item_id long, text string"),
    )


def test_like_brute_force(spark, monkeypatch):
    small = [c for c in cases() if len(c[1] or "") < 10_000]
    docs, items = frames(spark, small)
    got = sorted((tuple(r) for r in decontaminate.score(docs, items).collect()), key=str)
    assert got == brute(small, ITEMS)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert sorted((tuple(r) for r in decontaminate.score(docs, items).collect()), key=str) == got


def test_spans_are_of_the_original(spark):
    docs, items = frames(spark)
    texts = dict(cases())
    found = decontaminate.found_spans(docs, items).collect()
    by = {r.doc_id: texts[r.doc_id][r.begin: r.end] for r in found if r.doc_id in (2, 5, 12)}
    assert by == {2: "ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN, eleven -- twelve",
                  12: "one two three four five six seven eight nine ten"}


def test_clean_and_empty(spark):
    docs, items = frames(spark)
    kept = decontaminate.clean(docs.withColumn("item_id", F.lit(1)), items)
    assert {r.doc_id for r in kept.collect()} == {3, 5, 7, 8, 9, 10}
    docs, none = frames(spark, items=[])
    assert decontaminate.clean(docs, none).count() == len(cases())
    empty, _ = frames(spark, docs=[])
    assert decontaminate.score(empty, items).count() == 0
