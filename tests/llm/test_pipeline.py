import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from shelfline.llm.oracle import ORACLE

public = pytest.importorskip("public_tokenizers", reason="vocabulary files")
FOLDER = "/root/testdata/sf0.001"


def stages(spark, docs, folder):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], folder).checkpoint())
    return out


def sql(name, docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, r)) for r in cursor.fetchall()]


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = stages(spark, docs, FOLDER)
    columns = [set(d.columns) for d in made]
    assert columns[:5] == [set(docs.columns)] * 5
    rows = [d.collect() for d in made]
    # quality: what the SQL keeps; texts only lose lines
    kept = {r["doc_id"] for r in sql("op6_quality", made[0]) if r["kept"]}
    assert {r.doc_id for r in rows[1]} == kept and len(rows[1]) == len(kept)
    texts = {r.doc_id: r.text for r in rows[0]}
    for r in rows[1]:
        left = iter(texts[r.doc_id].split("\n"))
        assert all(line in left for line in r.text.split("\n")) and r.n_chars == len(r.text)
    # near-duplicates: the least id of each class
    classes = {r["class_id"] for r in sql("op1_near_dedup", made[1])}
    assert {r.doc_id for r in rows[2]} == classes and len(rows[2]) == len(classes)
    # decontamination: no hit by plain search
    import test_decontaminate

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hit = {r[0] for r in test_decontaminate.brute([(r.doc_id, r.text) for r in rows[2]], items) if r[5]}
    assert {r.doc_id for r in rows[3]} == classes - hit
    # mix: whole documents, as the SQL takes them
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in sql("op9_mixing", made[3])}
    times = Counter(r.doc_id for r in rows[4])
    assert all(times[i] == int(t / n + 0.5) for i, (t, n) in taken.items() if n)
    # tokens: of every row, in order
    from tokenizers import Tokenizer

    tokenizer, start, want = Tokenizer.from_file(public.path("word_bpe_49k.json")), 0, []
    for r in sorted(rows[4], key=lambda r: r.doc_id):
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows[5])) == sorted(want)
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(want)


def test_no_documents(spark, documents):
    empty, _ = documents([])
    assert all(d.count() == 0 for d in stages(spark, empty, FOLDER))
