import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import tokens

public = pytest.importorskip("public_tokenizers", reason="vocabulary files")


def brute(rows, name="word_bpe_49k.json"):
    from tokenizers import Tokenizer

    tokenizer, out, start = Tokenizer.from_file(public.path(name)), [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def cases():
    rng = random.Random(2)
    letters = ["a", "B", "ß", "É", "ÿ", "Ω", "ς", "Σ", "İ", "é", "é", "́", "1", "²", "٣", "'s", "'LL", "'", "-", "<|", "|>",
               "<|endoftext|>", "<|startoftext|>", " ", "\u0085", "\x1c", " ", "\x0b", "\n", " ", " ", "漢", "字", "😀", "½", "µ", "ª", "×", "\x00", "\x7f"]
    out = [(i * 3, "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 7, 60])))) for i in range(400)]
    return [(None, "no id"), *out, (2_000, None), (2_001, ""), (2_002, "long words " * 100_000), (2_003, "x" * 5000)]


@pytest.mark.parametrize("name,by_words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_come_back(spark, documents, monkeypatch, name, by_words):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 500)
    df, _ = documents(cases())
    got = tokens.encode(df.withColumn("row", F.lit(1)), public.path(name), by_words=by_words)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == brute(cases(), name)


def test_repeated_ids_and_reading(spark, documents, tmp_path):
    df, _ = documents([(1, "one two"), (1, "one two"), (0, "zero")])
    tokens.write(df, str(tmp_path / "t"), public.path("word_bpe_49k.json"), by_words=True)
    back = {r.doc_id: r.ids for r in tokens.read(spark, str(tmp_path / "t")).collect()}
    assert [len(back[0]), len(back[1])] == [2, 3] and back[1][-1] == 1
    ranks = spark.read.parquet(str(tmp_path / "t/ranks")).orderBy("rank").collect()
    assert ranks[0].id == 1  # the end id is the most frequent
    starts = sorted((r.doc_id, r.start) for r in tokens.index(spark, str(tmp_path / "t")).collect())
    assert starts == [(0, 0), (1, 2), (1, 5)]


def test_empty_table(documents):
    df, _ = documents([])
    assert tokens.encode(df, public.path("word_bpe_49k.json"), by_words=True).count() == 0


def test_packing():
    values = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 3, 7], np.uint32)
    for n in range(len(values) + 1):
        control, data = tokens.pack(values[:n])
        assert len(control) == -(-n // 4)
        assert tokens.unpack(control, data, n).tolist() == values[:n].tolist()
