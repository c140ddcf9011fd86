import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfline.llm import lm_score

SYLLABLES = "th er on an re he in ed nd ha é ß ing".split()


def rows(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(800)]
    texts = [" ".join(rng.choice(words).title() if rng.random() < 0.1 else words[int(800 * rng.random() ** 3)] for _ in range(rng.choice([1, 20, 90]))) for _ in range(n)]
    texts += texts[:20] + [None, "", " \n", "x" * 5000, "\x00\x1c é", texts[3] + "\n" + texts[4]]
    return [*enumerate(texts), (None, "no id"), (7, texts[7])]


def tokens(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [*re.findall(rb"[^\x20\x09-\x0D]+", raw), "end"]


def test_counts_and_base_like_brute_force(documents):
    data = rows()
    learnt = Counter(w for i, t in data if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(learnt.values()), len(learnt)
    want = []
    for i, t in data:
        own = tokens(t)
        base = sum(math.log10((learnt[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        want.append((str(i), out, len(own), sum(learnt[w] > 0 for w in own), n, round(base, 6)))
    df, _ = documents(data)
    got = lm_score.score(df.withColumn("row", F.lit(1)).withColumn("c", F.lit(2))).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    out = [r for r in got if r.held_out and r.n_tokens > 2]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    # a text that repeats another is likelier than one of the same words in another order
    by = {r.doc_id: r for r in got}
    assert all(by[400 + k].score > 0.8 * by[k].base_score for k in range(20) if by[k].n_tokens > 50 and not by[k].held_out)


def test_bits_of_a_byte_add_up_to_one():
    rng = np.random.default_rng(2)
    code = lm_score.Code(rng.integers(0, 1000, 256))
    packed = rng.integers(0, 1 << 32, (len(lm_score.ORDERS), 1 << lm_score.BITS), dtype=np.uint32)
    weights = rng.random((lm_score.GATES, len(lm_score.ORDERS))).astype(np.float32)
    refined = rng.random((lm_score.GATES, lm_score.STEPS))
    data, before = np.arange(256).astype(np.uint8), np.full(256, 0x616263, np.uint64)
    # some contexts are met: their check values are put into the table
    for _, _, places in code.bits(data, before):
        for k, (place, check) in enumerate(places):
            packed[k, place] = (check.astype(np.uint32) << np.uint32(16)) | rng.integers(0, 1 << 16)
    tables = lm_score.Tables(code, packed, weights, refined)
    total = np.zeros(256)
    for at, value, places in code.bits(data, before):
        p = tables.probability(*tables.inputs(value, places, own=False))
        total[at] += np.log(np.where(value, p, 1 - p))
    assert abs(np.exp(total).sum() - 1) < 1e-9


def test_pieces_depend_on_their_words_only():
    tail = " ".join(str(i * i) for i in range(300)).encode()
    texts = [b"a b c d e f g " * 40, b"", b"one", b"zz " + tail, tail]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    piece, first, first_piece, hashes = lm_score.pieces(data, offsets)
    assert len(piece) == sum(len(t.split()) for t in texts) and len(hashes) == first_piece[-1]
    assert (np.diff(piece) >= 0).all() and first_piece.tolist()[1:3] == [first_piece[1], first_piece[1] + 1]
    for i, t in enumerate(texts):
        alone = lm_score.pieces(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert alone[3].tolist() == hashes[first_piece[i]: first_piece[i + 1]].tolist()
    assert hashes[-1] == hashes[first_piece[4] - 1]


def grams_like_brute_force(text):
    """(byte, six bytes before it, what the word has before them) for each byte of a text."""
    data = b"".join(w + b" " for w in text.split()) + lm_score.END
    word = 0
    for i, byte in enumerate(data):
        yield byte, data[max(0, i - 6): i], data[word: max(word, i - 6)]
        if byte == 32:
            word = i + 1


def test_grams_of_texts():
    texts = [b"one two", b"", b"internationalisation " * 3, b"a\x00 \x00b xinternationalisation", b"internationalist one two"]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    got, in_word = lm_score.grams_of(*lm_score.split(b"".join(texts), offsets))
    want = [g for t in texts for g in grams_like_brute_force(t)]
    assert len(got) == len(want) == in_word.sum()
    for gram, (byte, before, rest) in zip(got.tolist(), want):
        assert gram.to_bytes(8, "little")[:7] == bytes([byte]) + before[::-1].ljust(6, b"\x00") and (gram >> 56 > 0) == (len(rest) > 0)
    same = {}
    assert all(same.setdefault(w, g) == g for w, g in zip(want, got.tolist()))


def test_every_occurrence_of_every_byte_is_learnt(documents):
    data = [(i, t) for i, t in rows(60) if i is not None]
    learnt = [t for i, t in data if zlib.crc32(str(i).encode()) % 5 != 1]
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    want = Counter(g[:2] for t in learnt for g in grams_like_brute_force((t or "").encode().translate(lower)))
    df, _ = documents(data)
    packed = lm_score._grams(df.withColumn("held_out", lm_score.held_out(F.col("doc_id")))).toArrow()
    got = Counter()
    for gram, n in lm_score._unpacked(packed, gram=np.uint64, n=np.int64):
        for g, c in zip(gram.tolist(), n.tolist()):
            raw = g.to_bytes(8, "little")
            got[raw[0], raw[1:7]] += c
    assert got == Counter({(b, before[::-1].ljust(6, b"\x00")): n for (b, before), n in want.items()})


def test_words_are_scored_where_they_stand(documents):
    rng = random.Random(4)
    learnt = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1][:300]
    out = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    # what follows a word goes with its last letter; all four words are about as frequent
    pairs = [("pola", "uno"), ("pide", "esi")]
    texts = [(i, " ".join(w for _ in range(20) for w in rng.choice(pairs))) for i in learnt]

    def one_piece(text):
        return len(lm_score.pieces(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[3]) == 1

    # a new word in the only piece, so that no piece is a known one
    said = ((f"q{k} pola uno q{k} pide esi q{k}", f"q{k} pola esi q{k} pide uno q{k}") for k in range(1000))
    usual, other = next(x for x in said if all(map(one_piece, x)))
    df, _ = documents([*texts, (out[0], usual), (out[1], other)])
    got = {r.doc_id: r.score for r in lm_score.score(df).where("held_out").collect()}
    assert got[out[0]] > got[out[1]] + 1


def test_kept_grams_have_their_own_probabilities(spark, documents, monkeypatch):
    df, _ = documents([(i, t) for i, t in rows(80) if i is not None])
    model = lm_score.fit(df.withColumn("held_out", lm_score.held_out(F.col("doc_id"))))
    rng = np.random.default_rng(3)
    grams = rng.integers(0, 1 << 12, 20_000).astype(np.uint64)
    monkeypatch.setattr(lm_score, "KEPT", 6)
    monkeypatch.setattr(lm_score._Shared, "kept", None)
    want = model.shared.tables(model.weights, model.refined).coded(grams)
    for _ in range(3):
        assert np.allclose(model.coded(grams), want, rtol=1e-6)
    lm_score._Shared.kept = None


def test_nothing_learnt_and_no_rows(documents):
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    df, _ = documents([(out, "some text"), (out, None)])
    got = lm_score.score(df).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.held_out and math.isfinite(r.score) for r in got)
    df, _ = documents([])
    assert lm_score.score(df).count() == 0
