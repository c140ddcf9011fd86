import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import alignment

public = pytest.importorskip("public_tokenizers", reason="vocabulary files")
FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def brute(rows):
    """All columns from the whole texts, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public.path(FILES[0]))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public.path(FILES[1]))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    for b in range(256):
        if b not in plain:
            byte_of[chr(256 + len(byte_of) - len(plain))] = b

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    docs, held = [], collections.Counter()
    for doc_id, text in rows:
        a = [] if not text else first.encode(" " + text, add_special_tokens=False).ids
        b = [] if not text else second.encode(text)
        a_bytes = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [piece(i) for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            docs.append((doc_id, 0, 0, [], collections.Counter()))
            continue
        groups, x, y, i, j = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if x <= y and i < len(a):
                groups[-1][0].append(a[i])
                x += len(a_bytes[i])
                i += 1
            else:
                groups[-1][1].append(b[j])
                y += len(b_bytes[j])
                j += 1
            if x == y and groups[-1][0] and groups[-1][1]:
                groups.append(([], []))
        groups.pop()
        links = collections.Counter((p, q) for g in groups for p in g[0] for q in g[1])
        held.update(links.keys())
        docs.append((doc_id, len(a), len(b), groups, links))
    highest = collections.defaultdict(int)
    for (p, _), n in held.items():
        highest[p] = max(highest[p], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), sum(links.values()), sum(m for k, m in links.items() if held[k] == highest[k[0]]),
            sum(m * held[k] for k, m in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    totals = collections.Counter()
    for d in docs:
        totals.update(d[4])
    return out, {(p, q, n, totals[p, q], n == highest[p]) for (p, q), n in held.items()}


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def check(documents, rows, folder):
    df, _ = documents(rows)
    table = alignment.chunks(
        df.withColumn("pairs", F.lit(1)).withColumn("chunk", F.lit("x")), public.path(FILES[0]), public.path(FILES[1]), folder
    )
    expected, pairs = brute(rows)
    got = alignment.links(table)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert order(map(tuple, got.collect())) == order(expected)
    counts = alignment.pair_counts(table)
    assert {(r.a, r.b, r.n_docs, r.n_links, r.best) for r in counts.collect()} == pairs
    return expected


LETTERS = [
    "a", "B", "ing", "tion", "strasse", "ß", "É", "é", "é", "ﬁ", "´", "Ω", "İ", "漢", "字", "😀", "½", "²", "٣", "1", "2024", "'s", "'", "-", ",", ".",
    "<|endoftext|>", "<s>", "<unk>", "<0x41>", "▁", "▁▁", " ", " ", " ", " ", "  ", "   ", "\n", "\n ", " \n", "\t", "\r\n", " ", "　", " ",
    "\x0b", "\x1c", "\x85", "\x00", "\x7f", "​", "﻿", "́", "ſ", "ɿ", "€", "©",
]


def test_random_texts_against_brute_force(documents, folder, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 7000)
    monkeypatch.setattr(alignment, "CALL_UNITS", 50)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(LETTERS) for _ in range(rng.choice([1, 2, 5, 12, 40])))) for i in range(1500)]
    expected = check(documents, rows, folder + "/t")
    assert sum(r[1] > 0 for r in expected) > 500 and sum(r[1] == 0 for r in expected) > 0


def test_prose_nulls_repeats_and_long_texts(documents, folder):
    rng = random.Random(6)
    words = ["Markt", "the", "naïve", "señor", "dashboard,", "(and)", "x=1;", "année", "don't", "e-mail", "über", "2,000"]
    prose = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 30, 300]))) for _ in range(120)]
    rows = [*enumerate(prose), (None, "no id"), (500, None), (501, ""), (502, " "), (503, " lead"), (504, "trail "),
            (505, "the " * 30_000), (506, "x" * 5000), (7, prose[7]), (7, prose[7]), (507, "漢字" * 4000), (508, " " * 3000)]
    check(documents, rows, folder + "/t")


def test_empty_tables(documents, folder):
    check(documents, [], folder + "/none")
    check(documents, [(1, None), (2, "")], folder + "/blank")


def test_every_character_beside_blanks():
    """Cutting at blanks changes no token, whatever character stands there."""
    import sentencepiece
    from tokenizers import Tokenizer

    sides = alignment._Sides(open(public.path(FILES[0]), encoding="utf-8").read(), open(public.path(FILES[1]), "rb").read())
    rng = random.Random(7)
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or rng.random() < 0.05)]
    for first in range(0, len(points), 2000):
        text = " " + "".join(f"a {chr(c)} {chr(c)}b c{chr(c)} d " for c in points[first: first + 2000])
        data = np.frombuffer(text.encode(), np.uint8)
        starts = alignment._cut(data, np.array([0, len(data)]))
        parts = [bytes(data[x:y]).decode() for x, y in zip(starts, [*starts[1:], len(data)])]
        a = sides.first.encode(text, add_special_tokens=False).ids
        b = sides.second.encode(text[1:])
        assert a == [i for p in parts for i in sides.first.encode(p, add_special_tokens=False).ids]
        if "".join(sides.second.id_to_piece(i) for i in b).replace("▁", " ") == text:
            assert b == [i for p in parts for i in sides.second.encode(p[1:])]


def test_postings_come_back():
    rng = np.random.default_rng(8)
    for n_docs in (1, 9, 300):
        sizes = rng.integers(1, n_docs + 1, 50)
        docs = np.concatenate([np.sort(rng.choice(n_docs, s, replace=False)) for s in sizes])
        links = rng.integers(1, 2000, len(docs))
        back = alignment.Postings.unpacked(n_docs, alignment.Postings(n_docs, sizes, docs, links).packed())
        assert (back.docs == docs).all() and (back.links == links).all() and (back.sizes == sizes).all()
        scores = rng.integers(0, 1 << 40, 50)
        sums = [int((np.repeat(scores, sizes) * links)[docs == d].sum()) for d in range(n_docs)]
        assert back.summed(scores).tolist() == sums
