"""Which tokens of two tokenizers cover the same text: links counted by inverted bitmaps of documents.

Every text is tokenised twice. Where tokens of both end on the same byte, the text is cut, and all tokens of
one side are linked to all of the other within a cut: a group. For each pair of ids, the documents that link it
are a bitmap, and how often they do so are planes of bits beside it:

1. Documents come in chunks of a few megabytes of text. Texts are cut into units, at blanks that no token of either
   side crosses, and each distinct unit is tokenised and linked once. A pair's documents are those of the units that
   hold it, OR-ed, with the units' links added. They are kept as a compressed bitmap (bits where a sixteenth or more of
   the chunk's documents are set, otherwise 16-bit numbers), the numbers of links as bit planes over its members.
2. The bitmaps' members are counted and added up over the chunks. Chunks hold different documents, so that
   OR-ing their bitmaps lays them side by side and their counts add.
3. A pair's count, and whether it is the highest of its first id, go back to the chunks that hold the pair, and from
   there along the bitmaps and planes to the documents.

Chunks are one table in the shared folder; only counts and, once, the chunks are shuffled. A pair that all documents hold
is one row for each chunk.

Defined cases: a NULL or empty text has no tokens, nor has one whose tokens, joined, are not the text with a blank
before it; rows that repeat an id or a text are documents of their own; strings of special tokens are plain text; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import arrays
from shelfline.session import scratch_path

#: Bytes of text that is cut into units together.
SLICE_BYTES = 8 << 20
#: Units that are tokenised in one call; a tokenizer's result is many times the size of its ids.
CALL_UNITS = 1 << 14
#: Bytes of text, and documents, in a chunk.
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 1 << 16

# Bytes before and after a blank at which a text may be cut: printable ASCII and the letters U+00C0 to U+027F. Neither is
# white space, a mark that combines with its neighbour, or changed beside a blank.
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xCA] = True


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Sides:
    """Both tokenizers, with the bytes of their tokens, kept by a Python worker from task to task."""

    held: tuple[int, _Sides] | None = None

    def __init__(self, spec: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(spec)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_proto=model)
        byte_of = _byte_of()
        vocabulary = self.first.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            self.a_bytes[at] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = []
        for at in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(at)
            own = bytes([int(piece[3:5], 16)]) if self.second.is_byte(at) else piece.replace("▁", " ").encode()
            self.b_bytes.append(own)
        self.a_table, self.b_table = pa.array(self.a_bytes, pa.large_binary()), pa.array(self.b_bytes, pa.large_binary())
        self.a_sizes = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)
        # each id as text, before another of its side, before the other side, and before another group
        self.ids = max(len(self.a_bytes), len(self.b_bytes))
        self.names = pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.ids)], pa.large_binary())

    @classmethod
    def of(cls, spec: str, model: bytes) -> _Sides:
        key = hash((spec, model))
        if cls.held is None or cls.held[0] != key:
            cls.held = key, cls(spec, model)
        return cls.held[1]


class _Units:
    """Units of text, each beginning with a blank: their tokens, groups and linked pairs."""

    def __init__(self, sides: _Sides, units: pa.Array) -> None:
        count = len(units)
        parts = [self._tokens(sides, units.slice(at, CALL_UNITS)) for at in range(0, max(count, 1), CALL_UNITS)]
        self.good, self.n_a, self.n_b, flat_a, flat_b = (np.concatenate(columns) for columns in zip(*parts))
        a_end, b_end = np.cumsum(sides.a_sizes[flat_a]), np.cumsum(sides.b_sizes[flat_b])
        # the units of good texts end on both sides, so no group is in two
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        a_first = np.searchsorted(a_group, np.arange(len(ends) + 1))
        b_first = np.searchsorted(b_group, np.arange(len(ends) + 1))
        a_unit = np.repeat(np.arange(count), self.n_a)
        self.n_groups = np.bincount(a_unit[a_first[:-1]], minlength=count)
        wide = np.diff(b_first)[a_group]
        self.n_links = np.bincount(a_unit, weights=wide, minlength=count).astype(np.int64)
        inner = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        pair = (np.repeat(flat_a, wide) << 32) | flat_b[np.repeat(b_first[a_group], wide) + inner]
        self.pairs, local = np.unique(pair, return_inverse=True)
        both, self.links = np.unique(np.repeat(a_unit, wide) * max(1, len(self.pairs)) + local, return_counts=True)
        unit, self.local = np.divmod(both, max(1, len(self.pairs)))
        self.at = np.searchsorted(unit, np.arange(count + 1))
        # the groups as text: ids in the order of group and side, each with the mark that follows it
        mark_a, mark_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        mark_a[a_first[1:] - 1], mark_b[b_first[1:] - 1] = 1, 2
        order = np.zeros(len(flat_a) + len(flat_b), np.int64)
        order[np.arange(len(flat_a)) + b_first[a_group]] = flat_a + sides.ids * mark_a
        order[np.arange(len(flat_b)) + a_first[b_group + 1]] = flat_b + sides.ids * mark_b
        data, offsets = arrays.text_bytes(sides.names.take(pa.array(order)))
        upto = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        self.text = pa.Array.from_buffers(
            pa.large_binary(), count, [None, pa.py_buffer(np.ascontiguousarray(offsets[upto])), pa.py_buffer(np.ascontiguousarray(data))]
        )

    @classmethod
    def _tokens(cls, sides: _Sides, units: pa.Array) -> tuple[np.ndarray, ...]:
        """Which units both sides give back, their numbers of tokens, and the ids, of good units only."""
        texts = units.cast(pa.large_string()).to_pylist()
        a = [e.ids for e in sides.first.encode_batch_fast(texts, add_special_tokens=False)]
        b = sides.second.encode([t[1:] for t in texts], num_threads=1) if texts else []
        good, flat = np.ones(len(texts), bool), cls._flat(a, b)
        if not cls._same(sides, units, *flat):
            good = np.array([
                b"".join(map(sides.a_bytes.__getitem__, x)) == u == b"".join(map(sides.b_bytes.__getitem__, y))
                for u, x, y in zip(units.to_pylist(), a, b)
            ], bool)
            for at in np.flatnonzero(~good):
                a[at], b[at] = [], []
            flat = cls._flat(a, b)
        return good, *flat

    @staticmethod
    def _flat(a: list[list[int]], b: list[list[int]]) -> tuple[np.ndarray, ...]:
        sizes = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        return *sizes, *(np.fromiter(itertools.chain.from_iterable(side), np.int64) for side in (a, b))

    @staticmethod
    def _same(sides: _Sides, units: pa.Array, n_a: np.ndarray, n_b: np.ndarray, flat_a: np.ndarray, flat_b: np.ndarray) -> bool:
        """Whether the tokens of both sides give back every unit."""
        data, offsets = arrays.text_bytes(units)
        for n, flat, table, sizes in ((n_a, flat_a, sides.a_table, sides.a_sizes), (n_b, flat_b, sides.b_table, sides.b_sizes)):
            upto = np.concatenate([[0], np.cumsum(sizes[flat])])[np.concatenate([[0], np.cumsum(n)])]
            if not np.array_equal(upto, offsets) or not np.array_equal(arrays.text_bytes(table.take(pa.array(flat)))[0], data):
                return False
        return True


def _cut(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: at the texts' own beginnings and at single blanks between plain characters."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 3:
        blank = np.flatnonzero(data[2:-1] == 32) + 2
        before = _ASCII[data[blank - 1]] | ((data[blank - 1] >> 6 == 2) & _LEAD[data[blank - 2]])
        after = _ASCII[data[blank + 1]] | _LEAD[data[blank + 1]]
        cut[blank[before & after]] = True
    cut[offsets] = True  # every text begins with a blank, and ends where the next begins
    return np.flatnonzero(cut[:-1])


def _distinct(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    bounds = np.concatenate([starts, [len(data)]]).astype(np.int64)
    units = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    return units.dictionary, units.indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Postings:
    """For each pair, the documents of a chunk that link it, and how often."""

    def __init__(self, n_docs: int, sizes: np.ndarray, docs: np.ndarray, links: np.ndarray) -> None:
        self.n_docs, self.sizes, self.docs, self.links = n_docs, sizes, docs, links

    def packed(self) -> dict[str, bytes]:
        """Compressed bitmaps and bit planes."""
        dense = self.sizes * 16 >= self.n_docs
        member = np.repeat(dense, self.sizes)
        width = -(-self.n_docs // 8)
        row = np.repeat(np.cumsum(dense) - 1, self.sizes)[member]
        doc = self.docs[member]
        bits = np.bincount(row * width + (doc >> 3), weights=1 << (doc & 7), minlength=int(dense.sum()) * width)
        top = int(self.links.max(initial=0)).bit_length()
        planes = [np.packbits((self.links >> j) & 1).tobytes() for j in range(top)]
        return {
            "sizes": self.sizes.astype("<u4").tobytes(), "bits": bits.astype(np.uint8).tobytes(),
            "numbers": self.docs[~member].astype("<u2").tobytes(), "planes": b"".join(planes),
        }

    @classmethod
    def unpacked(cls, n_docs: int, packed: dict[str, bytes]) -> Postings:
        sizes = np.frombuffer(packed["sizes"], "<u4").astype(np.int64)
        dense = sizes * 16 >= n_docs
        member = np.repeat(dense, sizes)
        docs = np.zeros(len(member), np.int64)
        bits = np.frombuffer(packed["bits"], np.uint8).reshape(int(dense.sum()), -(-n_docs // 8))
        docs[member] = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))[1]
        docs[~member] = np.frombuffer(packed["numbers"], "<u2")
        width = -(-len(docs) // 8)
        links = np.zeros(len(docs), np.int64)
        if width:
            for j, plane in enumerate(np.frombuffer(packed["planes"], np.uint8).reshape(-1, width)):
                links += np.unpackbits(plane, count=len(docs)).astype(np.int64) << j
        return cls(n_docs, sizes, docs, links)

    def summed(self, scores: np.ndarray) -> np.ndarray:
        """Each document's links, with the scores of their pairs, added up."""
        value = np.repeat(scores, self.sizes) * self.links
        # in two halves, so that sums of floating numbers stay exact
        low = np.bincount(self.docs, weights=value & 0x3FFFFFF, minlength=self.n_docs).astype(np.int64)
        return low + (np.bincount(self.docs, weights=value >> 26, minlength=self.n_docs).astype(np.int64) << 26)


_CHUNK = (
    "doc_ids array<{}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs binary, pair_links binary, sizes binary, bits binary, numbers binary, planes binary"
)


def chunks(
    docs: DataFrame, tokenizer: str, model: str, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the chunks of ``docs`` to ``folder`` and read them: one row each."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    with open(model, "rb") as file:
        proto = file.read()
    shared = spark.sparkContext.broadcast((spec, proto))  # two files of fixed size
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _Sides.of(*shared.value)
        for piece in arrays.slices(batches, "text", SLICE_BYTES):
            units, code, doc = _tokenised(sides, piece)
            first = 0
            for part in arrays.slices(iter([piece]), "text", CHUNK_BYTES):
                for low in range(first, first + len(part), CHUNK_DOCS):
                    own = piece.slice(low, min(CHUNK_DOCS, first + len(part) - low))
                    held = slice(*np.searchsorted(doc, [low, low + len(own)]))
                    yield _chunk(own.column("doc_id"), units, code[held], doc[held] - low)
                first += len(part)

    schema = _CHUNK.format(rows.schema["doc_id"].dataType.simpleString())
    written = rows.mapInArrow(run, schema).withColumn("chunk", F.monotonically_increasing_id())
    written.write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def _tokenised(sides: _Sides, piece: pa.RecordBatch) -> tuple[_Units, np.ndarray, np.ndarray]:
    """The distinct units of some texts, and in order of texts which unit is where, and in which text."""
    texts = pc.fill_null(piece.column("text").cast(pa.large_binary()), b"")
    full = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    texts = pc.binary_join_element_wise(
        pa.scalar(b" ", pa.large_binary()), texts.take(pa.array(full)), pa.scalar(b"", pa.large_binary())
    )
    data, offsets = arrays.text_bytes(texts)
    starts = _cut(data, offsets)
    distinct, code = _distinct(data, starts)
    doc = full[np.searchsorted(offsets, starts, "right") - 1] if len(full) else np.zeros(0, np.int64)
    units = _Units(sides, distinct)
    if not units.good.all():
        # a unit that one side does not give back: these texts are tokenised whole
        bad = np.unique(doc[~units.good[code]])
        keep = ~np.isin(doc, bad)
        units = _Units(sides, pa.concat_arrays([distinct, texts.take(pa.array(np.searchsorted(full, bad)))]))
        own = len(distinct) + np.arange(len(bad))
        fine = units.good[own]
        code, doc = np.concatenate([code[keep], own[fine]]), np.concatenate([doc[keep], bad[fine]])
        order = np.argsort(doc, kind="stable")
        code, doc = code[order], doc[order]
    return units, code, doc


def _chunk(doc_ids: pa.Array, units: _Units, code: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    n_docs = len(doc_ids)
    # how often each document holds each unit, then each pair
    both, times = np.unique(doc * max(1, len(units.n_a)) + code, return_counts=True)
    of_doc, of_unit = np.divmod(both, max(1, len(units.n_a)))
    wide = units.at[of_unit + 1] - units.at[of_unit]
    inner = np.repeat(units.at[of_unit], wide) + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
    key = units.local[inner] * n_docs + np.repeat(of_doc, wide)
    links = units.links[inner] * np.repeat(times, wide)
    order = np.argsort(key, kind="stable")
    key, links = key[order], links[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    links = np.add.reduceat(links, first) if len(key) else links
    local, member = np.divmod(key[first], max(1, n_docs))
    held, at, sizes = np.unique(local, return_index=True, return_counts=True)
    packed = Postings(n_docs, sizes, member, links).packed()
    per_doc = [
        np.bincount(doc, weights=values[code], minlength=n_docs).astype(np.int64)
        for values in (units.n_a, units.n_b, units.n_groups, units.n_links)
    ]
    written, offsets = arrays.text_bytes(units.text.take(pa.array(code)))
    bounds, written = offsets[np.searchsorted(doc, np.arange(n_docs + 1))].tolist(), memoryview(np.ascontiguousarray(written))
    # without the mark behind the last group
    digests = [hashlib.sha256(written[x: y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]
    pair_links = np.add.reduceat(links, at) if len(at) else links
    return pa.RecordBatch.from_arrays(
        [pa.array([doc_ids], pa.list_(doc_ids.type)),
         *(pa.array([v], pa.list_(pa.int64())) for v in per_doc), pa.array([digests], pa.list_(pa.string())),
         pa.array([units.pairs[held].astype("<i8").tobytes()], pa.binary()),
         pa.array([pair_links.astype("<i8").tobytes()], pa.binary()),
         *(pa.array([packed[k]], pa.binary()) for k in ("sizes", "bits", "numbers", "planes"))],
        ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "pair_links", "sizes", "bits", "numbers", "planes"],
    )


def _held_pairs(table: DataFrame) -> DataFrame:
    """chunk, at, a, b, n_docs, n_links: a row for each pair of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = np.frombuffer(row["pairs"], "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), row["chunk"], np.int64)), pa.array(np.arange(len(pairs), dtype=np.int32)),
                     pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)),
                     pa.array(np.frombuffer(row["sizes"], "<u4").astype(np.int64)), pa.array(np.frombuffer(row["pair_links"], "<i8"))],
                    ["chunk", "at", "a", "b", "n_docs", "n_links"],
                )

    return table.select("chunk", "pairs", "sizes", "pair_links").mapInArrow(
        run, "chunk long, at int, a int, b int, n_docs long, n_links long"
    )


def pair_counts(table: DataFrame) -> DataFrame:
    """a, b, n_docs, n_links, best: in how many documents, and how often, each pair of ids is linked.

    ``best``: no other pair of ``a`` is linked in more documents.
    """
    counts = _held_pairs(table).groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    highest = counts.groupBy("a").agg(F.max("n_docs").alias("highest"))
    # one row for each id of the vocabulary at most
    return counts.join(F.broadcast(highest), "a").withColumn("best", F.col("n_docs") == F.col("highest")).drop("highest")


def links(table: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document."""
    id_type = table.schema["doc_ids"].dataType.elementType.simpleString()
    scored = _held_pairs(table).select("chunk", "at", "a", "b").join(
        pair_counts(table).select("a", "b", F.col("n_docs").alias("n"), "best"), ["a", "b"]
    )
    # as many as a chunk has distinct pairs
    returned = scored.groupBy("chunk").agg(F.collect_list(F.struct("at", "n", "best")).alias("scores"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                n_docs = len(row["doc_ids"].values)
                postings = Postings.unpacked(n_docs, {k: row[k].as_py() for k in ("sizes", "bits", "numbers", "planes")})
                count, best = (np.zeros(len(postings.sizes), np.int64) for _ in range(2))
                if row["scores"].is_valid:
                    scores = row["scores"].values
                    at = scores.field("at").to_numpy()
                    count[at] = scores.field("n").to_numpy()
                    best[at] = scores.field("best").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, *(row[k].values for k in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(postings.summed(best)), pa.array(postings.summed(count)), row["groups_sha256"].values],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    joined = table.drop("pairs", "pair_links").join(returned, "chunk", "left")
    return joined.mapInArrow(run, (
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    ))


def align(docs: DataFrame, tokenizer: str, model: str, folder: str | None = None, **named) -> DataFrame:
    """``links`` of ``docs``; the chunks go below the shared folder if no other is named."""
    return links(chunks(docs, tokenizer, model, folder or scratch_path(docs.sparkSession, "alignment"), **named))
