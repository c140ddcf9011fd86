"""Removal of byte strings that occur more than once, found with suffix arrays.

A window is any ``WIDTH`` bytes of a text. Every window belongs to the anchor in it: the gram of ``GRAM`` bytes
with the least hash. Equal windows have the same anchor at the same place, so repeats are looked for
among the runs of windows with one anchor, and a text of n bytes has about n / 60 runs.

1. Hashes of anchors that occur in one place only are dropped. What is left is a small part of a corpus.
2. Runs whose bytes are equal as a whole repeat as a whole.
3. Where an anchor stands in runs of different bytes, one run of each kind goes to a suffix array,
   groups by anchor together, a few megabytes at a time. Neighbours in it that agree in ``WIDTH`` bytes
   are repeats (see ``suffixes``: two-stage sorting).
4. An anchor with more than ``GROUP`` different runs is not given to one task: its runs are cut at fixed
   distances from the anchor, which gives longer strings that all windows of a part share, and dealt anew by
   those; what becomes equal is settled by rule 2, and parts end as single windows.
5. Texts that occur more than once are removed whole if they hold a window.

Two sets are sent to all tasks while they are small, ``BROADCAST_ROWS`` rows at most; beyond that they are
joined by shuffling.

Defined cases: NULL and empty texts have no bytes; texts under ``WIDTH`` bytes keep everything; repeated rows
are texts that occur more than once; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import arrays, suffixes
from shelfline.llm.native import staged

WIDTH = 200
GRAM = 72
#: Different runs around an anchor that one task compares, at most.
GROUP = 4096
#: Bytes that go to one suffix array, unless a group is larger.
CHUNK_BYTES = 2 << 20
#: Bytes of text that are cut into runs at a time.
SLICE_BYTES = 1 << 19
#: Rows of some forty bytes that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def runs(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """Windows dealt to anchors.

    The anchor of a window is the gram in it with the least hash, the leftmost of equals. Returns, for
    each run of windows with one anchor: the anchor's hash, the hash of the run's bytes, the text's
    number, the first window, their number, and how far the anchor lies behind the first window.
    """
    n = len(data)
    span = width - gram + 1
    lengths = np.maximum(np.diff(offsets) - width + 1, 0)
    total = int(lengths.sum())
    empty = np.zeros(0, np.int64)
    if not total:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty, empty
    at = np.arange(n - gram + 1)
    hashes = arrays.span_hashes(data, at, at + gram)
    bits = np.uint64(max(24, int(n).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    keyed = (hashes & ~mask) | at.astype(np.uint64)
    # the least of every ``span`` neighbours: of the rest of one block and the beginning of the next
    blocks = np.full(-(-len(keyed) // span) * span + span, ~np.uint64(0))
    blocks[: len(keyed)] = keyed
    blocks = blocks.reshape(-1, span)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    text = np.repeat(np.arange(len(lengths)), lengths)
    window = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(lengths) - lengths), lengths)
    anchor = (np.minimum(down[window], up[window + span - 1]) & mask).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, total))
    start = window[first]
    anchor = anchor[first]
    return hashes[anchor], arrays.span_hashes(data, start, start + count - 1 + width), text[first], start, count, anchor - start


def joined_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that overlap or touch, as one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.append(True, begin[1:] > end[:-1])[: len(begin)]
    last = np.flatnonzero(np.append(new[1:], True)[: len(begin)])
    return begin[new], end[last]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (bytes), key and n_bytes, which together stand for the text."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("key"), F.octet_length("text").alias("n_bytes")
    )


def _marks(rows: DataFrame) -> DataFrame:
    """h, code: anchors with a number for the place, two for those that a text holds in equal runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            h, s, text, start, _, _ = _of_texts(part)
            key = part.column("key").to_numpy().view(np.uint64)[text]
            place = arrays.mix(key ^ arrays.mix(start.astype(np.uint64)))
            first, twice = _once(text, h, s)
            code = np.append(place[first], place[first][twice] + np.uint64(1))
            anchors = np.append(h[first], h[first][twice])
            yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(code.view(np.int64))], ["h", "code"])

    return rows.where(F.col("n_bytes") >= WIDTH).select("text", "key").mapInArrow(run, "h long, code long")


def _of_texts(part: pa.RecordBatch):
    """``runs`` with the first windows counted from the beginning of their text."""
    data, offsets = arrays.text_bytes(part.column("text"))
    h, s, text, start, count, behind = runs(data, offsets)
    return h, s, text, start - offsets[text], count, behind


def _once(text: np.ndarray, h: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the runs of a text that are equal, and whether there are more."""
    order = np.lexsort((np.arange(len(h)), s, h, text))
    t, a, b = text[order], h[order], s[order]
    new = np.append(True, (t[1:] != t[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(h)]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(h))) > 1


def _repeated_runs(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Runs at the given anchors (kind 0), and stretches that repeat within their text (kind 1).

    kind, h, s, key, n_bytes, doc_id, at, n, behind
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            h, s, text, start, count, behind = _of_texts(part)
            first, twice = _once(text, h, s)
            # all equal runs of a text, joined
            again = np.zeros(len(h), bool)
            if twice.any():
                order = np.lexsort((s, h, text))
                same = (text[order][1:] == text[order][:-1]) & (h[order][1:] == h[order][:-1]) & (s[order][1:] == s[order][:-1])
                again[order[1:][same]] = True
                again[order[:-1][same]] = True
            own = np.flatnonzero(again)
            # texts far enough apart that their stretches do not touch
            step = int(start.max(initial=0)) + int(count.max(initial=0)) + 2
            begin, end = joined_spans(start[own] + text[own] * step, start[own] + text[own] * step + count[own])
            doc, back = begin // step, begin // step * step
            pick = np.append(text[first], doc)
            none = arrays.mix(part.column("key").to_numpy().view(np.uint64)[doc] ^ arrays.mix((begin - back).astype(np.uint64)))
            kind = np.repeat([0, 1], [len(first), len(doc)]).astype(np.int32)
            columns = [
                pa.array(kind), pa.array(np.append(h[first], none).view(np.int64)), pa.array(np.append(s[first], none).view(np.int64)),
                *(part.column(c).take(pa.array(pick)) for c in ("key", "n_bytes", "doc_id")),
                pa.array(np.append(start[first], begin - back).astype(np.int32)),
                pa.array(np.append(count[first], end - begin).astype(np.int32)),
                pa.array(np.append(behind[first], np.zeros(len(doc), np.int64)).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "h", "s", "key", "n_bytes", "doc_id", "at", "n", "behind"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.where(F.col("n_bytes") >= WIDTH).mapInArrow(
        run, f"kind int, h long, s long, key long, n_bytes int, doc_id {kind}, at int, n int, behind int"
    )
    marked = _small(anchors.withColumn("wanted", F.lit(True)))
    return found.join(marked, "h", "left").where("kind = 1 or wanted").drop("wanted")


def _small(df: DataFrame) -> DataFrame:
    """``df``, a stored table, to be broadcast if its size was checked to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _same_windows(items: DataFrame) -> DataFrame:
    """h, s, first, n: windows of the runs that are in more runs of their group. ``items``: g, h, s, off, body."""

    def solve(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(x[3] for x in held), np.uint8)
        lengths = np.array([len(x[3]) for x in held])
        begins = np.cumsum(lengths) - lengths
        window = np.zeros(len(data), bool)
        counts = lengths - WIDTH + 1
        window[np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)] = True
        order = suffixes.suffix_array(data, WIDTH)
        order = order[window[order]]
        equal = suffixes.common_prefixes(order, suffixes.eight_bytes(data), WIDTH) >= WIDTH
        repeated = np.zeros(len(data) + 1, bool)
        repeated[order[equal]] = True
        repeated[order[np.flatnonzero(equal) - 1]] = True
        # stretches of repeated windows; the last bytes of a run begin no window
        edge = np.flatnonzero(repeated[1:] != repeated[:-1]) + 1
        edge = np.append(0, edge) if repeated[0] else edge
        first, last = edge[::2], edge[1::2]
        run = np.searchsorted(begins, first, "right") - 1
        h, s, off = (np.array([x[k] for x in held], np.int64)[run] for k in range(3))
        columns = [h, s, (first - begins[run] + off).astype(np.int32), (last - first).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "s", "first", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, group = 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("g", "h", "s", "off", "body"))
            for g, h, s, off, body in zip(*columns):
                if g != group and size >= CHUNK_BYTES:
                    yield solve(held)
                    held, size = [], 0
                held.append((h, s, off, body))
                size, group = size + len(body), g
        if held:
            yield solve(held)

    return items.repartition("g").sortWithinPartitions("g").mapInArrow(run, "h long, s long, first int, n int")


def _parts(items: DataFrame, lo: int, hi: int, level: int) -> DataFrame:
    """Runs cut to the windows whose anchor lies ``lo`` … ``hi`` - 1 bytes behind, grouped by what these share."""
    # windows of a run, by how far the anchor is behind: from ``behind`` down
    first = F.greatest(F.col("behind") - (hi - 1), F.lit(0))
    last = F.least(F.col("behind") - lo, F.octet_length("body") - WIDTH)
    cut = items.withColumn("skip", first).withColumn("windows", last - first + 1).where("windows > 0")
    cut = cut.withColumn("body", F.expr(f"substring(body, skip + 1, windows + {WIDTH - 1})"))
    cut = cut.withColumn("off", F.col("off") + F.col("skip")).withColumn("behind", F.col("behind") - F.col("skip"))
    shared = F.expr(f"substring(body, behind - {lo} + 1, {WIDTH + 1 + lo - hi})")
    return cut.withColumn("g", F.xxhash64("g", F.lit(level), F.lit(lo), shared)).drop("skip", "windows")


def _compared(items: DataFrame) -> list[DataFrame]:
    """Tables of h, s, first, n: windows of the runs that repeat. ``items``: g, h, s, off, behind, body."""
    found = []
    stretches, level = [(0, WIDTH - GRAM + 1)], 0
    while True:
        sizes = staged(items.groupBy("g").count().where("count > 1"))
        few = sizes.where(F.col("count") <= GROUP).select("g")
        found.append(_same_windows(items.join(few, "g", "left_semi")))
        many = sizes.where(F.col("count") > GROUP).select("g")
        if not many.take(1):
            return found
        hot = items.join(many, "g", "left_semi")
        level += 1
        halves, parts = [], None
        for lo, hi in stretches:
            mid = (lo + hi + 1) // 2
            for a, b in ((lo, mid), (mid, hi)):
                if a < b:
                    halves.append((a, b))
        for lo, hi in halves:
            part = _parts(hot, lo, hi, level)
            parts = part if parts is None else parts.unionByName(part)
        parts = staged(parts.withColumn("w", F.md5("body")))
        # parts that are now equal repeat as a whole; one of them goes on
        kinds = parts.groupBy("g", "behind", "w").agg(
            F.count("*").alias("n_equal"),
            F.min_by(F.struct("h", "s", "off", "body"), F.struct("h", "s")).alias("one"),
        )
        kinds = staged(kinds)
        equal = parts.join(kinds.where("n_equal > 1").select("g", "behind", "w"), ["g", "behind", "w"], "left_semi")
        found.append(equal.select("h", "s", F.col("off").alias("first"), (F.octet_length("body") - WIDTH + 1).alias("n")))
        items = kinds.select("g", "behind", "one.*")
        stretches = halves


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each text as stretches of bytes that do not touch."""
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = []
        for own in batch.column("own"):
            begin, n = (own.values.field(c).to_numpy().astype(np.int64) for c in ("begin", "n"))
            spans.append([{"begin": a, "end": b} for a, b in zip(*map(np.ndarray.tolist, joined_spans(begin, begin + n + WIDTH - 1)))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("n_bytes"), pa.array(spans, kind)], ["key", "n_bytes", "spans"]
        )


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as doc_id, text, key, n_bytes; and of texts with repeats: key, n_bytes, whole, spans.

    A span is a stretch of bytes that goes: begin, end.
    """
    rows = _rows(docs, id_col, text_col)
    copies = rows.where(F.col("n_bytes") >= WIDTH).groupBy("key", "n_bytes").count().where("count > 1").select("key", "n_bytes")
    places = _marks(rows).groupBy("h").agg(F.min("code").alias("a"), F.max("code").alias("b"))
    anchors = staged(places.where("a <> b").select("h"))
    found = staged(_repeated_runs(rows, anchors))
    inside = found.where("kind = 1").select("key", "n_bytes", F.col("at").alias("begin"), "n")
    place = F.struct("key", "n_bytes", "at")
    kinds = found.where("kind = 0").groupBy("h", "s").agg(
        F.min(place).alias("a"), F.max(place).alias("b"), F.min(F.struct(place.alias("place"), "doc_id", "n", "behind")).alias("one")
    )
    kinds = staged(kinds.select("h", "s", (F.col("a") != F.col("b")).alias("equal"), "one"))
    several = kinds.groupBy("h").agg(F.min("s").alias("a"), F.max("s").alias("b")).where("a <> b").select("h")
    wanted = staged(kinds.join(several, "h", "left_semi").select(
        "h", "s", F.col("one.place.key").alias("key"), F.col("one.place.at").alias("at"), F.col("one.doc_id").alias("_id"), "one.n", "one.behind"
    ))
    by_text = wanted.groupBy("key", "_id").agg(F.collect_list(F.struct("h", "s", "at", "n", "behind")).alias("own"))
    by_text = F.broadcast(by_text) if wanted.count() <= BROADCAST_ROWS else by_text
    held = rows.join(by_text, (rows["key"] == by_text["key"]) & rows["doc_id"].eqNullSafe(by_text["_id"]))
    items = held.select("text", F.explode("own").alias("r")).select(
        F.col("r.h").alias("g"), "r.h", "r.s", F.lit(0).alias("off"), "r.behind",
        F.expr(f"substring(text, r.at + 1, r.n + {WIDTH - 1})").alias("body"),
    )
    items = staged(items.groupBy("g", "h", "s", "off", "behind").agg(F.first("body").alias("body")))
    whole = kinds.where("equal").select("h", "s", F.lit(0).alias("first"), F.col("one.n").alias("n"))
    for table in _compared(items):
        whole = whole.unionByName(table)
    marks = found.where("kind = 0").select("h", "s", "key", "n_bytes", "at").join(whole, ["h", "s"]).select(
        "key", "n_bytes", (F.col("at") + F.col("first")).alias("begin"), "n"
    )
    gathered = marks.unionByName(inside).distinct().groupBy("key", "n_bytes").agg(F.collect_list(F.struct("begin", "n")).alias("own"))
    spans = gathered.mapInArrow(_merged, "key long, n_bytes int, spans array<struct<begin:int,end:int>>")
    both = copies.withColumn("whole", F.lit(True)).join(spans, ["key", "n_bytes"], "full")
    return rows, staged(both.select("key", "n_bytes", F.coalesce("whole", F.lit(False)).alias("whole"), "spans"))


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, kept (the bytes that stay), spans (begin, end of those that go): one row per row of ``docs``."""
    rows, found = repeats(docs, id_col, text_col)
    n_spans = found.agg(F.sum(F.coalesce(F.size("spans"), F.lit(0)) + 1)).first()[0] or 0
    found = F.broadcast(found) if n_spans <= BROADCAST_ROWS else found
    joined = rows.join(found, ["key", "n_bytes"], "left").select("doc_id", "text", "n_bytes", "whole", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text"):
            kept, spans = [], []
            for text, whole, own in zip(
                part.column("text").to_pylist(), part.column("whole").to_pylist(), part.column("spans").to_pylist()
            ):
                if whole:
                    kept.append(b"")
                    spans.append([(0, len(text))])
                elif own:
                    edges = [0, *(x[k] for x in own for k in ("begin", "end")), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    spans.append([(x["begin"], x["end"]) for x in own])
                else:
                    kept.append(text)
                    spans.append([])
            pairs = pa.array(
                [[{"begin": a, "end": b} for a, b in x] for x in spans],
                pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes").cast(pa.int64()), pa.array(kept, pa.binary()), pairs],
                ["doc_id", "n_bytes", "kept", "spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<begin:long,end:long>>")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the rows of ``cut``."""
    return removed.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
