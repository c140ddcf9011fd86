"""Benchmark decontamination with one Aho-Corasick automaton over the items' word windows.

Texts are normalised to lower-case words joined by single spaces; a word is a run of ASCII letters and
digits or of characters beyond ASCII. Every ten consecutive words of an item, or all words of a shorter
one, are a pattern with a space at either end. A text is scanned once; the offsets of a match are
counted back to words, and from there to the original text where they are asked for.

The automaton is broadcast, so its size is bounded: past ``BLOCK_BYTES`` of patterns the rest goes to
another automaton and another pass over the texts.

Defined cases: NULL and texts without words have no words and no hits; items without words have no
window; equal windows of several items hit for all of them, repeated items count by their id; an item
with a NULL id is written as the empty string; an empty benchmark hits nothing; an empty table gives an
empty result. Only id and text are read, ``clean`` carries all columns.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.llm import arrays
from shelfline.llm.native import staged

WINDOW = 10
#: Bytes of patterns in one automaton; it takes some twenty times as much memory.
BLOCK_BYTES = 4 << 20

RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

# lower-cases A-Z, keeps a-z, 0-9 and all bytes of characters beyond ASCII, and makes a space of the rest
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split(b" ")


def patterns(text: str | None, width: int = WINDOW) -> set[str]:
    """The windows of an item."""
    words = [w.decode() for w in normal_words(text) if w]
    last = max(1, len(words) - width + 1) if words else 0
    return {" " + " ".join(words[i: i + width]) + " " for i in range(last)}


def blocks(items: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_BYTES) -> Iterator[dict[str, list[str]]]:
    """Patterns with the ids of their items, ``limit`` bytes at a time.

    Items come to the driver one partition after the other, never all at once.
    """
    held: dict[str, set[str]] = {}
    size = 0
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator()
    for row in rows:
        for pattern in patterns(row.t):
            size += len(pattern.encode()) * (pattern not in held)
            held.setdefault(pattern, set()).add(row.i or "")
        if size >= limit:
            yield {k: sorted(v) for k, v in held.items()}
            held, size = {}, 0
    if held:
        yield {k: sorted(v) for k, v in held.items()}


def automaton(held: dict[str, list[str]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for pattern, ids in held.items():
        machine.add_word(pattern, (pattern.count(" ") - 1, ids))
    machine.make_automaton()
    return machine


def hits(normal: str, machine: ahocorasick.Automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """Stretches of word numbers [first, last) that are hit, and the items. ``normal``: words with a space at either end."""
    found, ids = [], set()
    counted = at = 0
    for end, (n, own) in machine.iter(normal):
        counted += normal.count(" ", at, end)
        at = end
        found.append((counted - n, counted))
        ids.update(own)
    return found, ids


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(stretches):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def spans(text: str, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches as offsets in the original text."""
    words = [m.span() for m in _WORD.finditer(text)]
    return [(words[first][0], words[last - 1][1]) for first, last in stretches]


class _Machines:
    """Automata of a Python worker: the one that its tasks use now."""

    name: str | None = None
    built: ahocorasick.Automaton | None = None

    @classmethod
    def of(cls, name: str, held) -> ahocorasick.Automaton | None:
        if cls.name != name:
            cls.name, cls.built = name, automaton(held.value) if held.value else None
        return cls.built


def _pass(rows: DataFrame, held: dict[str, list[str]], last: bool) -> DataFrame:
    """Adds what one automaton finds to the columns stretches and items; the last pass drops the text."""
    name, shared = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(held)
    fields = [f for f in rows.schema.fields if not (last and f.name == "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _Machines.of(name, shared)
        for part in arrays.slices(batches, "text"):
            data, offsets = arrays.text_bytes(part.column("text"))
            raw = data.tobytes().translate(_NORMAL)
            old = zip(part.column("stretches").to_pylist(), part.column("items").to_pylist())
            n_words, stretches, items = [], [], []
            for i, (before, known) in enumerate(old):
                words = raw[offsets[i]: offsets[i + 1]].split()
                n_words.append(len(words))
                found, ids = [], set()
                if words and machine is not None:
                    found, ids = hits(" " + b" ".join(words).decode() + " ", machine)
                if found:
                    before = [list(x) for x in merged([*map(tuple, before), *found])]
                    known = sorted({*known, *ids})
                stretches.append(before)
                items.append(known)
            new = {"n_words": pa.array(n_words, pa.int64()), "stretches": pa.array(stretches, pa.list_(pa.list_(pa.int64()))),
                   "items": pa.array(items, pa.list_(pa.string()))}
            names = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([new.get(x, None) if x in new else part.column(x) for x in names], names)

    return rows.mapInArrow(run, StructType(fields))


def scanned(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str) -> DataFrame:
    """row (a struct of the columns of ``docs``), n_words, stretches, items.

    One pass for a benchmark whose patterns fit one automaton. A larger one takes a pass for each
    block; what a pass leaves is written down before the next, so tasks hold one automaton at a time.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<long>>").alias("stretches"), F.array().cast("array<string>").alias("items"),
    )
    source = blocks(items, item_id, item_text, BLOCK_BYTES)
    held = next(source, {})
    while (following := next(source, None)) is not None:
        rows = staged(_pass(rows, held, last=False))
        held = following
    return _pass(rows, held, last=True)


def score(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id and the columns of ``RESULT``: one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = scanned(rows, items, "text", item_id, item_text)
    n_hit = F.aggregate("stretches", F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])
    return found.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def found_spans(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, items, begin, end: every hit stretch as character offsets of the original text, end exclusive."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = scanned(rows, items, "text", item_id, item_text).where("size(stretches) > 0")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out = []
            for i, row in enumerate(part.to_pylist()):
                for begin, end in spans(row["text"], row["stretches"]):
                    out.append((i, row["items"], begin, end))
            at = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(at), pa.array([x[1] for x in out], pa.list_(pa.string())),
                 pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64())],
                ["doc_id", "items", "begin", "end"],
            )

    flat = found.select("row.doc_id", "row.text", "stretches", "items")
    return flat.mapInArrow(run, f"doc_id {kind}, items array<string>, begin long, end long")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any hit."""
    return scanned(docs, items, text_col, item_id, item_text).where("size(stretches) = 0").select("row.*")
