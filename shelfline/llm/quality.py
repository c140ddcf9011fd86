"""Line-first quality rules: lines that fail a rule go, then documents that lost too much go.

A line fails if it

- is navigation or symbols: two characters of ``#*$%&|<>`` or more, and one for every five words,
- shouts: three exclamation marks or more and one for every three words, or three words or more with
  over three fifths of the ASCII letters in upper case,
- stammers: five words or more that equal the word before, and three tenths of all,
- has no punctuation: fifty words or more without any of ``. , ; : ! ?``,
- is boilerplate: phrases of ``BOILERPLATE``, whatever the case, are a tenth of its words or more; a long line may
  mention one.

A document fails if the lines that went held over three tenths of its characters in words. Before
that stands a base rule: under twenty words, or over three tenths of the words inside windows of eight
words that occur more than once.

Defined cases: a NULL text and one without words have no words and fail the base rule; lines without a
word are neither judged nor counted; a text may be one long line; an empty table gives an empty result.
Only id and text are read, ``clean`` carries all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import arrays

# Lower-case phrases of notices that pages and files repeat.
BOILERPLATE = (
    "all rights reserved",
    "apache license",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "terms of service",
    "terms of use",
)

MIN_WORDS = 20
WINDOW = 8

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_failed_lines long, lost_chars long"
)


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOL = _flags(b"#*$%&|<>")
_BANG = _flags(b"!")
_MARK = _flags(b".,;:!?")
_UPPER = _flags(bytes(range(65, 91)))
_LETTER = _flags(bytes([*range(65, 91), *range(97, 123)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _first_of_equals(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether it occurred before and whether it occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[1:] = keys[order][1:] == keys[order][:-1]
    again, many = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order] = same
    many[order] = same | np.append(same[1:], False)
    return again, many


def judge(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The result columns, and of the lines: their first bytes and the end, the first line of each text, whether each fails."""
    starts, ends, first = arrays.word_bounds(data, offsets)
    hashes = arrays.span_identities(data, starts, ends)
    n_words = np.diff(first)
    inside = ~arrays.IS_SPACE[data]
    char = inside & ((data & 0xC0) != 0x80)

    shingles, at = arrays.windows(hashes, first, WINDOW)
    text_of_word = np.repeat(np.arange(len(n_words)), n_words)
    salt = arrays.mix(np.arange(len(n_words), dtype=np.uint64))
    repeated = at[_first_of_equals(shingles ^ salt[text_of_word[at]])[1]]
    cover = np.zeros(len(starts) + WINDOW, np.int64)
    cover[repeated] += 1
    cover[repeated + WINDOW] -= 1
    covered = np.cumsum(cover)[: len(starts)] > 0

    # a line starts with each text and after each line feed
    begins = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    begins = begins[begins < len(data)]
    bounds = np.append(begins, len(data))
    text_of_line = np.searchsorted(offsets, begins, "right") - 1
    line_word = np.searchsorted(starts, bounds)
    words = np.diff(line_word)
    full = words > 0
    stop = bounds[1:] - (data[bounds[1:] - 1] == 10) if len(begins) else begins
    line_keys = arrays.span_identities(data, begins, stop) ^ salt[text_of_line]
    again = np.zeros(len(begins), bool)
    again[full] = _first_of_equals(line_keys[full])[0]

    def count(table: np.ndarray) -> np.ndarray:
        return arrays.per_text(table[data], bounds)

    symbols, bangs = count(_SYMBOL), count(_BANG)
    stammer = np.zeros(len(starts), bool)
    stammer[1:] = (hashes[1:] == hashes[:-1])
    stammer[line_word[:-1][full]] = False
    stammers = arrays.per_text(stammer, line_word)
    fails = (
        ((symbols >= 2) & (5 * symbols >= words))
        | ((bangs >= 3) & (3 * bangs >= words))
        | ((words >= 3) & (5 * count(_UPPER) > 3 * count(_LETTER)))
        | ((stammers >= 5) & (10 * stammers >= 3 * words))
        | ((words >= 50) & (count(_MARK) == 0))
    )
    lower, notice = _LOWER[data].tobytes(), np.zeros(len(begins), np.int64)
    for phrase in BOILERPLATE:
        found = lower.find(phrase.encode())
        while found >= 0:
            line = int(np.searchsorted(begins, found, "right")) - 1
            if found + len(phrase) <= bounds[line + 1]:
                notice[line] += phrase.count(" ") + 1
            found = lower.find(phrase.encode(), found + 1)
    fails |= (notice > 0) & (10 * notice >= words)
    fails &= full

    line_bounds = np.searchsorted(text_of_line, np.arange(len(n_words) + 1))
    lost = arrays.per_text(arrays.per_text(char, bounds) * fails, line_bounds)
    chars = arrays.per_text(char, offsets)
    repeats = arrays.per_text(covered, first)
    base_failed = (n_words < MIN_WORDS) | (100 * repeats > 30 * n_words)
    columns = {
        "n_words": n_words, "word_chars": chars, "n_symbols": arrays.per_text(_SYMBOL[data], offsets),
        "n_dup_lines": arrays.per_text(again, line_bounds), "n_repeat_words": repeats, "base_failed": base_failed,
        "kept": ~base_failed & (10 * lost <= 3 * chars),
        "n_failed_lines": arrays.per_text(fails, line_bounds), "lost_chars": lost,
    }
    return columns, bounds, line_bounds, fails


def _arrow(columns: dict[str, np.ndarray]) -> list[pa.Array]:
    return [pa.array(v if v.dtype == bool else v.astype(np.int64)) for v in columns.values()]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the columns of ``RESULT``: one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text"):
            columns, *_ = judge(*arrays.text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_arrow(columns)], ["doc_id", *columns])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {RESULT}")


def clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` that are kept, their texts without the failing lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, text_col):
            data, offsets = arrays.text_bytes(part.column(text_col))
            columns, bounds, line_bounds, fails = judge(data, offsets)
            texts = part.column(text_col).to_pylist()
            for i in np.flatnonzero(columns["kept"] & (columns["n_failed_lines"] > 0)):
                own = [k for k in range(line_bounds[i], line_bounds[i + 1]) if not fails[k]]
                lines = [data[bounds[k]: bounds[k + 1]].tobytes().decode().removesuffix("\n") for k in own]
                texts[i] = "\n".join(lines)
            new = part.set_column(part.schema.get_field_index(text_col), part.schema.field(text_col),
                                  pa.array(texts, part.schema.field(text_col).type))
            yield new.filter(pa.array(columns["kept"]))

    kept = docs.mapInArrow(run, docs.schema)
    return kept.withColumn(chars_col, F.length(text_col).cast("long")) if chars_col in docs.columns else kept
