"""Phrases whose words occur together more often than apart, by best-first branch and bound.

A phrase of 2 to ``longest`` words that occurs ``a`` >= ``least`` times is scored, for each cut into a first
part (``l`` times) and a rest (``r`` times), by floor(1000 * a * n / (l * r)), n being all words of its
language; the lowest-scoring cut counts. Since a <= r, no phrase that grows from a prefix scores above
floor(1000 * n / count of the prefix), and the first word gives the least of these bounds; since a <= l, the
last word bounds it likewise. So words are taken in the order of their bounds, the highest first:

1. Words are counted. The first frontier holds the words of a bound of ``start`` and more.
2. All phrases that begin or end with a word of the frontier are grown by a word at a time, a pass over the texts
   for each length. A phrase is counted if its words are frequent, and its prefix (or its rest, if it is the last
   word that is in the frontier) was frequent one pass before. What a phrase needs, its parts at every cut and
   its extensions by a word at either side, begins or ends with the same words, and is counted with it.
3. Phrases that begin and end with expanded words are scored. One is dropped if a phrase longer by a word at either
   side occurs as often; still longer ones cannot occur as often if none of these does.
4. A language is settled when its ``top``-th score lies above the bounds of all words that are left, so that not even
   a tie is open. Otherwise the frontier grows to all bounds that reach that score, or, with fewer scores, to
   bounds lower by ``STEP``.

Tasks learn which phrases are frequent from bitmaps of hashes, sized from their number and of at most 2^28 bits. A hash
that two phrases share only lets a rare phrase be counted, too; counts are by the phrase itself.

Defined cases: a NULL or empty text has no words; a NULL language is ``und``; repeated rows count again; with ties,
the phrase that is less in UTF-8 order comes first; an empty table gives an empty result. Other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import arrays
from shelfline.llm.native import staged

#: Bytes of text that are counted together.
SLICE_BYTES = 4 << 20
#: The bound that the first frontier reaches down to, and how much lower the next one reaches at most.
START = 1_000_000
STEP = 1000
MOST_BITS = 28
#: Languages that are sent to all tasks; more are joined by a shuffle.
MOST_SENT = 100_000

# The ends of pieces, and the white space within them.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)

_COUNTS = "lang string, phrase string, n long"


def _hash_words(langs: np.ndarray, words: np.ndarray) -> np.ndarray:
    return arrays.mix(langs * _STEP + words)


def _hash_next(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    return arrays.mix(prefix * _STEP + word)


def _hashes(column: pa.Array) -> np.ndarray:
    data, offsets = arrays.text_bytes(column)
    return arrays.span_hashes(data, offsets[:-1], offsets[1:])


class Bitmap:
    """Some hashes, as bits of a table; others may share their bits."""

    def __init__(self, bits: int, data: bytes) -> None:
        self.mask, self.data = np.uint64((1 << bits) - 1), np.frombuffer(data, np.uint8)


    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        return (self.data[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(phrases: DataFrame) -> Bitmap:
    """The phrases of a table (lang, phrase) as a bitmap: at most 32 MB whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _hashes(batch.column("lang"))
            data, offsets = arrays.text_bytes(batch.column("phrase"))
            # phrases hold single blanks only
            starts, ends, first = arrays.word_bounds_of(data, offsets, data != 32)
            words = _hash_words(np.repeat(langs, np.diff(first)), arrays.span_hashes(data, starts, ends))
            out, sizes = words[first[:-1]], np.diff(first)
            for k in range(1, sizes.max(initial=0)):
                more = sizes > k
                out[more] = _hash_next(out[more], words[first[:-1][more] + k])
            yield pa.RecordBatch.from_arrays([pa.array((out & np.uint64((1 << MOST_BITS) - 1)).astype(np.int64))], ["slot"])

    bits = min(MOST_BITS, max(16, (16 * phrases.count()).bit_length()))
    slot = F.col("slot").bitwiseAND((1 << bits) - 1) + 1
    pages = phrases.select("lang", "phrase").mapInArrow(run, "slot long").groupBy(
        F.bitmap_bucket_number(slot).alias("page")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    data = bytearray(max(4096, 1 << (bits - 3)))
    for row in pages.collect():  # pages of 4 kB of a bitmap of bounded size
        data[(row.page - 1) * 4096: row.page * 4096] = row.bits
    return Bitmap(bits, bytes(data))


class _Words:
    """The words of a slice of texts: their local codes, hashes, and which are in one piece with the next."""

    def __init__(self, piece: pa.RecordBatch) -> None:
        data, offsets = arrays.text_bytes(piece.column("text"))
        data = _LOWER[data]
        kind = _KIND[data]
        solid = kind == 0
        starts, ends, first = arrays.word_bounds_of(data, offsets, solid)
        self.n = len(starts)
        breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
        text = np.repeat(np.arange(len(piece)), np.diff(first))
        self.same = (breaks[1:] == breaks[:-1]) & (text[1:] == text[:-1])
        bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), self.n, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[solid]))]
        ).dictionary_encode()
        self.words, code = words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        langs = piece.column("lang").fill_null("und").dictionary_encode()
        self.langs = langs.dictionary
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        # a word of two languages is two
        both, self.code = np.unique(lang * max(1, len(self.words)) + code, return_inverse=True)
        self.lang_of, self.word_of = np.divmod(both, max(1, len(self.words)))
        self.hash = _hash_words(_hashes(self.langs)[self.lang_of], _hashes(self.words)[self.word_of])

    def rows(self, at: np.ndarray, size: int, counts: np.ndarray) -> pa.RecordBatch:
        """Counts of the phrases of ``size`` words at ``at``."""
        parts = [self.words.take(pa.array(self.word_of[self.code[at + k]])) for k in range(size)]
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang_of[self.code[at]])).cast(pa.string()), phrase.cast(pa.large_string()).cast(pa.string()),
             pa.array(counts.astype(np.int64))],
            ["lang", "phrase", "n"],
        )


def _counted(docs: DataFrame, run) -> DataFrame:
    """Sums of the counts of all slices of ``docs`` (lang, text)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.slices(batches, "text", SLICE_BYTES):
            words = _Words(piece)
            if words.n:
                yield from run(words)

    return docs.mapInArrow(over, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, n of all words, and the number of all words of a language under the empty phrase."""

    def run(words: _Words) -> Iterator[pa.RecordBatch]:
        counts = np.bincount(words.code, minlength=len(words.hash))
        first = np.zeros(len(counts), np.int64)
        first[words.code[::-1]] = np.arange(words.n)[::-1]
        yield words.rows(first, 1, counts)
        total = np.bincount(words.lang_of, weights=counts, minlength=len(words.langs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [words.langs.cast(pa.string()), pa.array([""] * len(total)), pa.array(total)], ["lang", "phrase", "n"]
        )

    return _counted(docs, run)


def phrase_counts(docs: DataFrame, size: int, frequent: Bitmap, fronts: list[Bitmap], shorter: Bitmap | None) -> DataFrame:
    """lang, phrase, n of the phrases of ``size`` words that the last of ``fronts`` adds and that may be frequent."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((frequent, fronts, shorter))  # bitmaps of bounded size

    def run(words: _Words) -> Iterator[pa.RecordBatch]:
        frequent, fronts, shorter = shared.value
        # 0: in no frontier, 1: in the newest, 2: in an earlier one
        stage = np.zeros(len(words.hash), np.int8)
        for nth, front in enumerate(fronts):
            stage = np.maximum(stage, np.where(front.has(words.hash), 2 - (nth == len(fronts) - 1), 0).astype(np.int8))
        stage, good = stage[words.code], frequent.has(words.hash)[words.code]
        fits = good[: words.n - size + 1].copy() if words.n >= size else np.zeros(0, bool)
        for k in range(1, size):
            fits &= good[k: len(fits) + k] & words.same[k - 1: len(fits) + k - 1]
        ends = stage[:len(fits)], stage[size - 1: size - 1 + len(fits)]
        fits &= np.maximum(*ends) == 1
        at = np.flatnonzero(fits)
        if shorter is not None and len(at):
            part = words.hash[words.code]
            prefix, rest = part[at], part[at + 1]
            for k in range(1, size - 1):
                prefix, rest = _hash_next(prefix, part[at + k]), _hash_next(rest, part[at + k + 1])
            at = at[((ends[0][at] == 0) | shorter.has(prefix)) & ((ends[1][at] == 0) | shorter.has(rest))]
        if not len(at):
            return
        key = words.code[at].astype(np.int64)
        for k in range(1, size):
            distinct, where, key, counts = np.unique(
                key * len(words.hash) + words.code[at + k], return_index=True, return_inverse=True, return_counts=True
            )
        yield words.rows(at[where], size, counts)

    return _counted(docs, run)


def _cut(phrase: Column, first: Column | int, last: Column | int) -> Column:
    """The words of a phrase from ``first`` (from 1), ``last`` of them."""
    return F.array_join(F.slice(F.split(phrase, " "), first, last), " ")


def _sent(langs: DataFrame) -> DataFrame:
    """A row for each language, for a join: sent to all tasks unless there are very many, as a language may hold most rows."""
    return F.broadcast(langs) if langs.count() <= MOST_SENT else langs


def scored(counts: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the surviving phrases that begin and end with expanded words.

    ``counts``: lang, phrase, size, f of all frequent words and phrases; ``langs``: lang, n, reach, the largest count
    of an expanded word.
    """
    phrases = counts.where("size > 1")
    # for each phrase, how often the commonest phrase that is longer by a word occurs
    longer = phrases.where("size > 2")
    within = longer.select("lang", _cut(F.col("phrase"), 1, F.col("size") - 1).alias("phrase"), F.col("f").alias("more")).unionByName(
        longer.select("lang", _cut(F.col("phrase"), 2, F.col("size") - 1).alias("phrase"), F.col("f").alias("more"))
    ).groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    left = phrases.join(within, ["lang", "phrase"], "left").where("more IS NULL OR more < f").drop("more")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "*", _cut(F.col("phrase"), 1, F.col("k")).alias("head"),
        _cut(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    named = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    both = cuts.join(named, ["lang", "head"], "left").join(
        named.select("lang", F.col("head").alias("tail"), F.col("l").alias("r")), ["lang", "tail"], "left"
    ).join(_sent(langs.select("lang", "n", "reach")), "lang")
    # 1000 * a * n and l * r may pass 64 bits, their quotient may not: it is at most 10 * n
    exact = both.withColumn("score", F.expr(
        "(1000BD * f * CAST(n AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
    ))
    return exact.groupBy("lang", "phrase", "n", F.col("f").alias("a"), "reach").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"),
        F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first_f"),
        F.max(F.when(F.col("k") == F.col("size") - 1, F.col("r"))).alias("last_f"),
    ).where((F.col("first_f") <= F.col("reach")) & (F.col("last_f") <= F.col("reach"))).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score"
    )


def collocations(
    docs: DataFrame, top: int = 2000, least: int = 100, longest: int = 5, start: int = START, text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the ``top`` phrases of every language."""
    docs = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    # all words pass through here once; only frequent ones are kept
    words = staged(word_counts(docs).where((F.col("n") >= least) | (F.col("phrase") == "")))
    known = words.where("phrase <> ''").select("lang", "phrase", F.lit(1).alias("size"), F.col("n").alias("f"))
    totals = words.where("phrase = ''").select("lang", "n")
    frequent, fronts = bitmap(known), []
    levels: dict[int, DataFrame] = {1: known}
    # reach: counts of expanded words go up to it
    langs = totals.withColumn("open", F.lit(True)).withColumn("before", F.lit(0).cast("long")).withColumn(
        "bound", F.lit(start).cast("long")
    )
    while True:
        # floor(1000 * n / f) >= bound, that is f <= 1000 * n / bound
        langs = staged(langs.withColumn("reach", F.when(F.col("open"), F.expr("1000 * n div bound")).otherwise(F.col("before"))))
        new = known.join(_sent(langs), "lang").where("f > before AND f <= reach").select("lang", "phrase")
        fronts.append(bitmap(new))
        for size in range(2, longest + 1):
            shorter = None if size == 2 else bitmap(levels[size - 1])
            found = phrase_counts(docs, size, frequent, fronts, shorter).where(F.col("n") >= least).select(
                "lang", "phrase", F.lit(size).alias("size"), F.col("n").alias("f")
            )
            levels[size] = staged(found if size not in levels else found.unionByName(levels[size]))
        counts = levels[1]
        for size in range(2, longest + 1):
            counts = counts.unionByName(levels[size])
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = staged(scored(counts, langs).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top))
        last = ranked.where(F.col("rank") == top).select("lang", F.col("score").alias("last"))
        rest = known.join(_sent(langs), "lang").where("f > reach").groupBy("lang").agg(F.min("f").alias("next_f"))
        langs = staged(
            langs.join(last, "lang", "left").join(rest, "lang", "left")
            .withColumn("open", F.expr("next_f IS NOT NULL AND (last IS NULL OR 1000 * n div next_f >= last)"))
            .withColumn("before", F.col("reach"))
            .withColumn("bound", F.greatest(F.lit(1), F.coalesce("last", F.expr(f"bound div {STEP}"))))
            .select("lang", "n", "open", "before", "bound")
        )
        if langs.where("open").isEmpty():
            return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
