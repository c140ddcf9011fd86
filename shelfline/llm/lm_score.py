"""Log probabilities of texts by logistic mixing of hashed-context bit predictions.

A text is its words and an end sign, cut into pieces where a hash of two neighbouring words says so, some
sixteen words long. A piece is either taken whole from the pieces that were learnt, or coded byte by byte.

*Bytes.* The words of a text, a blank after each, and the end sign are coded in place, bit by bit, along a prefix
code of the bytes. For every bit, contexts (the last one, two, three, four and six bytes of the text, whatever words
they are in, and the word so far) point by hash into tables of how often the bit was 0 and 1 there; a check value tells
a context from others that share its place. The predictions are stretched (log odds), summed with the weights of a
gate, which tells how well the long contexts are known, and squashed. A last table refines the result: for each gate and
step of log odds, how often the bit really was 1.

*Grams.* What is known of a bit depends on the byte and the bytes before it alone: a gram, six bytes and a hash of
what the word has before them. So equal grams have one probability, and their number stands for their occurrences.

*Pieces.* Of M pieces that were learnt, one with the count c has (c - D) / M, times the probability that a piece
is a known one. That bit is predicted from whether the two pieces before were known, and goes with texts
that repeat others. The rest goes to the product of the bytes.

*Learning.* Everything is learnt from the documents that are not held out, all of them: the counts, the weights and the
refinement from every occurrence of every byte. Weights, refinement and the prediction of known pieces are learnt with
the occurrence or piece at hand taken out of the counts; learnt texts are scored that way, too, as far as pieces go.
Weights are learnt online, step after step over the grams of a task, and averaged over tasks.

*Bounds.* The tables of a context have as many places as it has bits to keep, up to ``2 ** BITS``; these, the gates and
``FREQUENT`` words are sent to the tasks, a bounded size. Less frequent words are looked up with a join.

Defined cases: NULL and empty texts are the end sign alone; repeated rows are scored and counted each; a NULL
id is hashed as the empty string; without training documents all bytes are spelt, at even odds for each
bit; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import arrays, native
from shelfline.llm.native import staged

#: Bytes before the one to be coded that each context holds; 0 is the word so far.
ORDERS = (1, 2, 3, 4, 6, 0)
#: A table has up to 2 ** BITS places.
BITS = 24
#: Words whose counts every task holds.
FREQUENT = 1 << 17
#: Distinct words that a task counts before it hands them on, and grams.
COUNTED, COUNTED_GRAMS = 400_000, 2_000_000
#: Grams that are coded at a time.
BATCH = 1 << 16
#: Bytes of text that are cut into grams at a time, or one text.
TEXT_BYTES = 1 << 20
#: Grams are shared out by a hash of so many bits of the last three bytes before, places of a table by all but so many bits.
BUCKETS, SEGMENT = 10, 18
#: Coded grams that a worker keeps: two to this power.
KEPT = 22
#: A piece ends after one in so many pairs of words.
PIECE = 16
#: Steps of log odds in the refinement, from -LIMIT to LIMIT.
STEPS, LIMIT = 33, 12.0

END = b"\n"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 1


# counts in a byte: exact up to 15, then eight steps for each doubling


def _quantised(n: np.ndarray) -> np.ndarray:
    n = np.maximum(n, 0)
    return np.where(n < 16, n, 16 + np.floor(8 * np.log2(np.maximum(n, 16) / 16))).clip(0, 255).astype(np.uint8)


_COUNT = np.where(np.arange(256) < 16, np.arange(256), 16 * 2.0 ** ((np.arange(256) - 15.5) / 8))


def _log_odds(less0: int, less1: int) -> np.ndarray:
    """Log odds of a 1 for each pair of counts, as [zeros, ones], of which some are left out."""
    zeros = np.maximum(_COUNT[:, None] - less0, 0) + 0.4
    ones = np.maximum(_COUNT[None, :] - less1, 0) + 0.4
    return np.log(ones / zeros).astype(np.float32).ravel()


#: As counted, with a 0 less and with a 1 less.
_ODDS = np.stack([_log_odds(0, 0), _log_odds(1, 0), _log_odds(0, 1)])
_SEEN = (_COUNT[:, None] + _COUNT[None, :]).ravel()

GATES = 20

#: Two hashes of a gram.
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Code:
    """A prefix code of bytes: the inner nodes of its tree and the bits on the way to each byte."""

    def __init__(self, counts: np.ndarray, sizes: tuple[int, ...] = (BITS,) * len(ORDERS)) -> None:
        #: by order, the power of two that is the number of places
        self.sizes = sizes
        heap = [(float(n) + 1e-3, byte, byte) for byte, n in enumerate(counts)]
        heapq.heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        while len(heap) > 1:
            (n, _, left), (m, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            node = 256 + len(children)
            children[node] = left, right
            heapq.heappush(heap, (n + m, node, node))
        paths: dict[int, list[tuple[int, int]]] = {heap[0][2]: []}
        for node in sorted(children, reverse=True):
            for bit, child in enumerate(children[node]):
                paths[child] = [*paths[node], (node - 256, bit)]
        self.length = np.array([len(paths[b]) for b in range(256)])
        self.node = np.zeros((self.length.max(), 256), np.uint64)
        self.bit = np.zeros((self.length.max(), 256), np.uint8)
        for byte in range(256):
            for k, (node, bit) in enumerate(paths[byte]):
                self.node[k, byte], self.bit[k, byte] = node, bit

    def bits(self, data: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """Bit after bit: the numbers of the bytes that have one, its value, and places and checks by order.

        ``before``: the bytes before each, the last one lowest.
        """
        contexts = [
            arrays.mix((before & (np.uint64((1 << 8 * order) - 1) if order else _word_mask(before))) + np.uint64((order + 1) << 56))
            for order in ORDERS
        ]
        masks = [np.uint64((1 << size) - 1) for size in self.sizes]
        at = np.arange(len(data))
        for k in range(len(self.node)):
            at = at[self.length[data[at]] > k]
            if not len(at):
                return
            node = self.node[k][data[at]]
            step = node * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
            yield at, self.bit[k][data[at]], [
                (((c[at] + step) & mask).astype(np.int64), ((c[at] >> np.uint64(48)) ^ node).astype(np.uint16))
                for c, mask in zip(contexts, masks)
            ]


_BLANKS, _LOW_BITS, _HIGH_BITS = (np.uint64(int(x * 6, 16)) for x in ("20", "01", "80"))


def _word_mask(before: np.ndarray) -> np.ndarray:
    """The bits of the bytes since the last blank."""
    other = before & np.uint64((1 << 48) - 1) ^ _BLANKS
    blank = (other - _LOW_BITS) & ~other & _HIGH_BITS
    lowest = blank & (~blank + np.uint64(1))
    return (lowest >> np.uint64(7)) - np.uint64(1)


def split(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: their words and end signs, a blank after each, as bytes, the length of each with its blank, the first of each text."""
    texts = [b" ".join([*raw[a:b].split(), END]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.flatnonzero(data == 32) + 1
    starts = np.append(0, ends)[:-1]
    return data, ends - starts, np.append(0, np.flatnonzero(data[starts] == END[0]) + 1)


def _distinct(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word among the distinct ones, and these."""
    bounds = np.append(0, np.cumsum(lengths))
    encoded = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    return encoded.indices.to_numpy(), [w[:-1] for w in encoded.dictionary.to_pylist()]


def grams_of(data: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of texts that were split, with what is before it in its text, and the number of such bytes of each word.

    A gram is, from the lowest byte, the byte, the six before it, the last one first, and a hash of the bytes that its word has
    before these. There is none for the blank after an end sign.
    """
    lengths = lengths.copy()
    kept = np.ones(len(data), bool)
    kept[np.cumsum(lengths)[first[1:] - 1] - 1] = False
    lengths[first[1:] - 1] -= 1
    data = data[kept].astype(np.uint64)
    ends = np.cumsum(lengths)
    starts = ends - lengths

    def behind(x: np.ndarray, k: int) -> np.ndarray:
        return np.concatenate([np.zeros(min(k, len(x)), np.uint64), x[: max(0, len(x) - k)]])

    one = behind(data, 1)
    two = one | behind(one, 1) << np.uint64(8)
    before = two | behind(two, 2) << np.uint64(16) | behind(two, 4) << np.uint64(32)
    text, stop = starts[first[:-1]], ends[first[1:] - 1]
    for k in range(6):
        at = (text + k)[text + k < stop]
        before[at] &= np.uint64((1 << 8 * k) - 1)
    long = np.flatnonzero(lengths > 7)
    if len(long):
        many = lengths[long] - 7
        word = np.repeat(starts[long], many)
        at = word + 7 + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
        up, down = arrays._Powers.of(len(data) + 1)
        total = np.append(np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * up[: len(data)]))
        value = arrays.mix((total[at - 6] - total[word]) * down[word]) >> np.uint64(56)
        before[at] |= np.maximum(value, np.uint64(1)) << np.uint64(48)
    return before << np.uint64(8) | data, lengths


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes, those of one place side by side."""
    return pa.compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes(), "zstd", asbytes=True)


def _numbers(data: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(data, size * width, "zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, size).T).view(kind).ravel()


def _steps_of(rising: np.ndarray) -> np.ndarray:
    """The first of rising numbers and the differences to the next; their running sums are the numbers."""
    return np.append(rising[:1], np.diff(rising))


def _packed_rows(names: tuple[str, ...], at: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each of the values of ``at``: it, the number of its rows, and their columns as bytes."""
    order = np.argsort(at, kind="stable")
    own, first = np.unique(at[order], return_index=True)
    bounds = [*first.tolist(), len(at)]
    packed = [[_squeezed(c[order[a:b]]) for a, b in zip(bounds, bounds[1:])] for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(own.astype(np.int64)), pa.array(np.diff(bounds), pa.int64()), *(pa.array(c, pa.binary()) for c in packed)], [*names]
    )


def _unpacked(rows: pa.RecordBatch | pa.Table, **kinds: type) -> Iterator[tuple[np.ndarray, ...]]:
    """Row by row, the columns that were packed."""
    columns = [rows.column(c) for c in kinds]
    for i, size in enumerate(rows.column("size").to_pylist()):
        yield tuple(_numbers(c[i].as_py(), size, kind) for c, kind in zip(columns, kinds.values()))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The bytes of grams, what is before them, and their numbers, from one to two times ``BATCH`` at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        gram, n = (np.concatenate(x) for x in zip(*held))
        for own, times in zip(*(np.array_split(x, max(1, len(gram) // BATCH)) for x in (gram, n))):
            yield (own & np.uint64(255)).astype(np.uint8), own >> np.uint64(8), times

    for batch in batches:
        for row in _unpacked(batch, gram=np.uint64, n=np.int64):
            held.append(row)
            if sum(len(gram) for gram, _ in held) >= BATCH:
                yield from parts()
                held = []
    if held:
        yield from parts()


class Tables:
    """The code of bytes, counts by place and check value, weights by gate, and the refinement."""

    def __init__(self, code: Code, packed: np.ndarray, weights: np.ndarray, refined: np.ndarray | None) -> None:
        #: by order and place: check value (16 bits), zeros and ones (8 bits each)
        self.code, self.packed, self.weights, self.refined = code, packed, weights, refined

    def inputs(self, bit: np.ndarray, places, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of the predictions, as [bit, order], and the gates. ``own``: without the bit's own occurrence."""
        odds = np.empty((len(bit), len(ORDERS)), np.float32)
        known = np.zeros(len(bit), np.int64)
        for k, (place, check) in enumerate(places):
            found = self.packed[k][place]
            pair = np.where((found >> np.uint32(16)) == check, found & np.uint32(0xFFFF), np.uint32(0)).astype(np.int64)
            odds[:, k] = _ODDS[1 + bit, pair] if own else _ODDS[0][pair]
            if ORDERS[k] >= 3:
                seen = _SEEN[pair] - own
                known += seen >= 1
                if ORDERS[k] == 4:
                    # 0, 1, 2-3, 4-15, 16 and more
                    level = np.digitize(seen, [0.5, 1.5, 3.5, 15.5])
        return odds, np.minimum(known, 3) + 4 * level

    def mixed(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", odds, self.weights[gate], dtype=np.float32).clip(-LIMIT, LIMIT)

    def probability(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Of a 1, refined: the mean of the mixed prediction and what became of such predictions."""
        mixed = self.mixed(odds, gate)
        plain = 1 / (1 + np.exp(-mixed.astype(np.float64)))
        if self.refined is not None:
            low, part = _steps(mixed)
            table = self.refined.ravel()
            at = gate * STEPS + low
            plain = (plain + (1 - part) * table[at] + part * table[at + 1]) / 2
        return plain.clip(1e-6, 1 - 1e-6)

    def coded(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's byte after what is before it."""
        out = np.zeros(len(grams))
        for first in range(0, len(grams), BATCH):
            part = grams[first: first + BATCH]
            total = out[first: first + BATCH]
            for at, value, places in self.code.bits((part & np.uint64(255)).astype(np.uint8), part >> np.uint64(8)):
                p = self.probability(*self.inputs(value, places, own=False))
                total[at] += np.log10(np.where(value, p, 1 - p))
        return out


def _steps(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step below a value, and how far it is to the next."""
    scaled = (mixed.astype(np.float64) + LIMIT) * ((STEPS - 1) / (2 * LIMIT))
    low = np.minimum(scaled.astype(np.int64), STEPS - 2)
    return low, scaled - low


def token_counts(docs: DataFrame) -> DataFrame:
    """word, c: every token of ``docs`` with its number in the documents that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "c"])
            seen.clear()
            return out

        for part in arrays.slices(batches, "text"):
            data, offsets = arrays.text_bytes(part.column("text"))
            joined, lengths, first = split(data.tobytes().translate(_LOWER), offsets)
            number, words = _distinct(joined, lengths)
            learnt = np.repeat(~part.column("held_out").to_numpy(zero_copy_only=False), np.diff(first))
            for word, c in zip(words, np.bincount(number, learnt, len(words)).astype(np.int64).tolist()):
                seen[word] = seen.get(word, 0) + c
            if len(seen) > COUNTED:
                yield handed()
        yield handed()

    return docs.select("text", "held_out").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


_GRAMS = "bucket long, size long, gram binary, n binary"


def _grams(docs: DataFrame) -> DataFrame:
    """Every byte of the documents that are not held out with what is before it (gram), and how often it occurs (n).

    A row packs all distinct grams that share a hash of the last three bytes before, their bucket.
    """
    names = ("bucket", "size", "gram", "n")

    def rows(gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        near = arrays.mix(gram >> np.uint64(8) & np.uint64((1 << 24) - 1))
        return _packed_rows(names, (near >> np.uint64(64 - BUCKETS)).astype(np.uint16), gram, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in arrays.slices(batches, "text", TEXT_BYTES):
            data, offsets = arrays.text_bytes(part.column("text"))
            held.append(np.unique(grams_of(*split(data.tobytes().translate(_LOWER), offsets))[0], return_counts=True))
            if sum(len(gram) for gram, _ in held[1:]) > COUNTED_GRAMS // 4:
                held = [_summed(*(np.concatenate(x) for x in zip(*held)))]
                if len(held[0][0]) > COUNTED_GRAMS:
                    yield rows(*held[0])
                    held = []
        if held:
            yield rows(*_summed(*(np.concatenate(x) for x in zip(*held))))

    def merged(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([rows(*_summed(*(np.concatenate(x) for x in zip(*_unpacked(table, gram=np.uint64, n=np.int64)))))])

    counted = docs.where("not held_out").select("text").mapInArrow(run, _GRAMS)
    return counted.groupBy("bucket").applyInArrow(merged, _GRAMS)


def _code(grams: DataFrame) -> Code:
    """A code for all bytes, and by order a number of places for about all contexts of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, distinct = np.zeros(256), np.zeros(len(ORDERS), np.int64)
        for batch in batches:
            for gram, n in _unpacked(batch, gram=np.uint64, n=np.int64):
                data, before = gram & np.uint64(255), gram >> np.uint64(8)
                counts += np.bincount(data.astype(np.int64), n, 256)
                for k, order in enumerate(ORDERS):
                    mask = np.uint64((1 << 8 * order) - 1) if order else _word_mask(before)
                    distinct[k] += len(np.unique((before & mask) << np.uint64(8) | data))
        yield pa.RecordBatch.from_arrays([pa.array([counts.tolist()]), pa.array([distinct.tolist()])], ["counts", "distinct"])

    # two short lists of each task
    found = grams.mapInArrow(run, "counts array<double>, distinct array<long>").collect()
    counts = np.sum([r.counts for r in found], axis=0) if found else np.zeros(256)
    distinct = np.sum([r.distinct for r in found], axis=0) if found else np.zeros(len(ORDERS), int)
    # a byte after its context has up to some four bits that others of the context do not share; for one byte there are 256 contexts
    most = [16 if order == 1 else BITS for order in ORDERS]
    return Code(counts, tuple(min(m, max(10, int(4 * d).bit_length())) for m, d in zip(most, distinct)))


def _tables(grams: DataFrame, code: Code) -> list[list[tuple[int, bytes, bytes]]]:
    """Counts for all contexts: the one that was met most often keeps a place. By order, stretches of its table: how many places are taken, and steps between these and values as bytes."""
    kinds = {"key": np.uint64, "zeros": np.int64, "ones": np.int64}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, before, n in _batches(batches):
            keys, zeros, ones = [], [], []
            for at, value, places in code.bits(data, before):
                for k, (place, check) in enumerate(places):
                    keys.append((np.uint64(k) << np.uint64(40)) | (place.astype(np.uint64) << np.uint64(16)) | check)
                    ones.append(n[at] * value)
                    zeros.append(n[at] - ones[-1])
            if keys:
                columns = _summed(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))
                part = columns[0] >> np.uint64(16 + SEGMENT)
                first = np.append(True, part[1:] != part[:-1])
                steps = np.where(first, columns[0], _steps_of(columns[0]))
                yield _packed_rows(("part", "size", *kinds), part, steps, *columns[1:])

    def best(table: pa.Table) -> pa.Table:
        rows = ((np.cumsum(steps), *counts) for steps, *counts in _unpacked(table, **kinds))
        key, zeros, ones = _summed(*(np.concatenate(x) for x in zip(*rows)))
        place = (key >> np.uint64(16)).astype(np.int64)
        # of equals, the one with the greatest key
        order = np.lexsort((zeros + ones, place))
        order = order[np.append(place[order][1:] != place[order][:-1], True)]
        values = (
            ((key[order] & np.uint64(0xFFFF)) << np.uint64(16)).astype(np.uint32)
            | _quantised(zeros[order]).astype(np.uint32) << np.uint32(8) | _quantised(ones[order])
        )
        steps = _steps_of((place[order] & ((1 << 24) - 1)).astype(np.uint32))
        return pa.table({"k": [int(place[0] >> 24)], "size": [len(order)], "steps": [_squeezed(steps)], "vals": [_squeezed(values)]})

    counted = grams.mapInArrow(count, "part long, size long, key binary, zeros binary, ones binary")
    # at most 2 ** BITS places for an order, four bytes each
    tables: list[list[tuple[int, bytes, bytes]]] = [[] for _ in ORDERS]
    for row in counted.groupBy("part").applyInArrow(best, "k long, size long, steps binary, vals binary").toLocalIterator():
        tables[row.k].append((row.size, bytes(row.steps), bytes(row.vals)))
    return tables


class _Shared:
    """A code and its tables, sent to the tasks as compressed bytes; a Python worker unpacks them once."""

    held: tuple[str, list[np.ndarray]] | None = None
    #: of the model that was used last: its name, grams that were met, and their log10 probabilities
    kept: tuple[str, np.ndarray, np.ndarray] | None = None

    def __init__(self, spark: SparkSession, code: Code, parts: list[list[tuple[int, bytes, bytes]]]) -> None:
        self.code, self.name, self.parts = code, uuid.uuid4().hex, spark.sparkContext.broadcast(parts)

    def tables(self, weights: np.ndarray, refined: np.ndarray | None = None) -> Tables:
        if _Shared.held is None or _Shared.held[0] != self.name:
            _Shared.held = _Shared.kept = None
            packed = [np.zeros(1 << size, np.uint32) for size in self.code.sizes]
            for table, parts in zip(packed, self.parts.value):
                for size, steps, values in parts:
                    table[np.cumsum(_numbers(steps, size, np.uint32))] = _numbers(values, size, np.uint32)
            # the bytes are not needed again; they would be read anew from the worker's file
            vars(self.parts).pop("_value", None)
            _Shared.held = self.name, packed
        return Tables(self.code, _Shared.held[1], weights, refined)

    def coded(self, grams: np.ndarray, weights: np.ndarray, refined: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram; a worker keeps those that it met first, each in one of two places."""
        tables = self.tables(weights, refined)
        if _Shared.kept is None or _Shared.kept[0] != self.name:
            _Shared.kept = self.name, np.zeros(1 << KEPT, np.uint64), np.zeros(1 << KEPT, np.float32)
        _, keys, values = _Shared.kept
        out, new = np.empty(len(grams)), np.arange(len(grams))
        for factor in _FACTORS:
            gram = grams[new]
            place = (gram * factor >> np.uint64(64 - KEPT)).astype(np.int64)
            # a free place has the key 0, a gram of 0 is coded each time
            met = (keys[place] == gram) & (gram != 0)
            out[new[met]] = values[place[met]]
            new = new[~met]
        if len(new):
            gram, back = np.unique(grams[new], return_inverse=True)
            coded = tables.coded(gram).astype(np.float32)
            out[new] = coded[back]
            for factor in _FACTORS:
                place = (gram * factor >> np.uint64(64 - KEPT)).astype(np.int64)
                free = np.flatnonzero(keys[place] == 0)
                # one gram for each free place
                at, one = np.unique(place[free], return_index=True)
                keys[at], values[at] = gram[free[one]], coded[free[one]]
                rest = np.ones(len(gram), bool)
                rest[free[one]] = False
                gram, coded = gram[rest], coded[rest]
        return out


def _weights(grams: DataFrame, shared: _Shared) -> np.ndarray:
    """Weights by gate, learnt online in every task and averaged by what they were learnt from."""
    first = np.full((GATES, len(ORDERS)), 0.3, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.tables(first.copy())
        curve = np.zeros((GATES, len(ORDERS), len(ORDERS)))
        mass = np.zeros(GATES)
        for data, before, n in _batches(batches):
            for at, value, places in tables.code.bits(data, before):
                odds, gate = tables.inputs(value, places, own=True)
                p = 1 / (1 + np.exp(-tables.mixed(odds, gate)))
                times = n[at].astype(np.float64)
                slope, bend = times * (value - p), times * (p * (1 - p))
                order = np.argsort(gate.astype(np.uint8), kind="stable")
                bounds = np.searchsorted(gate[order], np.arange(GATES + 1))
                for g in np.flatnonzero(np.diff(bounds)):
                    rows = order[bounds[g]: bounds[g + 1]]
                    x = odds[rows]
                    mass[g] += times[rows].sum()
                    curve[g] += (x.T * bend[rows]) @ x
                    # a step against all that was seen so far
                    ridge = np.eye(len(ORDERS)) * (1e-3 * np.trace(curve[g]) / len(ORDERS) + 1e-6)
                    step = np.linalg.solve(curve[g] + ridge, (x.T @ slope[rows]).astype(np.float64))
                    tables.weights[g] += step.clip(-0.2, 0.2).astype(np.float32)
        g = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays(
            [pa.array(g), pa.array(mass[g]), pa.array((tables.weights[g] * mass[g, None]).tolist(), pa.list_(pa.float64()))],
            ["gate", "mass", "w"],
        )

    out = first.copy()
    sums = [F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(len(ORDERS))]
    learnt = grams.mapInArrow(run, "gate long, mass double, w array<double>")
    for row in learnt.groupBy("gate").agg(F.sum("mass").alias("mass"), *sums).collect():
        out[row.gate] = [row[f"w{k}"] / row.mass for k in range(len(ORDERS))]
    return out


def _refinement(grams: DataFrame, shared: _Shared, weights: np.ndarray) -> np.ndarray:
    """By gate and step of log odds, the share of bits that were 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.tables(weights)
        total = np.zeros((2, GATES * STEPS))
        for data, before, n in _batches(batches):
            for place, value, places in tables.code.bits(data, before):
                odds, gate = tables.inputs(value, places, own=True)
                times = n[place]
                low, part = _steps(tables.mixed(odds, gate))
                at = gate * STEPS + low
                for shift, share in ((0, 1 - part), (1, part)):
                    total[0] += np.bincount(at + shift, times * share, total.shape[1])
                    total[1] += np.bincount(at + shift, times * share * value, total.shape[1])
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], ["at", "n", "ones"])

    # before anything is seen, a step's own log odds, which count as much as two bits
    own = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, STEPS)))
    n, ones = np.full(GATES * STEPS, 2.0), np.tile(own, GATES) * 2
    found = grams.mapInArrow(run, "at long, n double, ones double")
    for row in found.groupBy("at").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect():
        n[row.at] += row.n
        ones[row.at] += row.ones
    return (ones / n).reshape(GATES, STEPS)


class Model:
    """The tables, sent to the tasks, with weights and refinement: probabilities of bytes."""

    def __init__(self, shared: _Shared, weights: np.ndarray, refined: np.ndarray) -> None:
        self.shared, self.weights, self.refined = shared, weights, refined

    def coded(self, grams: np.ndarray) -> np.ndarray:
        return self.shared.coded(grams, self.weights, self.refined)


def fit(docs: DataFrame) -> Model:
    """``docs``: text, held_out."""
    kept = native.Tables(docs.sparkSession, "grams")
    path, grams = kept.put(_grams(docs))
    code = _code(grams)
    shared = _Shared(docs.sparkSession, code, _tables(grams, code))
    weights = _weights(grams, shared)
    refined = _refinement(grams, shared, weights)
    kept.drop(path)
    return Model(shared, weights, refined)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the piece that each word is in, the first word and the first piece of each text, hashes of the pieces.

    The end sign is in the last piece and not a word here; a text without words is one piece.
    """
    starts, ends, first = arrays.word_bounds(data, offsets)
    words = arrays.span_hashes(data, starts, ends)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cut = np.zeros(len(words), bool)
    pair = arrays.mix(words[:-1] + arrays.mix(words[1:]))
    # the last word of a text goes with its end sign
    cut[1:] = (pair % np.uint64(PIECE) == 0) & (text[1:] == text[:-1])
    cut[first[1:][np.diff(first) > 0] - 1] = False
    per_text = arrays.per_text(cut, first) + 1
    first_piece = np.append(0, np.cumsum(per_text))
    before = np.append(0, np.cumsum(cut))
    piece = before[:-1] - before[first[:-1]][text] + first_piece[text]
    begin = np.searchsorted(piece, np.arange(first_piece[-1]))
    up, down = arrays._Powers.of(len(words) + 1)
    total = np.append(np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)]))
    end = np.append(begin[1:], len(words))
    value = (total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)
    value[first_piece[1:] - 1] ^= np.uint64(0x5851F42D4C957F2D)  # with the end sign
    return piece, first, first_piece, arrays.mix(value)


class _Numbers(dict):
    """Numbers of words; 0 for others."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _texts(rows: DataFrame, model: Model, shared) -> DataFrame:
    """Counts, base score and pieces of each text, with the words that are not among the frequent ones.

    row, doc_id, held_out, n_bytes, n_tokens, n_known, base, hashes, coded (by piece), rare
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, base = shared.value
        number = _Numbers(zip(frequent, range(1, len(frequent) + 1))).__getitem__
        for part in arrays.slices(batches, "text", TEXT_BYTES):
            data, offsets = arrays.text_bytes(part.column("text"))
            raw = data.tobytes().translate(_LOWER)
            piece, first, first_piece, hashes = pieces(np.frombuffer(raw, np.uint8), offsets)
            # the end signs, each in the last piece of its text
            piece = np.insert(piece, first[1:], first_piece[1:] - 1)
            joined, lengths, first = split(raw, offsets)
            grams, in_word = grams_of(joined, lengths, first)
            coded = np.bincount(np.repeat(piece, in_word), model.coded(grams), first_piece[-1])
            at, words = _distinct(joined, lengths)
            own = np.fromiter(map(number, words), np.int64, len(words))[at]
            text = np.repeat(np.arange(len(part)), np.diff(first))
            open_words = np.flatnonzero(own == 0)
            held = pa.array(np.searchsorted(open_words, first).astype(np.int32))
            bounds = pa.array(first_piece.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(offsets)), pa.array(np.diff(first)),
                 pa.array(arrays.per_text(own > 0, first)), pa.array(np.bincount(text, base[own], len(part))),
                 pa.ListArray.from_arrays(bounds, pa.array(hashes.view(np.int64))),
                 pa.ListArray.from_arrays(bounds, pa.array(coded)),
                 pa.ListArray.from_arrays(held, pa.array(words, pa.binary()).take(pa.array(at[open_words])))],
                ["row", "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base", "hashes", "coded", "rare"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_bytes long, n_tokens long, n_known long, base double, "
        "hashes array<long>, coded array<double>, rare array<binary>"
    )


def _known(counts: np.ndarray) -> np.ndarray:
    """Whether each piece of a text is a known one, and the gate: the same of the two before it."""
    flag = counts > 0
    one = np.append(False, flag[:-1])
    two = np.append(False, one[:-1])
    return flag, 2 * one + two


def _rates(seen: DataFrame) -> np.ndarray:
    """By gate, the share of known pieces; each training text without itself. ``seen``: held_out, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, 2))
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                flag, gate = _known(np.array(counts) - 1)
                np.add.at(total, (gate, flag.astype(int)), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(total[:, 0]), pa.array(total[:, 1])], ["gate", "unknown", "known"])

    found = seen.where("not held_out").select("counts").mapInArrow(run, "gate long, unknown double, known double")
    out = np.full(4, 0.5)
    for row in found.groupBy("gate").agg(F.sum("unknown").alias("unknown"), F.sum("known").alias("known")).collect():
        out[row.gate] = (row.known + 0.5) / (row.known + row.unknown + 1)
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("held_out", held_out(F.col("doc_id")))
    words = staged(token_counts(rows))
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    words = words.withColumn("base", F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1))))
    frequent = words.where("c > 0").orderBy(F.desc("c"), "word").limit(FREQUENT).select("word", "base").toArrow()
    # other words have the number 0, and nothing yet
    shared = docs.sparkSession.sparkContext.broadcast((frequent["word"].to_pylist(), np.append(0.0, frequent["base"].to_numpy())))
    texts = staged(_texts(rows, fit(rows), shared))

    open_words = texts.select("row", F.explode("rare").alias("word"))
    more = open_words.join(words, "word").groupBy("row").agg(
        F.count(F.when(F.col("c") > 0, 1)).alias("more_known"), F.sum("base").alias("more_base")
    )
    learnt = staged(texts.where("not held_out").select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("c")))
    m = learnt.agg(
        F.sum("c").alias("m"), F.count("*").alias("v"), *(F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2))
    ).first()
    in_order = texts.select("row", F.posexplode("hashes").alias("at", "hash")).join(learnt, "hash", "left").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("c", F.lit(0)).alias("c")))).alias("counts")
    )
    seen = staged(in_order.join(texts.select("row", "held_out"), "row").select("row", "held_out", F.col("counts.c").alias("counts")))
    rates = _rates(seen)
    discount = min(0.95, max(0.05, m.n1 / (m.n1 + 2 * m.n2))) if m.n1 else 0.05
    left = max(1.0, (m.m or 0) - discount * m.v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = []
            for out, counts, coded in zip(
                batch.column("held_out").to_pylist(), batch.column("counts").to_pylist(), batch.column("coded").to_pylist()
            ):
                # a text that was learnt does not vouch for its own pieces
                c = np.array(counts, float) - (not out)
                _, gate = _known(c)
                rate = rates[gate]
                whole = np.log10(np.maximum(c - discount, 0) * rate / left, out=np.full(len(c), -np.inf), where=c > discount)
                spelt = np.array(coded) + np.log10(1 - rate)
                high, low = np.maximum(whole, spelt), np.minimum(whole, spelt)
                total.append(float((high + np.log10(1 + 10.0 ** np.maximum(low - high, -300))).sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score")), pa.array(total, pa.float64())],
                ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score"],
            )

    full = texts.select("row", "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base", "coded").join(more, "row", "left").join(
        seen.select("row", "counts"), "row"
    ).select(
        "doc_id", "held_out", "n_bytes", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "coded", "counts",
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = full.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
        (F.col("score") * F.lit(float(-np.log2(10.0))) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
