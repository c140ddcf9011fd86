"""Texts of an Arrow batch as numpy arrays: words, lines, their hashes and windows of them.

Everything works on the UTF-8 bytes of many texts at once. Batches are cut into slices of a few
megabytes of text (or one text, if that is longer), which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 1 << 64)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with up to ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < len(sizes):
            before = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()  # the worker may be idle for long


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _BACK)):
                steps = np.full(max(n, SLICE_BYTES), base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes: differences of one running polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * _STEP)


_PRIME = (1 << 61) - 1
_P = np.uint64(_PRIME)
_LIMBS = (np.uint64(0), np.uint64(21), np.uint64(42))


def _fold(x: np.ndarray) -> np.ndarray:
    """64-bit numbers modulo 2^61 - 1."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _shifted(x: np.ndarray, bits: np.uint64) -> np.ndarray:
    """x * 2^bits modulo 2^61 - 1, for x below it."""
    return ((x << bits) & _P) | (x >> (np.uint64(61) - bits)) if bits else x


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, for factors below it."""
    half, low = np.uint64(32), np.uint64((1 << 32) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = _shifted(_fold(a1 * b0 + a0 * b1), half)
    return _fold(_shifted(_fold(a1 * b1), np.uint64(3)) + middle + _fold(a0 * b0))


class _PrimePowers:
    """Powers of the base modulo 2^61 - 1, in parts of 21 bits."""

    limbs: tuple[np.ndarray, ...] = (np.zeros(0, np.uint32),)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, ...]:
        if len(cls.limbs[0]) < n:
            size, up = max(n, SLICE_BYTES + 1), np.ones(1, np.uint64)
            while len(up) < size:
                up = np.concatenate([up, _product(up[: size - len(up)], np.uint64(pow(_BASE, len(up), _PRIME)))])
            cls.limbs = tuple(((up >> at) & np.uint64((1 << 21) - 1)).astype(np.uint32) for at in _LIMBS)
        return cls.limbs


def span_identities(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes that tell stretches of one ``data`` apart: a polynomial modulo a prime, mixed with the length.

    Unlike modulo 2^64, no regular pair of texts cancels out whatever the base. Hashes of different ``data`` do not compare.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    limbs, total = _PrimePowers.of(len(data) + 1), np.zeros(len(data) + 1, np.uint64)
    value, rest = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for limb, at in zip(limbs, _LIMBS):
        np.cumsum((data + np.uint32(1)) * limb[: len(data)], dtype=np.uint64, out=total[1:])
        value = _fold(value + _shifted(_fold(total[ends] - total[starts]), at))
        rest |= limb[len(data) - starts].astype(np.uint64) << at
    value = _product(value, rest)
    return mix(value ^ mix((ends - starts).astype(np.uint64)))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text."""
    return word_bounds_of(data, offsets, ~IS_SPACE[data])


def word_bounds_of(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for words made of the bytes that ``solid`` marks."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive words of a text, and the number of each one's first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[width - 1:])
    value = words[at]
    for k in range(1, width):
        value = (value ^ (value >> np.uint64(29))) * _STEP + words[at + k]
    return mix(value), at


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
