"""Suffix arrays by two-stage sorting, on numpy arrays.

Only suffixes that are smaller than the one after them are sorted by comparing their bytes. All others
follow from one scan over the buckets of first bytes: a suffix that is larger than its successor has its
place right after the suffixes whose successors come earlier. Suffixes are ordered by their first ``depth``
bytes; the order of those that agree in all of them is open.
"""

from __future__ import annotations

import numpy as np


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; past the end are zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data) + 1, np.uint64)
    for k in range(8):
        out |= padded[k: len(data) + 1 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def smaller(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it."""
    n = len(data)
    if not n:
        return np.zeros(0, bool)
    # within a run of equal bytes, the byte after the run decides; the last suffix is larger than the empty one
    change = np.flatnonzero(data[1:] != data[:-1])
    ends = np.append(change, n - 1)
    up = np.append(data[change] < data[change + 1], False)
    return np.repeat(up, np.diff(np.append(-1, ends)))


def direct(places: np.ndarray, eights: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the suffixes there."""
    last = len(eights) - 1
    key = eights[places]
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    tied = np.zeros(len(places) + 1, bool)
    tied[1:-1] = key[1:] == key[:-1]
    at = np.flatnonzero(tied[:-1] | tied[1:])
    group = np.cumsum(~tied[at])
    for done in range(8, depth, 8):
        if not len(at):
            break
        own = places[at]
        key = eights[np.minimum(own + done, last)]
        order = np.lexsort((key, group))
        own, key, group = own[order], key[order], group[order]
        places[at] = own
        tied = np.zeros(len(at) + 1, bool)
        tied[1:-1] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        stay = tied[:-1] | tied[1:]
        at, group = at[stay], np.cumsum(~tied[:-1])[stay]
    return places


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """The places of all suffixes in order."""
    n = len(data)
    small = smaller(data)
    head = direct(np.flatnonzero(small), eight_bytes(data), depth)
    first = data[head]
    bounds = np.searchsorted(first, np.arange(257))
    # larger suffixes, by first byte, in the order in which the scan finds them
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        larger[data[n - 1]].append(np.array([n - 1]))  # its successor is the empty suffix
    out = []
    for byte in range(256):
        found = larger[byte]
        # in one bucket a run of the byte leads from place to place
        for piece in found:
            before = piece[piece > 0] - 1
            again = before[data[before] == byte]
            if len(again):
                found.append(again)
        bucket = np.concatenate([*found, head[bounds[byte]: bounds[byte + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (data[before] > byte)]
        if len(before):
            byte_of = data[before]
            order = np.argsort(byte_of, kind="stable")
            before, byte_of = before[order], byte_of[order]
            cuts = np.flatnonzero(byte_of[1:] != byte_of[:-1]) + 1
            for piece in np.split(before, cuts):
                larger[data[piece[0]]].append(piece)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(order: np.ndarray, eights: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that neighbours in ``order`` have in common, ``depth`` at most, zero for the first.

    Both suffixes must hold ``depth`` bytes.
    """
    out = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for done in range(0, depth, 8):
        gap = eights[order[at] + done] ^ eights[order[at - 1] + done]
        differ = gap != 0
        if differ.any():
            bits = np.log2(gap[differ].astype(np.float64))  # the highest bit that differs
            zeros = 63 - np.floor(bits).astype(np.int64)
            # rounding up to a power of two may lose one bit, never a byte boundary below it
            over = gap[differ] >> (63 - zeros).astype(np.uint64) == 0
            out[at[differ]] = np.minimum(done + (zeros + over) // 8, depth)
            at = at[~differ]
    out[at] = depth
    return out
