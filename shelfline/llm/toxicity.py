"""Toxicity with noisy-channel deobfuscation: character lattices, Viterbi, and the score of what was meant.

*Language model.* Four-grams of 28 symbols (a boundary, the letters a-z, any other letter), counted over
all texts and interpolated with the shorter ones.

*Classifier.* Whole words and beginnings of words are ranked by how much more often they occur in toxic
documents. Copies count once: of toxic documents, those where a word stands between the same neighbours; of
others, near copies share the weight of one row. The best are chosen, as long as so many toxic documents could
not come about by chance among so many words, and of beginnings of each other the best. A chosen one makes a
document toxic with the share of these counts that is toxic, whatever the others do (noisy or). Labels come from
``FIT_ROWS`` rows at most, the first by a hash of their ids.

*Restoring.* A sign can stand for the letters that leetspeak writes with it, a run of equal letters
for one or two, and blanks or signs between letters for nothing. What could be a chosen word is found over
the texts' skeletons, in which all readings of a character look alike: by an automaton over those that keep
the signs that may be a letter or nothing, by the same over those without them, and where several such signs
stand close together by steps through the words in which each sign is either. Around such a place the lattice of readings is decoded with
Viterbi under the language model, and the words of the best reading count.

Defined cases: NULL and empty texts have no words and get the score of a text without chosen words; labels
that are NULL are left out, of several for a document the highest counts; without toxic labels the score is
the share of toxic rows; an empty table gives an empty result. Of ``docs`` only id and text are read, and
the id for nothing but the split and the result.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import arrays

#: Labelled rows that the classifier is fitted on, at most.
FIT_ROWS = 100_000
#: Words and beginnings that are looked at more closely, and that are chosen, at most.
CANDIDATES = 2048
CHOSEN = 512
#: Toxic rows that a chosen one must be in at least, for each row that is not toxic too.
PURE = 4
LEAST_ROWS = 3
#: Lengths of beginnings.
BEGINNINGS = range(4, 8)
#: Near copies agree in one of so many groups of so many least hashes of three words in a row.
BANDS, IN_BAND = 8, 4
#: The weight of a row that has no copies; copies share it.
UNIT = 1 << 20
THRESHOLD = 0.7
#: Restored stretches that a Python worker remembers.
REMEMBERED = 100_000

SYMBOLS = 28
ORDER = 4
BOUNDARY, OTHER = 0, 27
# Letters that leetspeak writes with a sign.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "#": "h",
}
#: Signs between letters that may stand for nothing; a star may be any letter, too.
SEPARATORS = ".-_*~'`^,:;/\\"
#: Signs that may be a letter or nothing.
EITHER = "!|(+#*"
# costs, as negative natural logarithms
READ_LEET, READ_SIGN, DROP_SIGN, DROP_REPEAT, DROP_DOUBLE, DROP_GAP, DROP_SPACE, ANY_LETTER = 1.0, 2.0, 1.0, 0.5, 4.0, 0.7, 6.0, 3.5
#: Share of the chosen words in the language model that readings are compared under.
CHOSEN_SHARE = 0.2

_WORD = re.compile(r"[^\W\d_]{3,24}")

_SYMBOL = np.full(256, BOUNDARY, np.int64)
_SYMBOL[128:] = OTHER
for _k in range(26):
    _SYMBOL[[65 + _k, 97 + _k]] = 1 + _k


def symbol(c: str) -> int:
    return int(_SYMBOL[ord(c)]) if ord(c) < 128 else OTHER


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


# language model


def gram_counts(docs: DataFrame) -> np.ndarray:
    """How often each four-gram of symbols occurs; at most ``SYMBOLS ** ORDER`` rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        for part in arrays.slices(batches, "text"):
            data, offsets = arrays.text_bytes(part.column("text"))
            # a letter beyond ASCII is several bytes: its first one counts
            lead = (data & 0xC0) != 0x80
            ends = np.zeros(len(data) + 1, bool)
            ends[offsets] = True
            at = np.flatnonzero(lead)
            symbols = np.insert(_SYMBOL[data[at]], np.searchsorted(at, np.flatnonzero(ends)), BOUNDARY)
            # boundaries count as one, however many signs stand together
            symbols = symbols[np.append(True, (symbols[1:] != BOUNDARY) | (symbols[:-1] != BOUNDARY))]
            symbols = np.concatenate([[BOUNDARY] * (ORDER - 1), symbols])
            code = np.zeros(max(0, len(symbols) - ORDER + 1), np.int64)
            for k in range(ORDER):
                code = code * SYMBOLS + symbols[k: len(symbols) - ORDER + 1 + k]
            total += np.bincount(code, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    counted = docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    table, rows = np.zeros(SYMBOLS**ORDER, np.float64), counted.toArrow()
    table[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return table


def language_model(counts: np.ndarray, strength: float = 5.0) -> np.ndarray:
    """Logarithms of the probability of a symbol after three others, as [s1, s2, s3, s4]."""
    grams = counts.reshape((SYMBOLS,) * ORDER)
    lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        n = grams.sum(axis=tuple(range(ORDER - order)))
        lower = (n + strength * lower) / (n.sum(axis=-1, keepdims=True) + strength)
    return np.log(lower).astype(np.float32)


def with_words(model: np.ndarray, words: Iterable[str]) -> np.ndarray:
    """The language model, mixed with one of the given words and beginnings (an end mark is a boundary)."""
    counts = np.zeros((SYMBOLS,) * ORDER)
    for w in words:
        symbols = [BOUNDARY] * (ORDER - 1) + [BOUNDARY if c == "$" else symbol(c) for c in w]
        for k in range(len(symbols) - ORDER + 1):
            counts[tuple(symbols[k: k + ORDER])] += 1
    total = counts.sum(axis=-1, keepdims=True)
    share = np.where(total > 0, CHOSEN_SHARE, 0.0)
    return np.log((1 - share) * np.exp(model) + share * counts / np.maximum(total, 1)).astype(np.float32)


# restoring


def _skeleton_table() -> np.ndarray:
    """A byte's look: letters and the signs that may stand for them share one; 0 is left out."""
    table = np.zeros(256, np.uint8)
    table[128:] = np.arange(128, 256)
    for k in range(26):
        table[[65 + k, 97 + k]] = 97 + k
    # signs with two readings make their letters look alike
    for a, b in (("i", "l"), ("b", "g")):
        table[table == ord(b)] = ord(a)
    for sign, letters in LEET.items():
        table[ord(sign)] = table[ord(letters[0])]
    table[ord("*")] = ord("*")
    return table


_SKELETON = _skeleton_table()
#: The same without the signs that may stand for nothing.
_BARE = _SKELETON.copy()
_BARE[[ord(c) for c in EITHER]] = 0
_STAR = ord("*")
_EITHER = np.zeros(256, bool)
_EITHER[[ord(c) for c in EITHER]] = True
_SPACE = " \t\n\x0b\x0c\r"


def _look(c: str) -> int:
    return int(_SKELETON[c.encode("utf-8", "ignore")[0]])


def skeleton(data: np.ndarray, table: np.ndarray = _SKELETON) -> tuple[np.ndarray, np.ndarray]:
    """The looks of a text's characters without blanks and repeats, and their places."""
    look = table[data]
    at = np.flatnonzero(look)
    look = look[at]
    new = np.append(True, look[1:] != look[:-1]) if len(look) else np.zeros(0, bool)
    return look[new], at[new]


def patterns(words: list[str]) -> set[str]:
    """Looks under which a word may be found: plain, with a star for one letter, and with stars between all."""
    out = set()
    for w in words:
        for masked in [w, *(f"{w[:i]}*{w[i + 1:]}" for i in range(len(w))), "*".join(w)]:
            look, _ = skeleton(np.frombuffer(masked.encode(), np.uint8))
            out.add(look.tobytes().decode("latin-1"))
    return out


class Decoder:
    """Restores texts around the places where a chosen word may stand."""

    def __init__(self, words: list[str], model: np.ndarray) -> None:
        self.words, self.model = frozenset(words), with_words(model, words)
        words = [w.removesuffix("$") for w in words]
        self.known: dict[bytes, frozenset[str]] = {}
        self.machine = ahocorasick.Automaton()
        for p in patterns(words):
            self.machine.add_word(p, len(p))
        self.bare = ahocorasick.Automaton()
        #: Looks of the words letter by letter: the next nodes, the look that led to a node, whether a word ends there.
        self.next: list[dict[int, int]] = [{}]
        self.look, self.ends, self.longest = [0], [False], 0
        for w in words:
            look = skeleton(np.frombuffer(w.encode(), np.uint8))[0].tobytes()
            self.bare.add_word(look.decode("latin-1"), len(look))
            self.longest = max(self.longest, len(look))
            node = 0
            for c in look:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.look.append(c)
                    self.ends.append(False)
                node = self.next[node][c]
            self.ends[node] = True
        if words:
            self.machine.make_automaton()
            self.bare.make_automaton()
        #: What several stars may stand for, by their number, with the looks of the letters around it (0 at the ends).
        self.fills: dict[int, set[tuple[int, str, int]]] = {}
        for w in words:
            around = [0, *(_look(c) for c in w), 0]
            for i in range(len(w)):
                for j in range(i + 2, len(w) + 1):
                    self.fills.setdefault(j - i, set()).add((around[i], w[i:j], around[j + 1]))

    def places(self, data: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of bytes, from blank to blank, that may hold a chosen word."""
        if not self.words:
            return []
        out: list[tuple[int, int]] = []
        raw = data.tobytes()
        signs = np.flatnonzero(_EITHER[data])
        for table, machine in ((_SKELETON, self.machine), (_BARE, self.bare))[: 1 + (len(signs) > 0)]:
            look, at = skeleton(data, table)
            for end, n in machine.iter(look.tobytes().decode("latin-1")):
                last = int(at[end + 1]) if end + 1 < len(at) else len(raw)
                out.append(_widened(raw, int(at[end - n + 1]), int(at[end]), last))
        if len(signs) > 1:
            out += (_widened(raw, first, last, last + 1) for first, last in self.mixed(raw, data, signs))
        return list(dict.fromkeys(out))

    def mixed(self, raw: bytes, data: np.ndarray, signs: np.ndarray) -> Iterator[tuple[int, int]]:
        """First and last bytes of what may be a chosen word if each of several signs is a letter or nothing."""
        at = np.flatnonzero(_SKELETON[data])
        look = _SKELETON[data[at]]
        # repeats are one; stars only if they touch, because each of them may be a letter
        starts = np.flatnonzero(np.append(True, (look[1:] != look[:-1]) | (look[1:] == _STAR) & (np.diff(at) > 1)))
        runs = np.diff(np.append(starts, len(at)))
        at, look = at[starts], look[starts]
        sign = np.flatnonzero(_EITHER[data[at]])
        # a word with several signs lies around signs with less than a word's length between them
        for group in np.split(sign, np.flatnonzero(np.diff(sign) > self.longest) + 1):
            if len(group) < 2 and not (len(group) and look[group[0]] == _STAR and runs[group[0]] > 1):
                continue
            active: dict[int, int] = {}
            for k in range(max(0, int(group[0]) - self.longest), min(len(at), int(group[-1]) + self.longest + 1)):
                place, own, n = int(at[k]), int(look[k]), int(runs[k])
                if own == _STAR:
                    # next to a blank it is read as itself
                    if place == 0 or place + n == len(raw) or arrays.IS_SPACE[raw[place - 1]] or arrays.IS_SPACE[raw[place + n]]:
                        active = {}
                        continue
                    following, level = dict(active), active | {0: place}
                    for _ in range(min(n, self.longest)):
                        level = {x: first for node, first in level.items() for x in self.next[node].values()}
                        for x, first in level.items():
                            following[x] = max(first, following.get(x, -1))
                else:
                    either = _EITHER[raw[place]]
                    following = {x: first for x, first in active.items() if either or self.look[x] == own}
                    for node, first in (active | {0: place}).items():
                        x = self.next[node].get(own)
                        if x is not None:
                            following[x] = max(first, following.get(x, -1))
                active = following
                yield from {(first, place + n - 1 if own == _STAR else place) for x, first in active.items() if self.ends[x]}

    def restore(self, text: str) -> str:
        """The likeliest reading of a stretch of text."""
        text = text.strip(_SPACE).lower()
        best: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
        model = self.model
        for first, last, readings in _lattice(text, self.fills):
            following: dict[tuple[int, int, int], tuple[float, str]] = {}
            for state, (cost, said) in best.items():
                for letters, price in readings:
                    s, c, out = state, cost + price, said
                    for letter in letters:
                        sym = symbol(letter)
                        if sym == BOUNDARY and s[2] == BOUNDARY:
                            out += letter
                            continue
                        c -= float(model[s[0], s[1], s[2], sym])
                        s = (s[1], s[2], sym)
                        out += letter
                    if s not in following or c < following[s][0]:
                        following[s] = (c, out)
            best = following
        ends = [(c - float(model[s[0], s[1], s[2], BOUNDARY]) * (s[2] != BOUNDARY), out) for s, (c, out) in best.items()]
        return min(ends)[1]

    def found(self, data: np.ndarray) -> set[str]:
        """The chosen words that the restored text holds."""
        out: set[str] = set()
        for first, last in self.places(data):
            piece = data[first:last].tobytes()
            own = self.known.get(piece)
            if own is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                read = _WORD_RUN.findall(self.restore(piece.decode("utf-8", "ignore")))
                own = self.known[piece] = self.words.intersection(features(read))
            out.update(own)
        return out


_WORD_RUN = re.compile(r"[^\W\d_]+")


def _widened(raw: bytes, first: int, end: int, last: int) -> tuple[int, int]:
    """A stretch whose last letter is at ``end``, from blank to blank."""
    while first > 0 and not arrays.IS_SPACE[raw[first - 1]]:
        first -= 1
    last = max(end + 1, min(last, len(raw)))
    while last < len(raw) and not arrays.IS_SPACE[raw[last]] and not arrays.IS_SPACE[raw[last - 1]]:
        last += 1
    return first, last


def _lattice(text: str, fills: dict[int, set[tuple[int, str, int]]] | None = None) -> Iterator[tuple[int, int, list[tuple[str, float]]]]:
    """Readings of each stretch of a text, with their costs; several stars may be as many letters out of ``fills``."""
    runs = [(m.group()[0], m.start(), m.end()) for m in re.finditer(r"(.)\1*", text, re.S)]
    for k, (c, first, last) in enumerate(runs):
        n = last - first
        before = runs[k - 1][0] if k else " "
        after = runs[k + 1][0] if k + 1 < len(runs) else " "
        if c in _SPACE:
            edge = k == 0 or k + 1 == len(runs)
            # a gap between single letters is no real gap
            alone = k + 1 < len(runs) and (
                (k >= 2 and runs[k - 2][0] in _SPACE or k == 1) and runs[k - 1][2] - runs[k - 1][1] == 1
                or (k + 2 < len(runs) and runs[k + 2][0] in _SPACE or k + 2 == len(runs)) and runs[k + 1][2] - runs[k + 1][1] == 1
            )
            yield first, last, [(" ", 0.0)] if edge else [(" ", 0.0), ("", DROP_GAP if alone else DROP_SPACE)]
        elif c in LEET:
            readings = [(c, READ_SIGN if after not in _SPACE else 0.0)]
            for letter in LEET[c]:
                readings.append((letter, READ_LEET + DROP_REPEAT * (n - 1)))
                if n > 1:
                    readings.append((letter * 2, 2 * READ_LEET + DROP_REPEAT * (n - 2)))
            if c in "!|(+#":
                readings.append(("", DROP_SIGN * n))
            yield first, last, readings
        elif c in SEPARATORS:
            readings = [(c, 0.0)]
            if before not in _SPACE and after not in _SPACE:
                readings.append(("", DROP_SIGN))
                if c == "*":
                    readings += [(chr(97 + i), ANY_LETTER + DROP_REPEAT * (n - 1)) for i in range(26)]
                    # a letter next to the stars is the one that the word has there
                    left, right = (_look(x) if x.isalpha() else None for x in (before, after))
                    readings += sorted({
                        (x, ANY_LETTER) for a, x, b in (fills or {}).get(n, ()) if left in (None, a) and right in (None, b)
                    })
            yield first, last, readings
        elif n == 1:
            yield first, last, [(c, 0.0)]
        elif c.isalpha():
            yield first, last, [(c * 2, DROP_REPEAT * (n - 2)), (c, DROP_DOUBLE if n == 2 else DROP_REPEAT * (n - 1))]
        else:
            yield first, last, [(c, 0.0)]


# classifier


def _plain(text: str | None) -> dict[str, tuple[str, str]]:
    """The words of a text in plain letters, each with the neighbours of its first place."""
    words = [x.strip(".,;:!?\"'()") for x in (text or "").lower().split()]
    around = zip(words, ["", *words[:-1]], [*words[1:], ""])
    out: dict[str, tuple[str, str]] = {}
    for w, before, after in around:
        if w not in out and _WORD.fullmatch(w):
            out[w] = before, after
    return out


def features(words: Iterable[str]) -> Iterator[str]:
    """The words themselves, with an end mark, and their beginnings."""
    for w in words:
        yield f"{w}$"
        for k in BEGINNINGS:
            if k > len(w):
                break
            yield w[:k]


def labelled(docs: DataFrame, labels: DataFrame, label_id: str, label: str, rows: int) -> DataFrame:
    """doc_id, text, toxic of the rows that may be learnt from; ``rows`` labels are sent to the tasks at most."""
    own = labels.select(F.col(label_id).alias("_id"), F.col(label).alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id"))
    )
    single = own.groupBy("_id").agg(F.max("toxic").cast("int").alias("toxic"))
    few = single.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(rows)
    return docs.join(F.broadcast(few), docs["doc_id"] == F.col("_id")).drop("_id")


_FACTORS = np.random.default_rng(8).integers(1, 2**63, (2, BANDS * IN_BAND), np.uint64) | np.uint64(1)


def bands(text: str) -> list[int]:
    """Hashes that texts with mostly the same three words in a row share."""
    words = np.array([zlib.crc32(w.encode("utf-8", "ignore")) for w in text.lower().split()], np.uint64)
    if not len(words):
        return [0] * BANDS
    around = np.concatenate([[0], words, [0]]).astype(np.uint64)
    triples = np.unique((around[:-2] * _FACTORS[0, 0] + around[1:-1]) * _FACTORS[0, 1] + around[2:])
    triples ^= triples >> np.uint64(29)
    least = np.array([((triples * a + b) >> np.uint64(31)).min() for a, b in _FACTORS.T], np.uint64)
    out = np.zeros(BANDS, np.uint64)
    for k in range(IN_BAND):
        out = (out ^ least[k::IN_BAND]) * _FACTORS[1, k]
    return out.view(np.int64).tolist()


def text_key(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode("utf-8", "ignore"), digest_size=12).digest()


class Weights:
    """What a training row counts: rows of one label that are near copies of each other count as one together."""

    def __init__(self, rows: Iterable[tuple[bytes, int, list[int], int]]) -> None:
        rows = sorted(rows)
        parent = list(range(len(rows)))

        def top(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        first: dict[tuple[int, int, int], int] = {}
        for i, (_, toxic, own, _) in enumerate(rows):
            for k, h in enumerate(own):
                parent[top(i)] = top(first.setdefault((toxic, k, h), i))
        size = Counter()
        for i, (*_, n) in enumerate(rows):
            size[top(i)] += n
        tops = [top(i) for i in range(len(rows))]
        self.shared = {(rows[i][0], rows[i][1]): max(1, UNIT // size[t]) for i, t in enumerate(tops) if size[t] > 1}
        kinds = Counter(rows[t][1] for t in set(tops))
        self.good, self.bad = kinds[0], kinds[1]

    def of(self, text: str | None, toxic: int) -> int:
        return self.shared.get((text_key(text), int(toxic > 0)), UNIT) if self.shared else UNIT


def weights(train: DataFrame) -> Weights:
    """Weights of the training rows; their hashes come to the driver, as many rows as the classifier is fitted on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([text_key(t) for t in texts], pa.binary()), pa.array([int(x > 0) for x in batch.column("toxic").to_pylist()], pa.int32()),
                 pa.array([bands(t or "") for t in texts], pa.list_(pa.int64()))],
                ["key", "toxic", "bands"],
            )

    kinds = train.select("text", "toxic").mapInArrow(run, "key binary, toxic int, bands array<long>")
    counted = kinds.groupBy("key", "toxic", "bands").count().toArrow()
    return Weights(zip(*(counted[c].to_pylist() for c in ("key", "toxic", "bands", "count"))))


def candidates(train: DataFrame, weight: Weights, most: int) -> tuple[list[tuple[str, int, float]], int]:
    """Features by the evidence that they go with toxic rows, with their counts; the number of features."""
    shared = train.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good: Counter = Counter()
        bad: set[tuple[str, str]] = set()
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                text = text.as_py()
                words = _plain(text)
                if toxic > 0:
                    # a row has one place for each of its features
                    bad.update({x: " ".join(near) for w, near in words.items() for x in features([w])}.items())
                else:
                    n = shared.value.of(text, toxic)
                    for x in {*features(words)}:
                        good[x] += n
        rows = [*((w, near, 1, 0) for w, near in bad), *((w, "", 0, n) for w, n in good.items())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
            ["word", "near", "bad", "good"],
        )

    counted = train.select("text", "toxic").mapInArrow(run, "word string, near string, bad long, good long")
    by_place = counted.groupBy("word", "near").agg(F.max("bad").alias("bad"), F.sum("good").alias("good"))
    words = by_place.groupBy("word").agg(
        F.sum("bad").alias("bad"), (F.sum("good") / F.lit(float(UNIT))).alias("good")
    ).persist()
    rate = F.log((F.col("bad") + 0.5) / F.lit(weight.bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(weight.good + 1.0))
    tried = words.count()
    best = words.where((F.col("bad") >= LEAST_ROWS) & (F.col("bad") >= PURE * F.col("good")))
    best = best.withColumn("evidence", F.col("bad") * rate).where("evidence > 0")
    out = [(r.word, r.bad, r.good) for r in best.orderBy(F.desc("evidence"), "word").limit(most).collect()]
    words.unpersist()
    return out, tried


def choose(counts: list[tuple[str, int, float]], least: float, most: int) -> list[int]:
    """Features that are in enough toxic rows, each less what it would wrongly explain, the best first."""
    # of beginnings of a word that do the same, the longest says the least about other words
    order = sorted(((bad - (PURE - 1) * good, len(name), -w) for w, (name, bad, good) in enumerate(counts)), reverse=True)
    chosen: list[int] = []
    for gain, _, w in order:
        if gain < least or len(chosen) == most:
            break
        name = counts[-w][0]
        if not any(counts[x][0].startswith(name) or name.startswith(counts[x][0]) for x in chosen):
            chosen.append(-w)
    return chosen


def weigh(rows: list[tuple[list[int], int, float]], counts: list[tuple[str, int, float]], chosen: list[int]) -> tuple[float, list[float]]:
    """The share of toxic rows among those without a chosen word, and among those with each."""
    own = set(chosen)
    rest = [(toxic, n) for words, toxic, n in rows if not own.intersection(words)]
    share = (sum(n for toxic, n in rest if toxic) + 0.5) / (sum(n for _, n in rest) + 1)
    return share, [(bad + 0.5) / (bad + good + 1) for _, bad, good in (counts[w] for w in chosen)]


class Model:
    """Chosen words with their shares of toxic rows, the share without any, and the language model."""

    def __init__(self, words: list[str], shares: list[float], rest: float, language: np.ndarray) -> None:
        self.shares, self.rest, self.language = dict(zip(words, shares)), rest, language

    def score(self, found: Iterable[str]) -> float:
        return 1 - (1 - self.rest) * math.prod(sorted(1 - self.shares[w] for w in found))


def fit(docs: DataFrame, labels: DataFrame, label_id: str, label: str, fit_rows: int) -> Model:
    language = language_model(gram_counts(docs))
    train = labelled(docs, labels, label_id, label, fit_rows)
    weight = weights(train)
    counts, tried = candidates(train, weight, CANDIDATES)
    prior = (weight.bad + 0.5) / (weight.bad + weight.good + 1.0)
    if not counts:
        return Model([], [], prior, language)
    sent = train.sparkSession.sparkContext.broadcast(({c[0]: i for i, c in enumerate(counts)}, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight = sent.value
        for batch in batches:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            own = [sorted({place[x] for x in features(_plain(t)) if x in place}) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.list_(pa.int32())), pa.array([int(x > 0) for x in toxic], pa.int32()),
                 pa.array([weight.of(t, x) for t, x in zip(texts, toxic)], pa.int64())],
                ["own", "toxic", "n"],
            )

    # numbers of candidates, for as many rows as the classifier is fitted on
    kinds = train.select("text", "toxic").mapInArrow(run, "own array<int>, toxic int, n long").groupBy("own", "toxic").agg(F.sum("n").alias("n"))
    rows = [(r["own"], r["toxic"], r["n"] / UNIT) for r in kinds.toArrow().to_pylist()]
    # at the rate of toxic rows, fewer than so many in a row come about by chance in one of a hundred tables
    least = max(LEAST_ROWS, math.log(100 * tried) / -math.log(prior))
    chosen = choose(counts, least, CHOSEN)
    rest, shares = weigh(rows, counts, chosen)
    return Model([counts[i][0] for i in chosen], shares, rest, language)


class _Worker:
    held: tuple[str, Decoder] | None = None

    @classmethod
    def of(cls, name: str, model: Model) -> Decoder:
        if cls.held is None or cls.held[0] != name:
            cls.held = name, Decoder(list(model.shares), model.language)
        return cls.held[1]


def apply(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, words: one row per row of ``docs``."""
    import uuid

    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _Worker.of(name, shared.value)
        for part in arrays.slices(batches, "text"):
            lower = [(t or "").lower().encode() for t in part.column("text").to_pylist()]
            found = [decoder.found(np.frombuffer(t, np.uint8)) for t in lower]
            score = np.array([shared.value.score(f) for f in found], float)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score),
                 pa.array((score >= THRESHOLD).astype(np.int32)), pa.array([sorted(f) for f in found], pa.list_(pa.string()))],
                ["doc_id", "held_out", "score", "predicted", "words"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, words array<string>")


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_id: str = "doc_id", label: str = "toxic", fit_rows: int = FIT_ROWS,
) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return apply(rows, fit(rows, labels, label_id, label, fit_rows))
