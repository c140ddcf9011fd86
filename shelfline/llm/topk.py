"""Exact top-k by integer inner product: global score histograms, refined until each kth value is known.

Vectors are quantised to integers and packed into blocks of bounded size, queries likewise. Every
block of queries meets every block of vectors on the key (block, query block), so no task holds more
than one of each and no side is taken to be small. All scores are computed in each round. A round
counts them, per query, in the bins of the stretch that still holds the query's kth value; a block of
vectors reports its bins from the top down to the one that reaches the wanted number, because the kth
value overall cannot lie below the kth value of a part. The bins are added up, the one that holds the
kth value becomes the next stretch, and after ``rounds`` (two or three) it is one number wide. A last
pass keeps the scores above that number, and as many of the scores equal to it as are wanted, ids
ascending.

Defined cases: a NULL vector, or one with a NULL, NaN or infinite component, takes no part, nor does a row
with a NULL id; vectors are compared with vectors of their own length, so those without components score 0
among themselves; rows that repeat an id are rows of their own: each is a query of its own and meets
the others; fewer candidates than k are all returned; scores that do not fit a long are held at ±2^61; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.native import staged

#: Bytes of a block of vectors, and of a table of scores that a task holds at once.
BLOCK_BYTES = 4 << 20
#: Queries in a block.
BLOCK_QUERIES = 4096
#: Each round tells 2^BITS bins apart.
BITS = 9
_FAR = 1 << 61

_BLOCK = "dim int, ids binary, kind string, vectors binary, norm double"
_QUERY = "dim int, block long, pos int, id long, vector binary"
_QUERY_BLOCK = "dim int, blocks binary, pos binary, ids binary, vectors binary"


def _packed(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """Blocks of quantised vectors: block, dim, ids, kind (of number), vectors, norm (the largest square)."""

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vector")
    ).where(F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", usable))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            column = batch.column("vector")
            dims = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            flat, first = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                step = max(1, BLOCK_BYTES // (8 * max(dim, 1)))
                for at in range(0, len(rows), step):
                    own = rows[at: at + step]
                    block = flat[first[own][:, None] + np.arange(dim)[None, :]]
                    with np.errstate(over="ignore"):
                        block = np.nan_to_num(np.floor(block * scale))
                        norm = float((block * block).sum(axis=1).max()) if dim else 0.0
                    top = np.abs(block).max() if block.size else 0
                    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([ids[own].astype("<i8").tobytes()], pa.binary()),
                         pa.array([kind]), pa.array([block.astype(kind).tobytes()], pa.binary()), pa.array([norm])],
                        ["dim", "ids", "kind", "vectors", "norm"],
                    )

    return staged(rows.mapInArrow(run, _BLOCK).withColumn("block", F.monotonically_increasing_id()))


def _queries(blocks: DataFrame, every: int) -> DataFrame:
    """Blocks of the vectors whose id is divisible by ``every``: q, dim, blocks, pos, ids, vectors."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(len(ids), row["dim"]).astype("<f8")
                at = np.flatnonzero(ids % every == 0)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["dim"], np.int32)), pa.array(np.full(n, row["block"], np.int64)),
                     pa.array(at.astype(np.int32)), pa.array(ids[at]),
                     pa.array([vectors[i].tobytes() for i in at], pa.binary())],
                    ["dim", "block", "pos", "id", "vector"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                step = max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * max(dim, 1))))
                for first in range(0, len(at), step):
                    own = batch.take(pa.array(at[first: first + step]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()),
                         pa.array([own.column("block").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([own.column("pos").to_numpy().astype("<i4").tobytes()], pa.binary()),
                         pa.array([own.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([b"".join(own.column("vector").to_pylist())], pa.binary())],
                        ["dim", "blocks", "pos", "ids", "vectors"],
                    )

    picked = staged(blocks.mapInArrow(pick, _QUERY))
    parts = max(1, picked.count() // BLOCK_QUERIES)
    packed = picked.repartition(parts).mapInArrow(pack, _QUERY_BLOCK)
    return staged(packed.withColumn("q", F.monotonically_increasing_id()))


def _met(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block of vectors beside every block of queries of its length."""
    # one number for each block, that is for some thousand vectors
    each_query = F.broadcast(queries.groupBy("dim").agg(F.collect_list("q").alias("qs")))
    each_block = F.broadcast(blocks.groupBy("dim").agg(F.collect_list("block").alias("all")))
    left = blocks.join(each_query, "dim").select(
        F.explode("qs").alias("q"), "block", "dim", "kind", F.col("ids").alias("ids"), F.col("vectors").alias("vectors")
    )
    right = queries.join(each_block, "dim").select(
        "q", F.explode("all").alias("block"), F.col("blocks").alias("q_blocks"), F.col("pos").alias("q_pos"),
        F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        *(c for c in ("state",) if c in queries.columns),
    )
    return left.join(right, ["block", "q"])


class _Pair:
    """One block of queries against one block of vectors."""

    def __init__(self, row: dict, peak: int, rest: int, k: int) -> None:
        self.ids = np.frombuffer(row["ids"], "<i8")
        n, self.peak = len(self.ids), peak
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(n, row["dim"])
        state = row.get("state")
        count = len(row["q_ids"]) // 8
        if state is None:
            at, self.low, self.need = np.arange(count), np.full(count, rest, np.int64), np.full(count, k, np.int64)
        else:
            at = np.array([s["at"] for s in state], np.int64)
            self.low = np.array([s["low"] for s in state], np.int64)
            self.need = np.array([s["need"] for s in state], np.int64)
        self.at = at
        self.q_ids = np.frombuffer(row["q_ids"], "<i8")[at]
        self.queries = np.frombuffer(row["q_vectors"], "<f8").reshape(count, row["dim"])[at]
        same = np.frombuffer(row["q_blocks"], "<i8")[at] == row["block"]
        self.own = np.where(same, np.frombuffer(row["q_pos"], "<i4")[at], -1)
        self.kind = np.float32 if peak < 1 << 24 else np.float64 if peak < 1 << 53 else object

    def _exact(self, vectors: np.ndarray) -> np.ndarray:
        if self.kind is not object:
            return vectors.astype(self.kind)
        return np.array([[int(x) for x in row] for row in vectors.tolist()], object).reshape(vectors.shape)

    def scores(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Parts of the queries with their scores and the places that do not count, the queries' own."""
        if not len(self.at):
            return
        right = self._exact(self.vectors).T
        step = max(1, BLOCK_BYTES // (8 * len(self.ids)))
        for first in range(0, len(self.at), step):
            part = slice(first, min(first + step, len(self.at)))
            product = self._exact(self.queries[part]) @ right
            if self.kind is object:
                product = np.array([[max(-_FAR, min(_FAR, int(x))) for x in row] for row in product.tolist()])
            product = product.astype(np.int64).reshape(part.stop - part.start, len(self.ids))
            away = np.zeros(product.shape, bool)
            mine = np.flatnonzero(self.own[part] >= 0)
            away[mine, self.own[part][mine]] = True
            yield part, product, away

    def histogram(self, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query, bin and number, from the top down to where the wanted number is reached."""
        size = 1 << BITS
        for part, product, away in self.scores():
            bins = (product - self.low[part, None]) >> shift
            use = (bins >= 0) & (bins < size) & ~away
            rows = np.broadcast_to(np.arange(len(bins))[:, None], bins.shape)
            table = np.bincount(rows[use] * size + bins[use], minlength=len(bins) * size).reshape(-1, size)
            above = table[:, ::-1].cumsum(axis=1)[:, ::-1] - table
            row, at = np.nonzero((table > 0) & (above < self.need[part, None]))
            yield self.at[part][row], at, table[row, at]

    def chosen(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Query, its id, vector id and score: above the kth value, and the first ids of those equal to it."""
        for part, product, away in self.scores():
            low, need = self.low[part], self.need[part]
            row, at = np.nonzero((product >= low[:, None]) & ~away)
            score = product[row, at]
            tie = score == low[row]
            order = np.lexsort((self.ids[at], tie, row))
            row, at, score, tie = row[order], at[order], score[order], tie[order]
            # ties stand last in a query's stretch
            start = np.searchsorted(row, np.arange(len(low)))
            over = np.bincount(row[~tie], minlength=len(low))
            keep = ~tie | (np.arange(len(row)) - start[row] - over[row] < need[row])
            row, at, score = row[keep], at[keep], score[keep]
            yield self.at[part][row], self.q_ids[part][row], self.ids[at], score


def _over_pairs(met: DataFrame, schema: str, work, peak: int, rest: int, k: int) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                for at, *columns in work(_Pair(row, peak, rest, k)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), row["q"], np.int64)), *(pa.array(c.astype(np.int64)) for c in (at, *columns))],
                        names,
                    )

    return met.mapInArrow(run, schema)


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best others of each row whose id ``every`` divides."""
    blocks = _packed(vectors, id_col, vec_col, scale)
    queries = _queries(blocks, every)
    largest = blocks.agg(F.max("norm")).first()[0] or 0.0
    # no score, nor a part of one, is larger than the largest square of a norm
    peak = int(min(largest * (1 + 1e-9) + 1, float(_FAR) if math.isfinite(largest) else _FAR))
    rest, width = -peak, (2 * peak + 1).bit_length()
    state, now = None, queries
    for shift in reversed(range(0, max(width, 1), BITS)):
        counted = _over_pairs(
            _met(blocks, now), "q long, at long, bin long, n long", lambda p, s=shift: p.histogram(s), peak, rest, k
        ).groupBy("q", "at", "bin").agg(F.sum("n").alias("n"))
        before = counted if state is None else counted.join(state, ["q", "at"])
        low, need = (F.lit(rest), F.lit(k)) if state is None else (F.col("low"), F.col("need"))
        query = Window.partitionBy("q", "at")
        down = query.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (
            before.withColumn("upto", F.sum("n").over(down))
            .withColumn("want", F.least(need.cast("long"), F.sum("n").over(query)))
            .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
        )
        state = staged(found.select(
            "q", "at", (low + F.col("bin") * F.lit(1 << shift)).cast("long").alias("low"),
            (F.col("want") - F.col("upto") + F.col("n")).cast("long").alias("need"),
        ))
        # as many rows as a block of queries has
        states = state.groupBy("q").agg(F.collect_list(F.struct("at", "low", "need")).alias("state"))
        now = queries.join(states, "q")
    hits = _over_pairs(
        _met(blocks, now), "q long, at long, query_id long, vec_id long, score long", lambda p: p.chosen(), peak, rest, k
    )
    order = Window.partitionBy("q", "at").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
