"""Near-duplicates by BagMinHash signatures, banding and exact multiset overlap.

*Signatures.* A text is the multiset of its runs of five words. Its weights are whole numbers, cut into
unit levels, and the levels into stretches [0, 1), [1, 2), [2, 4), [4, 8) …. Every shingle has one Poisson
process per stretch, seeded by shingle and stretch alone; a point has a time, one of ``BANDS * ROWS``
components, and a level, whose binary digits are its way down the halves of the stretch. Points at
levels below the weight belong to the text, and a component's signature is the earliest of them. Two
texts share it with the probability of their weighted Jaccard similarity. Points are made in order of
time and only until every component has one, so frequent shingles and long texts cost little more.

*Candidates.* Equal texts are one node. Nodes with an equal band share a bucket. Each bucket's nodes are
compared with its least node first. What then lies in one component needs no further comparison. In the
buckets that hold several components, the others are compared with nodes of the largest one, in a few rounds,
as long as that joins many. New links only join components that earlier ones have made. What is left is paired
across components where two nodes share a bucket and one of their rarest shingles, which similar nodes always
do. Before, nodes and pairs go that cannot be similar: the shingles of a node that no other node in question
has are in no overlap. So no link that shares a bucket is lost, and a bucket of copies costs its size, not its
square. At a similarity of 0.8, a pair shares no bucket once in 20,000 pairs.

*Verification.* Candidates are compared exactly: the sum of the least weights over the sum of the greatest.

Defined cases: texts of one to four words are one shingle; NULL texts and texts without words are like no
other and a class each; repeated rows are equal texts; NULL ids do not name a class, one of NULL ids
alone has a NULL class; an empty table gives an empty result. Only id and text are read, ``keep_one`` carries all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import arrays
from shelfline.llm.graph import components
from shelfline.llm.native import Tables

SHINGLE = 5
BANDS, ROWS = 25, 5
SIMILAR = (4, 5)
#: Rounds in which buckets are compared with one node of their largest component; what they leave is settled exactly.
ROUNDS = 3
#: Rarer tokens of its node that a token carries, so that a pair is not made again for every token that two nodes share.
CARRIED = 8

_GOLDEN = 0x9E3779B97F4A7C15


def _step(k: int) -> np.uint64:
    return np.uint64(k * _GOLDEN & 0xFFFFFFFFFFFFFFFF)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and the number of the first shingle of each text."""
    starts, ends, first = arrays.word_bounds(data, offsets)
    words = arrays.span_hashes(data, starts, ends)
    n = np.diff(first)
    value, at = arrays.windows(words, first, width)
    for k in range(1, width):
        own = np.flatnonzero(n == k)
        if len(own):
            short, _ = arrays.windows(words[(first[own][:, None] + np.arange(k)).ravel()], np.arange(len(own) + 1) * k, k)
            value, at = np.append(value, short), np.append(at, first[own])
    order = np.argsort(at, kind="stable")
    value, at = value[order], at[order]
    return value, np.searchsorted(at, first)


def weighted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their weights: text number, shingle, weight."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.append(True, (values[1:] != values[:-1]) | (text[1:] != text[:-1]))[: len(values)]
    at = np.flatnonzero(new)
    return text[at], values[at], np.diff(np.append(at, len(values)))


def _stretches(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray):
    """Processes that reach below each weight: text, seed, size of the stretch, levels of it below the weight."""
    low = 0
    while len(text):
        size = max(1, low)
        seed = arrays.mix(shingle + _step(low + 1))
        yield text, seed, size, np.minimum(weight - low, size)
        low += size
        more = weight > low
        text, shingle, weight = text[more], shingle[more], weight[more]


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """The times of the earliest points, as [text, component]; infinite where a text has no shingles."""
    out = np.full(n_texts * size, np.inf)
    total = np.bincount(text, weight, minlength=n_texts)
    limit = np.divide(np.log(size) + 3.0, total, out=np.zeros(n_texts), where=total > 0)
    open_texts = total > 0
    while open_texts.any():
        own = open_texts[text]
        for doc, seed, levels, below in _stretches(text[own], shingle[own], weight[own]):
            rate = float(levels * size)
            time, step = np.zeros(len(doc)), 0
            while len(doc):
                step += 1
                point = arrays.mix(seed + _step(step))
                time = time - np.log(_uniform(point)) / rate
                near = time <= limit[doc]
                if not near.all():
                    doc, seed, time, below, point = doc[near], seed[near], time[near], below[near], point[near]
                place = arrays.mix(point)
                component = (place % np.uint64(size)).astype(np.int64)
                if levels > 1:
                    level = (place // np.uint64(size)) % np.uint64(levels)
                    valid = level.astype(np.int64) < below
                    np.minimum.at(out, doc[valid] * size + component[valid], time[valid])
                else:
                    np.minimum.at(out, doc * size + component, time)
        # a text with an empty component is gone over again, further in time
        open_texts &= np.isinf(out.reshape(n_texts, size)).any(axis=1)
        limit = np.where(open_texts, limit * 2, limit)
    return out.reshape(n_texts, size)


def bands(times: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    """Hashes of the bands of each signature."""
    bits = times.view(np.uint64).reshape(len(times), n_bands, -1)
    value = np.tile(np.arange(1, n_bands + 1, dtype=np.uint64) * _step(1), (len(times), 1))
    for k in range(bits.shape[2]):
        value = arrays.mix(value ^ bits[:, :, k]) + _step(1)
    return value


def same(values: np.ndarray, bounds: np.ndarray, others: np.ndarray, other_bounds: np.ndarray) -> np.ndarray:
    """Whether each text is similar to its partner."""
    out = np.zeros(len(bounds) - 1, bool)
    for i in range(len(out)):
        a, n_a = np.unique(values[bounds[i]: bounds[i + 1]], return_counts=True)
        b, n_b = np.unique(others[other_bounds[i]: other_bounds[i + 1]], return_counts=True)
        _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        least = int(np.minimum(n_a[in_a], n_b[in_b]).sum())
        greatest = int(n_a.sum() + n_b.sum()) - least
        out[i] = least > 0 and SIMILAR[1] * least >= SIMILAR[0] * greatest
    return out


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def signed(rows: DataFrame) -> DataFrame:
    """doc_id, key, n (shingles), bands; no bands for texts without words. ``rows``: doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text"):
            values, bounds = shingles(*arrays.text_bytes(part.column("text")))
            times = signatures(*weighted(values, bounds), len(part), BANDS * ROWS)
            n = np.diff(bounds)
            own = bands(times)[n > 0].view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(np.where(n > 0, BANDS, 0))).astype(np.int32)), pa.array(own.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(n.astype(np.int64)), lists], ["doc_id", "key", "n", "bands"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select("doc_id", _key(F.col("text")).alias("key"), "text")
    return keyed.mapInArrow(run, f"doc_id {kind}, key binary, n long, bands array<long>")


def _texts(wanted: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """node, text of the nodes wanted. ``nodes``: node, doc_id, key; ``rows``: doc_id, text."""
    named = wanted.select("node").distinct().join(nodes.select("node", F.col("doc_id").alias("_id"), "key"), "node")
    keyed = rows.select("doc_id", _key(F.col("text")).alias("key"), "text")
    # id and key together: a text with very many copies is not dealt by its key alone
    texts = keyed.join(named, (keyed["key"] == named["key"]) & keyed["doc_id"].eqNullSafe(named["_id"]))
    return texts.select("node", "text").groupBy("node").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b: nodes) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text"):
            left, right = (shingles(*arrays.text_bytes(part.column(c))) for c in ("text", "other"))
            yield part.select(["a", "b"]).filter(pa.array(same(*left, *right)))

    left = pairs.join(texts, pairs["a"] == texts["node"]).select("a", "b", "text")
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    return left.join(other, "b").select("a", "b", "text", "other").mapInArrow(run, "a long, b long")


def _tokens(texts: DataFrame) -> DataFrame:
    """node, token, n_nodes: shingles, counted copies apart, that several nodes of ``texts`` have.

    The overlap of two nodes is the number of tokens that both have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text"):
            text, shingle, weight = weighted(*shingles(*arrays.text_bytes(part.column("text"))))
            copy = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            token = arrays.mix(np.repeat(shingle, weight) + arrays.mix(copy.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("node").take(pa.array(np.repeat(text, weight))), pa.array(token.view(np.int64))], ["node", "token"]
            )

    each = texts.select("node", "text").mapInArrow(run, "node long, token long")
    several = each.groupBy("token").agg(F.count("*").alias("n_nodes")).where("n_nodes > 1")
    return each.join(several, "token")


def _prefixes(tokens: DataFrame, sizes: DataFrame) -> DataFrame:
    """node, token, rank, rarer: the rarest tokens of each node, so many that two similar nodes have one in common.

    Of n tokens, similar nodes share four fifths at least; without any of the n // 5 + 1 that come first in one
    order of all tokens, too few are left. Tokens that no other node has come first and are of no use.
    ``rank`` is the place of a token in that order, ``rarer`` the last ones before it. ``sizes``: node, n, shared.
    """
    order = Window.partitionBy("node").orderBy("n_nodes", "token")
    ranked = tokens.withColumn("rank", F.row_number().over(order)).withColumn(
        "rarer", F.collect_list("token").over(order.rowsBetween(-CARRIED, -1))
    ).join(sizes, "node")
    return ranked.where(F.col("rank") + F.col("n") - F.col("shared") <= F.floor(F.col("n") / SIMILAR[1]) + 1).select("node", "token", "rank", "rarer")


def _sharing(members: DataFrame, prefixes: DataFrame) -> DataFrame:
    """a, b: nodes of different components that can be similar and share a bucket and a token, a pair about once.

    A pair is left out where both rows carry a lower bucket or a rarer token that is the same: it is made there. It
    always is in the lowest bucket and with the rarest token that two nodes share, so none is lost. With that token,
    the overlap is at most the tokens from its rank on.
    ``members``: bucket, node, n, shared, component; ``prefixes``: node, token, rank, rarer.
    """
    # at most one bucket for each band
    lower = F.collect_list("bucket").over(Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    one = members.select("bucket", "node", "n", "shared", "component", lower.alias("lower")).join(prefixes, "node").withColumn(
        "left", F.col("shared") - F.col("rank") + 1
    )
    # both sides are the same rows, shuffled once
    both = one.alias("l").join(one.alias("r"), ["bucket", "token"]).select(
        *(F.col(f"{side}.{c}").alias(f"{c}{end}") for side, end in (("l", ""), ("r", "_2")) for c in ("node", "n", "left", "component", "lower", "rarer"))
    )
    return both.where(
        (F.col("node") < F.col("node_2")) & (F.col("component") != F.col("component_2")) & _possible("left") & _similar_size()
        & ~F.arrays_overlap("rarer", "rarer_2") & ~F.arrays_overlap("lower", "lower_2")
    ).select(F.col("node").alias("a"), F.col("node_2").alias("b"))


def _possible(most: str = "shared") -> Column:
    """Whether two nodes can be similar: the overlap is at most what each shares with any other, or what is left of that."""
    least = F.least(most, f"{most}_2")
    return sum(SIMILAR) * least >= SIMILAR[0] * (F.col("n") + F.col("n_2"))


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _similar_size() -> Column:
    return SIMILAR[1] * F.least("n", "n_2") >= SIMILAR[0] * F.greatest("n", "n_2")


def labelled(nodes: DataFrame, rows: DataFrame, tables: Tables) -> DataFrame:
    """node, component of every node. ``nodes``: node, doc_id, key, n, bands."""
    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    pivots = members.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    at_full, full = tables.put(members.join(pivots.drop("size"), "bucket"))
    at_texts, texts = tables.put(_texts(full, nodes, rows))
    at_pairs, pairs = tables.put(full.where("node <> pivot").select(*_ordered(F.col("node"), F.col("pivot"))).distinct())
    tried = [at_pairs]
    at_found, found = tables.put(verified(pairs, texts))
    at_labels, labels = tables.put(
        nodes.select("node").join(components(found, tables), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    )
    tables.drop(at_found)

    def torn(held: DataFrame) -> DataFrame:
        """The members of buckets that hold several components."""
        several = held.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
        return held.join(several.select("bucket"), "bucket", "left_semi")

    def joined(pairs: DataFrame, named: DataFrame) -> tuple[int, int]:
        """Verify pairs and move the labels. How many pairs, and how many are similar. ``named``: node, component."""
        nonlocal at_labels, labels
        at_pairs, pairs = tables.put(pairs.join(tables.of(tried, pairs), ["a", "b"], "left_anti"))
        at_more, more = tables.put(verified(pairs, texts))
        n_pairs, n_more = pairs.count(), more.count()
        tried.append(at_pairs)
        if n_more:
            # only new links are labelled, between components
            ends = more
            for c in ("a", "b"):
                ends = ends.join(named.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")), c)
            moved = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")), tables)
            moved = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
            old = at_labels
            at_labels, labels = tables.put(labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
            tables.drop(old)
        tables.drop(at_more)
        return n_pairs, n_more

    at_open, members = tables.put(torn(full.select("bucket", "node", "n").join(labels, "node")))
    tables.drop(at_full)
    if members.take(1):
        shared = _tokens(texts.join(members.select("node").distinct(), "node", "left_semi")).groupBy("node").agg(F.count("*").alias("shared"))
        old = at_open
        # a node that shares less than four fifths with all others together is similar to none
        at_open, members = tables.put(torn(members.join(shared, "node").where(SIMILAR[1] * F.col("shared") >= SIMILAR[0] * F.col("n"))))
        tables.drop(old)
    for step in range(ROUNDS):
        sizes = members.groupBy("bucket", "component").agg(
            F.count("*").alias("size"), F.min_by(F.struct("node", "n", "shared"), F.xxhash64("node", "bucket", F.lit(step))).alias("p")
        ) if members.take(1) else None
        if sizes is None:
            break
        largest = sizes.groupBy("bucket").agg(F.max_by(F.struct("component", "p"), F.struct("size", "component")).alias("l")).select(
            "bucket", F.col("l.component").alias("of"), F.col("l.p.node").alias("node_2"), F.col("l.p.n").alias("n_2"), F.col("l.p.shared").alias("shared_2")
        )
        others = members.join(largest, "bucket").where((F.col("component") != F.col("of")) & _possible() & _similar_size())
        n_pairs, n_more = joined(others.select(*_ordered(F.col("node"), F.col("node_2"))).distinct(), labels)
        if not n_more:
            break
        old = at_open
        at_open, members = tables.put(torn(members.drop("component").join(labels, "node")))
        tables.drop(old)
        if 10 * n_more < n_pairs:
            break  # few are still joined that way
    # what is left: pairs across components that share a bucket and a rare token
    if members.take(1):
        sizes = members.select("node", "n", "component").distinct()
        tokens = _tokens(texts.join(sizes.select("node"), "node", "left_semi"))
        at_tokens, tokens = tables.put(tokens)
        shared = tokens.groupBy("node").agg(F.count("*").alias("shared"))
        sizes = sizes.join(shared, "node")
        at_prefixes, prefixes = tables.put(_prefixes(tokens, sizes.select("node", "n", "shared")))
        tables.drop(at_tokens)
        last = _sharing(members.select("bucket", "node", "n", "shared", "component"), prefixes).distinct()
        joined(last, labels)
        tables.drop(at_prefixes)
    tables.drop(at_open, at_texts, *tried)
    return labels


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, n, node, class_id of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tables = Tables(docs.sparkSession, "near-duplicates")
    _, marked = tables.put(signed(rows))
    nodes = marked.where("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("n", "bands")).alias("s")
    )
    _, nodes = tables.put(nodes.select(F.monotonically_increasing_id().alias("node"), "doc_id", "key", "s.n", "s.bands"))
    joined = nodes.select("node", "key", "doc_id").join(labelled(nodes, rows, tables), "node")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    named = joined.join(least, "component").select("key", "node", "component", "class_id")
    full = marked.where("n > 0").select("doc_id", "key", "n").join(named, "key")
    none = marked.where("n = 0").select("doc_id", "key", "n").withColumn("node", F.lit(None).cast("long"))
    none = none.withColumn("component", F.lit(None).cast("long")).withColumn("class_id", F.col("doc_id"))
    return full.unionByName(none)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the least id of its class): one row per row of ``docs``."""
    return _classes(docs, id_col, text_col).select("doc_id", "class_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each class, that with the least id; all rows without words stay."""
    tables = Tables(docs.sparkSession, "near-duplicates")
    _, named = tables.put(_classes(docs, id_col, text_col).where("n > 0").select("doc_id", "key", "component"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = named.groupBy("component").agg(F.min(order).alias("k")).select("k.doc_id", "k.key")
    times = named.groupBy("doc_id", "key").count()
    kept = kept.join(times, kept["doc_id"].eqNullSafe(times["doc_id"]) & (kept["key"] == times["key"])).select(
        kept["doc_id"], kept["key"], (F.col("count") > 1).alias("repeated")
    )
    row = F.struct(*docs.columns).alias("row")
    keyed = docs.select(row, F.col(id_col).alias("_id"), _key(F.col(text_col)).alias("_key"))
    bare = F.coalesce(F.regexp_count(F.col("row")[text_col], F.lit(r"[^\x20\x09-\x0D]")), F.lit(0)) == 0
    found = keyed.join(kept, keyed["_id"].eqNullSafe(kept["doc_id"]) & (keyed["_key"] == kept["key"])).select("row", "_id", "_key", "repeated")
    single = found.where("not repeated").select("row")
    double = found.where("repeated").dropDuplicates(["_id", "_key"]).select("row")
    return single.unionByName(double).unionByName(keyed.where(bare).select("row")).select("row.*")
