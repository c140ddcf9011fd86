"""Records that go over several lines, read by several tasks per file.

Spark splits text files at any separator. Cut at ``}`` (JSON) or at line ends (CSV), a file is a row of fragments,
and a record ends with a fragment after which no quote and no brace is open. Whether one is open depends on all
that came before, so a first pass sums up every block of a file: whether it turns quoted into unquoted text, and
how many braces it opens if it starts outside or inside quotes. Put together along the file, the sums tell each
block how it starts. The second pass cuts each block into records; the ends that lie in two blocks, one for each
border, are put together at last. Only sums and these ends are shuffled.

Works for every file system and compression that Spark reads; a compressed file is one block. Lines of CSV end in
``\\n`` or ``\\r\\n``, and quotes stand only around values, as in RFC 4180. A JSON file holds one array of objects, or
objects one after another. An array that is cut off, or a quote that is not closed, makes a JSON file unreadable: it
yields one NULL record, as an unreadable document does in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from shelfline.session import ensure_checkpoint_dir

#: Blocks whose states are sent to all tasks (some 20 MB); with more they are joined by a shuffle and sorted back.
MOST_SENT = 200_000

_SUMMARY = "file string, block long, flip int, braces array<long>, brackets array<long>"
_PIECE = "number long, part string, first boolean, record string"


def _bytes(values: pa.Array, separator: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fragments with their separators, end to end, and their offsets."""
    full = pc.binary_join_element_wise(
        values.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()), pa.scalar(separator, pa.large_binary())
    )
    offsets = np.frombuffer(full.buffers()[1], np.int64)[full.offset: full.offset + len(full) + 1]
    return np.frombuffer(full.buffers()[2], np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def _quotes(data: np.ndarray, json: bool) -> np.ndarray:
    """Marks of the quotes that open or close. Fragments hold whole escapes: none spans a separator."""
    quote = data == 34
    slash = data == 92
    if json and slash.any():
        at = np.flatnonzero(quote)
        plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        before = at - 1 - np.where(at > 0, plain[at - 1], -1)
        quote[at[before % 2 == 1]] = False
    return quote


def _levels(data: np.ndarray, up: bytes) -> np.ndarray:
    return (data == up[0]).astype(np.int8) - (data == up[1])


def _runs(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that agree in the named columns."""
    codes = [batch.column(n).dictionary_encode().indices.to_numpy(zero_copy_only=False) for n in names]
    change = reduce(np.logical_or, (c[1:] != c[:-1] for c in codes)) if len(batch) else np.zeros(0, bool)
    bounds = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
    for low, high in zip(bounds, bounds[1:]):
        if high > low:
            yield tuple(batch.column(n)[low].as_py() for n in names), batch.slice(low, high - low)


def _fragments(spark: SparkSession, path: str, json: bool) -> DataFrame:
    text = spark.read.option("lineSep", "}" if json else "\n").option("recursiveFileLookup", True).text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _summaries(fragments: DataFrame, json: bool) -> DataFrame:
    separator = b"}" if json else b"\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flip, sums = None, 0, None
        for batch in batches:
            for key, rows in _runs(batch, "file", "block"):
                if key != held:
                    if held is not None:
                        yield _row(held, flip, sums)
                    held, flip, sums = key, 0, [[0, 0], [0, 0]]
                data, _ = _bytes(rows.column("value"), separator)
                inside = (np.cumsum(_quotes(data, json)) & 1).astype(bool)
                if json:
                    for total, up in zip(sums, (b"{}", b"[]")):
                        level = _levels(data, up)
                        out, within = int(level[~inside].sum()), int(level[inside].sum())
                        total[0] += within if flip else out
                        total[1] += out if flip else within
                flip ^= int(inside[-1]) if len(inside) else 0
        if held is not None:
            yield _row(held, flip, sums)

    def _row(key: tuple, flip: int, sums: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"file": key[0], "block": key[1], "flip": flip, "braces": sums[0], "brackets": sums[1]}],
            pa.schema([("file", pa.string()), ("block", pa.int64()), ("flip", pa.int32()),
                       ("braces", pa.list_(pa.int64())), ("brackets", pa.list_(pa.int64()))]),
        )

    return fragments.mapInArrow(run, _SUMMARY)


def _states(fragments: DataFrame, json: bool) -> DataFrame:
    """file, block, number, inside, depth, broken, unclosed: how each block starts, and whether its file can be read."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    started = _summaries(fragments, json).withColumn("inside", F.coalesce(F.sum("flip").over(earlier) % 2, F.lit(0)).cast("int"))
    for name in ("braces", "brackets"):
        started = started.withColumn(name, F.element_at(name, F.col("inside") + 1))
    # the last fragment of a file ends without a separator; the one that is put there makes a brace too many, or
    # closes the object the file ends with
    broken = (F.sum("flip").over(whole) % 2 == 1) | ~F.sum("braces").over(whole).isin(0, -1) | (F.sum("brackets").over(whole) != 0)
    states = started.select(
        "file", "block", "inside", F.coalesce(F.sum("braces").over(earlier), F.lit(0)).alias("depth"),
        (broken if json else F.lit(False)).alias("broken"), (F.sum("flip").over(whole) % 2 == 1).alias("unclosed"), F.monotonically_increasing_id().alias("number"),
    )
    ensure_checkpoint_dir(states.sparkSession)
    return states.checkpoint()  # a row for each block of a file


def _pieces(fragments: DataFrame, states: DataFrame, json: bool, whole: bool) -> DataFrame:
    """number (of the block), part, first, record: records that lie in one block, or else the ends of the others."""
    separator = b"}" if json else b"\n"
    if states.count() <= MOST_SENT:
        joined = fragments.join(F.broadcast(states), ["file", "block"], "left")
    else:
        joined = fragments.withColumn("_at", F.monotonically_increasing_id()).join(
            states.hint("merge"), ["file", "block"], "left"
        ).sortWithinPartitions("file", "block", "_at")
    # blocks are cut as in the first pass, or not at all
    number = F.when(F.col("number").isNull(), F.raise_error(F.lit("files changed while they were read"))).otherwise(F.col("number"))
    rows = joined.where("broken IS NULL OR NOT broken").select("value", number.alias("number"), "block", "inside", "depth")

    def out(number: int, part: str, first: np.ndarray, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number, np.int64)), pa.array([part] * n, pa.string()), pa.array(first, pa.bool_()),
             records.cast(pa.large_string()).cast(pa.string())],
            ["number", "part", "first", "record"],
        )

    def one(number: int, part: str, first: bool, record: bytes) -> pa.RecordBatch:
        return out(number, part, np.array([first]), pa.array([record], pa.large_binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for key, part in _runs(batch, "number", "block", "inside", "depth"):
                if key != held:
                    if held is not None and carry and not whole:
                        yield one(held[0], "middle" if open_head else "tail", at_start and held[1] == 0, b"".join(carry))
                    held, (number, block, inside, depth) = key, key
                    carry, at_start, open_head = [], True, bool(inside or depth > 0)
                data, offsets = _bytes(part.column("value"), separator)
                state = (np.cumsum(_quotes(data, json)) + inside) & 1
                ends = offsets[1:] - 1
                neutral = state[ends] == 0
                if json:
                    level = depth + np.cumsum(_levels(data, b"{}") * (state == 0), dtype=np.int64)
                    neutral &= level[ends] <= 0
                    depth = int(level[-1])
                inside = int(state[-1])
                cuts = np.concatenate([[0], offsets[1:][neutral]])
                if len(cuts) > 1:
                    if carry or open_head:
                        record = b"".join([*carry, data[: cuts[1]].tobytes()])
                        if whole != open_head:
                            yield one(number, "head" if open_head else "whole", at_start and block == 0 and not open_head, record)
                        at_start, open_head, carry = at_start and open_head, False, []
                        cuts = cuts[1:]
                    if whole and len(cuts) > 1:
                        first = np.zeros(len(cuts) - 1, bool)
                        first[0] = at_start and block == 0
                        yield out(number, "whole", first, pa.Array.from_buffers(
                            pa.large_binary(), len(cuts) - 1,
                            [None, pa.py_buffer(np.ascontiguousarray(cuts)), pa.py_buffer(np.ascontiguousarray(data))],
                        ))
                    at_start = at_start and len(cuts) == 1
                if cuts[-1] < len(data):
                    carry.append(data[cuts[-1]:].tobytes())
        if held is not None and carry and not whole:
            yield one(held[0], "middle" if open_head else "tail", at_start and held[1] == 0, b"".join(carry))

    return rows.mapInArrow(run, _PIECE)


def _all(fragments: DataFrame, json: bool) -> tuple[DataFrame, DataFrame]:
    """number, first, record of all records, and the states of the blocks."""
    states = _states(fragments, json)
    records = _pieces(fragments, states, json, whole=True).select("number", "first", "record")
    # a block may start within a record, and CSV end within one
    if states.where("NOT broken AND (inside = 1 OR depth > 0 OR unclosed)").isEmpty():
        return records, states
    ends = _pieces(fragments, states, json, whole=False).join(states.select("number", "file", "block"), "number")
    rank = F.when(F.col("part") == "tail", 2).otherwise(1)
    order = Window.partitionBy("file").orderBy("block", rank)
    owner = F.sum((F.col("part") == "tail").cast("int")).over(order)
    glued = ends.withColumn("owner", owner).groupBy("file", "owner").agg(
        F.min("number").alias("number"), F.max("first").alias("first"),
        F.sort_array(F.collect_list(F.struct("block", rank.alias("rank"), "record"))).alias("parts"),
    ).select("number", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "").alias("record"))
    return records.unionByName(glued), states


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """record: the text of each object of the JSON files at a path; NULL for each unreadable file."""
    records, states = _all(_fragments(spark, path, json=True), json=True)
    at = F.locate("{", F.col("record"))
    objects = records.where(at > 0).select(F.substr("record", at).alias("record"))
    return objects.unionByName(states.where("broken").select("file").distinct().select(F.lit(None).cast("string").alias("record")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, first (record of the file), record: the records of the CSV files at a path, without their line ends."""
    return csv_records_and_heads(spark, path)[0]


def csv_records_and_heads(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The records, and file, record of the first of each file. For these only first blocks go through Python, unless a
    first record goes on in the second block."""
    fragments = _fragments(spark, path, json=False)
    records, states = _all(fragments, json=False)
    rows = _without_ends(records, states)
    starts = states.where("block = 0")
    ahead = _pieces(fragments.where("block = 0"), starts, json=False, whole=True).where("first")
    ensure_checkpoint_dir(spark)
    heads = _without_ends(ahead, starts).select("file", "record").checkpoint()  # a row for each file
    if heads.count() < starts.count():
        heads = rows.where("first").select("file", "record").checkpoint()
    return rows, heads


def _without_ends(records: DataFrame, states: DataFrame) -> DataFrame:
    if states.count() <= MOST_SENT:
        states = F.broadcast(states)
    return records.join(states.select("number", "file"), "number").select(
        "file", "first", F.regexp_replace("record", r"\r?\n?\z", "").alias("record")
    )


def with_first(text: DataFrame) -> DataFrame:
    """``text`` (file, block and more, in the order of reading) with ``first``: whether a row is the first of its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for key, rows in _runs(batch, "file", "block"):
                first = np.zeros(len(rows), bool)
                first[0] = key != held and key[1] == 0
                held = key
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(first)], [*rows.schema.names, "first"])

    return text.mapInArrow(run, T.StructType([*text.schema.fields, T.StructField("first", T.BooleanType())]))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, first (line of the file), record of CSV files whose records are lines; blank lines are left out."""
    return with_first(_csv_text(spark, path)).drop("block")


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(path).where("trim(value) <> ''").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("record"),
    )


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """file, record: the first line of each file that has one, found by the tasks that read its first block."""
    first = _csv_text(spark, path).where("block = 0").withColumn("at", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("record", "at").alias("record"))


def _lengths(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")


def total_bytes(spark: SparkSession, path: str) -> int:
    """What the files at a path add up to; asks the listing only."""
    return _lengths(spark, path).agg(F.sum("length")).first()[0] or 0


def in_one_split(spark: SparkSession, path: str) -> bool:
    """Whether every file is small enough to be one task's input anyway; asks the listing only."""
    largest = _lengths(spark, path).agg(F.max("length")).first()[0] or 0
    return largest <= spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
