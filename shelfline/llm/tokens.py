"""Token ids in files: frequency-ranked numbers in byte-aligned variable-length coding.

Documents are dealt over ascending ranges of their ids, tokenised once and cut into blocks of whole
documents. The ids of the whole corpus are counted, the most frequent id gets rank 0, and each block is
written as its ranks in one to four little-endian bytes. The lengths stand apart, in control bytes of
four two-bit codes, so a block is decoded with two table lookups per control byte and no branches.

A folder holds ``blocks`` (Parquet: part, block, doc_ids, n_tokens, control, data; one row per block, in
order of part and block) and ``ranks`` (Parquet: rank, id).

Defined cases: a NULL text is empty and has the end id alone; a NULL id comes first; rows with the same
id keep the order of the table's files; a block holds one document at least, however long; an
empty table gives an empty folder of both tables, which reads back as no rows. Only id and text are read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm import arrays
from shelfline.session import scratch_path
from shelfline.sources import paths

#: Ids in a block, but for documents that are longer.
BLOCK_IDS = 1 << 17
#: Pieces of words that a Python worker remembers, and as many words that are not split here; longer ones are encoded each time.
CACHED_WORDS = 800_000
CACHED_LENGTH = 64

# The split pattern of the word tokenizer, and the same within ASCII and the letters of Latin-1.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NARROW = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \t\n\x0b\x0c\ra-z0-9ß-öø-ÿ]+")
_SIMPLE = re.compile(r"[ \t\n\x0b\x0c\r!-~À-ÖØ-öø-ÿ]*")


class _Pieces(dict):
    """The ids of pieces of words, as bytes. A piece that is not there is encoded."""

    def __init__(self, model, kind: str) -> None:
        super().__init__()
        from tokenizers import pre_tokenizers

        self.model = model
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.code = "H" if kind == "<u2" else "I"

    def __missing__(self, piece: str) -> bytes:
        found = self.model.tokenize(piece if piece.isascii() else self.level.pre_tokenize_str(piece)[0][0])
        ids = struct.pack(f"<{len(found)}{self.code}", *[t.id for t in found])
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[piece] = ids
        return ids


class _Words(dict):
    """The ids of words, as bytes. A word that is not there is encoded."""

    def __init__(self, spec: str, kind: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.kind = kind
        self.tokenizer = Tokenizer.from_str(spec)
        self.pieces = _Pieces(self.tokenizer.model, kind)
        self.narrow = WORD_PATTERN in [
            p.get("pattern", {}).get("Regex") for p in (json.loads(spec)["pre_tokenizer"] or {}).get("pretokenizers", [])
        ]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def simple(self, text: str) -> bytes | None:
        """The ids of one or many words that the narrow pattern splits, or None."""
        # the letters of Latin-1 have no other normal form, and their lower case is one letter
        if not self.narrow or "<|" in text or not _SIMPLE.fullmatch(text):
            return None
        return b"".join(map(self.pieces.__getitem__, _NARROW.findall(text.lower())))

    def words(self, raw: bytes) -> bytes:
        """The ids of a text, word by word where it is not simple as a whole."""
        ids = self.simple(raw.decode())
        return b"".join(map(self.__getitem__, raw.split())) if ids is None else ids

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        ids = self.simple(text)
        if ids is None:
            ids = self.whole(text)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class _Worker:
    """The tokenizer of a Python worker, kept from task to task."""

    held: tuple[int, _Words] | None = None

    @classmethod
    def of(cls, spec: str, kind: str) -> _Words:
        key = hash((spec, kind))
        if cls.held is None or cls.held[0] != key:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            cls.held = key, _Words(spec, kind)
        return cls.held[1]


_BLOCKS = "part long, block long, doc_ids array<{}>, n_tokens array<long>, ids binary"


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, by_words: bool, id_col: str, text_col: str) -> DataFrame:
    """Blocks of ids in ascending order of document id: part, block, doc_ids, n_tokens, ids.

    ``by_words``: the tokenizer drops white space, so a text's ids are those of its words in order.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one file of fixed size
    top = max(end_id, *json.loads(spec)["model"]["vocab"].values(), *(t["id"] for t in json.loads(spec)["added_tokens"]))
    kind = "<u2" if top < 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    in_order = rows.repartitionByRange(F.asc_nulls_first("doc_id"), "row").sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "row"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _Worker.of(shared.value, kind), np.array([end_id], kind).tobytes()
        part, block, ids, held, counts, size = TaskContext.get().partitionId(), 0, [], [], [], 0
        id_kind = None

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([held], pa.list_(id_kind)),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([b"".join(ids)], pa.binary())],
                ["part", "block", "doc_ids", "n_tokens", "ids"],
            )

        for piece in arrays.slices(batches, "text"):
            id_kind = piece.schema.field("doc_id").type
            data, offsets = arrays.text_bytes(piece.column("text"))
            raw = data.tobytes()
            for i, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                own = raw[offsets[i]: offsets[i + 1]]
                coded = (words.words(own) if by_words else words.whole(own.decode())) + end
                n = len(coded) // len(end)
                if held and size + n > BLOCK_IDS:
                    yield full()
                    block, ids, held, counts, size = block + 1, [], [], [], 0
                ids.append(coded)
                held.append(doc_id)
                counts.append(n)
                size += n
        if held:
            yield full()

    return in_order.mapInArrow(run, _BLOCKS.format(id_type)).withMetadata("ids", {"kind": kind})


def counts(blocks: DataFrame, kind: str) -> DataFrame:
    """id, n: how often each id occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                more = np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=len(total))
                more[: len(total)] += total
                total = more
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    return blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# lengths of the four numbers of a control byte
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of numbers below 2^32; the last control byte is filled with zeros."""
    values = values.astype("<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = codes
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4)[None, :] <= codes[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers that ``pack`` was given."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    starts = ends - lengths
    out = raw[starts]
    for k in (1, 2, 3):
        out |= np.where(lengths > k, raw[starts + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, by_words: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all documents to ``folder``."""
    spark = docs.sparkSession
    blocks = tokenise(docs, tokenizer, end_id, by_words, id_col, text_col)
    kind = blocks.schema["ids"].metadata["kind"]
    raw = scratch_path(spark, "token-ids")
    blocks.write.option("compression", "zstd").parquet(raw)
    blocks = spark.read.parquet(raw)
    # as many rows as the vocabulary has at most
    ranked = [r.id for r in counts(blocks, kind).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(list(enumerate(ranked)), "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    ranks = np.zeros(max(ranked, default=0) + 1, np.uint32)
    ranks[ranked] = np.arange(len(ranked), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                control, data = pack(shared.value[np.frombuffer(row.column("ids")[0].as_buffer(), kind)])
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c) for c in ("part", "block", "doc_ids", "n_tokens")),
                     pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                    ["part", "block", "doc_ids", "n_tokens", "control", "data"],
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema if f.name != "ids")
    packed = blocks.mapInArrow(run, f"{schema}, control binary, data binary")
    packed.write.option("compression", "none").parquet(f"{folder}/blocks")
    paths.delete(spark, raw)


def _decoded(spark: SparkSession, folder: str):
    """The blocks of a folder, and a function that turns a block's row into its ids."""
    # as many rows as the vocabulary has at most
    order = [r.id for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    shared = spark.sparkContext.broadcast(np.array(order, "<u4"))

    def ids(control, data, n: int) -> np.ndarray:
        return shared.value[unpack(control, data, n)]

    return spark.read.parquet(f"{folder}/blocks"), ids


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and its ids, as an array: one row per document."""
    blocks, decode = _decoded(spark, folder)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                counts = np.array(batch.column("n_tokens")[i].as_py(), np.int64)
                ids = decode(batch.column("control")[i].as_buffer(), batch.column("data")[i].as_buffer(), counts.sum())
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int64)))],
                    ["doc_id", "ids"],
                )

    return blocks.mapInArrow(run, f"doc_id {id_type}, ids array<long>")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32: one row per document."""
    blocks, decode = _decoded(spark, folder)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each task that wrote
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at_part = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at_part"))
    starts = sizes.withColumn("in_part", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(at_part, "part").select(
        "part", "block", (F.col("at_part") + F.col("in_part")).alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                counts = np.array(batch.column("n_tokens")[i].as_py(), np.int64)
                ids = decode(batch.column("control")[i].as_buffer(), batch.column("data")[i].as_buffer(), counts.sum())
                bounds = np.concatenate([[0], np.cumsum(counts)])
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column("part")[i].as_py())), pa.array(np.full(n, batch.column("block")[i].as_py())),
                     batch.column("doc_ids")[i].values, pa.array(bounds[:-1]), pa.array(counts), pa.array(crc, pa.int64())],
                    ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    digests = blocks.mapInArrow(run, f"part long, block long, doc_id {id_type}, within long, n_tokens long, ids_crc32 long")
    return digests.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode(docs: DataFrame, tokenizer: str, folder: str | None = None, **named) -> DataFrame:
    """Write the files, below the shared folder if no other is named, and read back their index."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    write(docs, folder, tokenizer, **named)
    return index(spark, folder)
