"""Shards under a byte limit by extendible hashing (DataFrame functions only).

A row's key is 60 bits of a hash of its id and text. The directory has an entry for every prefix of
``bits`` bits and names the bucket that the prefix belongs to; a bucket is a shorter prefix. Starting
from one bucket for everything, only buckets over the limit split on their next bit. The sizes of all
prefixes come from one pass that counts the finest cells and adds them up along their prefixes, so the
number of passes does not grow with the depth; cells that are still too large go on with further bits.

Defined cases: a NULL text has no bytes; a document over the limit gets a bucket of its own; rows equal
in id and text cannot be told apart by any bit, so a bucket of nothing else goes on to overflow pages,
each under the limit or of one row; an empty table gives an empty result. Other columns are carried
by ``shards`` and not read by ``assign``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.native import staged

BITS = 60
#: Bits that the directory has beyond what even buckets would need.
SPARE_BITS = 3
#: Bits that are looked at in each further pass.
STEP_BITS = 12


def key(id_col: Column, text: Column) -> Column:
    """The first 60 bits of a hash of id and text."""
    joined = F.concat_ws("\x1f", F.coalesce(id_col.cast("string"), F.lit("\x1e")), F.coalesce(F.md5(text), F.lit("\x1e")))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def directory(sizes: DataFrame, base: int, bits: int, limit: int) -> DataFrame:
    """cell, depth, bucket_bytes, alone: the bucket of each cell of ``bits`` bits; no depth: not small enough.

    ``sizes``: key, n_bytes of the rows below prefixes of ``base`` bits that are over the limit.
    """
    cells = sizes.groupBy(F.shiftright("key", BITS - bits).alias("cell")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.min("key").alias("lo"), F.max("key").alias("hi")
    )
    along = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(bits)))).withColumn(
        "prefix", F.expr(f"shiftright(cell, {bits} - depth)")
    )
    nodes = along.groupBy("depth", "prefix").agg(
        F.sum("n_bytes").alias("bucket_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    fits = nodes.where((F.col("bucket_bytes") <= limit) | (F.col("lo") == F.col("hi"))).select(
        "depth", "prefix", "bucket_bytes", (F.col("lo") == F.col("hi")).alias("alone")
    )
    found = along.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"], "left")
    first = F.min(F.when(F.col("bucket_bytes").isNotNull(), F.struct("depth", "bucket_bytes", "alone")))
    return found.groupBy("cell").agg(first.alias("b")).select("cell", "b.*")


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with depth, bucket_bytes and alone. ``rows``: key, n_bytes and any others."""
    sizes = staged(rows.select("key", "n_bytes"))
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    base, bits = 0, min(BITS, (total // limit).bit_length() + SPARE_BITS)
    done = []
    while True:
        found = staged(directory(sizes, base, bits, limit))
        cell = F.shiftright("key", BITS - bits).alias("cell")
        done.append(rows.withColumn("cell", cell).join(found.where("depth is not null"), "cell").drop("cell"))
        rest = found.where("depth is null").select("cell")
        if bits == BITS or not rest.take(1):
            break
        sizes = sizes.withColumn("cell", cell).join(rest, "cell", "left_semi").drop("cell")
        base, bits = bits, min(BITS, bits + STEP_BITS)
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return placed


def _paged(placed: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Adds the page: 0, or for buckets of equal rows over the limit, as many rows as fit on each page."""
    over = F.col("alone") & (F.col("bucket_bytes") > limit)
    plain = placed.where(~over).withColumn("page", F.lit(0).cast("long"))
    per = F.greatest(F.floor(F.lit(limit) / F.col("n_bytes")), F.lit(1))
    counted = placed.where(over).groupBy(*group, "key", "n_bytes", "depth", "bucket_bytes", "alone").count()
    pages = counted.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / per))))
    on_page = F.least(per, F.col("count") - F.col("page") * per)
    rows = (
        pages.withColumn("bucket_bytes", on_page * F.col("n_bytes"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), on_page)))
    )
    return plain.unionByName(rows.drop("_copy", "count"))


def _named(paged: DataFrame, *first: Column) -> DataFrame:
    prefix = F.expr(f"CASE WHEN depth = 0 THEN '' ELSE lpad(bin(shiftright(key, {BITS} - depth)), depth, '0') END")
    return paged.select(
        *first, "n_bytes", prefix.alias("bucket"), "depth", "page", F.col("bucket_bytes").alias("shard_bytes")
    )


def assign(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, bucket (its bits), depth, page, shard_bytes: one row per row of ``docs``."""
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), key(F.col(id_col), F.col(text_col)).alias("key"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    ))
    return _named(_paged(_placed(rows, limit), ["doc_id"], limit), F.col("doc_id"))


def shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a struct of all columns of ``docs``) and the columns of ``assign``."""
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), key(F.col(id_col), F.col(text_col)).alias("key"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return _named(_paged(_placed(rows, limit), ["row"], limit), F.col("row"))


def write(docs: DataFrame, folder: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """One folder per shard below ``folder``, with the columns of ``docs``."""
    named = shards(docs, limit, id_col, text_col)
    shard = F.concat(F.lit("b"), F.col("bucket"), F.lit("-"), F.col("page"))
    out = named.select("row.*", shard.alias("_shard")).hint("rebalance", "_shard")
    out.write.partitionBy("_shard").parquet(folder)
