"""Mix sources to target weights with a low-discrepancy schedule (DataFrame functions only).

Each source's documents are shuffled by a hash and laid end to end into a stream of words, which is
cut into blocks of ``block`` words. A van der Corput sequence deals the slots of the mix: the point
of slot *i* is its bit-reversed number, and the source whose stretch of the cumulative targets holds
the point gets the slot. The slots of a source, ranked by *i*, take its blocks one after the other;
past the end the stream starts again. Targets that are over ``cap`` times the size of a source are
cut to it and the excess is shared again by weight.

Defined cases: a NULL text or one without words has size 0 and takes nothing; a NULL source is a
source of its own, last in order; equal rows are told apart by their place in the stream, and as a set
the result does not depend on which is which; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.native import WORDS, staged

#: Rows that share one range of the shuffle, and so one task's running sum, on average.
RANGE_ROWS = 4096
#: Slots of a source that share one range of the schedule, on average.
RANGE_SLOTS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def shuffle_key(*columns: Column) -> Column:
    """60 bits that place a row in the shuffle."""
    joined = F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x1e")) for c in columns))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Words each source gives. ``sizes``: source, source_size; one row per source.

    Weights go round over the sources in code-point order. In the order of cap per weight the
    capped sources come first, so one running sum finds where the caps end.
    """
    cycle = F.array(*(F.lit(w) for w in weights))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    ranked = sizes.withColumn("sid", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int")).cast("double")
    )
    limit = F.col("source_size") * F.lit(cap)
    order = Window.orderBy(limit / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    wanted = F.sum("source_size").over(whole) * F.lit(share)
    return (
        ranked.withColumn("wanted", wanted)
        .withColumn("left", F.col("wanted") - F.coalesce(F.sum(limit).over(before), F.lit(0.0)))
        .withColumn("capped", limit * F.sum("weight").over(after) <= F.col("left") * F.col("weight"))
        .withColumn("free", F.col("wanted") - F.sum(F.when(F.col("capped"), limit).otherwise(0.0)).over(whole))
        .withColumn("shared", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(whole))
        .withColumn("target", F.when(F.col("capped"), limit).otherwise(F.col("free") * F.col("weight") / F.col("shared")))
        .select("sid", "source", "source_size", "target")
    )


def _running(df: DataFrame, group: str, place: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of ``group`` before this one, by ranges of ``place``."""
    within = Window.partitionBy(group, place).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = df.groupBy(group, place).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(group, place, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inner = df.withColumn("_within", F.sum(value).over(within) - value)
    # the optimiser takes exploded rows for few: no broadcast on its estimate
    return inner.join(ranges.hint("merge"), [group, place]).withColumn(name, F.col("_before") + F.col("_within")).drop(
        "_before", "_within"
    )


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """Slots of the mix: slot, sid, rank and the stretch [from_word, to_word) of the source's stream.

    With 2^k slots the bit-reversed numbers are the numbers 0 … 2^k - 1, so each source's slots are
    found from its stretch of them, without comparing slots with sources.
    """
    need = F.ceil(F.floor("target") / F.lit(block)).cast("long")
    whole = Window.partitionBy()
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretch = (
        sources.withColumn("need", need)
        .withColumn("all", F.sum("need").over(whole))
        .where("need > 0")
        .withColumn("bits", F.greatest(F.ceil(F.log2(F.col("all"))), F.lit(1)).cast("int"))
        .withColumn("points", F.expr("shiftleft(1L, bits)"))
        .withColumn("upto", F.sum("need").over(upto))
        # points * upto may exceed a long; decimals keep it whole
        .withColumn("hi", F.ceil(F.col("upto").cast("decimal(19,0)") * F.col("points").cast("decimal(19,0)") / F.col("all")).cast("long"))
        .withColumn("lo", F.ceil((F.col("upto") - F.col("need")).cast("decimal(19,0)") * F.col("points").cast("decimal(19,0)") / F.col("all")).cast("long"))
        .withColumn("rough", F.greatest(F.ceil(F.log2(F.col("all") / RANGE_SLOTS)), F.lit(0)).cast("int"))
    )
    parts = stretch.withColumn("first", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(1 << 14)))).repartition("first")
    points = parts.withColumn("point", F.explode(F.sequence("first", F.least(F.col("first") + (1 << 14), F.col("hi")) - 1)))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), F.col("bits"), F.lit("0"))), 2, 10).cast("long")
    slots = points.withColumn("slot", slot).withColumn("range", F.expr("shiftright(slot, bits - least(rough, bits))"))
    ranked = _running(slots.select("sid", "need", "target", "slot", "range"), "sid", "range", ["slot"], F.lit(1).cast("long"), "rank")
    return ranked.where("rank < need").select(
        "slot",
        "sid",
        "rank",
        (F.col("rank") * block).alias("from_word"),
        F.least((F.col("rank") + 1) * block, F.floor("target").cast("long")).alias("to_word"),
    )


def streams(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their place in their source's stream, and the sources with their targets.

    Documents: doc_id, sid, source_size, target, size, start. The text is read once; what is kept is
    a number or two per row.
    """
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")
    ))
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = staged(targets(per_source, weights, share, cap))
    bits = max(0, (max(1, rows.count()) // RANGE_ROWS).bit_length())
    keyed = (
        rows.withColumn("key", shuffle_key(F.col("doc_id"), F.col("source"), F.col("size")))
        .withColumn("range", F.shiftright("key", 60 - bits))
    )
    named = sources.withColumnRenamed("source", "_source")
    placed = keyed.join(named, keyed["source"].eqNullSafe(named["_source"])).drop("_source")
    return _running(placed, "sid", "range", ["key", "doc_id", "size"], F.col("size"), "start"), sources


def pieces(docs: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """Stretches of documents in the slots of the mix; documents that the mix leaves out have no slot.

    A document lies once in every round of its source's stream and is cut where blocks end, so that
    documents and slots meet on (source, block number).
    """
    rounds = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("target") / F.col("source_size")) - 1, F.lit(0)))
    laid = docs.where("size > 0").withColumn("round", F.explode(rounds.cast("array<long>"))).withColumn(
        "at", F.col("start") + F.col("round") * F.col("source_size")
    )
    cut = laid.withColumn(
        "rank", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)))
    )
    joined = cut.join(schedule(sources, block).hint("merge"), ["sid", "rank"], "left")
    first = F.greatest("at", "from_word")
    last = F.least(F.col("at") + F.col("size"), F.col("to_word"))
    return joined.withColumn("first_word", first - F.col("at")).withColumn(
        "n_words", F.when(F.col("slot").isNotNull(), F.greatest(last - first, F.lit(0))).otherwise(0).cast("long")
    )


def taken(docs: DataFrame, block: int = 1000, with_source: bool = False, **named) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source): one row per row of ``docs``."""
    placed, sources = streams(docs, **named)
    summed = (
        pieces(placed, sources, block)
        .groupBy("sid", "source", "start", "doc_id", "size", "source_size", "target")
        .agg(F.sum("n_words").alias("taken"))
    )
    columns = ["doc_id", "size", "source_size", "target", "taken", *(["source"] if with_source else [])]
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return summed.select(*columns).unionByName(empty.select(*columns))


def mixed(docs: DataFrame, block: int = 1000, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", **named) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole, rounded to the nearest number.

    Only the document on which a source's target ends is taken in part, so rounding moves a source by
    half a document. Rows that agree in id, source and size lie side by side in the stream and get the
    mean of their numbers.
    """
    counts = taken(docs, block, id_col=id_col, text_col=text_col, source_col=source_col, with_source=True, **named)
    times = counts.where("size > 0").groupBy("doc_id", "source", "size").agg(
        F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("times")
    ).where("times > 0")
    row = F.struct(*docs.columns).alias("row")
    sized = docs.select(row, words(F.col(text_col)).alias("n")).where("n > 0")
    match = (
        F.col("row")[id_col].eqNullSafe(F.col("doc_id"))
        & F.col("row")[source_col].eqNullSafe(F.col("source"))
        & (F.col("n") == F.col("size"))
    )
    return sized.join(times, match).select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
