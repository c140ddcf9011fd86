"""Customer history: slowly changing dimension, type 2."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.schemas import EXEC_DATE
from shelfline.sources.versions import Snapshot, VersionedTable

VALID_FROM, VALID_TO = "dbt_valid_from", "dbt_valid_to"
ATTRIBUTES = (
    "customer_id", "first_name", "last_name", "email", "country", "city", "signup_date", "age", "gender",
)
HISTORY = (*ATTRIBUTES, EXEC_DATE, "dbt_scd_id", VALID_FROM, VALID_TO, "dbt_updated_at")
HISTORY_ROWS = (
    "customer_id string, first_name string, last_name string, email string, country string, city string, "
    f"signup_date date, age int, gender string, {EXEC_DATE} date, dbt_scd_id string, {VALID_FROM} date, "
    f"{VALID_TO} date, dbt_updated_at date, closed_on string"
)


def _version_columns(df: DataFrame) -> DataFrame:
    key = F.concat_ws("|", F.col("email"), F.col(VALID_FROM).cast("string"))
    return (
        df.withColumn("dbt_scd_id", F.md5(key))
        .withColumn("dbt_updated_at", F.col(EXEC_DATE))
        .select(*HISTORY)
    )


def batch_calendar(batches: DataFrame) -> DataFrame:
    """Each batch date with the next one: one row per date, however large the batches."""
    # The window runs over the distinct dates only.
    days = batches.select(EXEC_DATE).distinct()
    return days.withColumn("next_batch", F.lead(EXEC_DATE).over(Window.orderBy(EXEC_DATE)))


def versions(batches: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """History in which every batch opens a version of each key it holds.

    A version ends at the next batch, whether the key is still there (superseded) or
    gone (hard delete). ``batches`` is the staged data of all batches. Pass the raw
    table's calendar when staging can empty a batch.
    """
    steps = batch_calendar(batches) if calendar is None else calendar
    dated = batches.join(steps, EXEC_DATE, "left")
    return _version_columns(
        dated.withColumn(VALID_FROM, F.col(EXEC_DATE)).withColumnRenamed("next_batch", VALID_TO)
    )


def add_batch(history: DataFrame, batch: DataFrame, day: dt.date) -> DataFrame:
    """Apply one staged batch to the history. No join: all older open versions end at ``day``.

    Applying the same day again gives the same table.
    """
    older = history.where(F.col(VALID_FROM) < F.lit(day))
    closing = F.col(VALID_TO).isNull() | (F.col(VALID_TO) == F.lit(day))
    closed = older.withColumn(VALID_TO, F.when(closing, F.lit(day)).otherwise(F.col(VALID_TO)))
    opened = batch.withColumn(EXEC_DATE, F.lit(day)).withColumn(VALID_FROM, F.lit(day)).withColumn(
        VALID_TO, F.lit(None).cast("date")
    )
    return closed.select(*HISTORY).unionByName(_version_columns(opened))


def _same_attributes(left: str, right: str):
    same = F.lit(True)
    for column in ATTRIBUTES:
        same = same & F.col(f"{left}{column}").eqNullSafe(F.col(f"{right}{column}"))
    return same


def changed_versions(batches: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """History in which a version opens only when an attribute changes or the key returns.

    The window per email holds one row per batch the email appears in.
    """
    steps = batch_calendar(batches) if calendar is None else calendar
    dated = batches.join(steps, EXEC_DATE, "left")
    by_email = Window.partitionBy("email").orderBy(EXEC_DATE)
    state = F.struct(*ATTRIBUTES)
    marked = (
        dated.withColumn("_before", F.lag(F.struct(state.alias("s"), F.col("next_batch"))).over(by_email))
        .withColumn(
            "_opens",
            F.col("_before").isNull()
            | ~F.col("_before.next_batch").eqNullSafe(F.col(EXEC_DATE))
            | ~F.col("_before.s").eqNullSafe(state),
        )
        .withColumn("_run", F.count_if("_opens").over(by_email))
    )
    # A run of unchanged, adjacent batches is one version: it starts at its first
    # batch and ends after its last one.
    runs = Window.partitionBy("email", "_run")
    spans = marked.withColumn(
        "_last", F.max(F.struct(F.col(EXEC_DATE), F.col("next_batch"))).over(runs)
    ).where("_opens")
    return _version_columns(
        spans.withColumn(VALID_FROM, F.col(EXEC_DATE)).withColumn(VALID_TO, F.col("_last.next_batch"))
    )


def add_changed_batch(history: DataFrame, batch: DataFrame, day: dt.date) -> DataFrame:
    """Apply one staged batch, opening versions only for new or changed keys.

    ``history`` is a stored table; only its open rows take part in the join, and one join
    yields both the rows that stay and the rows that open.
    """
    today = F.lit(day)
    # Undo an earlier application of the same day.
    before = history.where(F.col(VALID_FROM) < today).withColumn(
        VALID_TO, F.when(F.col(VALID_TO) != today, F.col(VALID_TO))
    )
    done = before.where(F.col(VALID_TO).isNotNull()).select(*HISTORY)
    old = before.where(F.col(VALID_TO).isNull()).select(F.struct(*HISTORY).alias("o"))
    fresh = batch.withColumn(EXEC_DATE, today).withColumn(VALID_FROM, today).withColumn(
        VALID_TO, F.lit(None).cast("date")
    )
    new = _version_columns(fresh).select(F.struct(*HISTORY).alias("n"))
    # NULL-safe, because a missing email is a key like any other here.
    pairs = old.join(new, F.col("o.email").eqNullSafe(F.col("n.email")), "full")
    known, present = F.col("o").isNotNull(), F.col("n").isNotNull()
    unchanged = known & present & _same_attributes("o.", "n.")
    ended = F.col("o").withField(VALID_TO, F.when(~unchanged, today))
    rows = F.array_compact(F.array(F.when(known, ended), F.when(present & ~unchanged, F.col("n"))))
    return done.unionByName(pairs.select(F.inline(rows)))


class HistoryTable:
    """A stored history, partitioned by the day its versions were closed.

    One batch only touches the open versions and the day it closes some of them; versions
    closed earlier are never read or written again.
    """

    PART = "closed_on"
    OPEN = "open"

    def __init__(self, spark: SparkSession, path: str, changes_only: bool = False):
        self.spark = spark
        self.path = path
        self.step = add_changed_batch if changes_only else add_batch

        self.table = VersionedTable(spark, path, self.PART)

    def read(self) -> DataFrame:
        return self.table.read(HISTORY_ROWS).drop(self.PART)

    def apply(self, batch: DataFrame, day: dt.date) -> None:
        """Bring the history to ``day``, the newest or the last applied one."""
        self.table.change(lambda now: self._apply(now, batch, day))

    def _apply(self, now: Snapshot, batch: DataFrame, day: dt.date) -> None:
        today = f"{day:%Y-%m-%d}"
        if any(d > today for d in set(now.held) - {self.OPEN}):
            raise ValueError(f"history is already past {day}")
        # Versions closed today are open again before today's batch is applied.
        changing = (self.OPEN, today)
        current = now.read(HISTORY_ROWS, changing).drop(self.PART)
        part = F.coalesce(F.col(VALID_TO).cast("string"), F.lit(self.OPEN))
        # A repeated run may close nothing, an empty batch leaves nothing open.
        now.replace(self.step(current, batch, day).withColumn(self.PART, part), changing)


def as_of(facts: DataFrame, history: DataFrame, key: str, day: str, calendar: DataFrame) -> DataFrame:
    """Each fact with the version of its key that was valid on its date (left join).

    For any history, one with a version per batch or per change. The date is first mapped to the
    batch in force, by a table of one row per batch. The distinct pairs of key and batch are then
    sorted together with the versions of the key, and each pair takes the last version before it;
    pairs meet their versions first, so facts are shuffled for one join, on equality. A key with many facts
    and many versions never forms their product: what is sorted per key is bounded by the calendar.

    Dates without a batch stay in all branches and match nothing: a filter on them would reach the facts of one
    branch only, and these would be made twice.
    """
    # Days and batch dates merged into one sorted list: every day takes the last batch
    # before it. The list has one row per calendar day, so one task may sort it.
    days = facts.select(F.col(day).alias("_day")).distinct()
    marks = days.withColumn("_mark", F.lit(None).cast("date")).unionByName(
        calendar.select(F.col(EXEC_DATE).alias("_day"), F.col(EXEC_DATE).alias("_mark"))
    )
    so_far = Window.orderBy(F.col("_day"), F.col("_mark").asc_nulls_last())
    in_force = (
        marks.withColumn("_batch", F.last("_mark", ignorenulls=True).over(so_far))
        .where(F.col("_mark").isNull()).select("_day", "_batch")
    )
    placed = facts.join(F.broadcast(in_force), F.col(day) == F.col("_day"), "left").drop("_day")
    none = F.lit(None).cast("date")
    pairs = placed.select(F.col(key).alias("_key"), "_batch").distinct()
    line = pairs.select("_key", F.col("_batch").alias("_at"), none.alias("_from"), none.alias("_to")).unionByName(
        history.select(
            F.col(key).alias("_key"), F.col(VALID_FROM).alias("_at"), F.col(VALID_FROM).alias("_from"), F.col(VALID_TO).alias("_to")
        )
    )
    of_key = Window.partitionBy("_key").orderBy(F.col("_at"), F.col("_from").asc_nulls_last())
    version = F.last(F.when(F.col("_from").isNotNull(), F.struct("_from", "_to")), ignorenulls=True).over(of_key)
    valid = (
        line.withColumn("_v", version).where("_from is null and (_v._to is null or _v._to > _at)")
        .select("_key", "_at", F.col("_v._from").alias("_start")).where("_start is not null")
    )
    renamed = history.withColumnsRenamed({c: f"v_{c}" for c in history.columns})
    versions = valid.join(renamed, (F.col("_key") == F.col(f"v_{key}")) & (F.col("_start") == F.col(f"v_{VALID_FROM}")))
    matched = placed.join(versions, (F.col(key) == F.col("_key")) & (F.col("_batch") == F.col("_at")), "left")
    return matched.drop("_key", "_at", "_batch", "_start")
