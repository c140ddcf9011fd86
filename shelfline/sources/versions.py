"""A Parquet table by one partition column, whose partitions are replaced all at once.

New partitions go to a folder of their own, then a list of which folder holds which partition is put in
place under the next number. Until then readers and repeated runs see the old table, whole.

A writer works on a snapshot and claims the number after it. The claim fails if the number is taken, also where a rename would
put a file in another's place, so two writers never lose each other's change: the later one moves to the next number
if the other replaced partitions it did not look at, and otherwise starts over from what is there now. Lists
and partitions that the last ``keep`` lists do not need are dropped with every change; what a reader of one of these
lists sees stays. A run that broke off leaves a folder that no list names; it goes once it is older than ``ORPHAN_HOURS``.

With ``key`` a table has an index: each run also writes the hashes of the keys in each partition it filled, spread over buckets by
hash. What a run wrote about a partition counts while the list names that run for it, so index and table change in the same
step, nothing is ever looked up in vain for keys that have moved, and partitions written without an index are read themselves.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfline.sources import paths

#: Folders that no list names are left alone for so long, as their writer may still be at work.
ORPHAN_HOURS = 24 * 7


class ConcurrentChange(RuntimeError):
    """Another writer replaced partitions that this one has worked on."""


@dataclass(frozen=True)
class Snapshot:
    """The table under one list: its number (-1 before the first) and the folder of each partition."""

    table: VersionedTable
    number: int
    held: dict[str, str]

    def read(self, schema: T.StructType | str, values: Iterable[str] | None = None) -> DataFrame:
        """All partitions, or those named. ``schema`` holds the partition column, too."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        root, column, spark = self.table.root, self.table.column, self.table.spark
        wanted = sorted(self.held if values is None else set(values) & set(self.held))
        if not wanted:
            return spark.createDataFrame([], schema)
        folders = [f"{root}/data/run={self.held[v]}/{column}={v}" for v in wanted]
        full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        rows = spark.read.schema(full).option("basePath", f"{root}/data").parquet(*folders)
        return rows.select(*schema.names)

    def keys(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The index: (partition column, key hash, bucket), one row per different key of a partition. All buckets, or those named."""
        table = self.table
        runs = table.indexed_runs() & set(self.held.values())
        schema = f"key_hash long, {table.column} string, run string, bucket int"
        if not runs:
            return table.spark.createDataFrame([], schema).drop("run")
        found = table.spark.read.schema(schema).option("basePath", f"{table.root}/keys").parquet(
            *(f"{table.root}/keys/run={run}" for run in sorted(runs))
        )
        if buckets is not None:
            found = found.where(F.col("bucket").isin(sorted(buckets)))
        # one entry per partition of the table
        pairs = [f"{value}/{run}" for value, run in sorted(self.held.items()) if run in runs]
        return found.where(F.concat_ws("/", table.column, "run").isin(pairs)).select(table.column, "key_hash", "bucket")

    def holding(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        """The partitions that hold a key of ``rows``, with repeats: by the index, for its buckets that the keys fall into.

        Partitions without an index are looked through. ``schema`` is that of ``read``. ``rows`` is used twice.
        """
        table = self.table
        wanted = rows.select(table.hash().alias("key_hash"))
        buckets = {r[0] for r in wanted.select(table.bucket(F.col("key_hash"))).distinct().collect()}
        held = self.keys(buckets).select(table.column, "key_hash")
        runs = table.indexed_runs()
        bare = [value for value, run in self.held.items() if run not in runs]
        if bare:
            held = held.unionByName(self.read(schema, bare).select(table.column, table.hash().alias("key_hash")))
        return held.join(wanted, "key_hash", "left_semi").select(table.column)

    def replace(
        self, rows: DataFrame, values: Iterable[str] | None = None, looked_at: Iterable[str] = (), at_all: bool = False
    ) -> None:
        """Put ``rows`` in the place of the partitions named (None: of all); partitions they do not fill are gone.

        ``looked_at`` names further partitions that the rows were made from, ``at_all`` says that they depend on all there are. If one
        of these, of the ones named, or of the ones filled was changed since the snapshot, the table stays as it is and
        ``ConcurrentChange`` is raised.
        """
        table, run = self.table, uuid.uuid4().hex
        folder = f"{table.root}/data/run={run}"
        paths.overwrite_partitions(rows, folder, table.column)
        filled = {p[table.column] for p in paths.partition_values(table.spark, folder, table.column)}
        if table.key and filled:
            table.write_keys(run, rows.schema)
        named = None if values is None else set(values)
        watched = None if named is None or at_all else named | filled | set(looked_at)
        now = self
        while True:
            changed = {v for v in self.held.keys() | now.held.keys() if self.held.get(v) != now.held.get(v)}
            if changed and (watched is None or changed & watched):
                paths.delete(table.spark, folder)
                paths.delete(table.spark, f"{table.root}/keys/run={run}")
                raise ConcurrentChange(f"partitions {sorted(changed)[:5]} of {table.root} were replaced meanwhile")
            kept = {} if named is None else {v: r for v, r in now.held.items() if v not in named}
            if table.claim(now.number + 1, kept | dict.fromkeys(filled, run)):
                break
            now = table.snapshot()
        table.clean()


class VersionedTable:
    def __init__(
        self, spark: SparkSession, root: str, column: str, keep: int = 3, key: Sequence[str] = (), buckets: int = 64
    ):
        self.spark = spark
        self.key = tuple(key)
        self.buckets = buckets
        self.root = root.rstrip("/")
        self.column = column
        self.keep = keep

    def hash(self) -> Column:
        return F.xxhash64(*self.key)

    def bucket(self, key_hash: Column) -> Column:
        return F.pmod(key_hash, F.lit(self.buckets)).cast("int")

    def indexed_runs(self) -> set[str]:
        return {p["run"] for p in paths.partition_values(self.spark, f"{self.root}/keys", "run")}

    def write_keys(self, run: str, schema: T.StructType) -> None:
        """Index what a run has written: its key columns are read back."""
        fields = [*(schema[k] for k in self.key), T.StructField(self.column, T.StringType())]
        rows = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.root}/data/run={run}")
        keys = rows.select(self.column, self.hash().alias("key_hash")).distinct()
        spread = keys.withColumn("bucket", self.bucket(F.col("key_hash")))
        paths.overwrite_partitions(spread, f"{self.root}/keys/run={run}", "bucket")

    def _lists(self) -> list[str]:
        return paths.glob(self.spark, f"{self.root}/list/*.json")

    def snapshot(self) -> Snapshot:
        """The table as it is now."""
        while True:
            lists = self._lists()
            if not lists:
                return Snapshot(self, -1, {})
            try:
                return Snapshot(self, _number(lists[-1]), json.loads(paths.read_text(self.spark, lists[-1])))
            except Exception:
                if lists[-1] in self._lists():  # not one that newer lists have made superfluous meanwhile
                    raise

    def claim(self, number: int, held: dict[str, str]) -> bool:
        """Put a list in place under a number; False if there is one."""
        draft = paths.write_text(self.spark, f"{self.root}/draft/{uuid.uuid4().hex}.json", json.dumps(held, sort_keys=True))
        return paths.move_new(self.spark, draft, f"{self.root}/list/{number:012d}.json")

    def partitions(self) -> dict[str, str]:
        """The folder that holds each partition now."""
        return self.snapshot().held

    def read(self, schema: T.StructType | str, values: Iterable[str] | None = None) -> DataFrame:
        return self.snapshot().read(schema, values)

    def replace(self, rows: DataFrame, values: Iterable[str] | None = None) -> None:
        """As in ``Snapshot``, for rows that were not made from the table."""
        self.change(lambda now: now.replace(rows, values))

    def change(self, work: Callable[[Snapshot], object], attempts: int = 10):
        """Run ``work`` on a snapshot, and again on a new one each time another writer was faster."""
        for left in reversed(range(attempts)):
            try:
                return work(self.snapshot())
            except ConcurrentChange:
                if not left:
                    raise

    def clean(self, keep: int | None = None) -> None:
        """Drop lists but for the last ``keep``, the partitions that none of these names, and old folders without a list."""
        keep = max(1, self.keep if keep is None else keep)
        lists = self._lists()
        kept, past = lists[-keep:], lists[:-keep]
        used, gone = self._named(kept), self._named(past)
        for value, run in sorted(gone - used):
            paths.delete(self.spark, f"{self.root}/data/run={run}/{self.column}={value}")
        runs = {run for _, run in used}
        for run in sorted({run for _, run in gone} - runs):
            paths.delete(self.spark, f"{self.root}/data/run={run}")
            paths.delete(self.spark, f"{self.root}/keys/run={run}")
        # lists last: a run that breaks off here finds the same partitions again
        for path in past:
            paths.delete(self.spark, path)
        oldest = (time.time() - ORPHAN_HOURS * 3600) * 1000
        for kind in ("data/run=*", "keys/run=*", "draft/*.json"):
            for path, modified in paths.glob_times(self.spark, f"{self.root}/{kind}"):
                if modified < oldest and path.rsplit("=", 1)[-1] not in runs:
                    paths.delete(self.spark, path)

    def _named(self, lists: list[str]) -> set[tuple[str, str]]:
        """(partition, run) pairs of some lists; a list that another writer has just dropped names none."""
        found: set[tuple[str, str]] = set()
        for path in lists:
            try:
                found |= set(json.loads(paths.read_text(self.spark, path)).items())
            except Exception:
                if paths.exists(self.spark, path):
                    raise
        return found


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[-1].removesuffix(".json"))
