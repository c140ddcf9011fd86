"""Change feed into the operational store.

Source files are appended, as they arrived, to a bronze table exactly once: CSV by line, JSON by document. In micro-batches a
stream does that, which knows files by name; polling goes by a ledger of files with their modification time and size, so a file
that changes under its name is read again. A batch step then reads the rows of the batches that are not merged yet, CSV
by the header of each file, and merges them. All steps may be repeated after a failure. CSV values must not hold line breaks.
"""

from __future__ import annotations

import csv
import datetime as dt
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfline.functions import json_payload, record_id
from shelfline.operators.upsert import RecordStore, latest_changes
from shelfline.schemas import ENTITIES, ODS_KEYS, SOURCE_FORMATS
from shelfline.session import ensure_checkpoint_dir
from shelfline.sources import paths
from shelfline.sources.files import CSV_QUOTING, UNCAST
from shelfline.sources.records import MOST_SENT, with_first
from shelfline.streaming.ledger import FileLedger, same_file


# Where a row came from; orders changes of one key that arrive in the same pass.
ARRIVAL = "_arrival"
# Whether a row is the first line of its file.
FIRST = "_first"


def to_records(
    df: DataFrame, system: str, key: str, batch_id: str, now: Column | dt.datetime, *extra: str
) -> DataFrame:
    """Source rows as operational records: derived id, whole row as JSON, without the ``extra`` columns."""
    source_key = F.coalesce(F.col(key).cast("string"), F.lit("")) if key in df.columns else F.lit("")
    payload = json_payload(*(c for c in df.columns if c not in extra))
    return _record(df, system, source_key, payload, F.lit(batch_id), now if isinstance(now, Column) else F.lit(now), *extra)


def _record(
    df: DataFrame, system: str, source_key: Column, payload: Column, batch_id: Column, moment: Column, *extra: str
) -> DataFrame:
    return df.select(
        record_id(F.lit(system), source_key).alias("record_id"),
        F.lit(system).alias("source_system"),
        source_key.alias("source_key"),
        payload.alias("payload"),
        moment.cast("timestamp").alias("upsert_at"),
        batch_id.alias("batch_id"),
        *extra,
    )


def _csv_records(raw: DataFrame, entity: str) -> DataFrame | None:
    """Records from lines of CSV files. Every column of a file is part of the payload, under its own name;
    declared columns have their types, and text that does not fit is kept under ``UNCAST``."""
    system, key = ODS_KEYS[entity]
    filled = raw.withColumn("_file", F.struct(
        F.col(ARRIVAL)["file_path"].alias("path"), F.col(ARRIVAL)["file_modification_time"].alias("modified"), "batch_id"
    ))
    ensure_checkpoint_dir(raw.sparkSession)
    heads = filled.where(FIRST).select("_file", F.col("value").alias("_header")).checkpoint()
    # one row for each different header
    headers = sorted(r[0] for r in heads.select("_header").distinct().collect())
    rows_of = F.broadcast(heads) if heads.count() <= MOST_SENT else heads
    lines = filled.where(~F.col(FIRST)).join(rows_of, "_file")
    records = None
    for header in headers:
        columns = [c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]), [])]
        row = F.from_csv("value", _ddl(columns), CSV_QUOTING)
        rows = lines.where(F.col("_header") == header).select(row.alias("r"), "batch_id", "upsert_at", ARRIVAL).select(
            "r.*", "batch_id", "upsert_at", ARRIVAL
        )
        kinds = {f.name: f.dataType for f in ENTITIES[entity].fields if not isinstance(f.dataType, T.StringType)}
        values, lost = [], []
        for c in columns:
            typed = F.col(c).try_cast(kinds[c]) if c in kinds else F.col(c)
            values.append(typed.alias(c))
            if c in kinds:
                lost.append(F.when((F.trim(F.col(c)) != "") & typed.isNull(), F.struct(F.lit(c).alias("key"), F.col(c).alias("value"))))
        unfit = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<struct<key:string,value:string>>")
        plain = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
        full = F.to_json(F.struct(*values, F.map_from_entries(unfit).alias(UNCAST)), {"ignoreNullFields": "false"})
        source_key = F.coalesce(F.col(key), F.lit("")) if key in columns else F.lit("")
        part = _record(
            rows, system, source_key, F.when(F.size(unfit) > 0, full).otherwise(plain), F.col("batch_id"), F.col("upsert_at"), ARRIVAL
        )
        records = part if records is None else records.unionByName(part)
    return records


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)


def _json_records(raw: DataFrame, entity: str) -> DataFrame:
    """Records from JSON documents: one object, or an array of them, with all their fields."""
    system, key = ODS_KEYS[entity]
    many = F.expr(
        "CASE WHEN left(ltrim(value), 1) = '[' THEN CAST(parse_json(value) AS ARRAY<VARIANT>) ELSE array(parse_json(value)) END"
    )
    rows = raw.select(F.explode(many).alias("row"), "batch_id", "upsert_at", ARRIVAL)
    source_key = F.coalesce(F.try_variant_get("row", f"$.{key}", "string"), F.lit(""))
    return _record(rows, system, source_key, F.to_json("row"), F.col("batch_id"), F.col("upsert_at"), ARRIVAL)


class ChangeFeed:
    """Watches one folder per entity and keeps the operational store up to date."""

    def __init__(self, spark: SparkSession, inbox: Mapping[str, str], root: str, digits: int = 2):
        self.spark = spark
        self.inbox = inbox
        self.root = root.rstrip("/")
        self.store = RecordStore(spark, f"{self.root}/live", digits)

    def _source(self, reader, entity: str, folder: str, batch_id: str, now: dt.datetime) -> DataFrame:
        """The files below a folder as bronze rows. A JSON document may go over many lines, so such a file is one row."""
        whole = SOURCE_FORMATS[entity] == "json"
        meta = F.col("_metadata")
        rows = reader.text(folder, wholetext=whole).select(
            "value", F.lit(batch_id).alias("batch_id"), F.lit(now).cast("timestamp").alias("upsert_at"),
            F.struct(*(meta[c].alias(c) for c in ("file_modification_time", "file_path", "file_block_start", "file_size"))).alias(ARRIVAL),
            meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        ).where(F.trim("value") != "")
        rows = rows.withColumn("first", F.lit(True)) if whole else with_first(rows)
        return rows.drop("file", "block").withColumnRenamed("first", FIRST)

    def append(self, batch_id: str, now: dt.datetime, files_per_batch: int = 1000) -> None:
        """Take in every file that has arrived under a new name since the last call."""
        queries = []
        for entity, folder in self.inbox.items():
            if not paths.exists(self.spark, folder):
                continue
            reader = self.spark.readStream.option("maxFilesPerTrigger", files_per_batch)
            queries.append(
                self._source(reader, entity, folder, batch_id, now).writeStream.format("parquet").outputMode("append")
                .partitionBy("batch_id")
                .option("checkpointLocation", f"{self.root}/progress/{entity}")
                .trigger(availableNow=True)
                .start(f"{self.root}/bronze/{entity}")
            )
        for query in queries:
            query.awaitTermination()

    def ledger(self, entity: str) -> FileLedger:
        return FileLedger(self.spark, f"{self.root}/ledger/{entity}")

    def append_changed(self, batch_id: str, now: dt.datetime) -> bool:
        """Take in every file that is new, or whose modification time or size has changed, since the last call."""
        any_file = False
        for entity, folder in self.inbox.items():
            ledger = self.ledger(entity)
            if batch_id in ledger.committed() or not paths.exists(self.spark, folder):
                continue
            files = ledger.changed(folder)
            oldest = files.agg(F.min(F.unix_seconds("modified"))).first()[0]
            if oldest is None:
                continue
            # the listing leaves out older files; the join leaves out all others that were taken in as they are
            after = dt.datetime.fromtimestamp(oldest - 1, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
            reader = self.spark.read.option("recursiveFileLookup", True).option("modifiedAfter", after).option("timeZone", "UTC")
            rows = self._source(reader, entity, folder, batch_id, now)
            at = F.col(ARRIVAL)
            new = files.select(F.col("path").alias("_path"), F.col("modified").alias("_modified"), F.col("size").alias("_size"))
            new = F.broadcast(new) if new.count() <= MOST_SENT else new
            taken = rows.join(new, (same_file(at["file_path"]) == same_file(F.col("_path")))
                              & (at["file_modification_time"] == F.col("_modified")) & (at["file_size"] == F.col("_size")), "left_semi")
            taken.drop("batch_id").write.mode("overwrite").parquet(f"{self.root}/changed/{entity}/batch_id={batch_id}")
            ledger.commit(batch_id, files, now)
            any_file = True
        return any_file

    def _intakes(self, entity: str) -> dict[str, set[str]]:
        """The whole batches of an entity, by the folder that holds them."""
        streamed = f"{self.root}/bronze/{entity}"
        return {
            streamed: {p["batch_id"] for p in paths.partition_values(self.spark, streamed, "batch_id")},
            f"{self.root}/changed/{entity}": self.ledger(entity).committed(),
        }

    def _waiting(self) -> list[str]:
        found = set().union(*(ids for entity in self.inbox for ids in self._intakes(entity).values()))
        done = {p.rsplit("/", 1)[-1] for p in paths.glob(self.spark, f"{self.root}/merged/*")}
        # By time: ids are a prefix and the moment of the pass.
        return sorted(found - done, key=lambda batch_id: (batch_id.split("_", 1)[-1], batch_id))

    def merge(self) -> list[str]:
        """Merge the waiting batches, oldest first; returns their ids."""
        merged = []
        for batch_id in self._waiting():
            changes = None
            for entity in self.inbox:
                for folder, ids in self._intakes(entity).items():
                    if batch_id not in ids:
                        continue
                    raw = self.spark.read.option("basePath", folder).parquet(f"{folder}/batch_id={batch_id}")
                    read = _csv_records if SOURCE_FORMATS[entity] == "csv" else _json_records
                    part = read(raw, entity)
                    if part is not None:
                        changes = part if changes is None else changes.unionByName(part)
            if changes is None:
                continue
            # The newest file wins; repeats within one file block are settled by content.
            newest = [F.desc("upsert_at"), F.desc(ARRIVAL), F.desc("payload")]
            self.store.merge(latest_changes(changes, newest).drop(ARRIVAL))
            paths.mark(self.spark, f"{self.root}/merged/{batch_id}")
            merged.append(batch_id)
        return merged

    def micro_batch(self, now: dt.datetime, prefix: str = "micro") -> list[str]:
        """One pass over all sources under one batch id."""
        self.append(f"{prefix}_{now:%Y%m%d_%H%M%S}", now)
        return self.merge()

    def poll_once(self, now: dt.datetime) -> list[str]:
        """One pass over the files that are new or have changed under their names."""
        self.append_changed(f"poll_{now:%Y%m%d_%H%M%S}", now)
        return self.merge()

    def poll(self, interval: float, moments: Iterable[dt.datetime] | None = None) -> None:
        """Run a polling pass every ``interval`` seconds, for ever or once per given moment."""
        clock = moments if moments is not None else iter(lambda: dt.datetime.now(dt.timezone.utc), None)
        for now in clock:
            self.poll_once(now)
            time.sleep(interval)
