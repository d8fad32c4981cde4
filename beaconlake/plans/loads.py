"""Scheduled loads from what a subscription has written into a project's table, and compaction of closed dates.

The ledger of a table has a row per loaded micro-batch and date, written after the rows. A load reads only the folders of
finished micro-batches that the ledger lacks. If it fails in between, the next one reads the same micro-batches again and
finds their events stored. The ledger also tells the jobs behind it which dates have changed.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from beaconlake.plans import storage
from beaconlake.plans.warehouse import gathered, save_rows
from beaconlake.session import run_path
from beaconlake.streaming.ingest import BATCH, finished_batches, missing_rows

LEDGER = f"{BATCH} BIGINT, `date` DATE, load STRING, loaded_ms BIGINT"

#: Files of a closed date are brought to about this size.
FILE_BYTES = 256 << 20
COMPACTED = "`date` DATE, old_folder STRING, new_folder STRING, compacted_ms BIGINT"


def ledger_table(table: str) -> str:
    database, name = [part.strip("`") for part in table.split(".")]
    return f"`{database}`.`{name}_loads`"


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """Loaded micro-batches with their dates. Rows that came by a replay have no micro-batch."""
    name = ledger_table(table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER}) USING parquet")
    return spark.table(name)


def note_load(spark: SparkSession, table: str, batches: DataFrame) -> str:
    """Enter (micro-batch, date) rows into the table's ledger under a new load and return its name."""
    load = uuid.uuid4().hex
    rows = batches.select(
        F.col(BATCH).cast("bigint"), F.col("date"), F.lit(load), F.lit(int(time.time() * 1000)).cast("bigint")
    )
    ledger(spark, table)
    rows.coalesce(1).write.insertInto(ledger_table(table))
    return load


def note_dates(spark: SparkSession, table: str, dates: Iterable[date]) -> str:
    """Enter dates that were changed by other means than a load, so that the jobs behind it see them."""
    rows = [(None, day) for day in dates]
    return note_load(spark, table, spark.createDataFrame(rows, f"{BATCH} BIGINT, `date` DATE"))


def in_ranges(column: Column, numbers: Sequence[int]) -> Column:
    """Whether a column is one of ``numbers``, as few ranges, so that a long run of numbers stays a short condition."""
    condition, start = F.lit(False), None
    ordered = sorted(set(numbers))
    for i, number in enumerate(ordered):
        start = number if start is None else start
        if i + 1 == len(ordered) or ordered[i + 1] != number + 1:
            condition = condition | column.between(start, number)
            start = None
    return condition


def open_batches(spark: SparkSession, target: str, table: str) -> list[int]:
    """Numbers of the finished micro-batches under ``target`` that ``table`` has not loaded."""
    loaded = ledger(spark, table).select(BATCH).where(F.col(BATCH).isNotNull()).distinct()
    return sorted(row[0] for row in finished_batches(spark, target).join(loaded, BATCH, "left_anti").collect())


def batch_rows(spark: SparkSession, target: str, schema: StructType, batches: Sequence[int]) -> DataFrame:
    """The rows of some micro-batches with their number; only their folders are read."""
    stored = StructType([*schema.fields, StructField(BATCH, LongType())])
    rows = spark.read.schema(stored).parquet(target).where(in_ranges(F.col(BATCH), batches))
    return rows.select(*[F.col(f"`{name}`") for name in schema.names], BATCH)


def load_batches(spark: SparkSession, target: str, schema: StructType, table: str, most: int | None = None) -> list[int]:
    """Add the events of the micro-batches not loaded yet, each event once per date; return their numbers.

    With ``most`` a load takes that many of the oldest, so that a long backlog is worked off in parts.
    """
    batches = open_batches(spark, target, table)[:most]
    if not batches:
        return []
    rows = batch_rows(spark, target, schema, batches)
    _add_missing(spark, rows.drop(BATCH), table)
    # Partition columns only: no rows are read. A micro-batch without good rows has no folder, and is loaded too.
    dates = rows.select(BATCH, "date").distinct()
    numbers = spark.createDataFrame([(number,) for number in batches], f"{BATCH} BIGINT")
    note_load(spark, table, numbers.join(dates, BATCH, "left"))
    return batches


def _add_missing(spark: SparkSession, rows: DataFrame, table: str) -> list[date]:
    """Add the events that the table lacks; returns their dates, which are few. What was written on the way is removed."""
    path = run_path(spark, "load")
    missing = missing_rows(rows, spark.table(table), path)
    try:
        save_rows(spark, missing, table)
        return [row[0] for row in missing.select("date").distinct().collect()]
    finally:
        storage.remove_folder(spark, storage.split_name(spark, table)[0], path)


def replay_dates(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """As ``add_to_table``, with the dates entered into the ledger."""
    note_dates(spark, table, _add_missing(spark, rows, table))


def file_sizes(spark: SparkSession, table: str, before: date) -> DataFrame:
    """(date, files, bytes) of the dates before a day. Only the files' own figures are read."""
    files = spark.table(table).where(F.col("date") < F.lit(before)).select(
        "date", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    )
    return files.groupBy("date", "path").agg(F.max("size").alias("size")).groupBy("date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


def most_files(size: int, file_bytes: int = FILE_BYTES) -> int:
    """How many files a closed date of a size may have."""
    return 2 * max(1, math.ceil(size / file_bytes))


def compact_dates(spark: SparkSession, table: str, before: date, file_bytes: int = FILE_BYTES) -> list[date]:
    """Replace the files of the dates before a day that have too many of them; return those dates.

    New files are complete before the catalog points a date to them, one change per date. A date that got other files
    meanwhile is left for the next run. Folders that a run has replaced are removed by the next one.
    """
    database, name = storage.split_name(spark, table)
    log = f"`{database}`.`{name}_compactions`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {log} ({COMPACTED}) USING parquet")
    outdated = [row[0] for row in spark.table(log).select("old_folder").distinct().collect()]
    crowded = sorted(
        row["date"] for row in file_sizes(spark, table, before).collect() if row.files > most_files(row.bytes, file_bytes)
    )
    moved = _rewrite(spark, table, crowded) if crowded else []
    # The folders of the last run go; those of this one are for the next.
    in_use = {storage.location(spark, table, {"date": str(day)}) for day in [row[0] for row in moved]}
    for folder in outdated:
        if folder not in in_use:
            storage.remove_folder(spark, database, folder)
    now = int(time.time() * 1000)
    rows = spark.createDataFrame([(*row, now) for row in moved], COMPACTED)
    rows.coalesce(1).write.insertInto(log, overwrite=True)
    return [row[0] for row in moved]


def _files(spark: SparkSession, table: str, days: Sequence[date]) -> dict[str, set[str]]:
    found: dict[str, set[str]] = {}
    spark.catalog.refreshTable(table)
    for path in spark.table(table).where(F.col("date").isin(list(days))).inputFiles():
        folder, file = path.rsplit("/", 1)
        found.setdefault(folder.rsplit("/date=", 1)[1], set()).add(file)
    return found


def _rewrite(spark: SparkSession, table: str, days: Sequence[date]) -> list[tuple[date, str, str]]:
    """(date, old folder, new folder) of the dates that were pointed to new files."""
    before = _files(spark, table, days)
    folder = storage.new_folder(spark, table)
    rows = spark.table(table).where(F.col("date").isin(list(days)))
    gathered(rows, "date").write.partitionBy("date").parquet(folder)
    after, moved = _files(spark, table, days), []
    for day in days:
        if before.get(str(day)) != after.get(str(day)):
            continue
        partition = {"date": str(day)}
        old, new = storage.location(spark, table, partition), f"{folder}/date={day}"
        spark.sql(
            f"ALTER TABLE {table} PARTITION ({storage.spec_of(partition)}) SET LOCATION {storage.text(new)}"
        )
        moved.append((day, old, new))
    spark.catalog.refreshTable(table)
    return moved
