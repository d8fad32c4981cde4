"""Streaming ingestion of event messages.

A subscription is a streaming query with its own checkpoint, so two of them read one topic independently. Micro-batches
are written to partitions named after the batch: a batch that is repeated after a failure replaces its own output.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from beaconlake import contracts
from beaconlake.contracts import MESSAGE_RETENTION_SECONDS
from beaconlake.operators.skew import small_lookup_join
from beaconlake.plans.warehouse import EXPIRATION_MS, gathered, save_rows
from beaconlake.session import open_files, run_path
from beaconlake.sources.messages import good_rows, parse_messages, quarantined

BATCH = "ingest_batch"
ALL_AVAILABLE = {"availableNow": True}


def consume(
    stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None], trigger: dict = ALL_AVAILABLE
) -> StreamingQuery:
    """Pull subscription: hand every micro-batch with its number to ``fn``."""
    return stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_batch(rows: DataFrame, batch_id: int, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a micro-batch so that repeating it changes nothing."""
    gathered_rows = gathered(rows, *partition_by) if partition_by else rows
    (
        gathered_rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, BATCH)
        .parquet(path)
    )


def at_once(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run writes beside each other: one takes the cores that the last tasks of another leave idle. All end before it does."""
    with ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in started:
        write.result()


def _finished_path(target: str) -> str:
    return f"{target.rstrip('/')}_finished"


def finish_batch(spark: SparkSession, batch_id: int, target: str) -> None:
    """Note that all rows of a micro-batch are in ``target``; a repeated batch notes it again."""
    noted = spark.range(1, numPartitions=1).select(F.lit(int(time.time() * 1000)).alias("finished_ms"))
    write_batch(noted, batch_id, _finished_path(target))


def finished_batches(spark: SparkSession, target: str) -> DataFrame:
    """Numbers of the micro-batches whose rows are all in ``target``."""
    try:
        return spark.read.schema(f"finished_ms BIGINT, {BATCH} BIGINT").parquet(_finished_path(target)).select(BATCH).distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{BATCH} BIGINT")


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Everything that micro-batches have written to ``path``, in the given schema."""
    stored = StructType([*schema.fields, StructField(BATCH, LongType())])
    return spark.read.schema(stored).parquet(path).select(*[F.col(f"`{name}`") for name in schema.names])


def ingest_events(
    messages: DataFrame,
    schema: StructType,
    target: str,
    quarantine: str,
    checkpoint: str,
    drop_unknown_fields: bool = True,
    message_filter: str | None = None,
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Write good messages to a table partitioned by date, and the others with their reason to quarantine.

    Parsing is deterministic, so a bad message is set aside at the first attempt. Every valid message is kept, also a
    late one or a copy: removing copies is a later step.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsing twice took less time than caching the nested rows between the two writes.
        parsed = parse_messages(batch, schema, drop_unknown_fields, message_filter)
        # The session is the stream's own.
        with open_files(batch.sparkSession):
            at_once(
                batch.sparkSession,
                lambda: write_batch(good_rows(parsed, schema), batch_id, target, ("date",)),
                lambda: write_batch(quarantined(parsed), batch_id, quarantine),
            )
        finish_batch(batch.sparkSession, batch_id, target)

    return consume(messages, checkpoint, write, trigger)


def land_messages(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    trigger: dict = ALL_AVAILABLE,
    retention_seconds: int = MESSAGE_RETENTION_SECONDS,
) -> StreamingQuery:
    """Keep the envelopes as they came, by day of publication, for replays within the retention period.

    Files of batches older than that leave the sink's log, so readers no longer see them. The files themselves stay;
    where they should go too, land into a table (``land_into_table``).

    A task with messages of many days sorts them by day in memory, unless its session runs with ``open_files``, which has
    to hold while the stream runs.
    """
    return (
        messages.withColumn("publish_date", F.to_date("publish_time"))
        .writeStream.format("parquet")
        .partitionBy("publish_date")
        .option("path", target)
        .option("retention", f"{retention_seconds}s")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def create_landing(spark: SparkSession, database: str, table: str = "landed_messages") -> str:
    """The table of messages as they came, by day of publication and micro-batch, if it is absent; returns its name."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contracts.schema("event_messages").fields)
    name = f"{database}.{table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, publish_date DATE, {BATCH} BIGINT) USING parquet "
        f"PARTITIONED BY (publish_date, {BATCH}) TBLPROPERTIES ('{EXPIRATION_MS}' = '{MESSAGE_RETENTION_SECONDS * 1000}')"
    )
    return name


def land_into_table(messages: DataFrame, table: str, checkpoint: str, trigger: dict = ALL_AVAILABLE) -> StreamingQuery:
    """As ``land_messages`` into a table of ``create_landing``, whose old days ``expire_partitions`` deletes.

    The table's partitions say what it holds, and no log of the sink lists files: a day can be dropped with its files
    while the stream runs. A repeated micro-batch replaces its own partitions. Reads with a bound on ``publish_date`` do
    not touch the days that go.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("publish_date", F.to_date("publish_time")).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        save_rows(batch.sparkSession, rows, table, overwrite=True)

    return consume(messages, checkpoint, write, trigger)


def fan_out(
    messages: DataFrame,
    checkpoint: str,
    consumers: list[Callable[[DataFrame, int], None]],
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Give every micro-batch to several consumers and read the source once.

    The consumers share a cursor; where they must advance independently, start one ``consume`` for each.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for consumer in consumers:
                consumer(batch, batch_id)
        finally:
            batch.unpersist()

    return consume(messages, checkpoint, write, trigger)


def in_window(landed: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Landed messages published between two times, both included; only the days in between are read."""
    first, last = F.lit(start), F.lit(end)
    rows = landed.where(F.col("publish_time").between(first, last))
    if "publish_date" in landed.columns:
        rows = rows.where(F.col("publish_date").between(F.to_date(first), F.to_date(last))).drop("publish_date")
    return rows


def replay_window(
    landed: DataFrame, schema: StructType, start: datetime, end: datetime, drop_unknown_fields: bool = True
) -> DataFrame:
    """The good rows of the messages published in a window, read again from the landing table."""
    return good_rows(parse_messages(in_window(landed, start, end), schema, drop_unknown_fields), schema)


def replay_into(
    landed: DataFrame,
    schema: StructType,
    start: datetime,
    end: datetime,
    target: str,
    drop_unknown_fields: bool = True,
    message_filter: str | None = None,
) -> None:
    """Add the events of a window's messages that ``target`` lacks; nothing stored is replaced or removed.

    ``target`` is what ``ingest_events`` writes and stays in its layout; parsing options are those it was filled with.
    Only the stored ids of the dates that the window touches are read. The ids are required, so they tell events apart.
    A replay writes under a batch number of its own, made from the window, so repeating one changes nothing.
    """
    spark = landed.sparkSession
    parsed = parse_messages(in_window(landed, start, end), schema, drop_unknown_fields, message_filter)
    try:
        stored = read_batches(spark, target, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None
    # Negative numbers are never a micro-batch's.
    number = -1 - int(zlib.crc32(f"{start.isoformat()} {end.isoformat()}".encode()))
    missing = missing_rows(good_rows(parsed, schema), stored)
    gathered(missing, "date").withColumn(BATCH, F.lit(number).cast("bigint")).write.mode("append").partitionBy(
        "date", BATCH
    ).parquet(target)


def missing_rows(rows: DataFrame, stored: DataFrame | None, path: str | None = None) -> DataFrame:
    """One row per date and event id of ``rows`` that ``stored`` lacks, complete in the shared folder.

    ``rows`` are computed once, and only the stored ids of their dates are read. What is missing is found from the keys
    alone; whole rows are brought together only where some of them have to be left out. ``path`` names a folder for the
    rows that the caller removes.
    """
    keys, path = ["date", "event_id"], path or run_path(rows.sparkSession, "missing")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(rows.schema).parquet(f"{path}/{name}")

    read = kept(rows, "rows")
    missing = read.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    known = None
    if stored is not None:
        dates = read.select("date").distinct()
        known = small_lookup_join(stored.select(*keys), dates, ["date"], "left_semi")
        missing = missing.join(known, keys, "left_anti")
    found, copies = missing.agg(F.count(F.lit(1)), F.sum("copies")).first()
    if not found:
        return read.where(F.lit(False))
    if found == copies == read.count():
        return read
    once = read.dropDuplicates(keys)
    if known is not None:
        once = once.join(known, keys, "left_anti").select(*[F.col(f"`{n}`") for n in rows.columns])
    return kept(once, "missing")


def add_to_table(rows: DataFrame, table: str) -> None:
    """Append the events that a project's table lacks, each once; repeating it after a failure adds only the rest.

    It reads the stored ids of the dates that ``rows`` fall into, so it is meant for a scheduled load of what
    ``ingest_events`` has written since the last one, and not for every micro-batch.
    """
    spark = rows.sparkSession
    save_rows(spark, missing_rows(rows, spark.table(table)), table)


def replay_into_table(
    landed: DataFrame,
    schema: StructType,
    start: datetime,
    end: datetime,
    table: str,
    drop_unknown_fields: bool = True,
    message_filter: str | None = None,
) -> None:
    """As ``replay_into`` for a project's table, such as ``raw_events`` of ``bootstrap``."""
    parsed = parse_messages(in_window(landed, start, end), schema, drop_unknown_fields, message_filter)
    add_to_table(good_rows(parsed, schema), table)
