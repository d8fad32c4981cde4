"""Copies of events that came in earlier loads, found in a table of the ids that are stored already.

The table is bucketed by event id. New events are brought together by id once and meet the stored ids where they lie, so
history is read (its ids only) but never shuffled, however long it is. The rule is that of ``dedupe_events``: of the rows
with one id the one with the smallest ``timestamp`` stays, then the one with the smallest row hash, whichever came first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.operators.skew import MAX_BROADCAST_ROWS

SEEN = "event_id STRING, `date` DATE, `timestamp` BIGINT, row_hash BIGINT"
VERSION = "version"
BUCKETS = 200


def create_seen(spark: SparkSession, table: str, buckets: int = BUCKETS) -> None:
    """The table of stored ids, if it is absent. Each load adds a partition of its own, so a load can be repeated."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({SEEN}, {VERSION} INT) USING parquet PARTITIONED BY ({VERSION}) "
        f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {buckets} BUCKETS"
    )


def first_rows(events: DataFrame) -> DataFrame:
    """(event_id, row, age): the first row of each id. Copies are combined before rows are brought together."""
    columns = [F.col(f"`{name}`") for name in events.columns]
    age = F.struct(F.col("timestamp"), F.xxhash64(*columns).alias("row_hash"))
    return events.where("event_id is not null").groupBy("event_id").agg(
        F.min_by(F.struct(*columns), age).alias("row"), F.min(age).alias("age")
    )


def bucket_count(spark: SparkSession, table: str) -> int:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return int(next(row.data_type for row in details if row.col_name == "Num Buckets"))


def meet_buckets(rows: DataFrame, column: str, buckets: int) -> DataFrame:
    """``rows``, aggregated by ``column``, in as many partitions as a table has buckets, for a join with it.

    Left to itself, Spark shuffles the table where its buckets are fewer than the session's shuffle partitions.
    """
    same = rows.sparkSession.conf.get("spark.sql.shuffle.partitions") == str(buckets)
    return rows if same else rows.repartition(buckets, column)


def new_events(events: DataFrame, seen: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``events`` that are first of their id, also against the stored ids ``seen`` in ``buckets`` buckets.

    Two columns are added: ``row_hash``, and ``replaces``, the date of a stored row that a kept one comes before. A row
    that is stored itself (a date is read again) is kept. The ids alone say which rows have to be compared, with each other
    or with a stored one: where those are few, all other rows stay where they are. ``events`` is read once for its ids and
    once for its rows; rows without an id all stay and are read apart, which costs nothing where there are none.
    """
    named = events.where("event_id is not null")
    # A table of all ids is no side to broadcast, and a merge join uses its buckets.
    ids = meet_buckets(named.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies")), "event_id", buckets)
    old = seen.select(F.col("event_id").alias("_stored")).distinct().hint("merge")
    compared = ids.join(old, F.col("event_id") == F.col("_stored"), "left").where("copies > 1 or _stored is not null")
    compared = compared.select("event_id").checkpoint()
    several = compared.count()
    alone, rest = None, named
    # A row's hash depends on the order of its columns, which a join by name changes.
    columns = [F.col(f"`{name}`") for name in events.columns]
    if several <= MAX_BROADCAST_ROWS:
        alone, rest = (named.join(F.broadcast(compared), "event_id", how).select(*columns) for how in ("left_anti", "left_semi"))
    stored = seen.groupBy("event_id").agg(F.min(F.struct("timestamp", "row_hash", "date")).alias("stored"))
    stored_age = F.struct("stored.timestamp", "stored.row_hash")
    met = meet_buckets(first_rows(rest), "event_id", buckets).join(stored.hint("merge"), "event_id", "left")
    kept = met.where(F.col("stored").isNull() | (F.col("age") <= stored_age)).select(
        "row.*", F.col("age.row_hash").alias("row_hash"), F.when(F.col("age") < stored_age, F.col("stored.date")).alias("replaces")
    )
    if alone is not None:
        single = alone.select(*columns, F.xxhash64(*columns).alias("row_hash"), F.lit(None).cast("date").alias("replaces"))
        kept = single if not several else kept.unionByName(single)
    nameless = events.where("event_id is null").select(
        "*", F.lit(None).cast("bigint").alias("row_hash"), F.lit(None).cast("date").alias("replaces")
    )
    return kept.unionByName(nameless)


def remember(spark: SparkSession, kept: DataFrame, table: str, version: int) -> None:
    """Add the ids of rows that ``new_events`` kept; repeating a version replaces what it added."""
    ids = kept.where("event_id is not null").select("event_id", "date", "timestamp", "row_hash", F.lit(version).alias(VERSION))
    save_bucketed(spark, ids, table, "event_id")


def save_bucketed(spark: SparkSession, rows: DataFrame, table: str, column: str) -> None:
    """Write the partitions that ``rows`` fall into, with one file per bucket."""
    buckets = bucket_count(spark, table)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.repartition(buckets, column).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
