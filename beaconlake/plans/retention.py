"""Expiry of partitions and tables."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from beaconlake.plans import storage
from beaconlake.plans.warehouse import CREATED_MS, EXPIRATION_MS, PARTITION_TIME, table_properties

# Partition columns that stand for a time, in the order they are looked for.
TIME_COLUMNS = (PARTITION_TIME, "publish_date", "date")
# Partition values of the four units, by length.
FORMATS = {4: "%Y", 7: "%Y-%m", 10: "%Y-%m-%d", 13: "%Y-%m-%d-%H"}


def _end(value: str) -> datetime | None:
    """End of the time a partition value stands for; None for a null or foreign value."""
    if len(value) not in FORMATS or not re.fullmatch(r"[0-9-]+", value):
        return None
    start = datetime.strptime(value, FORMATS[len(value)])
    if len(value) == 4:
        return start.replace(year=start.year + 1)
    if len(value) == 7:
        return (start + timedelta(days=31)).replace(day=1)
    return start + (timedelta(days=1) if len(value) == 10 else timedelta(hours=1))


def expire_partitions(
    spark: SparkSession, table: str, now: date | datetime, expiration_ms: int | None = None
) -> list[str]:
    """Drop the partitions of a table that ended longer ago than its expiry and return them.

    Only partition names are listed, one per hour, day, month or year; the old ones go in one statement, by equality.
    """
    if expiration_ms is None:
        properties = table_properties(spark, table)
        if EXPIRATION_MS not in properties:
            return []
        expiration_ms = int(properties[EXPIRATION_MS])
    if not isinstance(now, datetime):
        now = datetime(now.year, now.month, now.day)
    oldest = now - timedelta(milliseconds=expiration_ms)
    dropped, specs = [], []
    for (name,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in name.split("/"))
        end = _end(next((values[name] for name in TIME_COLUMNS if name in values), ""))
        if end is not None and end <= oldest:
            dropped.append(name)
            specs.append("PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in values.items()) + ")")
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)} PURGE")
    return dropped


def _created(spark: SparkSession, table: str) -> datetime | None:
    """Creation time as ``create_table`` has noted it; None for a table of another origin."""
    noted = table_properties(spark, table).get(CREATED_MS)
    return None if noted is None else datetime.fromtimestamp(int(noted) / 1000, timezone.utc)


def expire_tables(spark: SparkSession, database: str, now: datetime | None = None) -> list[str]:
    """Drop the tables of a database that are older than its default table expiry.

    The age is counted from the time that ``create_table`` and ``materialize`` note in the table's properties. A table
    without one was made by other means and stays. The folders of a materialized table's versions go with it.
    """
    now = now or datetime.now(timezone.utc)
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()}
    found = re.search(r"default_table_expiration_ms\s*,\s*(\d+)", described.get("Properties", ""))
    if not found:
        return []
    limit = now - timedelta(milliseconds=int(found.group(1)))
    dropped = []
    for table in spark.catalog.listTables(database):
        if table.tableType == "VIEW" or table.isTemporary:
            continue
        name = f"`{database}`.`{table.name}`"
        created = _created(spark, name)
        if created is not None and created < limit:
            folders = storage.version_folders(spark, name)
            spark.sql(f"DROP TABLE {name}")
            for folder in folders:
                storage.remove_folder(spark, database, folder)
            dropped.append(table.name)
    return dropped
