"""SQL text materialized into tables, and the records of such jobs. No timer: the schedule is kept as metadata."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.plans import storage
from beaconlake.plans.warehouse import CREATED_MS, gathered, table_properties

DISPOSITIONS = ("WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_EMPTY")

# Defaults of a scheduled query.
DEFAULT_TEMPLATE = "scheduled_{run_date}"
DEFAULT_SCHEDULE = "every 24 hours"

# Properties that the catalog sets itself, by name.
OWN_PROPERTIES = ("transient_lastDdlTime", "last_modified_time", "last_modified_by", "numFiles", "totalSize", "numRows", "rawDataSize")

JOB_RECORD = (
    "display_name STRING, query STRING, database STRING, destination_template STRING, write_disposition STRING, "
    "partitioning_field STRING, schedule STRING, disabled BOOLEAN, created_ms BIGINT"
)


def destination(template: str, run_date: date) -> str:
    return template.replace("{run_date}", run_date.strftime("%Y%m%d"))


def materialize(
    spark: SparkSession,
    query: str,
    database: str,
    run_date: date,
    template: str = DEFAULT_TEMPLATE,
    write_disposition: str = "WRITE_TRUNCATE",
    partitioning_field: str = "",
) -> str:
    """Run a query and write its rows to the table the template names; return that table's name.

    TRUNCATE replaces the table, APPEND adds to it, EMPTY writes only if it is absent or has no rows.

    A replaced table gets its rows in a new folder and then the new location, in one change of the catalog: until then,
    and if the query or the write fails, the old rows are there whole. So a query may read the table it replaces. The
    version before stays for readers that have it open, until the next run removes it. Comment, labels and other
    properties stay. Only where the columns or the partitioning differ from the table's, or where another tool has made
    the table with partitions of its own, is it created anew, with the new rows complete and the same comment and
    properties.
    """
    if write_disposition not in DISPOSITIONS:
        raise ValueError(f"write_disposition must be one of {DISPOSITIONS}")
    table = f"`{database}`.`{destination(template, run_date)}`"
    exists = spark.catalog.tableExists(table)
    if write_disposition == "WRITE_EMPTY" and exists and not spark.table(table).isEmpty():
        raise ValueError(f"{table} is not empty")
    rows = spark.sql(query)
    if exists and write_disposition != "WRITE_TRUNCATE":
        rows.select(*[F.col(f"`{name}`") for name in spark.table(table).columns]).write.insertInto(table)
        return table
    replace_table(spark, table, rows, (partitioning_field,) if partitioning_field else ())
    return table


def replace_table(spark: SparkSession, table: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
    """Give a table, which need not exist, the rows of ``rows`` as a new version."""
    # Partition columns come last in a table.
    rows = rows.select(*[F.col(f"`{name}`") for name in rows.columns if name not in partition_by], *partition_by)
    folder = storage.new_folder(spark, table)
    writer = (gathered(rows, *partition_by) if partition_by else rows).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)

    if not spark.catalog.tableExists(table):
        created = {CREATED_MS: str(int(time.time() * 1000))}
        storage.create_at(spark, table, rows, folder, partition_by, created)
        return
    database, _ = storage.split_name(spark, table)
    properties = {k: v for k, v in table_properties(spark, table).items() if k not in OWN_PROPERTIES}
    before = storage.location(spark, table)
    partitions = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    stored = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
    same = stored == [(f.name, f.dataType) for f in rows.schema.fields] and partitions == partition_by
    outdated = properties.get(storage.PREVIOUS)
    if same and not storage.tracks_partitions(spark, table):
        storage.point_to(spark, table, folder)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({storage.text(storage.PREVIOUS)} = {storage.text(before)})")
    else:
        comment = spark.catalog.getTable(table).description
        properties.pop(storage.PREVIOUS, None)
        spark.sql(f"DROP TABLE {table}")
        storage.create_at(spark, table, rows, folder, partition_by, properties, comment)
    if outdated and outdated not in (before, folder):
        storage.remove_folder(spark, database, outdated)


def register_job(
    spark: SparkSession,
    path: str,
    display_name: str,
    query: str,
    database: str,
    template: str = DEFAULT_TEMPLATE,
    write_disposition: str = "WRITE_TRUNCATE",
    partitioning_field: str = "",
    schedule: str = DEFAULT_SCHEDULE,
    disabled: bool = False,
) -> None:
    """Append a job's definition to the job table."""
    row = (display_name, query, database, template, write_disposition, partitioning_field, schedule, disabled,
           int(time.time() * 1000))
    spark.createDataFrame([row], JOB_RECORD).write.mode("append").parquet(path)


def find_job(jobs: DataFrame, display_name: str) -> DataFrame:
    """The job with exactly this display name, the earliest if there are several; empty if there is none."""
    return jobs.where(F.col("display_name") == display_name).orderBy("created_ms").limit(1)
