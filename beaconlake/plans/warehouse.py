"""Databases, tables and views of a project."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconlake import contracts

# The four cost jobs share one table, so it is also split by source: each job replaces only its own part of a day.
PARTITIONS = {"ad_costs": ("date", "data_source")}
PARTITION_UNITS = ("HOUR", "DAY", "MONTH", "YEAR")
REQUIRE_FILTER = "require_partition_filter"
CLUSTERING = "clustering"
EXPIRATION_MS = "partition_expiration_ms"
PARTITION_UNIT = "partition_unit"
PARTITION_FIELD = "partition_field"
# Partition column of tables that are not partitioned by day.
PARTITION_TIME = "partition_time"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# How a null partition value is listed.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# When a table was created; expiry of tables goes by it.
CREATED_MS = "created_ms"
# The least and largest date in each partition of a table that is not partitioned by date, in a table beside it.
RANGES = "`{0}` STRING, low DATE, high DATE".format(PARTITION_TIME)


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(properties: dict[str, object]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def database_name(project_id: int) -> str:
    return f"{contracts.DATABASE_PREFIX}{project_id}"


def create_database(
    spark: SparkSession,
    project_id: int,
    location: str | None = None,
    description: str | None = None,
    default_table_expiration_ms: int | None = None,
    labels: dict[str, str] | None = None,
) -> str:
    """Create the project's database if it is absent and return its name."""
    name = database_name(project_id)
    properties = dict(labels or {})
    if default_table_expiration_ms is not None:
        properties["default_table_expiration_ms"] = str(default_table_expiration_ms)
    statement = f"CREATE DATABASE IF NOT EXISTS `{name}`"
    if description:
        statement += f" COMMENT {_text(description)}"
    if location:
        statement += f" LOCATION {_text(location)}"
    if properties:
        statement += f" WITH DBPROPERTIES ({_properties(properties)})"
    spark.sql(statement)
    return name


def create_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: StructType,
    partition_by: tuple[str, ...] = ("date",),
    description: str | None = None,
    labels: dict[str, str] | None = None,
    expiration_ms: int | None = None,
    require_partition_filter: bool | None = None,
    clustering: tuple[str, ...] = (),
    unit: str = "DAY",
    unit_field: str = "timestamp",
) -> None:
    """Create a partitioned Parquet table if it is absent; a table that exists is left as it is.

    With a ``unit`` of HOUR, MONTH or YEAR the table is partitioned by that part of an event time in milliseconds, in
    an added column ``partition_time`` that ``save_rows`` fills. A ``date`` need not agree with that time, so the dates
    of every partition are kept in a table beside it, by which ``read_table`` finds the partitions of a date.
    """
    if unit not in PARTITION_UNITS:
        raise ValueError(f"unit must be one of {PARTITION_UNITS}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    properties: dict[str, object] = dict(labels or {})
    properties[CREATED_MS] = int(time.time() * 1000)
    if expiration_ms is not None:
        properties[EXPIRATION_MS] = expiration_ms
    if require_partition_filter is not None:
        properties[REQUIRE_FILTER] = str(require_partition_filter).lower()
    if clustering:
        properties[CLUSTERING] = ",".join(clustering)
    if unit != "DAY":
        columns += f", `{PARTITION_TIME}` STRING"
        partition_by = (PARTITION_TIME,)
        properties[PARTITION_UNIT], properties[PARTITION_FIELD] = unit, unit_field
        if "date" in schema.names:
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {ranges_table(f'{database}.{table}')} ({RANGES}) USING parquet "
                f"TBLPROPERTIES ({_properties({CREATED_MS: properties[CREATED_MS]})})"
            )
    statement = f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet"
    if partition_by:
        statement += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if description:
        statement += f" COMMENT {_text(description)}"
    if properties:
        statement += f" TBLPROPERTIES ({_properties(properties)})"
    spark.sql(statement)


def create_view(spark: SparkSession, database: str, view: str, query: str, description: str | None = None) -> None:
    """Create a view from SQL text if it is absent."""
    comment = f" COMMENT {_text(description)}" if description else ""
    spark.sql(f"CREATE VIEW IF NOT EXISTS `{database}`.`{view}`{comment} AS {query}")


def database_exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database)


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"`{database}`.`{table}`")


def bootstrap(
    spark: SparkSession,
    project_id: int,
    location: str | None = None,
    prefix: str = "",
    excluded_referrers_query: str = contracts.EXCLUDED_REFERRERS_QUERY,
) -> dict[str, str]:
    """Create whatever of a project's database, tables and view is absent; return the resources by name.

    Running it again changes nothing.
    """
    database = create_database(spark, project_id, location)
    resources = {"database": database}
    for table in contracts.WAREHOUSE_TABLES:
        create_table(
            spark, database, table, contracts.schema(table, prefix), PARTITIONS.get(table, ("date",)),
            require_partition_filter=False,
        )
        resources[table] = f"{database}.{table}"
    create_view(spark, database, "excluded_referrers", excluded_referrers_query)
    resources["excluded_referrers"] = f"{database}.excluded_referrers"
    return resources


def ranges_table(table: str) -> str:
    """Name of the table with the dates in the partitions of ``table``."""
    database, name = [part.strip("`") for part in table.split(".")]
    return f"`{database}`.`{name}_ranges`"


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def save_rows(spark: SparkSession, df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert rows into a table by column name; ``overwrite`` replaces the partitions the rows fall into.

    The rows are put in the table's clustering order, if it has one. For a table with hours, months or years the dates in
    each partition are noted first: after a failure in between they are wider than the rows, never narrower. ``df`` is
    then read twice, the first time for its times and dates alone, and should give the same rows both times.
    """
    properties = table_properties(spark, table)
    clustering = tuple(name for name in properties.get(CLUSTERING, "").split(",") if name)
    if PARTITION_UNIT in properties:
        time = F.col(properties[PARTITION_FIELD])
        df = df.withColumn(PARTITION_TIME, partition_unit(properties[PARTITION_UNIT], time))
        if "date" in df.columns:
            dates = df.groupBy(PARTITION_TIME).agg(F.min("date").alias("low"), F.max("date").alias("high"))
            dates.write.insertInto(ranges_table(table))
    target = spark.table(table).schema.names
    ordered = df.select(*[F.col(f"`{name}`") for name in target])
    partition = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    if clustering:
        ordered = clustered(ordered, partition, clustering)
    elif partition:
        ordered = gathered(ordered, *partition)
    # An insert into a table takes the overwrite mode from the session only, not from the writer's options.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=overwrite)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def gathered(df: DataFrame, *partition_by: str) -> DataFrame:
    """Rows of a partition brought together before a write, so that there are few files.

    Spark sizes the result at run time: small partitions share a task and a large one is split over several. Without
    adaptive execution it could not split them, so the rows are then left where they are.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *[F.col(f"`{name}`") for name in partition_by])


def clustered(df: DataFrame, partition_by: tuple[str, ...], clustering: tuple[str, ...]) -> DataFrame:
    """Rows in clustering order inside each partition, so that file statistics can skip data.

    Range partitioning samples the data, so a value with very many rows is spread over several files.
    """
    order = [F.col(c) for c in (*partition_by, *clustering)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def partition_unit(unit: str, timestamp_ms: Column) -> Column:
    """Partition value of an event time in milliseconds for hourly, daily, monthly or yearly partitions."""
    if unit not in PARTITION_UNITS:
        raise ValueError(f"unit must be one of {PARTITION_UNITS}")
    length = {"HOUR": "yyyy-MM-dd-HH", "DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}[unit]
    return F.date_format(F.timestamp_millis(timestamp_ms), length)


def write_by_unit(df: DataFrame, path: str, unit: str, timestamp_ms: str = "timestamp") -> None:
    """Write a table partitioned by the hour, day, month or year of its event time."""
    timed = df.withColumn(PARTITION_TIME, partition_unit(unit, F.col(timestamp_ms)))
    gathered(timed, PARTITION_TIME).write.mode("overwrite").partitionBy(PARTITION_TIME).parquet(path)


def read_table(
    spark: SparkSession, table: str, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    """Rows of a table between two dates, both included. A table that requires a partition filter needs a bound."""
    properties = table_properties(spark, table)
    if properties.get(REQUIRE_FILTER) == "true" and date_from is None and date_to is None:
        raise ValueError(f"{table} needs a bound on its partition column")
    rows = spark.table(table)
    if PARTITION_UNIT in properties and "date" in rows.columns and (date_from or date_to):
        rows = rows.where(_partitions_with(spark, table, date_from, date_to))
    if date_from is not None:
        rows = rows.where(F.col("date") >= F.lit(date_from))
    if date_to is not None:
        rows = rows.where(F.col("date") <= F.lit(date_to))
    return rows


def _partitions_with(spark: SparkSession, table: str, date_from: date | None, date_to: date | None) -> Column:
    """A condition on the partition column that holds for every partition with a date between the bounds.

    A partition whose dates are not known, because its rows did not come by ``save_rows``, counts as one of them. The
    partitions, one per hour, month or year, are listed on the driver; neighbours become one range of the condition.
    """
    names = [part.split("=", 1)[1] for (part,) in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    known = spark.table(ranges_table(table)).groupBy(PARTITION_TIME).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    dates = {row[PARTITION_TIME] or NULL_PARTITION: (row.low, row.high) for row in known.collect()}

    def may_hold(name: str) -> bool:
        if name not in dates:
            return True
        low, high = dates[name]
        return low is not None and not (date_from is not None and high < date_from or date_to is not None and low > date_to)

    unit, condition, run = F.col(PARTITION_TIME), F.lit(False), []
    if NULL_PARTITION in names and may_hold(NULL_PARTITION):
        condition = unit.isNull()
    for name in [*sorted(n for n in names if n != NULL_PARTITION), None]:
        if name is not None and may_hold(name):
            run.append(name)
        elif run:
            condition = condition | unit.between(run[0], run[-1])
            run = []
    return condition


def replace_partitions(df: DataFrame, path: str, *partition_by: str, gather: bool = True) -> None:
    """Replace the partitions present in ``df`` under a path; others are left alone.

    Without ``gather`` the rows are written where they are, for rows that were dealt out by partition before.
    """
    (
        (gathered(df, *partition_by) if gather else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
