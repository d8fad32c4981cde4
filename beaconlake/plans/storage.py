"""Where tables keep their files: new versions beside the old ones, one catalog change to switch, and removal by SQL.

A table or partition is replaced by writing its new files to another folder and then pointing the catalog at them. Until
that one change readers see the old version whole; a write that fails or loses an executor leaves nothing behind that
anybody reads. The old files stay until the next replacement, for readers that still have them open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Table property with the folder of the version before the current one.
PREVIOUS = "previous_version"

#: Reads partitions from a table's folder and not from the catalog, so that one change of location moves them all.
PARTITIONS_IN_CATALOG = "spark.sql.hive.manageFilesourcePartitions"


def text(value: object) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def described(spark: SparkSession, table: str, partition: dict[str, str] | None = None) -> dict[str, str]:
    """What the catalog says about a table, or about one of its partitions."""
    spec = f" PARTITION ({spec_of(partition)})" if partition else ""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}{spec}").collect()
    names = [row.col_name for row in rows]
    # Columns come first, and may have any name.
    marks = ("# Detailed Partition Information", "# Detailed Table Information")
    start = next(names.index(mark) for mark in marks if mark in names)
    details: dict[str, str] = {}
    for row in rows[start + 1:]:
        details.setdefault(row.col_name, row.data_type)
    return details


def spec_of(partition: dict[str, str]) -> str:
    return ", ".join(f"`{name}` = {text(value)}" for name, value in partition.items())


def location(spark: SparkSession, table: str, partition: dict[str, str] | None = None) -> str:
    return described(spark, table, partition)["Location"].rstrip("/")


def tracks_partitions(spark: SparkSession, table: str) -> bool:
    """Whether the catalog has a location of its own for every partition of the table."""
    return described(spark, table).get("Partition Provider") == "Catalog"


def new_folder(spark: SparkSession, table: str) -> str:
    """A fresh folder for a version of a table, beside the database's tables."""
    database, name = split_name(spark, table)
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{root}/{name}.versions/{uuid.uuid4().hex}"


def version_folders(spark: SparkSession, table: str) -> list[str]:
    """Folders of versions that dropping the table would leave: of an external table, the current and the one before."""
    details = described(spark, table)
    if details.get("Type") != "EXTERNAL":
        return []
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return [folder for folder in (details["Location"], properties.get(PREVIOUS)) if folder and ".versions/" in folder]


def split_name(spark: SparkSession, table: str) -> tuple[str, str]:
    """(database, table) of a name with or without quotes and database."""
    parts = [part.strip("`") for part in table.split(".")]
    return (parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()), parts[-1]


def remove_folder(spark: SparkSession, database: str, folder: str) -> None:
    """Delete a folder with the catalog's own means, which reach every file system that tables lie on.

    The folder becomes the one partition of a managed table; dropping a partition of such a table deletes its files.
    """
    table = f"`{database}`.`removed_{uuid.uuid4().hex}`"
    spark.sql(f"CREATE TABLE {table} (value STRING, part STRING) USING parquet PARTITIONED BY (part)")
    try:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (part = '0') LOCATION {text(folder)}")
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (part = '0') PURGE")
    finally:
        spark.sql(f"DROP TABLE {table}")


def point_to(spark: SparkSession, table: str, folder: str) -> None:
    """Make ``folder`` the table's files: the one change that switches versions. Comment and properties stay."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION {text(folder)}")
    spark.catalog.refreshTable(table)


def create_at(
    spark: SparkSession, table: str, df: DataFrame, folder: str, partition_by: tuple[str, ...] = (),
    properties: dict[str, str] | None = None, comment: str | None = None,
) -> None:
    """Create a table over the files in ``folder``, written from ``df``; its partitions are found in the folder."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    statement = f"CREATE TABLE {table} ({columns}) USING parquet"
    if partition_by:
        statement += " PARTITIONED BY (" + ", ".join(f"`{name}`" for name in partition_by) + ")"
    statement += f" LOCATION {text(folder)}"
    if comment:
        statement += f" COMMENT {text(comment)}"
    if properties:
        statement += " TBLPROPERTIES (" + ", ".join(f"{text(k)} = {text(v)}" for k, v in properties.items()) + ")"
    before = spark.conf.get(PARTITIONS_IN_CATALOG)
    spark.conf.set(PARTITIONS_IN_CATALOG, "false")
    try:
        spark.sql(statement)
    finally:
        spark.conf.set(PARTITIONS_IN_CATALOG, before)
