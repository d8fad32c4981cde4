"""Advertising costs from the networks and from manual uploads, brought to one contract."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from beaconlake.contracts import schema
from beaconlake.operators.skew import MAX_BROADCAST_ROWS, MAX_GROUP_ROWS, small_lookup_join

# Holds the line of an upload that has not as many fields as its header.
CORRUPT_LINE = "_corrupt_line"

# Column names that differ between a network's table and the common one: common name -> network name.
RENAMED = {
    "facebook_ads": {"adgroup_id": "adset_id", "adgroup_name": "adset_name"},
    "google_ads": {},
    "tiktok_ads": {},
}


def update_network_costs(
    network: DataFrame,
    data_source: str,
    prefix: str = "",
    max_group_rows: int = MAX_GROUP_ROWS,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Newest snapshot of each account and day of a network's costs, in the common contract.

    The snapshots and their sizes are one aggregation; the rows of the newest ones are then kept by a semi join, so an
    account with most of the rows is never brought into one task. Columns the network does not have are null, and the
    keyword of a search network fills a missing term.
    """
    if data_source not in RENAMED:
        raise ValueError(f"data_source must be one of {sorted(RENAMED)}")
    snapshot = ["ad_account_id", "date", "inserted_at"]
    snapshots = network.groupBy(*snapshot).agg(F.count(F.lit(1)).alias("group_rows")).checkpoint()
    newest = snapshots.groupBy("ad_account_id", "date").agg(F.max("inserted_at").alias("inserted_at"))
    heavy = snapshots.where(F.col("group_rows") > max_group_rows)
    current = small_lookup_join(
        network, newest, snapshot, "left_semi", max_broadcast_rows, snapshots.count(), null_safe=True,
        heavy=None if heavy.isEmpty() else heavy, look_for_heavy=False,
    )
    if "keyword" in network.columns:
        current = current.withColumn("term", F.coalesce("term", "keyword"))
    renamed = RENAMED[data_source]
    columns = []
    for field in schema("ad_costs", prefix).fields:
        name = renamed.get(field.name, field.name)
        if field.name == "data_source":
            value = F.lit(data_source)
        elif name in network.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return current.select(*columns)


def scan_network_costs(*networks: tuple[str, DataFrame]) -> DataFrame:
    """All rows of the network tables with the table they come from; columns a network lacks are null."""
    tagged = [df.withColumn("network", F.lit(name)) for name, df in networks]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def check_manual_costs(uploaded: DataFrame, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Split uploaded rows of text into (good rows of the common contract, bad rows with a reason).

    A row is bad when a typed field does not parse, when it has no date or cost, when a figure is negative, when its line
    has more or fewer fields than its header, or when it fills a column that the contract does not have. ``url_params``
    is JSON text or, in uploads with types, the contract's own type.
    """
    params = schema("ad_costs", prefix)["url_params"].dataType
    contract = [f for f in schema("ad_costs", prefix).fields if f.name not in ("data_source", "url_params")]
    missing = [f.name for f in contract if f.name not in uploaded.columns]
    staged = uploaded.select("*", *[F.lit(None).cast("string").alias(name) for name in missing])
    given = "url_params" in uploaded.columns
    as_text = given and isinstance(uploaded.schema["url_params"].dataType, StringType)
    filled = F.coalesce(F.trim("url_params"), F.lit("")) != "" if as_text else F.lit(False)
    if as_text:
        url_params = F.when(filled, F.from_json("url_params", params, {"mode": "PERMISSIVE"}))
    else:
        url_params = F.col("url_params").cast(params) if given else F.lit(None).cast(params)
    known = {*[f.name for f in contract], "url_params", CORRUPT_LINE}
    unknown = [
        F.when(F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) != "", F.lit(f"unknown column {c}"))
        for c in uploaded.columns if c not in known
    ]
    broken = [F.when(F.col(CORRUPT_LINE).isNotNull(), F.lit("not as many fields as its header"))] if CORRUPT_LINE in uploaded.columns else []
    text = {f.name: F.trim(F.col(f.name).cast("string")) for f in contract}
    parsed = {
        f.name: F.when(text[f.name] != "", text[f.name]).try_cast(f.dataType.simpleString()) for f in contract
    }
    wrong = [
        F.when((text[f.name] != "") & parsed[f.name].isNull(), F.lit(f"{f.name} does not parse")) for f in contract
    ]
    required = [F.when(F.coalesce(text[n], F.lit("")) == "", F.lit(f"{n} is missing")) for n in ("date", "cost")]
    negative = [
        F.when(parsed[n] < 0, F.lit(f"{n} is negative")) for n in ("cost", "impressions", "reach", "clicks")
    ]
    if as_text:
        wrong.append(F.when(filled & F.from_json("url_params", params).isNull(), F.lit("url_params does not parse")))
    checked = staged.select(
        url_params.alias("_url_params"),
        *[parsed[f.name].alias(f"_{f.name}") for f in contract],
        F.struct(*[F.col(c) for c in uploaded.columns]).alias("_row"),
        F.concat_ws("; ", F.array_compact(F.array(*wrong, *required, *negative, *unknown, *broken))).alias("_reason"),
    )
    good = checked.where("_reason = ''").select(
        *[
            (
                F.lit("manual") if f.name == "data_source"
                else F.coalesce("_url_params", F.array().cast(f.dataType)) if f.name == "url_params"
                else F.col(f"_{f.name}")
            ).alias(f.name)
            for f in schema("ad_costs", prefix).fields
        ]
    )
    bad = checked.where("_reason <> ''").select(F.to_json("_row").alias("row"), F.col("_reason").alias("reason"))
    return good, bad


def load_manual_costs(
    spark: SparkSession, path: str, prefix: str = "", file_format: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """Read an upload, ``csv`` with a header in each file or ``parquet``, and split it into (good, bad).

    Each CSV file's own header names its fields, so files of one upload may order their columns differently. Headers are
    read by Spark, and all files with one header are one source: the driver sees the file names and the few headers. An
    upload without files gives frames without rows.
    """
    if file_format not in ("csv", "parquet"):
        raise ValueError("file_format must be csv or parquet")
    if file_format == "parquet":
        return check_manual_costs(spark.read.parquet(path), prefix)
    uploads = spark.read.option("recursiveFileLookup", "true").option("wholetext", "false")
    lines = uploads.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    # The header is the first line of the block at a file's start; the lines of other blocks are not its first.
    first = lines.where("start = 0").withColumn("place", F.monotonically_increasing_id())
    headers = first.groupBy("path").agg(F.min_by("value", "place").alias("header"))
    parts = []
    for row in headers.groupBy("header").agg(F.collect_list("path").alias("paths")).sort("header").collect():
        names = next(csv.reader([row.header.lstrip("\ufeff")]), [])
        fields = StructType([StructField(name, StringType()) for name in [*names, CORRUPT_LINE]])
        reader = spark.read.schema(fields)
        parts.append(reader.csv(sorted(unquote(path) for path in row.paths), header=True, escape='"', columnNameOfCorruptRecord=CORRUPT_LINE))
    if not parts:
        parts = [spark.createDataFrame([], "`date` STRING, cost STRING")]
    return check_manual_costs(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), prefix)


def unify_costs(*parts: DataFrame) -> DataFrame:
    """All cost rows under the common contract."""
    return reduce(lambda a, b: a.unionByName(b), parts)
