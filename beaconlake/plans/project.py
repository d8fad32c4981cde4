"""A project with its settings, and its jobs: each reads the project's tables, runs an operator and saves the result."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconlake import contracts
from beaconlake.operators import attribution, checks, costs
from beaconlake.operators.rollups import UTM
from beaconlake.operators.skew import small_lookup_join
from beaconlake.plans import configs, incremental, jobs, loads, warehouse

CONFIGS = "project_configs"
CONFIG_COLUMNS = (
    f"project_id BIGINT, unattributed_events_threshold DOUBLE, ignored_event_filters {checks.FILTER_TYPE}, "
    "timezone STRING, currency STRING"
)
CHECKED = "checked_ms"
# The name of a load in the run log, beside those of the seven jobs.
LOAD = "load_raw_events"
# How far a job has read a table that others write.
MARKS = "job_marks"
MARK_COLUMNS = "job STRING, mark BIGINT, noted_ms BIGINT"

# What the jobs write besides the warehouse tables: columns and partitioning. A check keeps the rows of each run.
_UTM = ", ".join(f"{name} STRING" for name in UTM)
RESULTS = {
    "attributed_events": (
        "`date` DATE, key STRING, event_name STRING, `timestamp` BIGINT, event_id STRING, value DOUBLE, "
        f"touch_event_id STRING, touch_timestamp BIGINT, {_UTM}", "date",
    ),
    "unattributed_shares": (
        "`date` DATE, event_name STRING, total BIGINT, unattributed BIGINT, share DOUBLE, breach BOOLEAN, "
        f"{CHECKED} BIGINT", CHECKED,
    ),
    "costs_without_visits": (
        f"`date` DATE, data_source STRING, {_UTM}, ad_id STRING, cost DOUBLE, {CHECKED} BIGINT", CHECKED,
    ),
    "manual_costs_rejected": (f"`row` STRING, reason STRING, {CHECKED} BIGINT", CHECKED),
}


def register_project(
    spark: SparkSession, project_id: int, location: str | None = None, buckets: int = incremental.BUCKETS, **options
) -> dict[str, str]:
    """Everything ``bootstrap`` creates, the tables of the jobs' results, the project's settings with their defaults and
    an empty run log. What exists stays as it is. ``buckets`` is for the tables of identifiers, of which a large project
    wants more; ``options`` are those of ``bootstrap``."""
    resources = warehouse.bootstrap(spark, project_id, location, **options)
    database = resources["database"]
    for name, (columns, partition) in RESULTS.items():
        warehouse.create_table(spark, database, name, StructType.fromDDL(columns), (partition,))
        resources[name] = f"{database}.{name}"
    incremental.create_state(spark, database, buckets)
    resources[MARKS] = f"{database}.{MARKS}"
    warehouse.create_table(spark, database, MARKS, StructType.fromDDL(MARK_COLUMNS), ())
    loads.ledger(spark, resources["raw_events"])
    resources[CONFIGS] = f"{database}.{CONFIGS}"
    warehouse.create_table(spark, database, CONFIGS, StructType.fromDDL(CONFIG_COLUMNS), ())
    if spark.table(resources[CONFIGS]).isEmpty():
        empty = spark.createDataFrame([(project_id, None, None, None, None)], CONFIG_COLUMNS)
        warehouse.save_rows(spark, configs.with_defaults(empty), resources[CONFIGS])
    spark.createDataFrame([], jobs.RUN_LOG).write.mode("append").parquet(run_log_path(spark, project_id))
    return resources


def run_log_path(spark: SparkSession, project_id: int) -> str:
    """Where the project's run log lies: beside its tables."""
    database = spark.catalog.getDatabase(warehouse.database_name(project_id))
    return f"{database.locationUri.rstrip('/')}/job_runs"


def run_log(spark: SparkSession, project_id: int) -> DataFrame:
    return spark.read.schema(jobs.RUN_LOG).parquet(run_log_path(spark, project_id))


def job_states(spark: SparkSession, project_id: int) -> DataFrame:
    """One row per job, also for jobs that never ran (``last_run`` 0, no status)."""
    known = spark.createDataFrame([(name,) for name in contracts.JOBS], "job string")
    states = jobs.last_run(run_log(spark, project_id)).drop("project_id")
    return known.join(F.broadcast(states), "job", "left").select(
        "job", F.coalesce("last_run", F.lit(0)).cast("bigint").alias("last_run"), "last_status",
        F.coalesce("is_running", F.lit(False)).alias("is_running"), "last_error_type",
        F.coalesce("runs", F.lit(0)).cast("bigint").alias("runs"),
    )


def run_job(spark: SparkSession, project_id: int, name: str, **options) -> None:
    """Run one of the project's jobs and log it. ``options`` are the keyword arguments of the job's function below.

    Running a job again gives the same tables: costs and events replace their dates, a check adds a run of its own.
    """
    if name not in contracts.JOBS:
        raise ValueError(f"job must be one of {contracts.JOBS}")
    step = STEPS[name]
    jobs.log_run(spark, run_log_path(spark, project_id), name, project_id, lambda: step(spark, project_id, name, **options))


def load_raw_events(spark: SparkSession, project_id: int, target: str, prefix: str = "", most: int | None = None) -> list[int]:
    """Load what ``ingest_events`` has finished under ``target`` since the last load into ``raw_events``, and log the run.

    Returns the numbers of the micro-batches; with ``most`` only that many of the oldest are taken.
    """
    table = _table(project_id, "raw_events")
    return jobs.log_run(
        spark, run_log_path(spark, project_id), LOAD, project_id,
        lambda: loads.load_batches(spark, target, contracts.schema("raw_events", prefix), table, most),
    )


def _table(project_id: int, name: str) -> str:
    return f"{warehouse.database_name(project_id)}.{name}"


def _config(spark: SparkSession, project_id: int):
    """The project's one settings record."""
    row = configs.with_defaults(spark.table(_table(project_id, CONFIGS)).where(F.col("project_id") == project_id)).first()
    if row is None:
        raise jobs.JobError("MISSING_PROJECT_CONFIG", f"project {project_id} has no settings")
    return row


def _save_check(spark: SparkSession, rows: DataFrame, table: str) -> None:
    warehouse.save_rows(spark, rows.withColumn(CHECKED, F.lit(int(time.time() * 1000)).cast("bigint")), table)


def _mark(spark: SparkSession, project_id: int, job: str) -> int:
    """The largest ``inserted_at`` that a job's successful runs have read."""
    return spark.table(_table(project_id, MARKS)).where(F.col("job") == job).agg(F.coalesce(F.max("mark"), F.lit(0))).first()[0]


def update_network(spark: SparkSession, project_id: int, name: str, prefix: str = "") -> None:
    """Dates for which the network's table got rows are brought to ``ad_costs`` anew; dates it no longer has are dropped.

    New rows are those beyond the largest ``inserted_at`` that was read before, not those since the last start: a row that
    was stamped before a run and written during it is not passed over.
    """
    network = name.removeprefix("update_").removesuffix("_ad_costs") + "_ads"
    source, costs_table = _table(project_id, f"{network}_ad_costs"), _table(project_id, "ad_costs")
    rows = spark.table(source)
    fresh = incremental.kept(
        jobs.newer_than(rows, _mark(spark, project_id, name)).groupBy("date").agg(F.max("inserted_at").alias("mark")), "network-dates"
    )
    touched = small_lookup_join(rows, fresh.select("date"), ["date"], "left_semi", null_safe=True)
    warehouse.save_rows(spark, costs.update_network_costs(touched, network, prefix), costs_table, overwrite=True)
    mark = fresh.agg(F.max("mark")).first()[0]
    if mark is not None:
        noted = spark.createDataFrame([(name, mark, int(time.time() * 1000))], MARK_COLUMNS)
        noted.write.insertInto(_table(project_id, MARKS))
    present = {str(day) for day in incremental.partition_dates(spark, source)}
    withdrawn = []
    for (part,) in spark.sql(f"SHOW PARTITIONS {costs_table}").collect():
        values = dict(pair.split("=", 1) for pair in part.split("/"))
        if values["data_source"] == network and values["date"][:1].isdigit() and values["date"] not in present:
            withdrawn.append(f"PARTITION (`date` = '{values['date']}', data_source = '{network}')")
    if withdrawn:
        spark.sql(f"ALTER TABLE {costs_table} DROP IF EXISTS {', '.join(withdrawn)} PURGE")


def update_manual(
    spark: SparkSession, project_id: int, name: str, upload: str, file_format: str = "csv", prefix: str = ""
) -> None:
    """An upload replaces the manual costs of its dates; rows that do not fit are kept with the reason."""
    good, bad = costs.load_manual_costs(spark, upload, prefix, file_format)
    warehouse.save_rows(spark, good, _table(project_id, "ad_costs"), overwrite=True)
    _save_check(spark, bad.select("row", "reason"), _table(project_id, "manual_costs_rejected"))


def attribute(
    spark: SparkSession, project_id: int, name: str, conversion_events: Sequence[str] = ("purchase",),
    model: str = "last_touch", lookback_days: int = 7, prefix: str = "",
) -> None:
    """Raw events once each, with their profile, to ``identified_events``; their conversions to ``attributed_events``.

    Both tables are brought up to date from the dates that changed since the last success (``incremental``).
    """
    database = warehouse.database_name(project_id)
    incremental.identify_dates(spark, database, avid_col=f"{prefix}avid")
    incremental.attribute_dates(spark, database, conversion_events, model, lookback_days)


def _attributed(spark, project_id, filters, conversion_events, model, lookback_days) -> DataFrame:
    events = spark.table(_table(project_id, "identified_events"))
    kept = checks.drop_ignored(events, filters) if filters else events
    return attribution.attribute_events(
        kept, conversion_events, model, lookback_days, excluded=spark.table(_table(project_id, "excluded_referrers"))
    )


def check_share(
    spark: SparkSession, project_id: int, name: str, conversion_events: Sequence[str] = ("purchase",), lookback_days: int = 7
) -> None:
    """The unattributed share, without the events that the project ignores, against the project's own threshold."""
    config = _config(spark, project_id)
    filters = [tuple(entry) for entry in config.ignored_event_filters]
    attributed = _attributed(spark, project_id, filters, conversion_events, "last_touch", lookback_days)
    shares = checks.check_unattributed_share(attributed, config.unattributed_events_threshold)
    _save_check(spark, shares, _table(project_id, "unattributed_shares"))


def check_visits(spark: SparkSession, project_id: int, name: str, by: Sequence[str] = UTM) -> None:
    """Costs of all sources against the visits in ``identified_events``."""
    excluded = spark.table(_table(project_id, "excluded_referrers"))
    seen = checks.visits(spark.table(_table(project_id, "identified_events")), excluded)
    found = checks.check_costs_without_visits(spark.table(_table(project_id, "ad_costs")), seen, by=by)
    _save_check(spark, found.select("date", "data_source", *UTM, "ad_id", "cost"), _table(project_id, "costs_without_visits"))


STEPS: dict[str, Callable[..., None]] = {
    "check_unattributed_events_share": check_share,
    "check_ad_costs_without_visits": check_visits,
    "calculate_events_attribution": attribute,
    "update_facebook_ad_costs": update_network,
    "update_google_ad_costs": update_network,
    "update_tiktok_ad_costs": update_network,
    "update_manual_ad_costs": update_manual,
}
