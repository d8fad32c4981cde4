"""The registered queries: each operator over the whole test tables, as flat rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconlake import fixtures as fx
from beaconlake.contracts import JOBS, MESSAGE_RETENTION_SECONDS, SINK_SUBSCRIPTION_PREFIX, schema
from beaconlake.functions.params import ad_value, param, string_value
from beaconlake.operators import (
    attribution, bitmaps, checks, commerce, costs, flatten, identity, quality, referrers, rollups, seen,
)
from beaconlake.plans import configs, incremental, jobs, loads, materialize, project, retention, warehouse
from beaconlake.session import configure, open_files, run_path
from beaconlake.sources.topic import envelopes, read_topic_files
from beaconlake.streaming import ingest, ordering, process

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

IGNORED = (
    ("error", None, None),
    ("signup", "referrer_url", None),
    ("view", "landing_page_url", "http://ththre.example.com/fr/825?page=2&ref=x"),
)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _day(name: str = "date"):
    return F.col(name).cast("string").alias(name)


# ---- derived tables, written once per application and data set ----

_paths: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = run_path(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]


def topic_path(spark: SparkSession, sf_dir: str) -> str:
    """The topic's files."""
    return _stored(
        spark, sf_dir, "topic",
        lambda path: fx.topic_rows(spark, sf_dir).write.parquet(path),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``raw_events`` table, by date."""
    path = _stored(
        spark, sf_dir, "raw_events",
        lambda path: warehouse.replace_partitions(fx.raw_events(spark, sf_dir), path, "date", gather=False),
    )
    contract = schema("raw_events")
    return spark.read.schema(contract).parquet(path).select(*[F.col(f"`{name}`") for name in contract.names])


def network_costs(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The cost table of a network, by date."""
    table = f"{name}_ad_costs"
    path = _stored(
        spark, sf_dir, table,
        lambda path: warehouse.replace_partitions(fx.network_costs(spark, sf_dir, name), path, "date"),
    )
    contract = schema(table)
    return spark.read.schema(contract).parquet(path).select(*[F.col(f"`{name}`") for name in contract.names])


def profiled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with the external id as the profile, for reports that need one profile per user."""
    return raw_events(spark, sf_dir).withColumn("profile_id", F.get("user_external_ids", F.lit(0))["value"])


# ---- topic and ingestion ----

def _messages(spark: SparkSession, sf_dir: str, batches: int | None = None) -> DataFrame:
    """The topic's messages; ``batches`` says in how many micro-batches they come, one without it."""
    files = batches and -(-fx.topic_files(spark, sf_dir) // batches)
    rows = read_topic_files(spark, topic_path(spark, sf_dir), files)
    return envelopes(rows, f"{SINK_SUBSCRIPTION_PREFIX}_{fx.PROJECT_ID}")


def _ingest(spark: SparkSession, sf_dir: str, **options) -> tuple[str, str]:
    run = run_path(spark, "ingest")
    target, quarantine = f"{run}/raw_events", f"{run}/quarantine"
    ingest.ingest_events(
        _messages(spark, sf_dir), schema("raw_events"), target, quarantine, f"{run}/checkpoint", **options
    ).awaitTermination()
    return target, quarantine


def _quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("message_id", "reason")


@query
def ingest_raw_events(spark, sf_dir):
    """JSON messages to typed rows; unknown fields are dropped."""
    target, _ = _ingest(spark, sf_dir)
    return ingest.read_batches(spark, target, schema("raw_events")).select(
        "event_id", _day(), "timestamp", "event_name", "avid",
        F.size("event_params").cast("bigint").alias("params"),
        F.size("products").cast("bigint").alias("product_lines"),
        F.size("ad_data").cast("bigint").alias("ad_networks"),
        F.coalesce(F.col("`order`.value"), F.lit(0.0)).alias("order_value"),
        F.coalesce("is_test_event", F.lit(False)).alias("is_test"),
    )


@query
def ingest_unknown_fields(spark, sf_dir):
    """Messages set aside when unknown fields are not accepted."""
    _, quarantine = _ingest(spark, sf_dir, drop_unknown_fields=False)
    return _quarantined(spark, quarantine)


@query
def ingest_filter(spark, sf_dir):
    """Only the messages that a subscription's filter lets through."""
    target, _ = _ingest(spark, sf_dir, message_filter="attr['event_name'] = 'purchase'")
    return ingest.read_batches(spark, target, schema("raw_events")).select("event_id", _day(), "event_name")


@query
def ingest_quarantine(spark, sf_dir):
    """Messages that do not fit, with the reason."""
    _, quarantine = _ingest(spark, sf_dir)
    return _quarantined(spark, quarantine)


@query
def ingest_quoted_fields(spark, sf_dir):
    """As ``ingest_unknown_fields``, where names that the schema does not know are in single quotes."""
    path = _stored(
        spark, sf_dir, "topic_quoted",
        lambda path: fx.topic_rows(spark, sf_dir, extra="'extra'").write.parquet(path),
    )
    run = run_path(spark, "ingest-quoted")
    messages = envelopes(read_topic_files(spark, path), f"{SINK_SUBSCRIPTION_PREFIX}_{fx.PROJECT_ID}")
    ingest.ingest_events(
        messages, schema("raw_events"), f"{run}/raw_events", f"{run}/quarantine", f"{run}/checkpoint", drop_unknown_fields=False
    ).awaitTermination()
    return _quarantined(spark, f"{run}/quarantine")


@query
def raw_events_loaded(spark, sf_dir):
    """The raw table after loads of several micro-batches: two, a load that fails before its ledger, all, and none."""
    contract = schema("raw_events")
    table = warehouse.bootstrap(spark, *_project(spark))["raw_events"]
    run = run_path(spark, "loads")
    target = f"{run}/raw_events"
    ingest.ingest_events(_messages(spark, sf_dir, 4), contract, target, f"{run}/bad", f"{run}/checkpoint").awaitTermination()
    loads.load_batches(spark, target, contract, table, most=2)
    rows = loads.batch_rows(spark, target, contract, loads.open_batches(spark, target, table)[:1])
    warehouse.save_rows(spark, ingest.missing_rows(rows.drop(ingest.BATCH), spark.table(table)), table)
    for _ in range(2):
        loads.load_batches(spark, target, contract, table)
    return spark.table(table).select("event_id", _day(), "event_name")


@query
def raw_events_compacted(spark, sf_dir):
    """Events per date, and whether a date has few files, after many small loads and compaction of all dates but the last."""
    table = warehouse.bootstrap(spark, *_project(spark))["raw_events"]
    raw = raw_events(spark, sf_dir)
    for i in range(4):
        warehouse.save_rows(spark, raw.where(F.col("event_id").cast("bigint") % 4 == i), table)
    last = raw.agg(F.max("date")).first()[0]
    if last is not None:
        # The second run finds nothing to do and removes the folders that the first one has replaced.
        for _ in range(2):
            loads.compact_dates(spark, table, last)
    sizes = loads.file_sizes(spark, table, date(9999, 1, 1)).select(F.col("date").alias("_date"), "files")
    events = spark.table(table).groupBy("date").agg(F.count(F.lit(1)).alias("events"))
    return events.join(sizes, F.col("date") == F.col("_date")).select(_day(), "events", (F.col("files") <= 2).alias("compact"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_path(spark, "landing")
    with open_files(spark):
        ingest.land_messages(_messages(spark, sf_dir), f"{run}/messages", f"{run}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{run}/messages")


@query
def land_messages(spark, sf_dir):
    """Envelopes as they came."""
    return _landed(spark, sf_dir).select(
        "subscription_name", "message_id", F.unix_millis("publish_time").alias("publish_ms"), "attributes",
        F.get_json_object("data", "$.event_id").alias("data_event_id"),
    )


@query
def replay_window(spark, sf_dir):
    """Everything published within the retention period before the latest message, read again."""
    landed = _landed(spark, sf_dir)
    last = landed.agg(F.max("publish_time")).first()[0]
    first = last - timedelta(seconds=MESSAGE_RETENTION_SECONDS)
    return ingest.replay_window(landed, schema("raw_events"), first, last).select("event_id", _day(), "event_name")


@query
def landed_survivors(spark, sf_dir):
    """Messages of forty days landed in several micro-batches, after expiry of what is older than the topic keeps."""
    number, location = _project(spark)
    table = ingest.create_landing(spark, warehouse.create_database(spark, number, location))
    offset = F.substring_index("message_id", "-", -1).cast("int")
    messages = _messages(spark, sf_dir, 4).withColumn("publish_time", F.col("publish_time") + F.make_dt_interval(offset % 10))
    checkpoint = run_path(spark, "landing")
    ingest.land_into_table(messages, table, checkpoint).awaitTermination()
    today = spark.table(table).agg(F.max("publish_date")).first()[0]
    if today is not None:
        retention.expire_partitions(spark, table, today)
    # The stream goes on from where it was.
    ingest.land_into_table(messages, table, checkpoint).awaitTermination()
    return spark.table(table).select("message_id", _day("publish_date"))


@query
def ordered_by_key(spark, sf_dir):
    """Events from micro-batches up to three hours out of order, numbered per visitor by time."""
    narrow = raw_events(spark, sf_dir).select("avid", "timestamp", "event_id", "event_name")
    delay_ms, slices = 3 * 3_600_000, 5
    arrival = F.col("timestamp") + F.crc32(F.col("event_id").cast("binary")) % delay_ms
    first, last = narrow.agg(F.min(arrival), F.max(arrival)).first()
    if first is None:
        parts = [narrow]
    else:
        width = (last - first) // slices + 1
        cut = F.floor((arrival - first) / width)
        parts = [narrow.where(cut == i) for i in range(slices)]
        # The stream knows that it is complete once an event comes that is later than all by more than the delay.
        parts.append(spark.createDataFrame([("end", last + 2 * delay_ms, "end", "end")], narrow.schema).coalesce(1))
    path, run = run_path(spark, "arrivals"), run_path(spark, "ordered")
    # The stream goes on with each part as one micro-batch, in as many files as the part needs.
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(narrow.schema).parquet(path)
        ordered = ordering.ordered_by_key(stream, "avid", "3 hours")
        query_ = ordered.writeStream.format("parquet").option("path", f"{run}/events").option("checkpointLocation", f"{run}/checkpoint")
        query_.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(ordered.schema).parquet(f"{run}/events").select("avid", "event_id", "position")


@query
def replay_ten_days(spark, sf_dir):
    """What was published in the last ten days before the latest message, read again from the landed days in between."""
    landed = _landed(spark, sf_dir)
    last = landed.agg(F.max("publish_time")).first()[0] or datetime(2000, 1, 1)
    return ingest.replay_window(landed, schema("raw_events"), last - timedelta(days=10), last).select("event_id", _day(), "event_name")


@query
def replay_into_table(spark, sf_dir):
    """The project's raw table after a load of all batches, the loss of two days, and a replay of the first of them."""
    number, location = _project(spark)
    contract = schema("raw_events")
    table = warehouse.bootstrap(spark, number, location)["raw_events"]
    target, _ = _ingest(spark, sf_dir)
    for _ in range(2):
        ingest.add_to_table(ingest.read_batches(spark, target, contract), table)
    first, last = spark.table(table).agg(F.min("date"), F.max("date")).first()
    if first is not None:
        for day in {first, last}:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`date` = '{day}')")
        start = datetime(first.year, first.month, first.day)
        # Messages are published two seconds after the event.
        for _ in range(2):
            ingest.replay_into_table(_landed(spark, sf_dir), contract, start, start + timedelta(days=1, seconds=2), table)
    return spark.table(table).select("event_id", _day(), "event_name")


@query
def ingest_fanout(spark, sf_dir):
    """Two independent subscriptions of one topic: the raw sink and the event processor."""
    run = run_path(spark, "fanout")
    contract = schema("raw_events")
    sink = ingest.ingest_events(
        _messages(spark, sf_dir), contract, f"{run}/raw", f"{run}/bad", f"{run}/sink_checkpoint"
    )
    processor = process.process_events(
        _messages(spark, sf_dir), contract, f"{run}/processed", f"{run}/processor_checkpoint", delay="40 days"
    )
    sink.awaitTermination()
    processor.awaitTermination()
    stored = ingest.read_batches(spark, f"{run}/raw", contract).select(F.lit("sink").alias("consumer"), "event_name")
    processed = spark.read.parquet(f"{run}/processed").select(F.lit("processor").alias("consumer"), "event_name")
    return stored.unionByName(processed).groupBy("consumer", "event_name").agg(F.count(F.lit(1)).alias("events"))


@query
def process_events_stream(spark, sf_dir):
    """Valid, real events once each with the parts of their landing page."""
    run = run_path(spark, "process")
    process.process_events(
        _messages(spark, sf_dir), schema("raw_events"), f"{run}/events", f"{run}/checkpoint", delay="40 days"
    ).awaitTermination()
    return spark.read.parquet(f"{run}/events").select(
        "event_id", _day(), "landing_hostname", "landing_page_path", F.size("url_params").cast("bigint").alias("params")
    )


@query
def process_events_late(spark, sf_dir):
    """The stream's events with a delay far shorter than the data and several micro-batches, and the late ones beside."""
    run = run_path(spark, "process-late")
    contract = schema("raw_events")
    process.process_events(
        _messages(spark, sf_dir, 4), contract, f"{run}/events", f"{run}/checkpoint", delay="1 minute"
    ).awaitTermination()
    landed = _landed(spark, sf_dir)
    first, last = landed.agg(F.min("publish_time"), F.max("publish_time")).first()
    processed = spark.read.parquet(f"{run}/events")
    if first is not None:
        process.late_events(landed, contract, first, last, processed).write.parquet(f"{run}/late")
        late = spark.read.schema(processed.schema).parquet(f"{run}/late")
        both = processed.unionByName(late)
        # Nothing is left for a second look.
        processed = both.unionByName(process.late_events(landed, contract, first, last, both))
    return processed.select(
        "event_id", _day(), "landing_hostname", "landing_page_path", F.size("url_params").cast("bigint").alias("params")
    )


def _later_copies(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("event_id").cast("bigint") % 40 == 5).withColumns(
        {"timestamp": F.col("timestamp") + 1000, "event_name": F.lit("copy")}
    )


@query
def dedupe_events(spark, sf_dir):
    """First row per event id of events with later copies."""
    raw = raw_events(spark, sf_dir)
    return quality.dedupe_events(raw.unionByName(_later_copies(raw))).select("event_id", "timestamp", "event_name")


@query
def dedupe_incremental(spark, sf_dir):
    """As ``dedupe_events``, from three loads where a copy may come before the event that it is a copy of."""
    raw = raw_events(spark, sf_dir)
    number = F.col("event_id").cast("bigint")
    load = F.when(F.col("event_name") == "copy", (number + 1) % 3).otherwise(number % 3)
    events = raw.unionByName(_later_copies(raw)).withColumn("load", load)
    database = warehouse.create_database(spark, *_project(spark))
    table, path = f"`{database}`.`seen_events`", run_path(spark, "dedupe")
    seen.create_seen(spark, table, 8)
    for i in range(3):
        seen.new_events(events.where(F.col("load") == i).drop("load"), spark.table(table), 8).write.parquet(f"{path}/load={i}")
        seen.remember(spark, spark.read.parquet(f"{path}/load={i}"), table, i)
    kept = spark.read.parquet(path).select("event_id", "timestamp", "event_name", "load", "replaces")
    replaced = kept.where("replaces is not null").select("event_id", F.col("load").alias("_later"))
    again = kept.join(replaced.groupBy("event_id").agg(F.max("_later").alias("_later")), "event_id", "left")
    return again.where("_later is null or load >= _later").select("event_id", "timestamp", "event_name")


# ---- tables ----

def _project(spark: SparkSession) -> tuple[int, str]:
    return uuid.uuid4().int % 10**12, run_path(spark, "project")


@query
def table_contracts(spark, sf_dir):
    """Every column path of the raw table with its type and the number of rows that hold a value."""
    resources = warehouse.bootstrap(spark, *_project(spark))
    warehouse.save_rows(spark, raw_events(spark, sf_dir), resources["raw_events"])
    stored = spark.table(resources["raw_events"])
    return quality.column_fill(stored.select(*[F.col(f"`{n}`") for n in schema("raw_events").names]))


@query
def bootstrap_twice(spark, sf_dir):
    """Rows per table after filling a project and creating it again."""
    project, location = _project(spark)
    resources = warehouse.bootstrap(spark, project, location)
    warehouse.save_rows(spark, raw_events(spark, sf_dir), resources["raw_events"])
    for name in fx.NETWORKS:
        warehouse.save_rows(spark, network_costs(spark, sf_dir, name), resources[f"{name}_ad_costs"])
    again = warehouse.bootstrap(spark, project, location)
    tables = [name for name in again if name != "database"]
    counts = [
        spark.table(again[name]).agg(F.count(F.lit(1)).alias("rows_stored")).select(
            F.lit(name).alias("table_name"), "rows_stored"
        )
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def jobs_end_to_end(spark, sf_dir):
    """Rows per table after all jobs of a project have run twice over raw events with copies."""
    number, location = _project(spark)
    resources = project.register_project(spark, number, location, excluded_referrers_query=fx.EXCLUDED_QUERY, buckets=8)
    raw = raw_events(spark, sf_dir)
    warehouse.save_rows(spark, raw.unionByName(_later_copies(raw)), resources["raw_events"])
    for name in fx.NETWORKS:
        warehouse.save_rows(spark, network_costs(spark, sf_dir, name), resources[f"{name}_ad_costs"])
    upload = run_path(spark, "upload")
    fx.manual_costs(spark, sf_dir).write.parquet(upload)
    options = {
        "update_manual_ad_costs": {"upload": upload, "file_format": "parquet"},
        "check_ad_costs_without_visits": {"by": ("source",)},
    }
    order = sorted(JOBS, key=lambda name: (name.startswith("check"), name.startswith("calculate")))
    for name in order + order:
        project.run_job(spark, number, name, **options.get(name, {}))
    counts = []
    for name in ("identified_events", "ad_costs", *project.RESULTS):
        rows = spark.table(resources[name])
        if project.CHECKED in rows.columns:
            last = rows.agg(F.max(project.CHECKED)).first()[0]
            rows = rows.where(F.col(project.CHECKED).eqNullSafe(F.lit(last).cast("bigint")))
        counts.append(rows.agg(F.count(F.lit(1)).alias("rows_stored")).select(F.lit(name).alias("table_name"), "rows_stored"))
    states = project.job_states(spark, number).where("last_status = 'success' and runs = 2")
    counts.append(states.agg(F.count(F.lit(1)).alias("rows_stored")).select(F.lit("job_states").alias("table_name"), "rows_stored"))
    return reduce(DataFrame.unionByName, counts)


@query
def partition_by_unit(spark, sf_dir):
    """Events per partition for hourly, daily, monthly and yearly partitions."""
    events = fx.staged_events(spark, sf_dir).select("event_id", "event_name", "timestamp")
    parts = []
    for unit in warehouse.PARTITION_UNITS:
        path = run_path(spark, f"by-{unit.lower()}")
        warehouse.write_by_unit(events, path, unit)
        stored = spark.read.schema("event_id string, partition_time string").parquet(path)
        parts.append(stored.groupBy(F.lit(unit).alias("unit"), "partition_time").agg(F.count(F.lit(1)).alias("events")))
    return reduce(DataFrame.unionByName, parts)


def _dated_table(spark: SparkSession, sf_dir: str, **options) -> str:
    project, location = _project(spark)
    database = warehouse.create_database(spark, project, location)
    events = fx.staged_events(spark, sf_dir).select("event_id", "event_name", "value", "date")
    warehouse.create_table(
        spark, database, "events_by_day", events.schema, clustering=("event_name",), **options
    )
    name = f"{database}.events_by_day"
    warehouse.save_rows(spark, events, name)
    return name


@query
def retention_survivors(spark, sf_dir):
    """Events per day that an expiry of ten days leaves, seen from the latest day."""
    name = _dated_table(spark, sf_dir, expiration_ms=10 * quality.DAY_MS)
    today = spark.table(name).agg(F.max("date")).first()[0]
    retention.expire_partitions(spark, name, today)
    return spark.table(name).groupBy(_day()).agg(F.count(F.lit(1)).alias("events"))


@query
def clustered_files(spark, sf_dir):
    """Per day, events and rows that come before a smaller one in their file, of a table clustered by event name."""
    name = _dated_table(spark, sf_dir)
    rows = spark.table(name).select(
        "date", "event_name", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    # Rows of a file are few next to a table's; the window reads each file's own.
    before = F.lag("event_name").over(Window.partitionBy("date", "file").orderBy("place"))
    return rows.withColumn("unordered", before > F.col("event_name")).groupBy(_day()).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("unordered").alias("unordered")
    )


@query
def partition_guard(spark, sf_dir):
    """Events per day of a table that only answers reads with a bound on its partition column."""
    name = _dated_table(spark, sf_dir, require_partition_filter=True)
    rows = warehouse.read_table(spark, name, date_from=date(2000, 1, 1))
    return rows.groupBy(_day()).agg(F.count(F.lit(1)).alias("events"))


@query
def partition_guard_by_unit(spark, sf_dir):
    """Events of eleven local dates inside the data, from tables by UTC hour, day, month and year of the event's time."""
    project_, location = _project(spark)
    database = warehouse.create_database(spark, project_, location)
    local = quality.local_date(F.col("timestamp"), ((F.col("user_id") % 5 - 2) * 14400).cast("int"))
    path = run_path(spark, "local-events")
    fx.staged_events(spark, sf_dir).select("event_id", "event_name", "timestamp", local.alias("date")).write.parquet(path)
    events = spark.read.parquet(path)
    first = events.agg(F.min("date")).first()[0] or date(2000, 1, 1)
    parts = []
    for unit in warehouse.PARTITION_UNITS:
        table = f"events_by_{unit.lower()}"
        warehouse.create_table(spark, database, table, events.schema, unit=unit, require_partition_filter=True)
        name = f"{database}.{table}"
        for half in range(2):
            warehouse.save_rows(spark, events.where(F.col("event_id").cast("bigint") % 2 == half), name)
        rows = warehouse.read_table(spark, name, first + timedelta(days=9), first + timedelta(days=19))
        parts.append(rows.groupBy(F.lit(unit).alias("unit"), _day()).agg(F.count(F.lit(1)).alias("events")))
    return reduce(DataFrame.unionByName, parts)


@query
def excluded_referrers(spark, sf_dir):
    """Events per excluded referrer, with the excluded list read from the project's view."""
    resources = warehouse.bootstrap(spark, *_project(spark), excluded_referrers_query=fx.EXCLUDED_QUERY)
    flagged = referrers.with_referrer(raw_events(spark, sf_dir), spark.table(resources["excluded_referrers"]))
    return flagged.where("referrer_excluded").groupBy("referrer_host").agg(F.count(F.lit(1)).alias("events"))


def _materialized(spark: SparkSession, sf_dir: str, disposition: str) -> DataFrame:
    project, location = _project(spark)
    database = warehouse.create_database(spark, project, location)
    view = f"staged_{project}"
    fx.staged_events(spark, sf_dir).createOrReplaceTempView(view)
    text = (
        f"select event_name, count(*) as events, cast(sum(cast(value as decimal(38,6))) as double) as total, `date` "
        f"from {view} group by event_name, `date`"
    )
    arguments = (spark, text, database, date(2024, 2, 1))
    options = {"write_disposition": disposition, "partitioning_field": "date"}
    name = materialize.materialize(*arguments, **options)
    try:
        materialize.materialize(*arguments, **options)
    except ValueError:
        if disposition != "WRITE_EMPTY":
            raise
    return spark.table(name).select("event_name", _day(), "events", "total")


@query
def materialize_truncate(spark, sf_dir):
    """A query materialized twice; the second run replaces the first."""
    return _materialized(spark, sf_dir, "WRITE_TRUNCATE")


@query
def materialize_append(spark, sf_dir):
    """A query materialized twice; the second run adds to the first."""
    return _materialized(spark, sf_dir, "WRITE_APPEND")


@query
def materialize_empty(spark, sf_dir):
    """A query materialized twice; the second run is refused."""
    return _materialized(spark, sf_dir, "WRITE_EMPTY")


@query
def config_enriched(spark, sf_dir):
    """Events of all projects with their project's settings."""
    events = raw_events(spark, sf_dir).withColumn(
        "project_id", F.substring_index(F.get("user_external_ids", F.lit(0))["value"], "u", -1).cast("bigint") % 5
    )
    enriched = configs.config_enriched(events, fx.project_configs(spark, sf_dir))
    return enriched.select(
        "event_id", "project_id", "timezone", "currency",
        F.col("unattributed_events_threshold").alias("threshold"),
        checks.is_ignored(F.col("ignored_event_filters")).alias("ignored"),
    )


@query
def job_last_run(spark, sf_dir):
    """Last successful start and last state per job and project."""
    return jobs.last_run(fx.job_runs(spark, sf_dir)).select("job", "project_id", "last_run", "last_status", "runs")


# ---- costs ----

def _network(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return costs.update_network_costs(network_costs(spark, sf_dir, name), name)


def _flat_costs(df: DataFrame) -> DataFrame:
    return df.select(
        _day(), "data_source", "source", "medium", "campaign", "term", "landing_hostname", "landing_page_path",
        "cost", "currency", "impressions", "reach", "clicks", "ad_id", "adgroup_id", "adgroup_name", "campaign_id",
    )


@query
def scan_network_costs(spark, sf_dir):
    """All snapshots of all networks."""
    networks = [(name, network_costs(spark, sf_dir, name)) for name in fx.NETWORKS]
    return costs.scan_network_costs(*networks).select(
        "network", "inserted_at", _day(), "ad_account_id", "ad_id", "keyword", "adset_id", "cost"
    )


@query
def facebook_costs_current(spark, sf_dir):
    """Newest snapshot, ad sets as ad groups."""
    return _flat_costs(_network(spark, sf_dir, "facebook_ads"))


@query
def google_costs_current(spark, sf_dir):
    """Newest snapshot, keywords as terms."""
    return _flat_costs(_network(spark, sf_dir, "google_ads"))


@query
def tiktok_costs_current(spark, sf_dir):
    """Newest snapshot."""
    return _flat_costs(_network(spark, sf_dir, "tiktok_ads"))


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = costs.check_manual_costs(fx.manual_costs(spark, sf_dir))
    return costs.unify_costs(*[_network(spark, sf_dir, name) for name in fx.NETWORKS], good)


@query
def ad_costs_unified(spark, sf_dir):
    """Costs of all networks and the good rows of the manual upload."""
    return _flat_costs(_unified(spark, sf_dir))


@query
def manual_costs_rejected(spark, sf_dir):
    """Rows of the manual upload that do not parse, with the reason."""
    upload = run_path(spark, "upload")
    fx.manual_costs(spark, sf_dir).write.csv(upload, header=True, escape='"')
    _, bad = costs.load_manual_costs(spark, upload)
    row = F.from_json("row", "`date` string, ad_id string, cost string")
    return bad.select(row["date"].alias("date"), row["ad_id"].alias("ad_id"), row["cost"].alias("cost"), "reason")


@query
def check_costs_without_visits(spark, sf_dir):
    """Cost rows without any visit."""
    networks = costs.unify_costs(*[_network(spark, sf_dir, name) for name in fx.NETWORKS])
    return checks.check_costs_without_visits(networks, fx.visits(spark, sf_dir)).select(
        _day(), "data_source", "source", "campaign", "term", "ad_id", "cost"
    )


@query
def costs_without_visits_by_source(spark, sf_dir):
    """Cost rows of all four sources on days without any visit from their source, with visits read from the events."""
    seen = checks.visits(raw_events(spark, sf_dir), fx.excluded_referrers(spark))
    return checks.check_costs_without_visits(_unified(spark, sf_dir), seen, by=("source",)).select(
        _day(), "data_source", "source", "campaign", "term", "ad_id", "cost"
    )


# ---- identity ----

@query
def identity_components(spark, sf_dir):
    """Every identifier with its profile."""
    return identity.identity_components(raw_events(spark, sf_dir))


@query
def identity_components_split(spark, sf_dir):
    """As ``identity_components``, with every busy identifier joined as a heavy one."""
    return identity.identity_components(raw_events(spark, sf_dir), max_group_rows=30)


@query
def identity_with_contacts(spark, sf_dir):
    """Every identifier, also e-mail addresses and phone numbers, with its profile."""
    return identity.identity_components(raw_events(spark, sf_dir), use_contacts=True)


@query
def identified_events(spark, sf_dir):
    """Events with the profile of their visitor."""
    identified = identity.identify_events(raw_events(spark, sf_dir), inserted_at=F.lit(1))
    return identified.select("event_id", _day(), "event_name", "profile_id", "inserted_at")


def _thirds(spark: SparkSession, sf_dir: str, seed_project: tuple[int, str]):
    """A project whose raw table gets the history in three parts by date; yields its tables after each part."""
    resources = project.register_project(spark, *seed_project, excluded_referrers_query=fx.EXCLUDED_QUERY, buckets=8)
    raw = raw_events(spark, sf_dir)
    days = sorted(row[0] for row in raw.select("date").distinct().collect())
    cut = [days[len(days) * i // 3:len(days) * (i + 1) // 3] for i in range(3)]
    for part in cut:
        if part:
            warehouse.save_rows(spark, raw.where(F.col("date").between(part[0], part[-1])), resources["raw_events"])
            yield resources
    if not days:
        yield resources


@query
def identity_incremental(spark, sf_dir):
    """As ``identified_events``, from three parts of the history, each resolved against the stored profiles."""
    for resources in _thirds(spark, sf_dir, _project(spark)):
        incremental.identify_dates(spark, resources["database"], inserted_at=F.lit(1))
    return spark.table(resources["identified_events"]).select("event_id", _day(), "event_name", "profile_id", "inserted_at")


@query
def attribution_incremental(spark, sf_dir):
    """As ``attribution_by_profile``, from three parts of the history; the last date then loses its purchases."""
    for resources in _thirds(spark, sf_dir, _project(spark)):
        incremental.identify_dates(spark, resources["database"], inserted_at=F.lit(1))
        incremental.attribute_dates(spark, resources["database"])
    table = resources["raw_events"]
    last = spark.table(table).agg(F.max("date")).first()[0]
    if last is not None:
        rest = incremental.kept(spark.table(table).where((F.col("date") == last) & (F.col("event_name") != "purchase")), "rest")
        warehouse.save_rows(spark, rest, table, overwrite=True)
        loads.note_dates(spark, table, [last])
        incremental.identify_dates(spark, resources["database"], inserted_at=F.lit(1))
        incremental.attribute_dates(spark, resources["database"])
    return _per_conversion(spark.table(resources["attributed_events"]))


# ---- attribution ----

def _attributed(spark: SparkSession, sf_dir: str, *arguments, **options) -> DataFrame:
    return attribution.attribute_events(
        profiled_events(spark, sf_dir), *arguments, excluded=fx.excluded_referrers(spark), **options
    )


def _per_conversion(attributed: DataFrame) -> DataFrame:
    return attributed.select("event_id", F.col("key").alias("profile"), "source", "medium", "touch_event_id", "value")


def _per_touch(attributed: DataFrame) -> DataFrame:
    return attributed.select("event_id", F.col("key").alias("profile"), "source", "conversions", "value")


@query
def purchase_revenue_by_source(spark, sf_dir):
    """Purchases and revenue by the source of the last touch."""
    attributed = _attributed(spark, sf_dir, "purchase")
    return attributed.groupBy(F.coalesce("source", F.lit("(unattributed)")).alias("source")).agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum(F.col("value").cast("decimal(38,6)")).cast("double").alias("revenue"),
    )


@query
def attribution_last_touch(spark, sf_dir):
    """Purchases with the latest touch of their visitor."""
    return _per_conversion(_attributed(spark, sf_dir, "purchase", "last_touch"))


@query
def attribution_first_touch(spark, sf_dir):
    """Purchases with the first touch inside the look-back period."""
    return _per_conversion(_attributed(spark, sf_dir, "purchase", "first_touch"))


@query
def attribution_linear(spark, sf_dir):
    """Touches with their equal shares of later purchases, and unattributed purchases."""
    return _per_touch(_attributed(spark, sf_dir, "purchase", "linear"))


@query
def attribution_position(spark, sf_dir):
    """Touches with 40/20/40 shares of later purchases, and unattributed purchases."""
    return _per_touch(_attributed(spark, sf_dir, "purchase", "position"))


@query
def attribution_linear_split(spark, sf_dir):
    """As ``attribution_linear``, with the events of busy visitors spread over several tasks."""
    return _per_touch(_attributed(spark, sf_dir, "purchase", "linear", max_group_rows=60))


def _by_profile(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    identified = identity.identify_events(raw_events(spark, sf_dir), inserted_at=F.lit(1))
    return _per_conversion(
        attribution.attribute_events(identified, "purchase", excluded=fx.excluded_referrers(spark), **options)
    )


@query
def attribution_by_profile(spark, sf_dir):
    """Purchases with the latest touch of their resolved profile."""
    return _by_profile(spark, sf_dir)


@query
def attribution_by_profile_split(spark, sf_dir):
    """As ``attribution_by_profile``, with the events of busy profiles spread over several tasks."""
    return _by_profile(spark, sf_dir, max_group_rows=1000)


@query
def attribution_linear_by_event(spark, sf_dir):
    """Touches with their equal shares of later purchases and of later signups."""
    shared = _attributed(spark, sf_dir, ("purchase", "signup"), "linear", value=F.lit(1.0))
    return shared.select(
        "event_id", "event_name", _day(), F.col("key").alias("profile"), "source", "conversions", "value"
    )


@query
def attribution_from_topic(spark, sf_dir):
    """From the topic's messages, copies among them, to purchases with the latest touch of their resolved profile."""
    target, _ = _ingest(spark, sf_dir)
    once = quality.dedupe_events(ingest.read_batches(spark, target, schema("raw_events")))
    identified = identity.identify_events(once, inserted_at=F.lit(1))
    return _per_conversion(
        attribution.attribute_events(identified, "purchase", excluded=fx.excluded_referrers(spark))
    )


@query
def check_unattributed_share(spark, sf_dir):
    """Unattributed share of purchases and signups per day, without ignored events."""
    kept = checks.drop_ignored(profiled_events(spark, sf_dir), IGNORED[:2])
    attributed = attribution.attribute_events(kept, ("purchase", "signup"), excluded=fx.excluded_referrers(spark))
    shares = checks.check_unattributed_share(attributed)
    return shares.withColumn("date", F.col("date").cast("string"))


@query
def ignored_events(spark, sf_dir):
    """Events that no ignore filter matches."""
    return checks.drop_ignored(raw_events(spark, sf_dir), IGNORED).select("event_id", "event_name")


@query
def campaign_performance(spark, sf_dir):
    """Costs, revenue, CPC, CTR and ROAS per source."""
    attributed = _attributed(spark, sf_dir, "purchase")
    return rollups.campaign_performance(_unified(spark, sf_dir), attributed, by=("source",))


@query
def campaign_performance_linear(spark, sf_dir):
    """Costs and shared revenue per UTM values, where conversions are the credit of touches."""
    attributed = _attributed(spark, sf_dir, "purchase", "linear")
    return rollups.campaign_performance(_unified(spark, sf_dir), attributed, by=rollups.UTM).drop("cpc", "ctr", "roas")


@query
def campaign_performance_by_currency(spark, sf_dir):
    """Costs and revenue per source and currency."""
    attributed = _attributed(spark, sf_dir, "purchase", currency=F.col("`order`.currency"))
    return rollups.campaign_performance(_unified(spark, sf_dir), attributed, by=("source", "currency"))


# ---- events ----

@query
def param_lookup(spark, sf_dir):
    """First value of a parameter, by type, and lookups in the string lists."""
    return raw_events(spark, sf_dir).select(
        "event_id",
        param("event_params", "k", "int_value").alias("k"),
        param("event_params", "value", "double_value").alias("value"),
        param("event_params", "landing_page_url", "string_value").alias("landing_page_url"),
        param("event_params", "referrer_url", "string_value").alias("referrer_url"),
        string_value("user_external_ids", "user_id").alias("external_id"),
        ad_value("ad_data", "google_ads", "campaign_id").alias("google_campaign"),
    )


@query
def external_ids(spark, sf_dir):
    """One row per external id."""
    return flatten.external_ids(raw_events(spark, sf_dir))


@query
def ad_data_flat(spark, sf_dir):
    """One row per network, key and value."""
    return flatten.ad_data_flat(raw_events(spark, sf_dir))


@query
def product_lines(spark, sf_dir):
    """One row per product with its net value."""
    return flatten.product_lines(raw_events(spark, sf_dir))


@query
def offer_lines(spark, sf_dir):
    """One row per offer with its net value."""
    return flatten.offer_lines(raw_events(spark, sf_dir))


@query
def url_parts(spark, sf_dir):
    """Host, path and parameters of landing pages."""
    events = raw_events(spark, sf_dir).select("event_id", referrers.landing_url().alias("landing_page_url"))
    pairs = F.transform("url_params", lambda p: F.concat_ws("=", p["key"], p["value"]["string_value"]))
    return flatten.url_parts(events, "landing_page_url").select(
        "event_id", "landing_hostname", "landing_page_path", F.array_join(pairs, "&").alias("params")
    )


@query
def external_referrals(spark, sf_dir):
    """Events that came from another, not excluded site."""
    return referrers.external_referrals(raw_events(spark, sf_dir), fx.excluded_referrers(spark)).select(
        "event_id", "referrer_host"
    )


@query
def real_events(spark, sf_dir):
    """Events that are not tests."""
    return quality.real_events(raw_events(spark, sf_dir)).select("event_id", "event_name")


@query
def local_dates(spark, sf_dir):
    """Local date by the device's offset."""
    return quality.local_dates(raw_events(spark, sf_dir)).select(
        "event_id", _day(), _day("local_date"), "date_differs"
    )


@query
def local_dates_in_zone(spark, sf_dir):
    """Local date in the project's time zone."""
    return quality.local_dates(raw_events(spark, sf_dir), "Asia/Tokyo").select(
        "event_id", _day(), _day("local_date"), "date_differs"
    )


@query
def variant_slot_violations(spark, sf_dir):
    """Typed values with more than one slot set."""
    return quality.variant_slot_violations(raw_events(spark, sf_dir)).withColumn(
        "slots_set", F.col("slots_set").cast("bigint")
    )


def _state(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return commerce.latest_state(raw_events(spark, sf_dir), entity).select(
        "id", "status", "value", "paid_value", "refund_value", "currency", "state_event_id"
    )


@query
def order_state(spark, sf_dir):
    """Latest state of each order."""
    return _state(spark, sf_dir, "order")


@query
def deal_state(spark, sf_dir):
    """Latest state of each deal."""
    return _state(spark, sf_dir, "deal")


@query
def deal_balance(spark, sf_dir):
    """Paid, refunded and net value of the latest deals per currency."""
    return commerce.balance_by_currency(commerce.latest_state(raw_events(spark, sf_dir), "deal"))


@query
def transaction_links(spark, sf_dir):
    """Transactions with the state of their order and deal."""
    return commerce.transaction_links(raw_events(spark, sf_dir))


@query
def geo_rollup(spark, sf_dir):
    """Events and profiles per place with subtotals."""
    return rollups.geo_rollup(profiled_events(spark, sf_dir))


@query
def device_cube(spark, sf_dir):
    """Events and profiles per combination of device properties."""
    return rollups.device_cube(profiled_events(spark, sf_dir))


def _days_table(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    """The bitmaps of a range of days inside the data, numbered in two steps; the first and last five days are left out."""
    events = profiled_events(spark, sf_dir)
    run = run_path(spark, "bitmaps")
    half = events.where(F.col("event_id").cast("bigint") % 2 == 0).select("profile_id")
    bitmaps.number_profiles(half).write.parquet(f"{run}/numbers")
    numbers = spark.read.schema(bitmaps.NUMBERS).parquet(f"{run}/numbers")
    bitmaps.number_profiles(events.select("profile_id"), numbers).write.parquet(f"{run}/later")
    numbers = numbers.unionByName(spark.read.schema(bitmaps.NUMBERS).parquet(f"{run}/later"))
    warehouse.replace_partitions(bitmaps.daily_profiles(events, numbers, columns), f"{run}/days", "date")
    first, last = events.agg(F.min("date"), F.max("date")).first()
    days = spark.read.parquet(f"{run}/days")
    inner = F.col("date").between(F.date_add(F.lit(first), 5), F.date_sub(F.lit(last), 5))
    return days.where(inner) if first is not None else days


@query
def geo_rollup_from_days(spark, sf_dir):
    """As ``geo_rollup`` for a range of days, from the days' bitmaps of profiles and no events."""
    return bitmaps.rollup_days(_days_table(spark, sf_dir, bitmaps.GEO), tuple(bitmaps.GEO))


@query
def device_cube_from_days(spark, sf_dir):
    """As ``device_cube`` for a range of days, from the days' bitmaps of profiles and no events."""
    return bitmaps.cube_days(_days_table(spark, sf_dir, bitmaps.DEVICE), tuple(bitmaps.DEVICE))
