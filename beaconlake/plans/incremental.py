"""Identity and attribution of a project, brought up to date from the dates that changed.

Identification keeps, under a version number per run: the ids of stored events (``seen_events``, bucketed), every
identifier with the profile it was first given (``identity_nodes``, bucketed), what profiles that were merged are called
now (``identity_aliases``, whole in each version) and on which dates a profile has events (``profile_dates``). A run reads
the changed dates of the raw table and these tables. New links are resolved among profiles, and of the identified events
only the changed dates and those with a renamed profile are written again.

Attribution keeps the last touch per profile and day (``daily_touches``) and which days the events of a date fall on
(``event_days``; a date is its sender's, a day is UTC). A conversion can change when events of its day or of a day in its
look-back period have, so those dates are attributed again: from their days' events and the touches of the days before.
A date left without conversions loses its partition.

A run's last step is a row in its version table. If a run fails before, the next one repeats it from the same state: what
it wrote under its version is replaced, and dates written already come out the same.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.operators import attribution, identity, seen
from beaconlake.operators.skew import MAX_GROUP_ROWS, lookup_join, small_lookup_join
from beaconlake.plans import loads, storage, warehouse
from beaconlake.session import run_path

BUCKETS = 200
#: Versions after which the small parts of the bucketed tables are brought together.
VERSIONS_TO_FOLD = 50

#: Tables that grow by a part per run, with the column they are bucketed by.
FOLDED = {"seen_events": "event_id", "identity_nodes": "node", "profile_dates": None}

NODES = "node STRING, profile_id STRING"
TABLES = {
    "identity_nodes": f"{NODES}, version INT) USING parquet PARTITIONED BY (version) CLUSTERED BY (node) SORTED BY (node) INTO {{buckets}} BUCKETS",
    "identity_aliases": "old_profile_id STRING, profile_id STRING, version INT) USING parquet PARTITIONED BY (version)",
    "profile_dates": "profile_id STRING, `date` DATE, version INT) USING parquet PARTITIONED BY (version)",
    "identity_versions": "version INT, dates ARRAY<DATE>, changed ARRAY<DATE>, loads ARRAY<STRING>, ended_ms BIGINT) USING parquet",
    "daily_touches": (
        "key STRING, `timestamp` BIGINT, event_id STRING, "
        + ", ".join(f"{name} STRING" for name in attribution.SOURCE_COLUMNS) + ", day DATE) USING parquet PARTITIONED BY (day)"
    ),
    "event_days": "day DATE, `date` DATE) USING parquet PARTITIONED BY (`date`)",
    "attribution_versions": "version INT, options STRING, ended_ms BIGINT) USING parquet",
}


def create_state(spark: SparkSession, database: str, buckets: int = BUCKETS) -> None:
    """The tables above, where they are absent."""
    for name, rest in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({rest.format(buckets=buckets)}")
    seen.create_seen(spark, f"`{database}`.`seen_events`", buckets)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df``, complete in the shared folder: computed once, and what it was read from may then be written."""
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate rows of one run: complete in the shared folder, and removed at the run's end."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database, self.folder, self.names = spark, database, run_path(spark, "state"), 0

    def __enter__(self) -> Scratch:
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.names += 1
        path = f"{self.folder}/{self.names}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        if self.names:
            storage.remove_folder(self.spark, self.database, self.folder)


def _save_version(spark: SparkSession, rows: DataFrame, table: str, version: int) -> None:
    warehouse.save_rows(spark, rows.withColumn("version", F.lit(version)), table)


def _versions(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _drop_versions(spark: SparkSession, table: str, versions: Iterable[int]) -> None:
    specs = ", ".join(f"PARTITION (version = {number})" for number in versions)
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs} PURGE")


def fold_versions(spark: SparkSession, table: str, version: int, bucketed_by: str | None = None) -> None:
    """Bring the rows of all versions up to ``version`` into that one, so that a table of many runs has few files.

    If it fails in between, rows are there twice, which their readers allow for.
    """
    rows = kept(spark.table(table).where(F.col("version") <= version).drop("version").distinct(), "fold")
    older = [number for number in _versions(spark, table) if number < version]
    if bucketed_by:
        seen.save_bucketed(spark, rows.withColumn("version", F.lit(version)), table, bucketed_by)
    else:
        warehouse.save_rows(spark, rows.withColumn("version", F.lit(version)), table, overwrite=True)
    _drop_versions(spark, table, older)


def _committed(spark: SparkSession, database: str, name: str) -> int:
    return spark.table(f"`{database}`.`{name}`").agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def _dates(df: DataFrame, name: str = "date") -> list[date]:
    """The distinct dates of a column; they are few, so they come to the driver."""
    return sorted(row[0] for row in df.select(name).where(F.col(name).isNotNull()).distinct().collect())


def partition_dates(spark: SparkSession, table: str, name: str = "date") -> list[date]:
    """Dates that a table partitioned by ``name`` has, from the catalog alone."""
    values = (dict(part.split("=", 1) for part in row[0].split("/"))[name] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return sorted(date.fromisoformat(value) for value in values if value[:1].isdigit())


def drop_dates(spark: SparkSession, table: str, dates: Iterable[date], name: str = "date") -> None:
    specs = ", ".join(f"PARTITION (`{name}` = '{day}')" for day in sorted(dates))
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs} PURGE")


def replace_dates(
    spark: SparkSession, rows: DataFrame, table: str, dates: Sequence[date], scratch: Scratch, name: str = "date", complete: bool = False
) -> None:
    """Make ``rows`` all that ``table`` has of ``dates``: dates without rows lose their partition.

    The rows are complete in the shared folder first, unless the caller says that they are.
    """
    rows = rows if complete else scratch.keep(rows)
    warehouse.save_rows(spark, rows, table, overwrite=True)
    drop_dates(spark, table, set(dates) - set(_dates(rows, name)), name)


def on_dates(df: DataFrame, dates: Sequence[date], name: str = "date") -> DataFrame:
    """The rows of some dates, as a short condition that prunes partitions."""
    epoch = date(1970, 1, 1)
    condition, run = F.lit(False), []
    ordered = sorted((day - epoch).days for day in set(dates))
    for i, number in enumerate(ordered):
        run.append(number)
        if i + 1 == len(ordered) or ordered[i + 1] != number + 1:
            first, last = (epoch + timedelta(days=n) for n in (run[0], run[-1]))
            condition, run = condition | F.col(name).between(F.lit(first), F.lit(last)), []
    return df.where(condition)


# ---- identity ----

def changed_dates(spark: SparkSession, database: str) -> tuple[list[date], list[str]]:
    """(dates of the raw table that no run has seen as they are, loads that they came with)."""
    raw = f"{database}.raw_events"
    versions = spark.table(f"`{database}`.`identity_versions`")
    done = versions.select(F.explode("loads").alias("load")).distinct()
    fresh = loads.ledger(spark, raw).join(done, "load", "left_anti")
    new_loads = [row[0] for row in fresh.select("load").distinct().collect()]
    known = {row[0] for row in versions.select(F.explode("dates").alias("date")).distinct().collect()}
    unknown = set(partition_dates(spark, raw)) - known
    return sorted(unknown | set(_dates(fresh))), new_loads


def profiles_now(nodes: DataFrame, aliases: DataFrame, look_for_heavy: bool = True) -> DataFrame:
    """(node, profile_id) with the profiles' present names."""
    renamed = aliases.select(F.col("old_profile_id").alias("profile_id"), F.col("profile_id").alias("_now"))
    joined = lookup_join(nodes.select("node", "profile_id"), renamed, ["profile_id"], look_for_heavy=look_for_heavy)
    return joined.select("node", F.coalesce("_now", "profile_id").alias("profile_id"))


def identify_dates(
    spark: SparkSession, database: str, dates: Sequence[date] | None = None, inserted_at: Column | None = None, avid_col: str = "avid",
) -> list[date]:
    """Bring ``identified_events`` up to date with ``dates`` of ``raw_events``, by default those that have changed.

    Returns the dates of identified events that were written: the given ones, those with a renamed profile, and those that
    lose a row because an earlier copy of it has come. Copies are dropped across all dates.
    """
    create_state(spark, database)
    found, new_loads = changed_dates(spark, database)
    dates = found if dates is None else sorted(dates)
    if not dates:
        return []
    with Scratch(spark, database) as scratch:
        return _identify(spark, database, dates, new_loads, inserted_at, avid_col, scratch)


def _identify(
    spark: SparkSession, database: str, dates: Sequence[date], new_loads: Sequence[str], inserted_at: Column | None, avid_col: str,
    scratch: Scratch,
) -> list[date]:
    kept = scratch.keep

    def table(name: str) -> str:
        return f"{database}.{name}"

    before = _committed(spark, database, "identity_versions")
    version = before + 1

    def stored(name: str) -> DataFrame:
        return spark.table(table(name)).where(F.col("version") <= before).drop("version")

    # What a run that failed has left under this version.
    for name in ("seen_events", "identity_nodes", "identity_aliases", "profile_dates"):
        _drop_versions(spark, table(name), [version])
        if name in FOLDED and len(_versions(spark, table(name))) > VERSIONS_TO_FOLD:
            fold_versions(spark, table(name), before, FOLDED[name])

    buckets = seen.bucket_count(spark, table("seen_events"))
    raw = on_dates(spark.table(table("raw_events")), dates)
    new = kept(seen.new_events(raw, stored("seen_events"), buckets))
    nodes = new.select("event_id", identity.event_nodes(avid_col).alias("nodes"))
    edges = kept(identity.event_edges(nodes))
    # No key has more rows than there are: with few rows nothing needs to look for busy identifiers.
    many = new.count() > MAX_GROUP_ROWS or edges.count() > MAX_GROUP_ROWS

    # Profiles of the nodes that the new events name. Only their side is brought to the buckets of the stored nodes.
    named = nodes.select(F.explode("nodes").alias("node")).distinct()
    aliases = spark.table(table("identity_aliases")).where(F.col("version") == before).drop("version")
    given = stored("identity_nodes").groupBy("node").agg(F.min("profile_id").alias("profile_id"))
    known = seen.meet_buckets(named, "node", buckets).join(given.hint("merge"), "node")
    known = kept(profiles_now(known, aliases, many))
    merged, renamed = identity.merge_profiles(known, edges, many)
    merged, renamed = kept(merged), kept(renamed)

    seen.remember(spark, new, table("seen_events"), version)
    fresh = named.join(known, "node", "left_anti").join(merged, "node", "left").select(
        "node", F.coalesce("profile_id", "node").alias("profile_id")
    )
    seen.save_bucketed(spark, fresh.withColumn("version", F.lit(version)), table("identity_nodes"), "node")
    _save_version(spark, identity.extend_aliases(aliases, renamed, aliases.count() > MAX_GROUP_ROWS), table("identity_aliases"), version)

    # Names of the new events' profiles: all their nodes share one.
    names = renamed.select(F.col("old_profile_id").alias("profile_id"), F.col("profile_id").alias("_now"))
    now = lookup_join(known, names, ["profile_id"], look_for_heavy=many).select(
        "node", F.coalesce("_now", "profile_id").alias("profile_id")
    ).unionByName(fresh)
    inserted_at = F.unix_millis(F.current_timestamp()) if inserted_at is None else inserted_at
    identified = identity.with_profiles(new.drop("row_hash", "replaces"), kept(now), avid_col, inserted_at, look_for_heavy=many)

    # Dates written before that have a renamed profile or lose a row.
    written, others = identified.withColumn("_now", F.col("profile_id")), []
    replaced = new.where("replaces is not null").select("event_id", F.col("replaces").alias("date"))
    if before:
        moved = renamed.select(F.col("old_profile_id").alias("profile_id"))
        touched = small_lookup_join(stored("profile_dates"), moved, ["profile_id"], "left_semi")
        others = sorted((set(_dates(touched)) | set(_dates(replaced))) - set(dates))
    if others:
        old = on_dates(spark.table(table("identified_events")), others)
        old = small_lookup_join(old, replaced.select("event_id").distinct(), ["event_id"], "left_anti")
        again = small_lookup_join(old, names, ["profile_id"])
        again = again.withColumn("profile_id", F.coalesce("_now", "profile_id")).select(*[F.col(f"`{c}`") for c in identified.columns], "_now")
        written = written.unionByName(again)
    written = kept(written)
    # Only names that these dates did not have before.
    pairs = written.where("_now is not null").select("profile_id", "date").distinct()
    _save_version(spark, pairs, table("profile_dates"), version)
    replace_dates(spark, written.drop("_now"), table("identified_events"), [*dates, *others], scratch, complete=True)

    changed = sorted({*dates, *others})
    commit = [(version, list(dates), changed, new_loads, int(time.time() * 1000))]
    columns = "version INT, dates ARRAY<DATE>, changed ARRAY<DATE>, loads ARRAY<STRING>, ended_ms BIGINT"
    spark.createDataFrame(commit, columns).write.insertInto(table("identity_versions"))
    # Aliases are whole in each version; those before the last are not read any more.
    _drop_versions(spark, table("identity_aliases"), [n for n in _versions(spark, table("identity_aliases")) if n < before])
    return changed


# ---- attribution ----

def utc_day(timestamp: Column) -> Column:
    """UTC day of a time in milliseconds, as a date."""
    return F.date_add(F.lit(date(1970, 1, 1)), F.floor(timestamp / attribution.DAY_MS).cast("int"))


def attribute_dates(
    spark: SparkSession, database: str, conversion_events: Sequence[str] = ("purchase",), model: str = "last_touch", lookback_days: int = 7,
) -> list[date]:
    """Bring ``attributed_events`` up to date with ``identified_events``; returns the dates that were attributed again.

    What the changed dates are, the versions of ``identify_dates`` since the last run say. With other options than those
    of the last run all dates are attributed again.
    """
    if model not in ("last_touch", "first_touch"):
        raise ValueError("the table of attributed events holds one touch per conversion")
    create_state(spark, database)
    with Scratch(spark, database) as scratch:
        return _attribute(spark, database, conversion_events, model, lookback_days, scratch)


def _attribute(
    spark: SparkSession, database: str, conversion_events: Sequence[str], model: str, lookback_days: int, scratch: Scratch
) -> list[date]:
    def table(name: str) -> str:
        return f"{database}.{name}"

    options = f"{sorted(conversion_events)} {model} {lookback_days}"
    last = spark.table(table("attribution_versions")).orderBy(F.desc("ended_ms")).first()
    version = _committed(spark, database, "identity_versions")
    versions = spark.table(table("identity_versions")).where(F.col("version") > (last.version if last else 0))
    changed = _dates(versions.select(F.explode("changed").alias("date")))
    events, attributed = spark.table(table("identified_events")), table("attributed_events")
    everything = last is None or last.options != options
    if not changed and not everything:
        return []

    # Pairs of date and day only grow: days that a date has lost are then looked at once more than needed.
    day = utc_day(F.col("timestamp"))
    fresh_pairs = on_dates(events, changed).where("timestamp is not null").select(day.alias("day"), "date")
    old_pairs = spark.table(table("event_days"))
    fresh_pairs = scratch.keep(fresh_pairs.unionByName(on_dates(old_pairs, changed)).distinct())
    warehouse.save_rows(spark, fresh_pairs, table("event_days"), overwrite=True)
    pairs = spark.table(table("event_days"))

    excluded = spark.table(table("excluded_referrers"))
    changed_days = _dates(fresh_pairs, "day")
    _update_touches(spark, database, events, pairs, changed_days, excluded, scratch)

    if everything:
        out = sorted({*partition_dates(spark, table("identified_events")), *partition_dates(spark, attributed)})
    else:
        # A touch reaches conversions up to the look-back period after its day.
        reached = {d + timedelta(days=n) for d in changed_days for n in range(lookback_days + 1)}
        out = sorted({*changed, *_dates(on_dates(pairs, sorted(reached), "day"))})
    days = _dates(on_dates(pairs, out), "day")
    before = sorted({d - timedelta(days=n) for d in days for n in range(1, lookback_days + 1)} - set(days))
    if model == "first_touch":
        # The first touch of a day may lie before a conversion's look-back period, so the events are needed.
        used, earlier = sorted({*days, *before}), None
    else:
        used, earlier = days, on_dates(spark.table(table("daily_touches")), before, "day").drop("day")
    # Events of these days, whatever their date; those without a time are of no day and only conversions.
    inputs = sorted({*out, *_dates(on_dates(pairs, used, "day"))})
    read = on_dates(events, inputs)
    read = on_dates(read.withColumn("_day", day), used, "_day").unionByName(read.where("timestamp is null").withColumn("_day", F.lit(None).cast("date")))
    rows = attribution.attribute_events(
        read.drop("_day"), list(conversion_events), model, lookback_days, excluded=excluded, earlier_touches=earlier
    )
    replace_dates(spark, on_dates(rows, out), attributed, out, scratch)
    commit = [(version, options, int(time.time() * 1000))]
    spark.createDataFrame(commit, "version INT, options STRING, ended_ms BIGINT").write.insertInto(table("attribution_versions"))
    return out


def _update_touches(
    spark: SparkSession, database: str, events: DataFrame, pairs: DataFrame, days: Sequence[date], excluded: DataFrame,
    scratch: Scratch,
) -> None:
    """Last touch per profile of some days, from the dates that have events on them."""
    dates = _dates(on_dates(pairs, days, "day"))
    read = on_dates(on_dates(events, dates).withColumn("day", utc_day(F.col("timestamp"))), days, "day")
    last = attribution.touches(read, excluded, keep=("day",)).groupBy("key", "day").agg(
        F.max_by("touch", F.struct("touch.timestamp", "touch.event_id")).alias("touch")
    )
    columns = [F.col(f"touch.`{name}`") for name in ("timestamp", "event_id", *attribution.SOURCE_COLUMNS)]
    replace_dates(spark, last.select("key", *columns, "day"), f"{database}.daily_touches", days, scratch, "day")
