"""Profiles counted exactly over any range of days, from bitmaps per day instead of events.

Every profile has a number. A day's table holds, per group of column values, the number of events and a bitmap of the
profiles seen, cut into buckets of 32,768 numbers. Bitmaps of several days or groups are joined by OR, and their bits are
the distinct profiles: a report over a year reads the days' rows and no event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconlake.operators.skew import lookup_join

NUMBERS = "profile_id STRING, number BIGINT"
#: Ranges of profiles that are numbered beside each other.
PARTS = 64

GEO = {"continent": "geo.continent", "country": "geo.country", "city": "geo.city"}
DEVICE = {
    "category": "device_info.category", "operating_system": "device_info.operating_system", "browser": "device_info.web_info.browser",
}


def number_profiles(profiles: DataFrame, numbers: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """Numbers for those of ``profiles`` (profile_id) that ``numbers`` lacks; append them to it.

    Profiles are dealt to ``parts`` parts by hash. Part i gives i, i + parts, i + 2 parts, ..., so numbers stay dense, no
    task sees all profiles, and later profiles go on where the part has stopped.
    """
    part = F.pmod(F.xxhash64("profile_id"), F.lit(parts))
    new = profiles.select("profile_id").where("profile_id is not null").distinct()
    place = F.row_number().over(Window.partitionBy("part").orderBy("profile_id"))
    if numbers is None:
        return new.withColumn("part", part).select("profile_id", ((place - 1) * parts + F.col("part")).cast("bigint").alias("number"))
    new = new.join(numbers.select("profile_id"), "profile_id", "left_anti").withColumn("part", part)
    # One row per part.
    used = numbers.groupBy((F.col("number") % parts).alias("part")).agg(F.max("number").alias("last"))
    used = used.select("part", (F.col("last") - F.col("part") + parts).alias("next"))
    start = F.coalesce("next", F.lit(0).cast("bigint"))
    return new.join(F.broadcast(used), "part", "left").select(
        "profile_id", (start + (place - 1) * parts + F.col("part")).cast("bigint").alias("number")
    )


def daily_profiles(events: DataFrame, numbers: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of a day's table: (date, the names of ``columns``, bucket, profiles, events).

    A group has a row per bucket of profile numbers, and one without bucket that counts its events.
    """
    groups = events.select("date", *[F.col(path).alias(name) for name, path in columns.items()], "profile_id")
    # Summed per group and profile first: what is shuffled does not grow with the events of a profile.
    counted = groups.groupBy(*groups.columns).agg(F.count(F.lit(1)).alias("n"))
    numbered = lookup_join(counted, numbers.select("profile_id", "number"), ["profile_id"])
    keys = ["date", *columns]
    maps = numbered.where("number is not null").groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("profiles"), F.lit(None).cast("bigint").alias("events")
    )
    sums = numbered.groupBy(*keys).agg(F.sum("n").alias("events"))
    empty = [F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("profiles")]
    return maps.unionByName(sums.select(*keys, *empty, "events"))


def merged(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of several days or finer groups brought to one per group of ``keys`` and bucket."""
    sized = [F.bitmap_or_agg("profiles").alias("profiles"), F.sum("events").alias("events")]
    maps = daily.where("bucket is not null").groupBy(*keys, "bucket").agg(*sized)
    sums = daily.where("bucket is null").groupBy(*keys).agg(F.sum("events").alias("events"))
    return maps.unionByName(sums.select(
        *keys, F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("profiles"), "events"
    ))


def counts(groups: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(names, level, events, profiles) of groups that are merged by ``keys``; other names are null.

    ``level`` has a bit per name that is not a key, the first name's the highest.
    """
    level = sum(1 << i for i, name in enumerate(reversed(names)) if name not in keys)
    totals = groups.groupBy(*keys).agg(
        F.coalesce(F.sum("events"), F.lit(0)).cast("bigint").alias("events"),
        F.coalesce(F.sum(F.bitmap_count("profiles")), F.lit(0)).cast("bigint").alias("profiles"),
    )
    return totals.select(
        *[F.col(name) if name in keys else F.lit(None).cast(groups.schema[name].dataType).alias(name) if name in groups.columns
          else F.lit(None).cast("string").alias(name) for name in names],
        F.lit(level).cast("bigint").alias("level"), "events", "profiles",
    )


def rollup_days(daily: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts with subtotals, as ``geo_rollup`` gives from events: each level is merged from the one below it."""
    result, groups = None, daily
    for n in range(len(names), -1, -1):
        groups = merged(groups, names[:n])
        level = counts(groups, names[:n], names)
        result = level if result is None else result.unionByName(level)
    return result


def cube_days(daily: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts for every combination of the names, as ``device_cube`` gives from events."""
    finest = merged(daily, names)
    result = None
    for chosen in range(1 << len(names)):
        keys = [name for i, name in enumerate(names) if chosen >> i & 1]
        part = counts(merged(finest, keys), keys, names)
        result = part if result is None else result.unionByName(part)
    return result

