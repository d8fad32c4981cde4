"""Duplicates, test events, wrong dates and contract violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from beaconlake.functions.params import slots_set
from beaconlake.operators.skew import MAX_BROADCAST_ROWS, MAX_GROUP_ROWS, small_lookup_join
from beaconlake.sources.messages import SANE_MS

DAY_MS = 86_400_000


def real_events(events: DataFrame) -> DataFrame:
    """Leave out test events; a missing flag counts as a real event."""
    return events.where(~F.coalesce(F.col("is_test_event"), F.lit(False)))


def dedupe_events(
    events: DataFrame,
    delay: str = "1 hour",
    max_group_rows: int = MAX_GROUP_ROWS,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    arrival: str | None = None,
) -> DataFrame:
    """First row per ``event_id``.

    A stream keeps the first row to arrive within ``delay`` of the watermark. The watermark follows the column
    ``arrival``, the time of publication, so that no sender's clock can move it; without one it follows ``timestamp``.
    A batch keeps the row with the smallest ``timestamp``, then the smallest row hash. It finds the repeated ids from
    the id column alone, so rows whose id is unique go through without a shuffle, as long as the repeated ids are few
    enough to broadcast. Rows without an id are not copies of each other and all stay.
    """
    if events.isStreaming:
        timed = events.withColumn("_event_time", F.col(arrival) if arrival else F.timestamp_millis("timestamp"))
        return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["event_id"]).drop("_event_time")
    keys = ["event_id"]
    copies = F.count(F.lit(1)).alias("group_rows")
    repeated = events.groupBy(*keys).agg(copies).where("event_id is not null and group_rows > 1").checkpoint()
    ids = repeated.count()
    if ids == 0:
        return events
    heavy = repeated.where(F.col("group_rows") > max_group_rows)
    heavy = None if heavy.isEmpty() else heavy

    def join(how: str) -> DataFrame:
        return small_lookup_join(
            events.where("event_id is not null"), repeated.select(*keys), keys, how, max_broadcast_rows, ids,
            heavy=heavy, look_for_heavy=False,
        )

    row = F.struct(*[F.col(c) for c in events.columns])
    age = F.struct(F.col("timestamp"), F.xxhash64(*[F.col(c) for c in events.columns]))
    first = join("left_semi").groupBy(*keys).agg(F.min_by(row, age).alias("row")).select("row.*")
    return join("left_anti").unionByName(first).unionByName(events.where("event_id is null"))


def local_date(timestamp: Column, offset_seconds: Column) -> Column:
    """Date at an offset from UTC, whatever the session time zone; null for a timestamp that no date can hold."""
    timestamp = F.when(timestamp.between(*SANE_MS), timestamp)
    days = F.floor((timestamp + F.coalesce(offset_seconds, F.lit(0)) * 1000) / DAY_MS)
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def local_dates(events: DataFrame, tz: str | None = None) -> DataFrame:
    """Add ``local_date``, from the device's offset or from a project time zone, and whether ``date`` differs."""
    if tz is None:
        local = local_date(F.col("timestamp"), F.col("device_info.timezone_offset_seconds"))
    else:
        low, high = SANE_MS
        sane = f"CASE WHEN `timestamp` BETWEEN {low} AND {high} THEN `timestamp` END"
        utc = F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, ({sane}) / 1000.0)")
        local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc).cast("date")
    return events.withColumn("local_date", local).withColumn(
        "date_differs", F.coalesce(F.col("local_date") != F.col("date"), F.lit(False))
    )


def column_paths(data_type: DataType, path: str = "") -> list[tuple[str, str]]:
    """Every column path of a schema with its type; list elements are written ``name[]``."""
    if isinstance(data_type, StructType):
        paths = []
        for field in data_type.fields:
            paths += column_paths(field.dataType, f"{path}.{field.name}" if path else field.name)
        return paths
    if isinstance(data_type, ArrayType):
        return column_paths(data_type.elementType, f"{path}[]")
    return [(path, data_type.simpleString())]


def contract_diff(df: DataFrame, expected: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """Differences between a frame and a contract: (missing|extra|type, path, expected type, actual type)."""
    want, have = dict(column_paths(expected)), dict(column_paths(df.schema))
    differences = [("missing", path, kind, None) for path, kind in want.items() if path not in have]
    differences += [("extra", path, None, kind) for path, kind in have.items() if path not in want]
    differences += [
        ("type", path, kind, have[path]) for path, kind in want.items() if path in have and have[path] != kind
    ]
    return differences


def column_fill(df: DataFrame) -> DataFrame:
    """One row per column path of the frame: its type and how many rows hold a value there.

    A path inside a list counts the rows where at least one element holds a value. One pass over the frame.
    """
    paths = column_paths(df.schema)
    counts = [
        F.struct(
            F.lit(path).alias("path"), F.lit(kind).alias("type"), F.count_if(_holds_value(df, path)).alias("rows_set")
        )
        for path, kind in paths
    ]
    return df.agg(F.array(*counts).alias("paths")).select(F.inline("paths"))


def _holds_value(df: DataFrame, path: str) -> Column:
    def step(value: Column, names: list[str]) -> Column:
        if not names:
            return value.isNotNull()
        name = names[0]
        if name == "[]":
            return F.exists(value, lambda element: step(element, names[1:]))
        return step(value[name], names[1:])

    names = path.replace("[]", ".[]").split(".")
    return F.coalesce(step(df[f"`{names[0]}`"], names[1:]), F.lit(False))


TYPED_LISTS = ("event_params", "user_properties", "deal.custom_params", "order.custom_params",
               "transaction.custom_params")


VIOLATIONS_TYPE = "array<struct<list:string,key:string,slots_set:int>>"


def _slot_counts(name: str) -> Column:
    column, *fields = name.split(".")
    entries = F.col(".".join([f"`{column}`", *fields]))
    counts = F.transform(
        entries,
        lambda entry: F.struct(
            F.lit(name).alias("list"), entry["key"].alias("key"), slots_set(entry["value"]).alias("slots_set")
        ),
    )
    return F.coalesce(counts, F.array().cast(VIOLATIONS_TYPE))


def variant_slot_violations(events: DataFrame) -> DataFrame:
    """Typed values with more than one slot set, from every typed list of an event."""
    found = F.flatten(F.array(*[_slot_counts(name) for name in TYPED_LISTS]))
    wrong = F.filter(found, lambda entry: entry["slots_set"] > 1)
    return events.select("event_id", F.inline(wrong))
