"""Which visit earned a conversion.

A touch is a visit event with a known source. A touch competes for a conversion of the same key when it comes before
it in (``timestamp``, ``event_id``) order and is at most ``lookback_days`` old; all models use this one rule, and events
must be deduplicated. No model pairs conversions with touches: the cost grows with the events, not with the product of
a busy key's touches and conversions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.operators.referrers import with_source
from beaconlake.operators.skew import MAX_GROUP_ROWS, heavy_keys, running

MODELS = ("last_touch", "first_touch", "linear", "position")
TOUCH_EVENTS = ("click", "view")
SOURCE_COLUMNS = ("source", "medium", "campaign", "content", "term")
DAY_MS = 86_400_000
# Leaves room for the ten digits a sum and the one an addition add, so that Spark keeps all nine decimals.
SHARE = "decimal(27,9)"

# Share of the first and of the last touch in the position model; the touches between them divide the rest.
POSITION_ENDS = 0.4

# Row kinds, in the order they take at one moment and event.
CONVERSION, TOUCH = 0, 1


def attribute_events(
    identified: DataFrame,
    conversion_event: str | Sequence[str],
    model: str = "last_touch",
    lookback_days: int = 7,
    excluded: DataFrame | None = None,
    key: str = "profile_id",
    value: Column | None = None,
    touch_events: Sequence[str] = TOUCH_EVENTS,
    max_group_rows: int = MAX_GROUP_ROWS,
    currency: Column | None = None,
    earlier_touches: DataFrame | None = None,
) -> DataFrame:
    """Attribute conversions to touches.

    ``excluded`` lists referrers that are no source. ``last_touch`` and ``first_touch`` give one row per conversion with
    the touch's id, time and source. ``linear`` and ``position`` give one row per touch that earned something and
    conversion event, with the conversions and the value credited to it, and one row per unattributed conversion.
    Unattributed rows have a null ``source``; a conversion without a key is always unattributed. ``event_name`` is the
    conversion's. ``date`` is the conversion's too, but for credit of the shared models it is the touch's. With
    ``currency`` (of the conversion) given, the models of one touch return it. ``earlier_touches`` (key, timestamp,
    event_id, source columns) stand for touches that ``identified`` leaves out; for the last touch, the last one of a day
    is enough.
    """
    if model not in MODELS:
        raise ValueError(f"model must be one of {MODELS}")
    if earlier_touches is not None and model != "last_touch":
        raise ValueError("earlier touches stand in for events only where the last one counts")
    names = [conversion_event] if isinstance(conversion_event, str) else list(conversion_event)
    value = F.col("`order`")["value"] if value is None else value
    # One touch takes the whole amount as it is; only shares are exact decimals, and an amount beyond them has no share.
    amount = value.cast("double") if model in ("last_touch", "first_touch") else value.try_cast(SHARE)
    is_conversion = F.coalesce(F.col("event_name").isin(names), F.lit(False))
    may_touch = F.coalesce(F.col("event_name").isin(list(touch_events)), F.lit(False))
    used = identified.where(F.col("event_name").isin([*names, *touch_events])).select(
        F.col(key).alias("key"), "date", "event_name", "timestamp", "event_id", amount.alias("value"),
        "event_params", *([] if currency is None else [currency.alias("currency")]),
    )
    # Counted before the URLs are read: an upper bound that needs the key and the event name only.
    heavy = heavy_keys(used.where("key is not null").select("key"), ["key"], max_group_rows)
    keyless = used.where(F.col("key").isNull() & is_conversion)
    # Rows that turn out to be neither conversion nor touch give no timeline row, so no filter repeats the URL reading.
    keyed = with_source(used.where("key is not null"), excluded).select(
        *[name for name in used.columns if name != "event_params"],
        *SOURCE_COLUMNS,
        is_conversion.alias("is_conversion"),
        (may_touch & F.col("source").isNotNull()).alias("is_touch"),
    )
    lookback_ms = lookback_days * DAY_MS
    if earlier_touches is not None:
        stored = [*earlier_touches.columns]
        keyed = keyed.unionByName(earlier_touches.where("key is not null").select(
            *[F.col(f"`{name}`") if name in stored else F.lit(name == "is_touch") if name.startswith("is_")
              else F.lit(None).cast(keyed.schema[name].dataType).alias(name) for name in keyed.columns]
        ).toDF(*keyed.columns))
    if model == "last_touch":
        return _last_touch(keyed, lookback_ms, heavy, max_group_rows).unionByName(_untouched(keyless))
    if model == "first_touch":
        return _first_touch(keyed, lookback_ms, heavy, max_group_rows).unionByName(_untouched(keyless))
    return _shared(keyed, keyless, names, model, lookback_ms, heavy, max_group_rows)


def touches(
    identified: DataFrame, excluded: DataFrame | None = None, key: str = "profile_id", touch_events: Sequence[str] = TOUCH_EVENTS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, the columns ``keep``, touch): the touches among events that have a key."""
    may_touch = identified.where(F.col("event_name").isin(list(touch_events)) & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), *keep, "timestamp", "event_id", "event_params"
    )
    return with_source(may_touch, excluded).where("source is not null").select("key", *keep, _touch_record().alias("touch"))


def _touch_record() -> Column:
    return F.struct("timestamp", "event_id", *SOURCE_COLUMNS)


def _kinds(rows: DataFrame, *kinds: tuple[Column, int, Column, int]) -> DataFrame:
    """One row per kind whose condition holds: (condition, kind, moment, rank at that moment)."""
    wanted = F.array_compact(
        F.array(
            *[
                F.when(condition, F.struct(moment.alias("at"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))
                for condition, kind, moment, rank in kinds
            ]
        )
    )
    return rows.select("*", F.inline(wanted))


def _given(rows: DataFrame) -> list[str]:
    return ["currency"] if "currency" in rows.columns else []


def _attributed(rows: DataFrame, touch: Column, valid: Column) -> DataFrame:
    winner = F.when(valid, touch)
    return rows.select(
        "key", "date", "event_name", "timestamp", "event_id", F.col("value").cast("double").alias("value"),
        winner["event_id"].alias("touch_event_id"),
        winner["timestamp"].alias("touch_timestamp"),
        *[winner[name].alias(name) for name in SOURCE_COLUMNS], *_given(rows),
    )


def _untouched(conversions: DataFrame) -> DataFrame:
    return conversions.select(
        "key", "date", "event_name", "timestamp", "event_id", F.col("value").cast("double").alias("value"),
        F.lit(None).cast("string").alias("touch_event_id"),
        F.lit(None).cast("bigint").alias("touch_timestamp"),
        *[F.lit(None).cast("string").alias(name) for name in SOURCE_COLUMNS], *_given(conversions),
    )


def _last_touch(rows: DataFrame, lookback_ms: int, heavy: DataFrame | None, max_group_rows: int) -> DataFrame:
    at = F.col("timestamp")
    timeline = _kinds(
        rows, (F.col("is_conversion"), CONVERSION, at, 1), (F.col("is_touch"), TOUCH, at, 1)
    )
    order = [F.col("timestamp"), F.col("event_id"), F.col("kind")]
    touch = F.when(F.col("kind") == TOUCH, _touch_record())
    seen = running(timeline, ["key"], order, {"touch": ("last", touch)}, heavy, max_group_rows)
    in_reach = F.col("timestamp") - F.col("touch.timestamp") <= lookback_ms
    return _attributed(seen.where(F.col("kind") == CONVERSION), F.col("touch"), in_reach)


def _first_touch(rows: DataFrame, lookback_ms: int, heavy: DataFrame | None, max_group_rows: int) -> DataFrame:
    """A conversion looks from the start of its look-back period for the next touch.

    Read backwards in time, that is again the latest touch seen so far.
    """
    at = F.col("timestamp")
    timeline = _kinds(
        rows,
        (F.col("is_conversion"), CONVERSION, at - lookback_ms, 0),
        (F.col("is_touch"), TOUCH, at, 1),
    )
    order = [F.col("at").desc(), F.col("rank").desc(), F.col("event_id").desc()]
    touch = F.when(F.col("kind") == TOUCH, _touch_record())
    seen = running(timeline, ["key"], order, {"touch": ("last", touch)}, heavy, max_group_rows)
    earlier = F.struct(F.col("touch.timestamp"), F.col("touch.event_id")) < F.struct("timestamp", "event_id")
    return _attributed(seen.where(F.col("kind") == CONVERSION), F.col("touch"), earlier)


def _shared(
    rows: DataFrame,
    keyless: DataFrame,
    names: Sequence[str],
    model: str,
    lookback_ms: int,
    heavy: DataFrame | None,
    max_group_rows: int,
) -> DataFrame:
    """Shares for all touches in reach, without pairing them with conversions.

    Touches of a key are numbered in order. The touches in reach of a conversion are then a range of numbers, found
    from two counts: touches before the conversion and touches before its look-back period. A conversion changes the
    credit only at the ends of that range, so a running total of those changes is each touch's credit, with a total for
    each of the conversion events that are asked for. Shares are decimals, so the totals are exact in any order.
    """
    at = F.col("timestamp")
    looked_back = 2
    timeline = _kinds(
        rows,
        (F.col("is_conversion"), CONVERSION, at, 1),
        (F.col("is_touch"), TOUCH, at, 1),
        (F.col("is_conversion"), looked_back, at - lookback_ms, 0),
    )
    order = [F.col("at"), F.col("rank"), F.col("event_id"), F.col("kind")]
    is_touch = (F.col("kind") == TOUCH).cast("bigint")
    # Read three times below: kept, so that the events are scanned and shuffled once.
    numbered = running(timeline, ["key"], order, {"number": ("sum", is_touch)}, heavy, max_group_rows).checkpoint()

    reach = (
        numbered.where(F.col("kind") != TOUCH)
        .groupBy("key", "date", "event_name", "timestamp", "event_id", "value")
        .agg(
            F.max(F.when(F.col("kind") == CONVERSION, F.col("number"))).alias("last"),
            (F.max(F.when(F.col("kind") == looked_back, F.col("number"))) + 1).alias("first"),
        )
        .withColumn("touches", F.col("last") - F.col("first") + 1)
    )
    changes = reach.where("touches > 0").select(
        "key", "event_name", F.inline(_changes(model)), F.lit(None).cast("string").alias("event_id"),
        F.lit(None).cast("date").alias("date"), F.lit(None).cast("bigint").alias("timestamp"),
        *[F.lit(None).cast("string").alias(name) for name in SOURCE_COLUMNS],
    )
    touches = numbered.where(F.col("kind") == TOUCH).select(
        "key", F.lit(None).cast("string").alias("event_name"), "number", "event_id", "date", "timestamp", *SOURCE_COLUMNS,
        F.lit(None).cast(SHARE).alias("conversions"), F.lit(None).cast(SHARE).alias("value"),
    )
    steps = touches.unionByName(changes)
    order = [F.col("number"), F.col("event_id").asc_nulls_first()]
    totals: dict[str, tuple[str, Column]] = {}
    for i, name in enumerate(names):
        own = F.col("event_name") == name
        totals[f"credited_{i}"] = ("sum", F.when(own, F.col("conversions")))
        totals[f"credited_value_{i}"] = ("sum", F.when(own, F.col("value")))
    credit = running(steps, ["key"], order, totals, heavy, max_group_rows)
    per_name = F.array(*[
        F.struct(
            F.lit(name).alias("event_name"), F.col(f"credited_{i}").alias("credited"),
            F.col(f"credited_value_{i}").alias("credited_value"),
        )
        for i, name in enumerate(names)
    ])
    earned = credit.where("event_id is not null").select(
        "key", "date", "event_id", "timestamp", *SOURCE_COLUMNS, F.inline(F.filter(per_name, lambda c: c["credited"] != 0))
    )
    columns = ["key", "date", "event_name", "event_id", "timestamp"]
    earned = earned.select(
        *columns, *SOURCE_COLUMNS,
        F.col("credited").cast("double").alias("conversions"),
        F.coalesce(F.col("credited_value").cast("double"), F.lit(0.0)).alias("value"),
    )
    unattributed = reach.where("touches <= 0").select(*columns, "value").unionByName(keyless.select(*columns, "value"))
    return earned.unionByName(
        unattributed.select(
            *columns, *[F.lit(None).cast("string").alias(name) for name in SOURCE_COLUMNS],
            F.lit(1.0).alias("conversions"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"),
        )
    )


def _changes(model: str) -> Column:
    """Where the credit changes: ``array<struct<number, conversions, value>>``."""
    count = F.col("touches")
    value = F.coalesce(F.col("value"), F.lit(0).cast(SHARE))

    def part(amount: Column, share: Column) -> Column:
        return (amount * share).cast(SHARE)

    def change(number: Column, to_count: Column, to_value: Column) -> Column:
        return F.struct(number.alias("number"), to_count.cast(SHARE).alias("conversions"),
                        to_value.cast(SHARE).alias("value"))

    even = (F.lit(1).cast("decimal(20,0)") / count.cast("decimal(20,0)")).cast(SHARE)
    even_value = (value / count.cast("decimal(20,0)")).cast(SHARE)
    linear = F.array(
        change(F.col("first"), even, even_value), change(F.col("last") + 1, -even, -even_value)
    )
    if model == "linear":
        return linear

    ends = F.lit(POSITION_ENDS).cast("decimal(2,1)")
    between = F.lit(1 - 2 * POSITION_ENDS).cast("decimal(2,1)")
    inner = F.greatest(count - 2, F.lit(1)).cast("decimal(20,0)")
    end_value = part(value, ends)
    inner_share = (between / inner).cast(SHARE)
    inner_value = (part(value, between) / inner).cast(SHARE)
    position = F.array(
        change(F.col("first"), ends, end_value),
        change(F.col("first") + 1, inner_share - ends, inner_value - end_value),
        change(F.col("last"), ends - inner_share, end_value - inner_value),
        change(F.col("last") + 1, -ends, -end_value),
    )
    return F.when(count <= 2, linear).otherwise(position)
