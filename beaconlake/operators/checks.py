"""Data checks and event filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.contracts import UNATTRIBUTED_THRESHOLD_PERCENT
from beaconlake.operators.attribution import TOUCH_EVENTS
from beaconlake.operators.referrers import with_source
from beaconlake.operators.rollups import UTM
from beaconlake.operators.skew import MAX_GROUP_ROWS, lookup_join

FILTER_TYPE = "array<struct<event_name:string,param_key:string,param_value:string>>"


def ignored_filters(filters: Sequence[tuple[str, str | None, str | None]]) -> Column:
    """A project's filters (event name, parameter key or None, parameter value or None) as an array column."""
    entries = [
        F.struct(
            F.lit(name).alias("event_name"),
            F.lit(key).cast("string").alias("param_key"),
            F.lit(value).cast("string").alias("param_value"),
        )
        for name, key, value in filters
    ]
    return F.array(*entries).cast(FILTER_TYPE)


def is_ignored(filters: Column) -> Column:
    """Whether an event matches any filter: its name, and, where the filter names one, a parameter and its value.

    Filters are part of the project's configuration, so they are read row by row from an array and need no join.
    """
    def matches(rule: Column) -> Column:
        has_param = F.exists(
            "event_params",
            lambda p: (p["key"] == rule["param_key"])
            & (rule["param_value"].isNull() | (p["value"]["string_value"] == rule["param_value"])),
        )
        return (rule["event_name"] == F.col("event_name")) & (rule["param_key"].isNull() | has_param)

    return F.coalesce(F.exists(filters, matches), F.lit(False))


def drop_ignored(events: DataFrame, filters: Sequence[tuple[str, str | None, str | None]] | Column) -> DataFrame:
    """Leave out events that match an ignored-event filter; an empty list leaves everything in."""
    column = filters if isinstance(filters, Column) else ignored_filters(filters)
    return events.where(~is_ignored(column))


def check_unattributed_share(
    attributed: DataFrame, threshold_pct: float | Column = UNATTRIBUTED_THRESHOLD_PERCENT
) -> DataFrame:
    """Unattributed share of conversions per date and event name, and whether it is above the threshold in percent.

    Rows of the models that share a conversion count with their credit, which is dated by the touch.
    """
    missing = F.col("source").isNull()
    if "conversions" in attributed.columns:
        part = F.col("conversions").cast("decimal(38,9)")
        total, unattributed = F.sum(part), F.coalesce(F.sum(F.when(missing, part)), F.lit(0).cast("decimal(38,9)"))
        total, unattributed = total.cast("double"), unattributed.cast("double")
    else:
        total, unattributed = F.count(F.lit(1)), F.count_if(missing)
    shares = attributed.groupBy("date", "event_name").agg(total.alias("total"), unattributed.alias("unattributed"))
    threshold = threshold_pct if isinstance(threshold_pct, Column) else F.lit(threshold_pct)
    share = F.col("unattributed") / F.col("total")
    return shares.select("*", share.alias("share"), (100 * share > threshold).alias("breach"))


def visits(
    events: DataFrame, excluded: DataFrame | None = None, touch_events: Sequence[str] = TOUCH_EVENTS
) -> DataFrame:
    """Visits of the site: the date and UTM values of each event that can be a touch; a direct visit has a null source."""
    return with_source(events.where(F.col("event_name").isin(list(touch_events))), excluded).select("date", *UTM)


def check_costs_without_visits(
    costs: DataFrame, visits: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, by: Sequence[str] = UTM
) -> DataFrame:
    """Cost rows with a positive cost and no visit on the same date under the same UTM values; nulls compare equal.

    ``by`` narrows the comparison to some of the UTM columns, for networks whose campaign names are not those of the URLs.
    """
    keys = ["date", *by]
    seen = visits.select(*keys).distinct()
    return lookup_join(
        costs.where("cost > 0"), seen, keys, "left_anti", null_safe=True, max_group_rows=max_group_rows
    )
