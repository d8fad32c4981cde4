"""Project configuration records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.contracts import UNATTRIBUTED_THRESHOLD_PERCENT
from beaconlake.operators.checks import FILTER_TYPE
from beaconlake.operators.skew import small_lookup_join

CONFIG_COLUMNS = ("unattributed_events_threshold", "ignored_event_filters", "timezone", "currency")


def with_defaults(configs: DataFrame) -> DataFrame:
    """Fill what a configuration leaves open: threshold 1 %, no filters, UTC, US dollars."""
    return configs.select(
        "project_id",
        F.coalesce("unattributed_events_threshold", F.lit(float(UNATTRIBUTED_THRESHOLD_PERCENT))).alias(
            "unattributed_events_threshold"
        ),
        F.coalesce("ignored_event_filters", F.array().cast(FILTER_TYPE)).alias("ignored_event_filters"),
        F.coalesce("timezone", F.lit("UTC")).alias("timezone"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
    )


def config_enriched(events: DataFrame, configs: DataFrame) -> DataFrame:
    """Events of many projects with their project's settings; one row per project is looked up."""
    return small_lookup_join(events, with_defaults(configs), ["project_id"])
