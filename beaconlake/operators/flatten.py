"""Nested event columns as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import urls


def external_ids(events: DataFrame) -> DataFrame:
    """One row per external id of an event."""
    return events.select("event_id", F.inline("user_external_ids"))


def ad_data_flat(events: DataFrame) -> DataFrame:
    """One row per advertising network, key and value of an event."""
    networks = events.select("event_id", F.explode("ad_data").alias("network"))
    return networks.select(
        "event_id", F.col("network.ad_network").alias("ad_network"), F.inline("network.values")
    )


def net_value(value: Column, discount_amount: Column, discount_percentage: Column) -> Column:
    """Value after the percentage discount and then the absolute one; a missing discount is none."""
    rate = F.lit(1) - F.coalesce(discount_percentage, F.lit(0.0)) / 100
    return value * rate - F.coalesce(discount_amount, F.lit(0.0))


def product_lines(events: DataFrame) -> DataFrame:
    """One row per product of an event with its net line value; events without products keep one row of nulls."""
    lines = events.select("event_id", F.explode_outer("products").alias("p"))
    return lines.select(
        "event_id",
        F.col("p.id").alias("product_id"),
        F.col("p.category").alias("category"),
        F.col("p.currency").alias("currency"),
        F.col("p.quantity").alias("quantity"),
        F.col("p.value").alias("value"),
        (
            F.coalesce(F.col("p.quantity"), F.lit(1))
            * net_value(F.col("p.value"), F.col("p.discount_amount"), F.col("p.discount_percentage"))
        ).alias("net_value"),
    )


def offer_lines(events: DataFrame) -> DataFrame:
    """One row per offer of an event with its net value; events without offers keep one row of nulls."""
    lines = events.select("event_id", F.explode_outer("offers").alias("o"))
    return lines.select(
        "event_id",
        F.col("o.id").alias("offer_id"),
        F.col("o.name").alias("offer_name"),
        F.col("o.currency").alias("currency"),
        F.col("o.value").alias("value"),
        net_value(F.col("o.value"), F.col("o.discount_amount"), F.col("o.discount_percentage")).alias("net_value"),
    )


def url_parts(df: DataFrame, url_col: str) -> DataFrame:
    """Add ``landing_hostname``, ``landing_page_path`` and the ``url_params`` list of a URL column."""
    url = F.col(url_col)
    return df.select(
        "*",
        urls.host(url).alias("landing_hostname"),
        urls.path(url).alias("landing_page_path"),
        urls.query_params(url).alias("url_params"),
    )
