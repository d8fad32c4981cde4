"""Reports over events and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UTM = ("source", "medium", "campaign", "content", "term")

# Amounts in exact sums. A larger one, or one that is no number, cannot be added to them.
MONEY = "decimal(28,6)"


def beyond_money(amount: Column) -> Column:
    """Whether an amount has no place in an exact sum."""
    return amount.isNotNull() & amount.try_cast(MONEY).isNull()


def campaign_performance(
    costs: DataFrame, attributed: DataFrame, by: tuple[str, ...] = UTM[:3], report_left_out: bool = False
) -> DataFrame:
    """Costs and attributed revenue per source, medium and campaign, or other UTM columns, with CPC, CTR and ROAS.

    Both sides are reduced to one stream of partial figures and summed once, which also treats null keys as equal.
    ``reach`` counts people, so it is not additive: the largest single figure is reported. An amount beyond ``MONEY``
    has no place in an exact sum and is left out of it; with ``report_left_out`` a column ``left_out`` counts those.
    """
    keys = by
    # Models that share a conversion between touches credit each with a part of it; parts are summed as decimals.
    shared = "conversions" in attributed.columns
    count = "decimal(38,12)" if shared else "bigint"
    cost_rows = costs.select(
        *keys,
        F.col("cost").try_cast(MONEY).alias("cost"),
        F.col("impressions"),
        F.col("clicks"),
        F.col("reach"),
        F.lit(None).cast(MONEY).alias("revenue"),
        F.lit(0).cast(count).alias("conversions"),
        beyond_money(F.col("cost")).alias("left_out"),
    )
    revenue_rows = attributed.select(
        *keys,
        F.lit(None).cast(MONEY).alias("cost"),
        F.lit(None).cast("bigint").alias("impressions"),
        F.lit(None).cast("bigint").alias("clicks"),
        F.lit(None).cast("bigint").alias("reach"),
        F.col("value").try_cast(MONEY).alias("revenue"),
        (F.col("conversions") if shared else F.lit(1)).cast(count).alias("conversions"),
        beyond_money(F.col("value")).alias("left_out"),
    )
    totals = cost_rows.unionByName(revenue_rows).groupBy(*keys).agg(
        F.sum("cost").cast("double").alias("cost"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.max("reach").alias("max_reach"),
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("conversions").cast("double" if shared else "bigint").alias("conversions"),
        F.count_if("left_out").alias("left_out"),
    )
    if not report_left_out:
        totals = totals.drop("left_out")
    return totals.select(
        "*",
        F.try_divide("cost", "clicks").alias("cpc"),
        F.try_divide("clicks", "impressions").alias("ctr"),
        F.try_divide("revenue", "cost").alias("roas"),
    )


def geo_rollup(events: DataFrame) -> DataFrame:
    """Events and profiles per continent, country and city with subtotals; ``level`` is 0 for the finest."""
    places = events.select(
        F.col("geo.continent").alias("continent"),
        F.col("geo.country").alias("country"),
        F.col("geo.city").alias("city"),
        "profile_id",
    )
    # Summed per place and profile first: the rollup copies those rows for each level, not the events.
    counted = places.groupBy("continent", "country", "city", "profile_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.rollup("continent", "country", "city").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").alias("events"),
        F.countDistinct("profile_id").alias("profiles"),
    )


def device_cube(events: DataFrame) -> DataFrame:
    """Events and profiles per device category, operating system and browser, for every combination of the three."""
    devices = events.select(
        F.col("device_info.category").alias("category"),
        F.col("device_info.operating_system").alias("operating_system"),
        F.col("device_info.web_info.browser").alias("browser"),
        "profile_id",
    )
    # As above: the cube makes eight copies of the counted rows, not of the events.
    counted = devices.groupBy("category", "operating_system", "browser", "profile_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.cube("category", "operating_system", "browser").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").alias("events"),
        F.countDistinct("profile_id").alias("profiles"),
    )
