"""Where a visit came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import urls
from beaconlake.functions.params import param
from beaconlake.operators.skew import small_lookup_join

# Event parameters that carry the page and the referrer.
LANDING_PARAM = "landing_page_url"
REFERRER_PARAM = "referrer_url"


def landing_url() -> Column:
    return param("event_params", LANDING_PARAM, "string_value")


def referrer_url() -> Column:
    return param("event_params", REFERRER_PARAM, "string_value")


def excluded_hosts(excluded: DataFrame) -> DataFrame:
    """The distinct hosts of the excluded list. Entries may be URLs or bare hosts."""
    hosts = excluded.select(F.explode("hosts").alias("entry"))
    return hosts.select(urls.host_or_text(F.col("entry")).alias("referrer_host")).where(
        "referrer_host is not null"
    ).distinct()


def with_referrer(events: DataFrame, excluded: DataFrame | None) -> DataFrame:
    """Add ``referrer_host`` and ``referrer_excluded``."""
    hosted = events.withColumn("referrer_host", urls.host(referrer_url()))
    if excluded is None:
        return hosted.withColumn("referrer_excluded", F.lit(False))
    entries = excluded.agg(F.coalesce(F.sum(F.size("hosts")), F.lit(0))).first()[0]
    flagged = excluded_hosts(excluded).withColumn("_excluded", F.lit(True))
    return small_lookup_join(hosted, flagged, ["referrer_host"], rows=entries).select(
        *events.columns, "referrer_host", F.coalesce("_excluded", F.lit(False)).alias("referrer_excluded")
    )


def external_referrals(events: DataFrame, excluded: DataFrame | None) -> DataFrame:
    """Events that came from another site that is not excluded."""
    known = with_referrer(events, excluded).where("referrer_host is not null and not referrer_excluded")
    return known.where(~F.col("referrer_host").eqNullSafe(urls.host(landing_url())))


def with_source(events: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Add ``source``, ``medium``, ``campaign``, ``content`` and ``term``; a null source is a direct visit.

    The page's ``utm_*`` parameters decide; without a ``utm_source`` it is the referrer's host, unless that is the
    page's own host or an excluded one.
    """
    staged = with_referrer(events, excluded).withColumn("_landing", landing_url())
    landing = F.col("_landing")
    referral = F.when(
        ~F.col("referrer_excluded") & ~F.col("referrer_host").eqNullSafe(urls.host(landing)), F.col("referrer_host")
    )
    utm_source = urls.query_value(landing, "utm_source")
    return staged.select(
        *events.columns,
        F.coalesce(utm_source, referral).alias("source"),
        F.coalesce(
            urls.query_value(landing, "utm_medium"),
            F.when(utm_source.isNull() & referral.isNotNull(), F.lit("referral")),
        ).alias("medium"),
        *[urls.query_value(landing, f"utm_{name}").alias(name) for name in ("campaign", "content", "term")],
    )
