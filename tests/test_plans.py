"""What the physical plans may and may not contain."""

from __future__ import annotations

import re

import pytest

from beaconlake import fixtures as fx
from beaconlake import reports
from beaconlake.operators import attribution, identity

SF_DIR = "/root/testdata/sf0.001"

PLANNED = (
    "attribution_last_touch", "attribution_linear_split", "check_costs_without_visits", "campaign_performance",
    "transaction_links", "config_enriched", "identified_events", "dedupe_events", "geo_rollup", "external_referrals",
)


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> list[str]:
    return re.findall(r"FileScan parquet.*", text)


@pytest.mark.parametrize("name", PLANNED)
def test_no_products_and_no_python(spark, name):
    text = plan(reports.QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert word not in text


def test_attribution_reads_few_columns_and_pushes_the_event_names(spark):
    events = reports.raw_events(spark, SF_DIR).withColumnRenamed("avid", "profile_id")
    text = plan(attribution.attribute_events(events, "purchase", excluded=fx.excluded_referrers(spark)))
    assert text.count("Exchange hashpartitioning(key") == 1
    for scan in scans(text):
        assert "In(event_name, [click,purchase,view])" in scan or "In(event_name, [purchase,click,view])" in scan
        assert "order:struct<value:double>" in scan
        for unused in ("geo", "products", "device_info", "user_data"):
            assert f"{unused}:" not in scan


def test_identity_reads_identifiers_only(spark):
    nodes = reports.raw_events(spark, SF_DIR).select(identity.event_nodes().alias("nodes"))
    (scan,) = scans(plan(identity.event_edges(nodes)))
    schema = scan.split("ReadSchema: ")[1]
    assert "user_external_ids" in schema and "avid" in schema and "event_params" not in schema


def test_a_period_reads_its_days_only(spark):
    text = plan(reports.raw_events(spark, SF_DIR).where("date = date'2024-01-05'").select("event_id"))
    assert "PartitionFilters: [isnotnull(date" in text
