"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. ``detail`` adds, per query, the shuffle and spill
bytes of its Spark stages. The derived tables are written before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from beaconlake import fixtures, reports  # noqa: E402
from beaconlake.session import configure  # noqa: E402

HEADLINE = (
    "purchase_revenue_by_source",
    "ingest_raw_events",
    "process_events_stream",
    "dedupe_events",
    "identity_components",
    "identified_events",
    "attribution_last_touch",
    "attribution_first_touch",
    "attribution_linear",
    "attribution_position",
    "ad_costs_unified",
    "check_costs_without_visits",
    "campaign_performance",
    "check_unattributed_share",
    "transaction_links",
    "geo_rollup",
    "device_cube",
    "param_lookup",
    "product_lines",
    "url_parts",
)


def stage_totals(spark: SparkSession) -> dict[str, int]:
    gateway = spark.sparkContext._gateway
    no_quantiles = gateway.new_array(gateway.jvm.double, 0)
    no_statuses = gateway.jvm.java.util.ArrayList()
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, no_quantiles, no_statuses)
    totals = {"shuffle_write_bytes": 0, "spill_bytes": 0}
    for i in range(stages.size()):
        stage = stages.apply(i)
        totals["shuffle_write_bytes"] += stage.shuffleWriteBytes()
        totals["spill_bytes"] += stage.diskBytesSpilled()
    return totals


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.retainedStages", "100000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    names = sys.argv[1:] or HEADLINE
    reports.raw_events(spark, sf_dir)
    reports.topic_path(spark, sf_dir)
    for network in fixtures.NETWORKS:
        reports.network_costs(spark, sf_dir, network)
    seconds, detail = {}, {}
    for name in names:
        before = stage_totals(spark)
        start = time.perf_counter()
        result = reports.QUERIES[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        after = stage_totals(spark)
        detail[name] = {key: after[key] - before[key] for key in after}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "detail": detail,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
