"""Streaming enrichment of events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from beaconlake.operators.flatten import url_parts
from beaconlake.operators.quality import dedupe_events, real_events
from beaconlake.operators.referrers import landing_url
from beaconlake.sources.messages import good_rows, parse_messages
from beaconlake.streaming.ingest import ALL_AVAILABLE, in_window, missing_rows


def enriched(messages: DataFrame, schema: StructType, delay: str = "1 hour") -> DataFrame:
    """Valid, real events once each, with the parts of their landing page."""
    parsed = parse_messages(messages, schema)
    if messages.isStreaming:
        events = real_events(good_rows(parsed, schema, keep=("publish_time",)))
        once = dedupe_events(events, delay, arrival="publish_time").drop("publish_time")
    else:
        once = dedupe_events(real_events(good_rows(parsed, schema)))
    return url_parts(once.withColumn("landing_page_url", landing_url()), "landing_page_url")


def process_events(
    messages: DataFrame,
    schema: StructType,
    target: str,
    checkpoint: str,
    delay: str = "1 hour",
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Append enriched events to ``target`` by date, exactly once.

    Copies are recognised within ``delay`` of the watermark, which follows the time of publication: an event's own
    timestamp, early or late, costs no event. A message that is delivered later than ``delay`` after its publication is
    left out here; ``late_events`` finds what is missing among the landed messages.
    """
    return (
        enriched(messages, schema, delay)
        .writeStream.format("parquet")
        .partitionBy("date")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def late_events(landed: DataFrame, schema: StructType, start: datetime, end: datetime, processed: DataFrame) -> DataFrame:
    """Enriched events, once each, of the landed messages published in a window that ``processed`` lacks.

    They belong in a table of their own: files beside those of the stream are not in its log, so no reader sees them.
    With ``processed`` being both tables, running it again adds nothing.
    """
    return missing_rows(enriched(in_window(landed, start, end), schema), processed)
