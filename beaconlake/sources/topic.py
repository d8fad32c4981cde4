"""The event topic as a stream of message envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.contracts import TOPIC_PREFIX

# The columns of Spark's Kafka source, with headers on.
TOPIC_ROWS = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, "
    "headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
)


def topic_name(project_id: int) -> str:
    return f"{TOPIC_PREFIX}_{project_id}"


def read_topic(spark: SparkSession, project_id: int, servers: str, **options: str) -> DataFrame:
    """Stream of a project's topic. Producers key messages by visitor, which keeps a visitor's messages in order."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic_name(project_id))
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
    )
    return reader.options(**options).load()


def read_topic_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of topic rows kept as Parquet files, in the layout of the Kafka source."""
    reader = spark.readStream.schema(TOPIC_ROWS)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def envelopes(topic_rows: DataFrame, subscription: str) -> DataFrame:
    """Topic rows as message envelopes; headers become a JSON object of attributes, and the last of a name wins."""
    last_of_name = F.filter(
        "headers",
        lambda h, i: ~F.exists(
            F.slice("headers", i + 2, F.greatest(F.size("headers"), F.lit(1))), lambda later: later["key"] == h["key"]
        ),
    )
    pairs = F.transform(last_of_name, lambda h: F.struct(h["key"], h["value"].cast("string")))
    return topic_rows.select(
        F.lit(subscription).alias("subscription_name"),
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("publish_time"),
        F.col("value").cast("string").alias("data"),
        F.coalesce(F.to_json(F.map_from_entries(pairs)), F.lit("{}")).alias("attributes"),
    )
