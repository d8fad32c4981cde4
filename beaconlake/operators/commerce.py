"""State of orders, deals and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.operators.skew import MAX_GROUP_ROWS, lookup_join

ENTITIES = ("order", "deal", "transaction")

# Money in sums: leaves room for the digits that a sum and a difference add.
MONEY = "decimal(27,6)"


def latest_state(events: DataFrame, entity: str) -> DataFrame:
    """Latest record per order, deal or transaction id, by (``timestamp``, ``event_id``).

    One aggregation: Spark keeps one record per id and task before the shuffle, so an id with many events is no burden.
    """
    if entity not in ENTITIES:
        raise ValueError(f"entity must be one of {ENTITIES}")
    record = F.col(f"`{entity}`")
    with_id = events.where(record["id"].isNotNull())
    latest = with_id.groupBy(record["id"].alias("_id")).agg(
        F.max_by(
            F.struct(record.alias("record"), F.col("timestamp"), F.col("event_id")),
            F.struct("timestamp", "event_id"),
        ).alias("latest")
    )
    return latest.select(
        "latest.record.*",
        F.col("latest.timestamp").alias("state_timestamp"),
        F.col("latest.event_id").alias("state_event_id"),
    )


def balance_by_currency(states: DataFrame, report_left_out: bool = False) -> DataFrame:
    """Paid, refunded and net value of order or deal states per currency, summed as decimals so order cannot matter.

    An amount beyond ``MONEY`` is left out of the sums; with ``report_left_out`` a column counts those.
    """
    def total(name: str):
        return F.coalesce(F.sum(F.col(name).try_cast(MONEY)), F.lit(0).cast("decimal(37,6)"))

    paid, refunded = total("paid_value"), total("refund_value")
    beyond = [(F.col(name).isNotNull() & F.col(name).try_cast(MONEY).isNull()).cast("int") for name in ("paid_value", "refund_value")]
    left_out = [F.sum(beyond[0] + beyond[1]).alias("left_out")] if report_left_out else []
    return states.groupBy("currency").agg(
        F.count(F.lit(1)).alias("records"),
        paid.cast("double").alias("paid_value"),
        refunded.cast("double").alias("refund_value"),
        (paid - refunded).cast("double").alias("net_value"),
        *left_out,
    )


def transaction_links(events: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Latest state of each transaction with the status of its order and deal; null where no such record exists."""
    linked = latest_state(_narrow(events, "transaction", "value", "currency", "order_id", "deal_id"), "transaction")
    linked = linked.select(F.col("id").alias("transaction_id"), "value", "currency", "order_id", "deal_id")
    for entity in ("order", "deal"):
        states = latest_state(_narrow(events, entity, "status"), entity).select(
            F.col("id").alias(f"{entity}_id"), F.col("status").alias(f"{entity}_status"),
            F.lit(True).alias(f"has_{entity}"),
        )
        linked = lookup_join(linked, states, [f"{entity}_id"], "left", max_group_rows=max_group_rows)
        linked = linked.withColumn(f"has_{entity}", F.coalesce(f"has_{entity}", F.lit(False)))
    return linked


def _narrow(events: DataFrame, entity: str, *fields: str) -> DataFrame:
    """Only the needed fields of a record, so that the scan and the aggregation do not carry the others."""
    record = F.col(f"`{entity}`")
    wanted = F.struct(*[record[name].alias(name) for name in ("id", *fields)])
    return events.select("timestamp", "event_id", F.when(record["id"].isNotNull(), wanted).alias(entity))
