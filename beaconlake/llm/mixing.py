"""Mixing sources to target weights with a low-discrepancy schedule.

Sources get targets by weight (water-filling: no source above a multiple of its size). Slot i of the schedule takes the
point frac((i + 1/2) * golden ratio); the cumulated target shares turn the point into a source, so that every stretch of
the schedule holds the sources in nearly their shares. A source's slots are ranked; slot k takes the k-th block of equal
size from the source's stream, which is its documents in shuffled order, repeated. A block may cut a document.

Every key is spread: documents and slots are numbered within pieces of a source of about the square root of the rows,
and pieces by their sums. The order is a hash of document id and text, so reruns agree.

Defined results: a null or empty text has size 0 and takes nothing; a source of size 0 has target 0; the null source is a
source of its own, last in order; repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconlake.llm.common import broadcast_if_small, table, words, written

GOLDEN = 0.6180339887498949
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 64
CELLS = 4096


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, place): words per document and its place in the shuffled order."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("bigint").alias("size"),
        F.conv(F.substr(F.md5(key), F.lit(1), F.lit(15)), 16, 10).cast("bigint").alias("place"),
    )


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_no, source_size, target) for each source. One row per source meets here, never documents.

    With sources in order of size over weight, those below the water level are full. The level is found where the next
    source is no longer below it.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    named = per_source.select("*", (F.row_number().over(by_name) - 1).alias("source_no")).withColumn("weight", weight)
    full = (F.col("source_size") * repeats).cast("double")
    by_level = Window.orderBy(full / F.col("weight"), "source_no")
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = named.withColumn("full", full).withColumn("level", left / weight_left)
    level = F.max(F.when(F.col("full") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything)
    target = F.least("full", F.coalesce(level * F.col("weight"), F.col("full")))
    return levelled.select("source", "source_no", "source_size", target.alias("target"))


def _running(df: DataFrame, key: str, piece: str, order: Sequence, value, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, in each key; pieces of a key are summed first, then their rows."""
    sums = df.groupBy(key, piece).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, piece, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(sums, [key, piece]).withColumn(name, F.col(name) + F.col("_before")).drop("_before", piece)


def schedule(sources: DataFrame, slots: int, cells: int = CELLS) -> DataFrame:
    """(slot, source_no, rank): the source of each slot and the slot's rank within it.

    Points and sources meet by an equal join on cells of the unit interval, so the number of sources is free.
    """
    spark = sources.sparkSession
    order = Window.orderBy("source_no")
    shares = sources.where("target > 0").select(
        "source_no", (F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("target").over(Window.partitionBy())).alias("high")
    )
    shares = shares.withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0.0)))
    cell = F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))
    shares = written(shares.select("source_no", "low", "high", F.explode(cell).alias("cell")), "mix-shares")
    turned = (F.col("id") + 0.5) * GOLDEN
    points = spark.range(slots).select(F.col("id").alias("slot"), (turned - F.floor(turned)).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    taken = points.join(broadcast_if_small(shares), "cell").where("point >= low and point < high").select("slot", "source_no")
    piece = max(256, math.isqrt(slots))
    ranked = taken.withColumn("piece", F.floor(F.col("slot") / piece))
    return _running(ranked, "source_no", "piece", ["slot"], F.lit(1), "rank").select("slot", "source_no", "rank")


def blocks(sizes: DataFrame, sources: DataFrame, rows: int, block: int = BLOCK_WORDS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(doc_id, source_no, source_size, target, size, start, block, words): pieces of documents by block of the stream."""
    named = sizes.where("size > 0").join(broadcast_if_small(sources), sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    piece = max(64, math.isqrt(rows))
    # The place has 60 bits; its first 20 give pieces in order of place.
    placed = named.withColumn("piece", F.shiftright(F.shiftright("place", 40) * F.lit(piece).cast("bigint"), 20))
    placed = _running(placed, "source_no", "piece", ["place", "doc_id", "size"], F.col("size"), "start")
    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    from_, to = F.col("start") + F.col("turn") * F.col("source_size"), F.col("from") + F.col("size")
    pieces = placed.select("*", turn.alias("turn")).withColumn("from", from_).withColumn("to", to)
    number = F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)))
    pieces = pieces.select("*", number.alias("block"))
    inside = F.least("to", (F.col("block") + 1) * block) - F.greatest("from", F.col("block") * block)
    return pieces.select("doc_id", "source_no", "source", "source_size", "target", "size", "start", "block", inside.alias("words"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, block: int = BLOCK_WORDS, repeats: int = MAX_REPEATS,
) -> tuple[DataFrame, DataFrame]:
    """(schedule of slots, documents with ``size``, ``source_size``, ``target`` and ``taken`` words)."""
    sizes = written(sized(docs), "mix-sizes")
    sources = written(targets(sizes, weights, share, repeats), "mix-targets")
    rows, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    slots = schedule(sources, math.ceil(share * total / block))
    pieces = blocks(sizes, sources, rows, block, repeats)
    used = slots.select("source_no", F.col("rank").alias("block"), F.lit(1).alias("used"))
    taken = pieces.join(used, ["source_no", "block"], "left").groupBy(
        "doc_id", "source", "size", "source_size", "target", "source_no", "start"
    ).agg(F.sum(F.when(F.col("used") == 1, F.col("words")).otherwise(0)).alias("taken"))
    empty = sizes.where("size = 0").join(broadcast_if_small(sources), sizes["source"].eqNullSafe(sources["source"])).select(
        "doc_id", sizes["source"], "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken")
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return slots, taken.select(*columns).unionByName(empty)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, by the contract's weights and limits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs)[1].select("doc_id", "size", "source_size", "target", "taken")
