"""Keys that hold too many rows for one task, and joins and running values that stay safe with them.

Aggregations need nothing from here: Spark combines them before the shuffle. Two shapes do need care, because they
bring all rows of a key together: a join of a large frame with one row per key, and a window over a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Rows of one key that one task may hold. A few hundred megabytes for the narrow frames used here.
MAX_GROUP_ROWS = 2_000_000

# Rows of a configuration-sized lookup that may be broadcast.
MAX_BROADCAST_ROWS = 100_000


def heavy_keys(df: DataFrame, keys: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame | None:
    """Keys with more than ``max_group_rows`` rows, with their ``group_rows``; None when there are none.

    The result has at most ``rows / max_group_rows`` rows, so it may be broadcast whatever the size of ``df``.
    Only the key columns are read, and the count is combined before the shuffle.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))
    heavy = counts.where(F.col("group_rows") > max_group_rows).checkpoint()
    return None if heavy.isEmpty() else heavy



def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    """Join on keys; the left side's key columns are kept."""
    if not null_safe:
        return left.join(right, list(keys), how)
    right = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    tests = [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys]
    joined = left.join(right, reduce(lambda a, b: a & b, tests), how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    heavy: DataFrame | None = None,
    look_for_heavy: bool = True,
) -> DataFrame:
    """Join ``big`` with ``small``, which holds at most one row per key (any number for semi and anti joins).

    Rows of heavy keys never shuffle: the few matching rows of ``small`` go to them by broadcast. The other rows take
    the join Spark chooses. Every row of ``big`` is in exactly one of the two parts.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if heavy is None and look_for_heavy:
        heavy = heavy_keys(big, keys, max_group_rows)
    if heavy is None:
        return _join(big, small, keys, how, null_safe)
    heavy_only = F.broadcast(heavy.select(*keys))
    lookup_rows = _join(small, heavy_only, keys, "left_semi", null_safe)
    if how in ("left_semi", "left_anti"):
        lookup_rows = lookup_rows.select(*keys).distinct()
    # A null key can be heavy too, so membership is null-safe even where the join itself is not.
    crowded = _join(big, heavy_only, keys, "left_semi", True)
    ordinary = _join(big, heavy_only, keys, "left_anti", True)
    return _join(crowded, F.broadcast(lookup_rows), keys, how, null_safe).unionByName(
        _join(ordinary, small, keys, how, null_safe)
    )


def small_lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    rows: int | None = None,
    null_safe: bool = False,
    **options,
) -> DataFrame:
    """As ``lookup_join`` for a lookup that is usually small: its rows are counted, and broadcast up to a limit.

    ``rows`` is an upper bound of the count where the caller knows one; ``options`` are those of ``lookup_join``.
    """
    if rows is None:
        rows = small.limit(max_rows + 1).count()
    if rows <= max_rows:
        return _join(big, F.broadcast(small), keys, how, null_safe)
    return lookup_join(big, small, keys, how, null_safe, **options)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: dict[str, tuple[str, Column]],
    heavy: DataFrame | None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add running values per key: ``name -> ("sum" | "last", column)``, up to and including each row.

    ``sum`` is a running total (null counts as nothing), ``last`` the latest non-null value. Keys must not be null and
    ``order`` must give the rows of a key a total order. ``heavy`` lists the keys too large for one task; their rows
    are range-partitioned by key and order, so that one key spans many tasks, and each task's running values are
    completed with what the earlier tasks of the same key hand over.
    """

    def compute(rows: DataFrame, window: Window) -> DataFrame:
        return rows.select("*", *[_running_value(kind, value).over(window).alias(name)
                                  for name, (kind, value) in values.items()])

    def up_to_here(*partition: str):
        return Window.partitionBy(*partition).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )

    if heavy is None:
        return compute(df, up_to_here(*keys))

    # Read by both parts, and once more to sample the range bounds.
    df = df.checkpoint()
    heavy_only = F.broadcast(heavy.select(*keys))
    ordinary = compute(df.join(heavy_only, list(keys), "left_anti"), up_to_here(*keys))

    heavy_rows = heavy.agg(F.sum("group_rows")).first()[0]
    pieces = int(heavy_rows // max_group_rows) + 1
    split = (
        df.join(heavy_only, list(keys), "left_semi")
        .repartitionByRange(pieces, *[F.col(k) for k in keys], *order)
        .withColumn("_piece", F.spark_partition_id())
    )
    in_piece = Window.partitionBy("_piece", *keys).orderBy(*order)
    # The piece of a row depends on sampled range bounds: fix it before it is used twice.
    local = (
        compute(split, up_to_here("_piece", *keys))
        .withColumn("_is_end", F.lead(F.lit(1)).over(in_piece).isNull())
        .checkpoint()
    )

    # One row per piece and key: at most ``pieces`` plus the number of heavy keys, whatever the size of ``df``.
    ends = local.where("_is_end").select("_piece", *keys, *values)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_piece", *keys,
        *[_running_value(kind, F.col(name)).over(before).cast(local.schema[name].dataType).alias(f"_carried_{name}")
          for name, (kind, _) in values.items()],
    )
    joined = local.join(F.broadcast(carried), ["_piece", *keys], "left")
    completed = joined.select(
        *df.columns,
        *[_complete(kind, F.col(f"_carried_{name}"), F.col(name)).alias(name) for name, (kind, _) in values.items()],
    )
    return ordinary.unionByName(completed)


def _running_value(kind: str, value: Column) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "last":
        return F.last(value, ignorenulls=True)
    raise ValueError(f"unknown running value {kind}")


def _complete(kind: str, carried: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carried)
    return F.coalesce(carried + local, carried, local)
