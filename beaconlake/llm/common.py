"""What several operators of this package share: tables, words, size checks, written intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.session import run_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What separates words: ASCII white space, and for word matching every other ASCII character that is no letter or digit.
SPACE = r"\x20\x09-\x0D"
NOT_WORD = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

#: A lookup is broadcast only up to these limits, which are checked on its rows.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = run_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed. Pure ASCII texts take the faster built-in function."""
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, separators: str = SPACE) -> Column:
    """The words of a text as an array; null and texts without a word give an empty array."""
    parts = F.array_remove(F.split(text, f"[{separators}]+"), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A small given list as rows of the plan itself; empty lists are not allowed."""
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _bytes(field: T.StructField) -> Column:
    """Bytes of a value: of a string or binary as it is, of arrays, maps and structs as JSON, else at most 16."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        column = F.to_json(F.struct(column))
    elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")


def is_small(df: DataFrame) -> bool:
    """Whether the rows of ``df`` and the bytes of its values are within the limits of a broadcast.

    ``df`` should be cheap to read (a written table): it is measured.
    """
    size = sum((_bytes(field) for field in df.schema.fields), F.lit(0)).cast("bigint")
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it is small; beyond that Spark joins by shuffle."""
    return F.broadcast(df) if is_small(df) else df
