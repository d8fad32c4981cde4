"""JSON messages to typed rows.

Fields are matched to columns by name at every depth. A message that does not fit goes to quarantine whole; Spark alone
would keep the half it could read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

CORRUPT = "_corrupt"

# Milliseconds since 1970 that a date of the years 1 to 9999 can hold, a day short at both ends for offsets: later or earlier ones would stop every job that reads the row.
SANE_MS = (-62_135_500_000_000, 253_402_200_000_000)
REQUIRED = ("event_id", "date")

# Names in single quotes are not JSON. Spark would read them, but no test of names would see them.
STRICT = {"allowSingleQuotes": "false"}


def parse_messages(
    messages: DataFrame,
    schema: StructType,
    drop_unknown_fields: bool = True,
    message_filter: str | None = None,
    required: tuple[str, ...] = REQUIRED,
) -> DataFrame:
    """Envelopes with the parsed ``row`` and a ``reason``, which is null for a good message.

    ``message_filter`` is a SQL condition on the envelope, with the attributes as the map ``attr``; other messages are
    not delivered. With ``drop_unknown_fields`` extra keys are ignored, without it they are a reason for quarantine.
    """
    if message_filter is not None:
        messages = (
            messages.withColumn("attr", F.from_json("attributes", "map<string,string>"))
            .where(F.expr(message_filter))
            .drop("attr")
        )
    wanted = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    row = F.from_json("data", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **STRICT})
    # A generated column is computed once; a projected one would be parsed again in every test on it.
    parsed = messages.select("*", F.explode(F.array(row)).alias("row"))
    reasons = [
        F.when(F.trim(F.coalesce("data", F.lit(""))) == "", F.lit("empty message")),
        F.when(F.col(f"row.{CORRUPT}").isNotNull(), F.lit("does not fit the schema")),
        *[F.when(F.col(f"row.`{name}`").isNull(), F.lit(f"no {name}")) for name in required],
    ]
    if "timestamp" in schema.names:
        reasons.append(F.when(~F.col("row.timestamp").between(*SANE_MS), F.lit("timestamp out of range")))
    if not drop_unknown_fields:
        # Most messages have no unknown field, and that is seen without reading every level again.
        unknown = F.when(_all_read(F.col("data"), F.col("row")), F.lit("")).otherwise(
            F.array_join(unknown_fields(F.col("data"), schema), ", ")
        )
        parsed = parsed.select("*", F.explode(F.array(unknown)).alias("_unknown"))
        reasons.append(F.when(F.col("_unknown") != "", F.concat(F.lit("unknown fields: "), "_unknown")))
    return parsed.withColumn("reason", F.coalesce(*reasons)).drop("_unknown")


def good_rows(parsed: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of the good messages; a missing repeated field is an empty list. ``keep`` names envelope columns."""
    return parsed.where("reason is null").select(
        *[F.col(name) for name in keep],
        *[_filled(F.col(f"row.`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
    )


def quarantined(parsed: DataFrame) -> DataFrame:
    """Envelopes of the messages that did not fit, with the reason."""
    return parsed.where("reason is not null").drop("row")


def _has_list(data_type: DataType) -> bool:
    if isinstance(data_type, StructType):
        return any(_has_list(f.dataType) for f in data_type.fields)
    return isinstance(data_type, ArrayType)


def _filled(value: Column, data_type: DataType) -> Column:
    if not _has_list(data_type):
        return value
    if isinstance(data_type, StructType):
        fields = [_filled(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if _has_list(data_type.elementType):
        value = F.transform(value, lambda element: _filled(element, data_type.elementType))
    return F.coalesce(value, F.array().cast(data_type))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _all_read(data: Column, row: Column) -> Column:
    """Whether every key of a message is surely in the row read from it; else its levels have to be looked at.

    The row as JSON has no key that the message lacks, so with as many keys both have the same. Without backslashes no
    quote stands inside a text; a text that begins with a colon is counted too, on both sides.
    """
    keys = F.lit(r'"\s*:')
    return ~F.contains(data, F.lit("\\")) & (F.regexp_count(data, keys) == F.regexp_count(F.to_json(row), keys))


def unknown_fields(data: Column, schema: StructType) -> Column:
    """Paths of the JSON keys that the schema does not name, at every depth.

    Each level reads only the text of its own object, so a message is read about once per level of nesting.
    """
    return _unknown_in_object(data, schema, "")


def _unknown_in_list(text: Column, struct: StructType, prefix: str) -> Column:
    elements = F.from_json(text, "array<string>", STRICT)
    return F.flatten(F.transform(elements, lambda element: _unknown_in_object(element, struct, prefix)))


def _unknown_in_object(text: Column, struct: StructType, prefix: str) -> Column:
    names = F.array(*[F.lit(f.name) for f in struct.fields])
    nothing = F.array().cast("array<string>")

    def check(members: Column) -> Column:
        found = [F.transform(F.array_except(F.map_keys(members), names), lambda k: F.concat(F.lit(prefix), k))]
        for f in struct.fields:
            if isinstance(f.dataType, StructType):
                found.append(_unknown_in_object(members[f.name], f.dataType, f"{prefix}{f.name}."))
            elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType):
                found.append(_unknown_in_list(members[f.name], f.dataType.elementType, f"{prefix}{f.name}[]."))
        return F.concat(*[F.coalesce(paths, nothing) for paths in found])

    return F.coalesce(_once(F.from_json(text, "map<string,string>", STRICT), check), nothing)
