"""Lookups in key/value lists.

The lists stay ``array<struct<key, value>>``: duplicate keys are legal, so a map type would reject valid rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = ("string_value", "int_value", "double_value", "boolean_value")


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def string_value(entries: Column | str, key: str) -> Column:
    """Value of the first entry with this key in a key/string list, null if there is none."""
    found = F.filter(_column(entries), lambda entry: entry["key"] == F.lit(key))
    return F.get(found, F.lit(0))["value"]


def param(entries: Column | str, key: str, slot: str) -> Column:
    """One slot of the first entry with this key in a typed list, null if there is none."""
    if slot not in SLOTS:
        raise ValueError(f"slot must be one of {SLOTS}")
    return string_value(entries, key)[slot]


def ad_value(ad_data: Column | str, network: str, key: str) -> Column:
    """Value of ``key`` in the first entry of ``network`` in the ad data, null if there is none."""
    found = F.filter(_column(ad_data), lambda entry: entry["ad_network"] == F.lit(network))
    return string_value(F.get(found, F.lit(0))["values"], key)


def slots_set(value: Column) -> Column:
    """How many slots of a typed value are set."""
    return sum((value[slot].isNotNull().cast("int") for slot in SLOTS), F.lit(0))
