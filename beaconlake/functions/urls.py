"""URL parts. A malformed URL gives null and never fails a job.

Host and path are parsed by Spark without the query, so a badly encoded query does not cost the whole URL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from beaconlake.contracts import URL_PARAMS


def _before_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*", 0)


def _query(url: Column) -> Column:
    """Query text without the question mark, ``''`` when there is none."""
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def host(url: Column) -> Column:
    """Lower-case host of an absolute URL."""
    return F.lower(F.try_parse_url(_before_query(url), F.lit("HOST")))


def host_or_text(entry: Column) -> Column:
    """Host of a list entry that is either an absolute URL or a bare host."""
    bare = F.lower(F.regexp_extract(F.trim(entry), r"^([^/?#:\s]+)(?:[:/?#].*)?$", 1))
    return F.coalesce(host(F.trim(entry)), F.when(~entry.contains("://") & (bare != ""), bare))


def path(url: Column) -> Column:
    """Path of an absolute URL, ``''`` when it has none."""
    return F.try_parse_url(_before_query(url), F.lit("PATH"))


def query_value(url: Column, key: str) -> Column:
    """First value of a query parameter; an empty one counts as absent.

    Several parameters of one URL share the query text: Spark evaluates a common expression once per row.
    """
    raw = F.regexp_extract(_query(url), f"(?:^|&){key}=([^&]*)", 1)
    decoded = F.coalesce(F.try_url_decode(raw), raw)
    return F.when(decoded != "", decoded)


def query_params(url: Column) -> Column:
    """All query parameters in order, as ``array<struct<key, value: struct<string_value>>>``.

    A part that is not valid percent-encoding is kept as it is.
    """
    pieces = F.filter(F.split(_query(url), "&"), lambda piece: piece != "")

    def entry(piece: Column) -> Column:
        key = F.substring_index(piece, "=", 1)
        text = F.regexp_replace(piece, r"^[^=]*=?", "")
        return F.struct(
            F.coalesce(F.try_url_decode(key), key).alias("key"),
            F.struct(F.coalesce(F.try_url_decode(text), text).alias("string_value")).alias("value"),
        )

    return F.coalesce(F.transform(pieces, entry), F.array().cast(URL_PARAMS))
