from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from beaconlake.contracts import schema  # noqa: E402
from beaconlake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def make_events(spark):
    """Rows of an event table from dictionaries; what is left out is null."""

    def make(rows: list[dict], table: str = "raw_events") -> DataFrame:
        texts = spark.createDataFrame([(json.dumps(row),) for row in rows], "j string")
        return texts.select(F.from_json("j", schema(table)).alias("r")).select("r.*")

    return make


def as_tuples(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=lambda t: tuple(map(str, t)))
