"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps the ids of a stream's de-duplication on disk and not in executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"

OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 32


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on and make sure a checkpoint folder is known."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    shared_folder(spark)
    return spark


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes inside keep the files of up to ``OPEN_FILES`` partitions open in a task and take rows as they come.

    Else a task sorts all its rows by partition in memory first. Of more partitions Spark sorts the rows of those beyond.
    It is for narrow rows, or for rows gathered by partition: with many files of many columns open a task takes longer.
    """
    before = spark.conf.get(OPEN_FILES_SETTING)
    spark.conf.set(OPEN_FILES_SETTING, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES_SETTING, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where driver and executors are one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    current = context.getCheckpointDir()
    if folder is None and current is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="beaconlake-")
    if current is None:
        context.setCheckpointDir(folder)
    return folder or current


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
