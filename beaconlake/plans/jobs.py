"""Run log of the project's jobs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.contracts import JOB_ERROR_TYPES

RUN_LOG = (
    "job STRING, project_id BIGINT, started_ms BIGINT, ended_ms BIGINT, status STRING, "
    "error_type STRING, error_message STRING"
)


class JobError(Exception):
    """A failure with one of the known error types."""

    def __init__(self, error_type: str, message: str):
        if error_type not in JOB_ERROR_TYPES:
            raise ValueError(f"error_type must be one of {JOB_ERROR_TYPES}")
        super().__init__(message)
        self.error_type = error_type


def log_run(spark: SparkSession, path: str, job: str, project_id: int, fn: Callable[[], object]) -> object:
    """Run ``fn`` and append a row to the log before and after, also when it fails. The failure is raised again."""
    started = int(time.time() * 1000)

    def append(ended: int | None, status: str, error_type: str | None = None, message: str | None = None) -> None:
        row = (job, project_id, started, ended, status, error_type, message)
        spark.createDataFrame([row], RUN_LOG).write.mode("append").parquet(path)

    append(None, "running")
    try:
        result = fn()
    except Exception as error:
        error_type = error.error_type if isinstance(error, JobError) else "UNRECOGNIZED_ERROR"
        append(int(time.time() * 1000), "error", error_type, str(error))
        raise
    append(int(time.time() * 1000), "success")
    return result


def last_run(log: DataFrame) -> DataFrame:
    """Per job and project: start of the last successful run (0 if none), and the state and error of the last run.

    A run that has no row with its end is still running.
    """
    latest = F.struct("started_ms", "ended_ms", "status")
    return log.groupBy("job", "project_id").agg(
        F.coalesce(F.max(F.when(F.col("status") == "success", F.col("started_ms"))), F.lit(0)).alias("last_run"),
        F.max_by("status", latest).alias("last_status"),
        (F.max_by("status", latest) == "running").alias("is_running"),
        F.max_by("error_type", latest).alias("last_error_type"),
        F.count_if(F.col("status") != "running").alias("runs"),
    )


def newer_than(df: DataFrame, last_run_ms: int) -> DataFrame:
    """Rows inserted after the last run; the test reaches the Parquet scan."""
    return df.where(F.col("inserted_at") > F.lit(last_run_ms))
