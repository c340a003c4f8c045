"""Run audit: events are appended, never updated; the status of a run is its latest event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.functions.casts import moment

# States of a run.
STARTED, SUCCEEDED, FAILED = "STARTED", "SUCCEEDED", "FAILED"
#: Parts of the event log. A start looks for its own run in one of them.
EVENT_BUCKETS = 64
EVENT_COLUMNS = "run_id string, job_name string, trigger_type string, data_owner string, status string"


def run_event(
    spark: SparkSession,
    run_id: str,
    status: str,
    job_name: str | None = None,
    trigger_type: str = "manual",
    data_owner: str = "analytics-team",
    error_message: str | None = None,
    as_of=None,
) -> DataFrame:
    """One event row."""
    row = spark.createDataFrame(
        [(run_id, job_name, trigger_type, data_owner, status, error_message)],
        EVENT_COLUMNS + ", error_message string",
    )
    return row.withColumn("event_at", moment(as_of))


def event_bucket(run_id: Column) -> Column:
    """The part of the event log that holds a run; a number for a literal, so that only that part is listed and read."""
    return F.pmod(F.xxhash64(run_id), F.lit(EVENT_BUCKETS)).cast("int")


def new_run_id(spark: SparkSession) -> str:
    return spark.range(1).select(F.uuid().alias("id")).first()["id"]


def absent_rows(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``existing`` does not have: insert, do nothing on conflict.

    ``existing`` is cut down to the incoming keys before it is made distinct, so few new rows cost little.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = existing.select(*keys).join(incoming.select(*keys).distinct(), keys, "left_semi").distinct()
    return incoming.join(known, keys, "left_anti")


def run_audit(events: DataFrame) -> DataFrame:
    """One row per run and job: latest status and error, first start, and the end if it has ended.

    Partial aggregation keeps one row per run, job and input task, so a run with very many events does not
    collect in one task. Later statuses win at equal times.
    """
    rank = F.when(F.col("status") == STARTED, 0).when(F.col("status") == SUCCEEDED, 1).otherwise(2)
    latest = F.max(
        F.struct("event_at", rank.alias("rank"), "status", "trigger_type", "data_owner", "error_message")
    )
    per_run = events.groupBy("run_id", "job_name").agg(
        latest.alias("last"), F.min(F.when(F.col("status") == STARTED, F.col("event_at"))).alias("started_at")
    )
    ended = F.col("last.status").isin(SUCCEEDED, FAILED)
    return per_run.select(
        "run_id",
        "job_name",
        "last.trigger_type",
        "last.data_owner",
        "last.status",
        "started_at",
        F.when(ended, F.col("last.event_at")).alias("ended_at"),
        "last.error_message",
    )
