"""Orphans, lifecycle snapshot, run summary and activity log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.casts import as_whole, moment
from tallyframe.functions.columns import require

# Trip keys that must be in the master and the orphan type of each.
ORPHAN_TYPES = {"PULocationID": "PICKUP_NOT_IN_MASTER", "DOLocationID": "DROPOFF_NOT_IN_MASTER"}


def known_ids(master: DataFrame, id_column: str = "LocationID") -> DataFrame:
    require(master, id_column)
    return master.select(as_whole(master, id_column).alias("known_id")).dropna().distinct()


def _with_whole_keys(trips: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    require(trips, *keys)
    return trips.withColumns({f"{key}_int": as_whole(trips, key) for key in keys})


def orphans_of(trips: DataFrame, master: DataFrame, key: str, orphan_type: str) -> DataFrame:
    """Trips whose ``key`` is not in the master; a NULL or unreadable key is not in it."""
    keyed = _with_whole_keys(trips, {key: orphan_type})
    ids = known_ids(master)
    return keyed.join(ids, F.col(f"{key}_int") == F.col("known_id"), "left_anti").withColumn(
        "orphan_type", F.lit(orphan_type)
    )


def orphans(
    trips: DataFrame, master: DataFrame, job_name: str, types: Mapping[str, str] = ORPHAN_TYPES, as_of=None
) -> DataFrame:
    """Every trip once for each of its keys that is not in the master.

    Both keys are tested on one read of the trips. The ids are distinct, so the left joins add no rows; Spark
    broadcasts them if they are small, and AQE splits hot and NULL keys if it has to shuffle.
    """
    marked = _with_whole_keys(trips, types)
    ids = known_ids(master)
    for key in types:
        hit = ids.select(F.col("known_id").alias(f"_{key}_hit"))
        marked = marked.join(hit, F.col(f"{key}_int") == F.col(f"_{key}_hit"), "left")
    missing = F.array_compact(
        F.array(*[F.when(F.col(f"_{key}_hit").isNull(), F.lit(kind)) for key, kind in types.items()])
    )
    return (
        marked.withColumn("orphan_type", F.explode(missing))
        .drop(*[f"_{key}_hit" for key in types])
        .withColumns({"job_name": F.lit(job_name), "detected_at_utc": moment(as_of)})
    )


def lifecycle(master: DataFrame, job_name: str, as_of=None) -> DataFrame:
    """Records per ``mdm_state``; without that column all are ACTIVE."""
    state = F.col("mdm_state") if "mdm_state" in master.columns else F.lit("ACTIVE")
    return (
        master.groupBy(state.alias("mdm_state"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumns({"job_name": F.lit(job_name), "snapshot_at_utc": moment(as_of)})
    )


def run_summary(
    zones: DataFrame, trips: DataFrame, orphan_rows: DataFrame, job_name: str, as_of=None, **paths: str
) -> DataFrame:
    """One row: the job, its ``paths`` and the row counts of its tables."""
    named = {"zones_count": zones, "trips_count": trips, "orphans_count": orphan_rows}
    counts = None
    for name, table in named.items():
        one = table.agg(F.count(F.lit(1)).alias(name))
        counts = one if counts is None else counts.unionByName(one, allowMissingColumns=True)
    # One row per table, folded into one by an aggregate: no join without a key.
    counts = counts.agg(*[F.max(name).alias(name) for name in named])
    texts = {"job_name": F.lit(job_name), **{name: F.lit(path) for name, path in paths.items()}}
    return counts.select(
        *[value.alias(name) for name, value in texts.items()],
        "orphans_count",
        "zones_count",
        "trips_count",
        moment(as_of).alias("generated_at_utc"),
    )


def activity(summary: DataFrame, run_id: str, as_of=None) -> DataFrame:
    """The steward log entry of a run, made from its summary row."""
    details = F.format_string(
        "zones=%d, trips=%d, orphans=%d", F.col("zones_count"), F.col("trips_count"), F.col("orphans_count")
    )
    return summary.select(
        F.lit(run_id).alias("run_id"),
        F.lit("PIPELINE_RUN_SUMMARY").alias("event_type"),
        F.lit("SYSTEM").alias("actor"),
        details.alias("details"),
        "job_name",
        moment(as_of).alias("event_time_utc"),
    )
