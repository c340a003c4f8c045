"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a folder in the session's warehouse.

    A warehouse on a machine's own disk serves a local session only, so a cluster session must name the folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/scratch"


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder; all those of one application lie below one folder, which storage rules can expire."""
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tallyframe-{run}/{purpose}-{uuid.uuid4().hex}"


def via_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, and lost executors cost no recomputation."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
