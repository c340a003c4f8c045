"""A manifest per run: which folder each output of the run is in. Written last, so readers see whole runs only.

Outputs of a run go to folders of their own, and versioned tables keep a folder per version, so nothing that a
published run has written is touched by the next one. A run that dies leaves folders that no manifest names. One run at
a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.casts import moment
from tallyframe.sources.readers import read_parquet, table_exists

MANIFEST_SCHEMA = "position bigint, run_id string, committed_at timestamp, outputs map<string,string>"


class Outputs:
    """The folders of one run below ``root``. ``folder`` names a new one; ``bind`` adds one that is elsewhere."""

    def __init__(self, root: str, run_id: str):
        self.run_id = run_id
        self.root = f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def folder(self, name: str) -> str:
        return self.bind(name, f"{self.root}/{name}")

    def bind(self, name: str, path: str) -> str:
        self.paths[name] = path
        return path


def manifest_folder(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All published runs; empty when there is none."""
    path = manifest_folder(root)
    if not table_exists(spark, path, "json"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def commit(spark: SparkSession, root: str, outputs: Outputs, as_of=None) -> None:
    """Publish the outputs of a run, all at once: one row in one file, which is moved into place when it is complete."""
    last = manifests(spark, root).agg(F.max("position")).first()[0]
    rows = [(0 if last is None else last + 1, outputs.run_id, outputs.paths)]
    entry = spark.createDataFrame(rows, "position bigint, run_id string, outputs map<string,string>")
    entry.withColumn("committed_at", moment(as_of)).coalesce(1).write.mode("append").json(manifest_folder(root))


def published_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """The folders of the run that was published last; none before the first."""
    last = manifests(spark, root).agg(F.max_by("outputs", "position").alias("outputs")).first()["outputs"]
    return dict(last or {})


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output of the run that was published last."""
    paths = published_paths(spark, root)
    if name not in paths:
        raise ValueError(f"no published run has an output {name}")
    return read_parquet(spark, paths[name])
