"""Versioned tables: Delta's own versions where there is Delta, else a log of the writes made here.

``publish`` writes each version of a Parquet table to its own folder and then appends one log row. Readers take
the folder of the latest version, so a table can be read while its next version is made from it, and a write
that dies half-way is never seen. One writer per table is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.casts import moment
from tallyframe.sources.readers import read_table, table_exists
from tallyframe.sources.schemas import reconciled
from tallyframe.sources.writers import overwrite, overwrite_partitioned, table_format

LOG_SCHEMA = (
    "table_name string, table_path string, version bigint, timestamp timestamp, operation string, "
    "data_format string, num_output_rows bigint, run_id string"
)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All logged writes; empty when there is no log yet."""
    if not table_exists(spark, log_path, "json"):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(log_path)


def latest(spark: SparkSession, log_path: str, table_name: str) -> tuple[str, int] | None:
    """Folder and number of the latest version, or None."""
    rows = read_log(spark, log_path).filter(F.col("table_name") == table_name)
    last = rows.agg(F.max(F.struct("version", "table_path")).alias("last")).first()["last"]
    return None if last is None else (last["table_path"], last["version"])


def table_folder(root: str, table_name: str) -> str:
    return f"{root.rstrip('/')}/{table_name}"


def has_versions(spark: SparkSession, root: str, log_path: str, table_name: str) -> bool:
    if table_format(spark) == "delta":
        return table_exists(spark, table_folder(root, table_name), "delta")
    return latest(spark, log_path, table_name) is not None


def read_latest(spark: SparkSession, root: str, log_path: str, table_name: str) -> DataFrame:
    if table_format(spark) == "delta":
        return read_table(spark, table_folder(root, table_name), "delta")
    found = latest(spark, log_path, table_name)
    if found is None:
        raise ValueError(f"table {table_name} has no version in {log_path}")
    return read_table(spark, found[0])


def choose_latest(spark: SparkSession, root: str, log_path: str, first: str, fallback: str) -> tuple[DataFrame, str]:
    """The table ``first`` if it has a version, else ``fallback``; and which it was, CURATED or INPUT."""
    if has_versions(spark, root, log_path, first):
        return read_latest(spark, root, log_path, first), "CURATED"
    return read_latest(spark, root, log_path, fallback), "INPUT"


def publish(
    df: DataFrame,
    root: str,
    log_path: str,
    table_name: str,
    partition: str | None = None,
    run_id: str | None = None,
    as_of=None,
    laid_out: bool = False,
    evolve: bool = False,
) -> str:
    """Write ``df`` as the next version of a table and log it; returns the folder. For ``laid_out`` see writers.

    ``evolve`` reconciles the schema with that of the last version: see ``schemas.reconciled``.
    """
    spark = df.sparkSession
    if evolve and has_versions(spark, root, log_path, table_name):
        df = reconciled(df, read_latest(spark, root, log_path, table_name).schema)
    if table_format(spark) == "delta":
        folder = table_folder(root, table_name)
        if partition is None:
            overwrite(df, folder, "delta")
        else:
            overwrite_partitioned(df, folder, partition, "delta", laid_out)
        return folder
    last = latest(spark, log_path, table_name)
    version = 0 if last is None else last[1] + 1
    path = f"{table_folder(root, table_name)}/version={version}"
    if partition is None:
        overwrite(df, path)
    else:
        overwrite_partitioned(df, path, partition, laid_out=laid_out)
    # Counting a Parquet folder reads footers only.
    written = spark.read.schema(df.schema).parquet(path).agg(F.count(F.lit(1)).alias("num_output_rows"))
    entry = written.select(
        F.lit(table_name).alias("table_name"),
        F.lit(path).alias("table_path"),
        F.lit(version).cast("bigint").alias("version"),
        moment(as_of).alias("timestamp"),
        F.lit("WRITE").alias("operation"),
        F.lit("parquet").alias("data_format"),
        "num_output_rows",
        F.lit(run_id).cast("string").alias("run_id"),
    )
    entry.coalesce(1).write.mode("append").json(log_path)
    return path


def delta_history(spark: SparkSession, path: str, has_delta: bool) -> DataFrame:
    """The commits of a Delta table: by Delta itself, or from its JSON log when Delta is not installed."""
    if has_delta:
        return spark.sql(f"DESCRIBE HISTORY delta.`{path}`")
    commits = spark.read.json(f"{path.rstrip('/')}/_delta_log/*.json").filter("commitInfo is not null")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1).cast("bigint")
    return commits.select(number.alias("version"), "commitInfo.*")


def table_history(spark: SparkSession, root: str, log_path: str, table_name: str) -> tuple[DataFrame, str]:
    """The history of a table written by ``publish``, and its folder."""
    folder = table_folder(root, table_name)
    if table_format(spark) == "delta":
        return delta_history(spark, folder, has_delta=True), folder
    log = read_log(spark, log_path).filter(F.col("table_name") == table_name)
    return log.withColumnRenamed("table_path", "version_path"), folder


def history_audit(histories: dict[str, tuple[DataFrame, str]], job_name: str, as_of=None) -> DataFrame:
    """Histories of several tables (name -> history, path) as one; columns a table lacks are NULL."""
    audit = None
    for name, (history, path) in histories.items():
        tagged = history.withColumns(
            {
                "table_name": F.lit(name),
                "table_path": F.lit(path),
                "job_name": F.lit(job_name),
                "captured_at_utc": moment(as_of),
            }
        )
        audit = tagged if audit is None else audit.unionByName(tagged, allowMissingColumns=True)
    return audit
