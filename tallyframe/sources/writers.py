"""Sinks: tables, partitioned tables, reports, JDBC and catalog loads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def table_format(spark: SparkSession) -> str:
    """``delta`` if this session is set up for it, else ``parquet``; decided once, not by a failed write."""
    extensions = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "DeltaSparkSessionExtension" in extensions else "parquet"


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table at ``path``, which ``df`` must not read."""
    df.write.mode("overwrite").format(fmt).save(path)


def overwrite_partitioned(df: DataFrame, path: str, column: str, fmt: str = "parquet", laid_out: bool = False) -> None:
    """Replace the table at ``path``, one directory per value of ``column``.

    ``laid_out``: ``df`` comes from a table with that layout and has not been shuffled since. Then a task holds the
    files of few values already, and a shuffle would only bring together what is together.

    The rebalance hint brings each value together, so it is not spread over a file per task, and lets AQE cut
    a value that holds much of the table into several tasks and merge small ones.
    """
    dealt = df if laid_out else df.hint("rebalance", column)
    dealt.write.mode("overwrite").format(fmt).partitionBy(column).save(path)


def overwrite_dates(df: DataFrame, path: str, column: str) -> None:
    """Replace those directories of the table at ``path`` whose values ``df`` has; the others are not touched."""
    dealt = df.hint("rebalance", column)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def csv_ready(df: DataFrame) -> DataFrame:
    """Arrays as text, which CSV can hold."""
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({name: F.concat_ws("|", name) for name in arrays})


def report_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """A report of a few rows as one CSV file with a header. ``repartition`` leaves the stage before it parallel."""
    csv_ready(df).repartition(1).write.mode(mode).option("header", True).csv(path)


def report_json(df: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file."""
    df.repartition(1).write.mode("overwrite").json(path)


def listing_csv(df: DataFrame, path: str) -> None:
    """A result of any size as CSV, one file per task and each with a header."""
    csv_ready(df).write.mode("overwrite").option("header", True).csv(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 8) -> None:
    """Append to a database table over at most ``connections`` parallel connections."""
    df.write.mode("append").option("numPartitions", connections).jdbc(url, table, properties=dict(properties))


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 8) -> None:
    """Empty a database table and load it, keeping its definition."""
    writer = df.write.mode("overwrite").option("truncate", True).option("numPartitions", connections)
    writer.jdbc(url, table, properties=dict(properties))


def replace_table(df: DataFrame, table: str) -> None:
    """Replace the contents of a catalog table, keeping its definition; create it if it is missing."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    else:
        df.write.format("parquet").saveAsTable(table)
