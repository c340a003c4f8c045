"""A type 2 dimension in buckets of its key, so that a load shuffles its feed and not the dimension.

Current rows are a catalog table in buckets, a new one per load; closed rows are appended, by load, and never written
again. A view over both is replaced last, so a load that dies leaves the dimension as it was. One writer is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.operators import history

VERSION = "load_number"


@dataclass(frozen=True)
class BucketedDimension:
    """``database``.``name`` is the view. ``buckets`` should give buckets of about one task's memory, and stays fixed."""

    database: str
    name: str
    key: str = history.ZONE_KEY
    attributes: Sequence[str] = history.ZONE_VALUES
    buckets: int = 32

    @property
    def view(self) -> str:
        return f"{self.database}.{self.name}"

    @property
    def closed_table(self) -> str:
        return f"{self.view}_closed"

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attributes, *history.HISTORY]

    def current_table(self, version: int) -> str:
        return f"{self.view}_current_{version}"

    def version(self, spark: SparkSession) -> int | None:
        """The number of the last complete load, or None before the first."""
        if not spark.catalog.tableExists(self.view):
            return None
        found = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:view)", args={"view": self.view}).filter(F.col("key") == VERSION)
        return int(found.first()["value"])

    def read(self, spark: SparkSession) -> DataFrame:
        """Current and closed rows."""
        return spark.table(self.view)

    def changes(self, spark: SparkSession, incoming: DataFrame, as_of=None, **options) -> DataFrame:
        """The rows that are current after ``incoming``, and those that it closes: the join of one load."""
        last = self.version(spark)
        current = None if last is None else spark.table(self.current_table(last))
        return history.apply_history(incoming, current, self.key, self.attributes, as_of, **options)

    def load(self, spark: SparkSession, incoming: DataFrame, as_of=None, **options) -> None:
        """Apply a feed (see ``history.apply_history``) as the next version."""
        self.replace(spark, self.changes(spark, incoming, as_of, **options))

    def replace(self, spark: SparkSession, rows: DataFrame) -> None:
        """Make the current ``rows`` those of the next version, and add the closed ones to the closed rows."""
        last = self.version(spark)
        version = 0 if last is None else last + 1
        staged = f"{self.view}_staged_{version}"
        # Both halves come from one pass over the join; a task holds whole buckets, so buckets need no shuffle.
        writer = rows.select(*self.columns).write.format("parquet").mode("overwrite").partitionBy("is_current")
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(staged)
        both = spark.table(staged).select(*self.columns)
        kept = both.filter("is_current").write.format("parquet").mode("overwrite")
        kept.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.current_table(version))
        if not spark.catalog.tableExists(self.closed_table):
            none = both.limit(0).withColumn(VERSION, F.lit(version))
            none.write.format("parquet").partitionBy(VERSION).saveAsTable(self.closed_table)
        names = ", ".join(self.columns)
        # A load that died before may have left rows of this number; only they are replaced.
        spark.sql(
            f"""INSERT OVERWRITE IDENTIFIER(:closed) PARTITION ({VERSION} = {version})
            SELECT {names} FROM IDENTIFIER(:staged) WHERE NOT is_current""",
            args={"closed": self.closed_table, "staged": staged},
        )
        spark.sql(
            f"""CREATE OR REPLACE VIEW IDENTIFIER(:view) TBLPROPERTIES ('{VERSION}' = '{version}') AS
            SELECT {names} FROM IDENTIFIER(:current)
            UNION ALL SELECT {names} FROM IDENTIFIER(:closed) WHERE {VERSION} <= {version}""",
            args={"view": self.view, "current": self.current_table(version), "closed": self.closed_table},
        )
        spark.sql("DROP TABLE IDENTIFIER(:staged)", args={"staged": staged})
