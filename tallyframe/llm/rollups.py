"""Token counts as rollups that signed deltas keep up to date.

A batch of changes is reduced to additive deltas per source, language and tokenizer version: +1 document and +n tokens
for an insert, -1 and -n for a delete, both for a revised count. A batch is committed once under its id, in a folder of
its own, and the totals are the sum over committed batches. Running a batch again therefore changes nothing, and a
batch that died half-way counts for nothing until it is run again. Documents are never read again for the totals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.llm.common import scratch_folder, via_table
from tallyframe.llm.leaks import PRE_SPLIT, read_ranks

KEYS = ("source", "lang", "version")
DELTAS = "source string, lang string, version string, docs long, tokens long"


class Rollup:
    """Totals in a folder that all executors reach: ``batch=<id>`` holds the deltas of each committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"a batch id has letters, digits, dots, dashes and underscores only: {batch!r}")
        return f"{self.path}/batch={batch}"

    def committed(self, batch: str) -> bool:
        """Spark's writer marks a folder as complete after all tasks have committed, never before."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._folder(batch)}/_SUCCESS")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if its id is committed already, and then ``changes`` is not even read.

        One writer per batch id. What an earlier run of the batch left without the mark is replaced.
        """
        if self.committed(batch):
            return False
        deltas = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        deltas.filter("docs <> 0 OR tokens <> 0").write.mode("overwrite").parquet(self._folder(batch))
        return True

    def _batches(self) -> list[str]:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*/_SUCCESS")
        found = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
        return [status.getPath().getParent().toString() for status in found or []]

    def totals(self) -> DataFrame:
        """Documents and tokens per source, language and version; groups in which nothing is left are absent."""
        folders = self._batches()
        deltas = self.spark.read.schema(DELTAS).parquet(*folders) if folders else self.spark.createDataFrame([], DELTAS)
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs <> 0 OR tokens <> 0")


def signed(counts: DataFrame, version: str, tokens: Column, sign: int) -> DataFrame:
    """Deltas of whole documents entering (1) or leaving (-1) under a tokenizer version. NULL source and language are groups of their own."""
    return counts.select("source", "lang", F.lit(version).alias("version"), F.lit(sign).cast("long").alias("docs"), (F.lit(sign) * tokens).cast("long").alias("tokens"))


def revised(counts: DataFrame, old: tuple[str, Column], new: tuple[str, Column]) -> DataFrame:
    """Deltas of documents whose count is replaced, under the same version or another one."""
    return signed(counts, *old, -1).unionByName(signed(counts, *new, 1))


def token_count(spark: SparkSession, text: Column, vocabulary: str) -> Column:
    """Tokens of each whole text under a rank file of fixed size (about 1 MB, broadcast); 0 for NULL."""
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        encoding = tiktoken.Encoding("rollup", pat_str=PRE_SPLIT, mergeable_ranks=ranks.value, special_tokens={})
        for batch in batches:
            yield pd.Series([len(encoding.encode_ordinary(value)) if value else 0 for value in batch], dtype="int64")

    return count(text)


def corpus_rollup(docs: DataFrame, labels: DataFrame, vocabulary: str, other_vocabulary: str, main_language: str = "en") -> DataFrame:
    """Totals of a corpus after three batches: all documents enter; those of other languages than ``main_language``
    (or of none) are counted anew with the second vocabulary; those labelled toxic leave. The first batch comes twice,
    as after a lost acknowledgement, and counts once. Repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    names = [path.rsplit("/", 1)[-1].rsplit(".", 1)[0] for path in (vocabulary, other_vocabulary)]
    other = F.coalesce(F.col("lang") != main_language, F.lit(True))
    rows = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), "text")
    first = token_count(spark, F.col("text"), vocabulary)
    second = token_count(spark, F.when(other, F.col("text")), other_vocabulary)
    counts = via_table(rows.select("doc_id", "source", "lang", first.alias("first"), second.alias("second")), "rollup-counts")
    toxic = labels.filter("toxic = 1").select("doc_id").distinct()

    rollup = Rollup(spark, scratch_folder(spark, "rollup"))
    enter = signed(counts, names[0], F.col("first"), 1)
    rollup.commit("1-enter", enter)
    rollup.commit("2-revise", revised(counts.filter(other), (names[0], F.col("first")), (names[1], F.col("second"))))
    rollup.commit("1-enter", enter)
    leave = counts.join(toxic, "doc_id", "left_semi")
    gone = signed(leave.filter(other), names[1], F.col("second"), -1).unionByName(signed(leave.filter(~other), names[0], F.col("first"), -1))
    rollup.commit("3-leave", gone)
    return rollup.totals()
