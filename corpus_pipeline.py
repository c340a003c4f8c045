"""A cleaning pipeline for training text: each stage is one operator, written as Parquet and read by the next.

Toxic documents go; one document of each group of near copies stays; secrets are cut out of the texts; documents are
repeated or left out so that sources come near their weights; texts become piece ids. The filtering stages keep clean
documents. All columns of the input pass through every stage but the last, extra ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.llm import leaks, mixing, nearcopies, pieces, toxicity
from tallyframe.llm.common import table, via_table

#: Tables of decisions up to this many rows (a few numbers each) are broadcast, so that texts stay where they are read;
#: larger ones are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def _sized(decisions: DataFrame) -> DataFrame:
    return F.broadcast(decisions) if decisions.count() <= MOST_BROADCAST else decisions


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go. Stems and curve are learned from the labelled training rows.

    NULL and empty texts show no toxicity and stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity_score(F.col("text"), model) < 0.5)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, in any case."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _own_ids(docs: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """doc_id, the key of the text, text and own_id for each different text of the ids in ``repeated``.

    The first text by key has the doc_id for its own id; the others have numbers from 2^62 on, which no other text gets.
    """
    several = docs.join(_sized(repeated), "doc_id", "left_semi").select("doc_id", "text").withColumn(key, _text_key())
    rows = several.dropDuplicates(["doc_id", key])
    first = rows.groupBy("doc_id").agg(F.min(key).alias(f"{key}_first"))
    other = F.xxhash64("doc_id", key).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    own = F.when(F.col(key) == F.col(f"{key}_first"), F.col("doc_id").cast("long")).otherwise(other)
    return rows.join(first, "doc_id").select("doc_id", key, "text", own.alias("own_id"))


def _text_key() -> Column:
    return F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit(""))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 over five-word shingles, the document with the smallest id stays.

    Empty texts and rows without an id are in no group. Of rows that repeat both id and text, one stays. Different texts
    under one id are judged each by itself: the first by its hash under that id, the others after all other ids.
    """
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = via_table(repeated.select("doc_id"), "pipeline-repeated")
    if repeated.isEmpty():
        gone = _gone(docs)
        return docs.join(_sized(gone), "doc_id", "left_anti").select(docs.columns)
    key = _free(docs, "_text_key")
    once = docs.join(_sized(repeated), "doc_id", "left_anti").select(docs.columns)
    named = via_table(_own_ids(docs, repeated, key), "pipeline-own-ids")
    own = named.select(F.col("own_id").alias("doc_id"), "text")
    gone = _gone(via_table(once.select("doc_id", "text").unionByName(own), "pipeline-texts"))
    stays = named.join(gone.withColumnRenamed("doc_id", "own_id"), "own_id", "left_anti").select("doc_id", key)
    several = docs.join(_sized(repeated), "doc_id", "left_semi").withColumn(key, _text_key())
    several = several.join(stays, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key]).select(docs.columns)
    return once.join(_sized(gone), "doc_id", "left_anti").select(docs.columns).unionByName(several)


def _gone(docs: DataFrame) -> DataFrame:
    found = via_table(nearcopies.near_copies(docs, shingle=5, percent=80), "pipeline-groups")
    return found.filter("NOT kept").select("doc_id").distinct()


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans with secrets are replaced by a mark; no document goes. ``n_chars`` follows the text."""
    clean = leaks.redacted(F.col("text"), leaks.secret_spans(spark, F.col("text")))
    changed = docs.withColumn("text", clean)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated up to three times, so that sources give words by the weights 1, 2, 3.

    Rows that share an id share one decision, the largest. Documents without words add nothing and are left out.
    """
    key, copies, copy = (_free(docs, name) for name in ("_id", "_copies", "_copy"))
    mixed = mixing.mix(docs, F.array(F.col("source").cast("string")), mixing.n_words(F.col("text")))
    taken = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(copies)).filter(F.col(copies) > 0)
    taken = via_table(taken, "pipeline-copies")
    rows = docs.join(_sized(taken), docs["doc_id"].eqNullSafe(F.col(key)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, pieces (ids of the best sum of scores), n_pieces and whether decoding gives the text back, for every row."""
    return pieces.encoded(docs, pieces.read_pieces(), fold="viterbi")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", cut_secrets),
    ("mix", mix_sources),
    ("pieces", encode),
]

#: Learned weights and token vocabularies have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = via_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
