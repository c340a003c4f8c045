"""Connected components of a table of edges, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import via_table


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours on one side are linked to its least neighbour instead. One row per edge, never per pair."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    linked = both.join(least, "a")
    if large:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    moved = linked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """``id, label``: every id of an edge (``a``, ``b``) and the least id that it reaches. Loops and repeats are harmless.

    The number of rounds grows with the logarithm of the number of nodes. A node with very many neighbours is a hot key
    of joins whose other side has one row for it, which Spark splits.
    """
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = via_table(current, "components"), None
    while True:
        sums = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if sums == before:
            break
        before = sums
        current = via_table(_stars(_stars(current, large=True), large=False).distinct(), "components")
    return current.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(
        current.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    )
