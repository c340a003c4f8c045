"""Connected components of a table of links, by randomised contraction.

Bögeholz, Brand and Todor ("In-database connected component analysis", ICDE 2020): in each round every node picks, of
itself and its neighbours, the one that a hash of this round puts first, and links move to the picks. A constant share
of the nodes is left after a round, whatever the shape (a chain, a star), so all rounds together read a few times the
links. The picks are then followed from the last round back to the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.sources.scratch import via_table


def _placed(node: str, level: int) -> Column:
    return F.struct(F.xxhash64(F.lit(level), F.col(node)).alias("place"), F.col(node).alias("node"))


def _picks(links: DataFrame, level: int) -> DataFrame:
    """node, pick: partial minima leave a task once per node, so a node with very many links is no hot group."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = both.groupBy("a").agg(F.min(_placed("b", level)).alias("other"))
    return first.select(F.col("a").alias("node"), F.least(_placed("a", level), F.col("other"))["node"].alias("pick"))


def connected(links: DataFrame) -> DataFrame:
    """node, label for every node of ``links`` (``a``, ``b``): nodes have one label if and only if links connect them.

    The label is one of the nodes, the same in every run. Links that repeat, run both ways or join a node with itself
    are harmless; links with a NULL side are left out.
    """
    current = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    loose = current.select(F.col("a").alias("node")).unionByName(current.select(F.col("b").alias("node"))).distinct()
    current = via_table(current.filter("a <> b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not current.isEmpty():
        picks = via_table(_picks(current, len(rounds)), "link-picks")
        rounds.append(picks)
        for side in ("a", "b"):
            moved = picks.select(F.col("node").alias(side), F.col("pick").alias(f"{side}_pick"))
            current = current.join(moved, side)
        moved = current.select(F.col("a_pick").alias("a"), F.col("b_pick").alias("b"))
        current = via_table(moved.filter("a <> b").distinct(), "links")
    if not rounds:
        return loose.select("node", F.col("node").alias("label"))
    labels = rounds.pop().withColumnRenamed("pick", "label")
    for picks in reversed(rounds):
        later = labels.select(F.col("node").alias("pick"), "label")
        followed = picks.join(later, "pick", "left").select("node", F.coalesce("label", "pick").alias("label"))
        labels = via_table(followed, "link-labels")
    alone = loose.join(labels, "node", "left_anti")
    return labels.unionByName(alone.select("node", F.col("node").alias("label")))
