"""What AUTO_MERGE does to golden records: names that are linked, also through others, keep one survivor.

Links are taken between name classes, not records, and a family of names that are all close enough is linked by a star,
so their number grows with the names and never with the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions import text as tx
from tallyframe.functions.casts import moment
from tallyframe.operators.linked import connected
from tallyframe.operators.matching import close_families, hot_names, in_families, score, similar_classes
from tallyframe.sources.scratch import via_table

# States of a golden record and the rule that picks a survivor.
ACTIVE, MERGED = "ACTIVE", "MERGED"
MERGE_RULE = "min(location_id) per cluster of AUTO_MERGE names"


def _key(name: Column) -> Column:
    return F.concat_ws("::", F.col("block"), name)


def merge_links(classes: DataFrame, high: float = tx.HIGH_CONFIDENCE) -> DataFrame:
    """a, b: the match keys of names that AUTO_MERGE at ``high``; all names of a close family are linked to its first.

    ``classes`` is the result of ``name_classes``, stored.
    """
    close = via_table(close_families(classes, high), "close-families")
    hot = via_table(hot_names(classes, high, close), "hot-names")
    members = in_families(classes, close)
    star = members.join(close.select("block", "family", "first_name"), ["block", "family"])
    found = similar_classes(classes, high, hot, close).select("block", "zone_a", "zone_b")
    pairs = score(found, high, high).filter(F.col("decision") == tx.AUTO_MERGE)
    return pairs.select(_key(F.col("zone_a")).alias("a"), _key(F.col("zone_b")).alias("b")).unionByName(
        star.select(_key(F.col("first_name")).alias("a"), _key(F.col("name")).alias("b"))
    )


def golden_members(per_copy: DataFrame, links: DataFrame) -> DataFrame:
    """Every match key and where it went: its block, name, least id, records, and those of its cluster's survivor.

    The survivor of a cluster is the name of the least id; at ties, the first name. A key without links is its own
    survivor. Records without a block, name or id are in no pair, so they have no row here. A cluster of very many names
    is a hot key of a join whose other side is one row, which Spark splits.
    """
    least = (
        per_copy.filter(F.col("name").isNotNull())
        .groupBy("block", "name")
        .agg(F.min("id").alias("location_id"), F.sum("copies").alias("records"))
    )
    keyed = least.withColumn("match_key", _key(F.col("name")))
    labelled = keyed.join(connected(links).withColumnRenamed("node", "match_key"), "match_key", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "match_key"))
    survivor = F.min(F.struct("location_id", "match_key"))
    chosen = labelled.groupBy("label").agg(survivor.alias("survivor"))
    return labelled.join(chosen, "label").select(
        F.col("block").alias("borough"),
        "name",
        "match_key",
        "location_id",
        "records",
        F.col("survivor.location_id").alias("survivor_id"),
        F.col("survivor.match_key").alias("survivor_key"),
        F.when(F.col("match_key") == F.col("survivor.match_key"), ACTIVE).otherwise(MERGED).alias("mdm_state"),
    )


def golden_clusters(members: DataFrame) -> DataFrame:
    """One row per survivor: how many names and records it stands for, and the largest id among their least ids."""
    return members.groupBy("borough", "survivor_id", "survivor_key").agg(
        F.count(F.lit(1)).alias("names"),
        F.sum("records").alias("records"),
        F.max("location_id").alias("last_id"),
    )


def merge_golden(golden: DataFrame, members: DataFrame, as_of=None) -> DataFrame:
    """Golden records after the merge: those that did not survive are MERGED and name their survivor, none goes."""
    went = members.filter(F.col("mdm_state") == MERGED).select("match_key", "survivor_id", "survivor_key")
    changed = {"mdm_state": F.lit(MERGED), "updated_at_utc": moment(as_of), "survivorship_rule": F.lit(MERGE_RULE)}
    merged = F.col("survivor_key").isNotNull()
    joined = golden.join(went, "match_key", "left").select(*golden.columns, "survivor_id", "survivor_key")
    return joined.withColumns({name: F.when(merged, value).otherwise(F.col(name)) for name, value in changed.items()})
