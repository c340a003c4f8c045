"""Master-data matching: normalise, block, score, band; golden records, steward queue, audit.

Within a block every record could be paired with every other one. The operators here never form those pairs:

* equal names are one *class* with a record count, so copies cost one row, whatever their number;
* similar classes are found by a similarity join (``similarity.near_pairs``);
* the number of pairs compared, and so of rejected pairs, follows from the counts.

Record pairs are counted, never formed: the steward queue holds pairs of golden records.

``copies`` is the one pass over the records. Stored, it serves all steps after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions import text as tx
from tallyframe.functions.casts import as_whole, moment
from tallyframe.functions.columns import pick, require
from tallyframe.operators.similarity import hot_segments, near_pairs
from tallyframe.sources.scratch import via_table

# Texts of the golden record and of the master-data scorecard.
SURVIVORSHIP = "min(location_id) per match_key"
MDM_SCORECARD = {
    "domain": "taxi_zones",
    "metric": "duplicate_candidates_rate",
    "business_impact": "Bad master data causes incorrect joins → wrong zone reporting and broken downstream analytics",
    "owner": "MDM Steward",
    "threshold": "<= 2%",
    "action_on_failure": "Trigger steward review workflow",
}
MATCH_COUNTS = ("total_pairs_compared", "auto_merge_pairs", "steward_review_pairs", "reject_pairs")

LOWEST_REVIEW = 0.3
# Records of a block on each side of a tile, where rejected pairs are listed.
REJECT_TILE = 5_000
COUNT = "decimal(38,0)"
# How a name is compared: without the first token among names that share it, or whole among all of a block.
SAME_TOKEN, ANY_TOKEN = "=", "*"
FAMILY = ("block", "family")


def normalize(zones: DataFrame, id_type: str | None = None) -> DataFrame:
    """Add location_id (from LocationID), zone_norm, borough_norm and match_key."""
    require(zones, "LocationID")
    name = pick(zones, "Zone", "zone_name")
    block = tx.normalized("Borough") if "Borough" in zones.columns else F.lit("UNKNOWN")
    return (
        zones.withColumn("LocationID", as_whole(zones, "LocationID", id_type))
        .withColumnRenamed("LocationID", "location_id")
        .withColumns({"zone_norm": tx.normalized(name), "borough_norm": block})
        .withColumn("match_key", F.concat_ws("::", "borough_norm", "zone_norm"))
    )


def golden(records: DataFrame, as_of=None) -> DataFrame:
    """One record per match key, the one with the least id; a NULL id comes first.

    Spark keeps only the first row per key of every input task before the shuffle (WindowGroupLimit), so a
    hot key moves one row per task.
    """
    ties = [F.col(c) for c in records.columns if c not in ("location_id", "match_key")]
    order = Window.partitionBy("match_key").orderBy(F.col("location_id").asc(), *ties)
    return (
        records.withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") == 1)
        .drop("rn")
        .withColumns(
            {
                "mdm_state": F.lit("ACTIVE"),
                "created_at_utc": moment(as_of),
                "updated_at_utc": moment(as_of),
                "survivorship_rule": F.lit(SURVIVORSHIP),
            }
        )
        .withColumnRenamed("location_id", "LocationID")
    )


def copies(records: DataFrame) -> DataFrame:
    """block, name, id and how often that combination occurs; only records that can be in a pair."""
    return (
        records.filter(F.col("borough_norm").isNotNull() & F.col("location_id").isNotNull())
        .groupBy(
            F.col("borough_norm").alias("block"), F.col("zone_norm").alias("name"), F.col("location_id").alias("id")
        )
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _pairs_of(total: Column, squares: Column) -> Column:
    """Pairs with different ids among ``total`` records whose counts per id have these summed squares."""
    return ((total * total - squares) / 2).cast(COUNT)


def _square_sums(counts: Column) -> tuple[Column, Column]:
    n = counts.cast("decimal(18,0)")
    return F.sum(n).cast("decimal(19,0)"), F.sum(n * n).cast(COUNT)


def block_pairs(per_copy: DataFrame) -> DataFrame:
    """block, records and the number of record pairs with different ids, from counts alone."""
    per_id = per_copy.groupBy("block", "id").agg(F.sum("copies").alias("n"))
    total, squares = _square_sums(F.col("n"))
    sums = per_id.groupBy("block").agg(F.sum("n").alias("records"), total.alias("total"), squares.alias("squares"))
    return sums.select("block", "records", _pairs_of(F.col("total"), F.col("squares")).alias("pairs_compared"))


def name_classes(per_copy: DataFrame) -> DataFrame:
    """block, name, its records and the pairs among them."""
    total, squares = _square_sums(F.col("copies"))
    sums = (
        per_copy.filter(F.col("name").isNotNull())
        .groupBy("block", "name")
        .agg(F.sum("copies").alias("records"), total.alias("total"), squares.alias("squares"))
    )
    return sums.select("block", "name", "records", _pairs_of(F.col("total"), F.col("squares")).alias("inner_pairs"))


def score(pairs: DataFrame, high: float = tx.HIGH_CONFIDENCE, review: float = tx.REVIEW_CONFIDENCE) -> DataFrame:
    """Score and band the name pairs ``zone_a``, ``zone_b``."""
    scored = pairs.withColumns(
        {
            "name_similarity": tx.name_similarity(F.col("zone_a"), F.col("zone_b")),
            "token_a": tx.first_token(F.col("zone_a")),
            "token_b": tx.first_token(F.col("zone_b")),
        }
    )
    scored = scored.withColumn("token_match", F.when(F.col("token_a") == F.col("token_b"), 1.0).otherwise(0.0))
    scored = scored.withColumn(
        "match_confidence", tx.match_confidence(F.col("name_similarity"), F.col("token_match"))
    )
    return scored.withColumn("decision", tx.decision(F.col("match_confidence"), high, review))


def similarity_floor(review: float, token_match: float) -> float:
    """A similarity that every pair reaching ``review`` has, with room for both roundings."""
    rounding = 0.5 * 10**-tx.SCORE_DIGITS
    return (review - rounding - tx.TOKEN_WEIGHT * token_match) / tx.NAME_WEIGHT - rounding - 1e-6


def compared_names(classes: DataFrame, review: float) -> DataFrame:
    """How each name is compared: in the family of its first token by the rest, and in its block as a whole.

    Names with the same first token have the edit distance of the rest. Names with different first tokens need
    a higher similarity to reach ``review``, so fewer edits are allowed.
    """
    if review < LOWEST_REVIEW:
        raise ValueError(f"the review threshold must be at least {LOWEST_REVIEW}, not {review}")
    same = F.struct(
        F.concat(F.lit(SAME_TOKEN), tx.first_token(F.col("name"))).alias("family"),
        F.expr("substring(name, length(substring_index(name, ' ', 1)) + 1)").alias("text"),
        F.lit(similarity_floor(review, 1.0)).alias("floor"),
        F.lit(None).cast("string").alias("unlike"),
    )
    other = F.struct(
        F.lit(ANY_TOKEN).alias("family"),
        F.col("name").alias("text"),
        F.lit(similarity_floor(review, 0.0)).alias("floor"),
        tx.first_token(F.col("name")).alias("unlike"),
    )
    return classes.select("block", F.length("name").alias("size"), "records", F.inline(F.array(same, other)))


def _names_to_compare(classes: DataFrame, review: float, apart: DataFrame | None, across: bool) -> DataFrame:
    names = compared_names(classes, review)
    if apart is not None:
        names = names.join(apart.select(*FAMILY), list(FAMILY), "left_anti").select(names.columns)
    return names if across else names.filter(F.col("family") != ANY_TOKEN)


def hot_names(
    classes: DataFrame, review: float = tx.REVIEW_CONFIDENCE, apart: DataFrame | None = None, across: bool = True
) -> DataFrame:
    """Parts of names that so many names share that their comparison has to be spread; see ``hot_segments``.

    ``apart`` and ``across`` as for ``similar_classes``.
    """
    return hot_segments(_names_to_compare(classes, review, apart, across), FAMILY)


def in_families(classes: DataFrame, families: DataFrame) -> DataFrame:
    """block, name, family of the names that belong to one of ``families`` (``block``, ``family``)."""
    family = F.concat(F.lit(SAME_TOKEN), tx.first_token(F.col("name"))).alias("family")
    return classes.select("block", "name", family).join(families.select("block", "family"), ["block", "family"], "left_semi")


def close_families(classes: DataFrame, least: float) -> DataFrame:
    """Families (names of a block with one first token) whose rests are so short that any two names reach ``least``.

    block, family, its number of names and the first of them. Two rests of at most r characters are at most r edits
    apart, one less where both begin with the space; the bound falls as r grows, so the longest rest decides.
    """
    token = tx.first_token(F.col("name"))
    rest = F.length("name") - F.length(token)
    groups = classes.groupBy("block", F.concat(F.lit(SAME_TOKEN), token).alias("family")).agg(
        F.count(F.lit(1)).alias("names"),
        F.min("name").alias("first_name"),
        F.max(rest).alias("longest"),
        F.min(rest).alias("shortest"),
        F.max(F.length("name")).alias("size"),
    )
    edits = F.col("longest") - F.least("shortest", F.lit(1))
    similarity = F.round(1 - edits / F.col("size"), tx.SCORE_DIGITS)
    bound = tx.match_confidence(similarity, F.lit(1.0))
    return groups.filter((F.col("names") > 1) & (bound >= least)).select("block", "family", "names", "first_name")


def family_groups(per_copy: DataFrame, classes: DataFrame, high: float, review: float) -> DataFrame:
    """One row per family in which every pair of names is accepted: names, records, and record pairs in each band.

    Pairs are counted from sums. Only pairs that reach ``high`` are looked for, by the similarity join of that threshold;
    where all of a family reach it, none is. ``family_partners`` lists the pairs of the records asked for.
    """
    close = close_families(classes, review)
    member = in_families(classes, close)
    copies = per_copy.join(member, ["block", "name"])
    per_id = copies.groupBy("block", "family", "id").agg(F.sum("copies").alias("n"))
    total, squares = _square_sums(F.col("n"))
    sums = per_id.groupBy("block", "family").agg(F.sum("n").alias("records"), total.alias("total"), squares.alias("squares"))
    inner = (
        classes.join(member, ["block", "name"])
        .groupBy("block", "family")
        .agg(F.sum("inner_pairs").cast(COUNT).alias("inner_pairs"))
    )
    all_high = close_families(classes, high).select("block", "family", F.lit(True).alias("all_high"))
    # Names of families that are close at ``review`` but not at ``high``.
    mixed = member.join(all_high, ["block", "family"], "left_anti").select("block", "name")
    mixed = via_table(classes.join(mixed, ["block", "name"], "left_semi"), "family-names")
    hot = via_table(hot_names(mixed, high, across=False), "hot-names")
    near = similar_classes(mixed, high, hot, across=False)
    scored = score(count_across(near, per_copy), high, review).filter(F.col("decision") == tx.AUTO_MERGE)
    merged = scored.groupBy("block", F.concat(F.lit(SAME_TOKEN), F.col("token_a")).alias("family")).agg(
        F.sum("record_pairs").cast(COUNT).alias("found")
    )
    keys = ["block", "family"]
    whole = close.join(sums, keys).join(inner, keys).join(all_high, keys, "left").join(merged, keys, "left")
    pairs = (_pairs_of(F.col("total"), F.col("squares")) - F.col("inner_pairs")).cast(COUNT)
    auto = F.when(F.col("all_high"), pairs).otherwise(F.coalesce("found", F.lit(0))).cast(COUNT)
    return whole.select(
        F.col("block").alias("borough"),
        F.expr(f"substring(family, {len(SAME_TOKEN) + 1})").alias("token"),
        "names",
        "records",
        pairs.alias("record_pairs"),
        auto.alias("auto_merge_pairs"),
        (pairs - auto).cast(COUNT).alias("steward_review_pairs"),
    )


def family_partners(
    classes: DataFrame, wanted: DataFrame, high: float = tx.HIGH_CONFIDENCE, review: float = tx.REVIEW_CONFIDENCE
) -> DataFrame:
    """The accepted pairs that the names ``wanted`` (``block``, ``name``) have within close families, scored, each once."""
    member = in_families(classes, close_families(classes, review))
    asked = wanted.select("block", "name").distinct().withColumn("asked", F.lit(True))
    marked = member.join(asked, ["block", "name"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    x = marked.filter("asked").select("block", "family", F.col("name").alias("x"))
    y = marked.select("block", "family", F.col("name").alias("y"), "asked")
    # Of two asked names the first is x, so the pair comes once.
    pairs = x.join(y, ["block", "family"]).filter((F.col("x") != F.col("y")) & (~F.col("asked") | (F.col("x") < F.col("y"))))
    ordered = pairs.select("block", F.least("x", "y").alias("zone_a"), F.greatest("x", "y").alias("zone_b"))
    return score(ordered, high, review).filter(F.col("decision") != tx.REJECT).withColumnRenamed("block", "borough")


def similar_classes(
    classes: DataFrame,
    review: float,
    hot: DataFrame | None = None,
    apart: DataFrame | None = None,
    across: bool = True,
) -> DataFrame:
    """block, zone_a < zone_b and their record counts for every pair of names that can reach ``review``.

    Pairs within the families ``apart`` (``block``, ``family``) are left out; without ``across`` so are pairs of names
    with different first tokens.
    """

    def full(text: str) -> Column:
        return F.when(F.col("family") == ANY_TOKEN, F.col(text)).otherwise(
            F.concat(F.expr(f"substring(family, {len(SAME_TOKEN) + 1})"), F.col(text))
        )

    found = near_pairs(_names_to_compare(classes, review, apart, across), FAMILY, hot)
    found = found.withColumns({"x": full("text_x"), "y": full("text_y")})
    ordered = F.col("x") < F.col("y")
    return found.select(
        "block",
        F.least("x", "y").alias("zone_a"),
        F.greatest("x", "y").alias("zone_b"),
        F.when(ordered, F.col("records_x")).otherwise(F.col("records_y")).alias("records_a"),
        F.when(ordered, F.col("records_y")).otherwise(F.col("records_x")).alias("records_b"),
    )


def count_across(class_pairs: DataFrame, per_copy: DataFrame) -> DataFrame:
    """Pairs of classes with their record pairs: the product of the counts, less the pairs of one and the same id.

    Only ids that occur under several names of a block are looked up; usually there are none.
    """
    repeated = per_copy.groupBy("block", "id").agg(F.count(F.lit(1)).alias("names")).filter("names > 1")
    ids = per_copy.join(repeated, ["block", "id"], "left_semi").filter(F.col("name").isNotNull())
    left = ids.select("block", F.col("name").alias("zone_a"), "id", F.col("copies").alias("copies_a"))
    right = ids.select("block", F.col("name").alias("zone_b"), "id", F.col("copies").alias("copies_b"))

    def product(a: str, b: str) -> Column:
        return (F.col(a).cast("decimal(18,0)") * F.col(b).cast("decimal(18,0)")).cast(COUNT)

    shared = F.coalesce(F.sum(product("copies_a", "copies_b")), F.lit(0))
    counted = (
        class_pairs.join(left, ["block", "zone_a"], "left")
        .join(right, ["block", "zone_b", "id"], "left")
        .groupBy(*class_pairs.columns)
        # The names leave the aggregate as its results: else Spark would push the scoring that follows below it
        # and into the similarity join, to be done for every candidate.
        .agg(F.max("zone_a").alias("name_a"), F.max("zone_b").alias("name_b"), shared.alias("shared"))
    )
    pairs = (product("records_a", "records_b") - F.col("shared")).cast(COUNT)
    return counted.select(
        "block",
        F.col("name_a").alias("zone_a"),
        F.col("name_b").alias("zone_b"),
        "records_a",
        "records_b",
        pairs.alias("record_pairs"),
    ).filter(F.col("record_pairs") > 0)


def accepted_names(
    per_copy: DataFrame,
    high: float = tx.HIGH_CONFIDENCE,
    review: float = tx.REVIEW_CONFIDENCE,
    classes: DataFrame | None = None,
    hot: DataFrame | None = None,
    apart: DataFrame | None = None,
) -> DataFrame:
    """Every pair of names that is not rejected, scored, with their records and the record pairs behind it.

    A name paired with itself stands for the pairs among its own records. ``per_copy`` is the result of
    ``copies``; ``classes`` and ``hot`` are those of ``name_classes`` and ``hot_names`` if they have been written to
    a table. Pairs within the families ``apart`` are left out; ``family_groups`` counts them.
    """
    if classes is None:
        classes = name_classes(per_copy)
    within = classes.filter(F.col("inner_pairs") > 0).select(
        "block",
        F.col("name").alias("zone_a"),
        F.col("name").alias("zone_b"),
        F.col("records").alias("records_a"),
        F.col("records").alias("records_b"),
        F.col("inner_pairs").alias("record_pairs"),
    )
    across = count_across(similar_classes(classes, review, hot, apart), per_copy)
    scored = score(within.unionByName(across), high, review).filter(F.col("decision") != tx.REJECT)
    return scored.withColumnRenamed("block", "borough")


def block_ledger(per_copy: DataFrame, accepted: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """Per block: records, pairs compared, and pairs in each band. Rejects are the pairs not accepted.

    ``families`` (of ``family_groups``) adds the pairs that are not listed in ``accepted``.
    """
    bands = {"auto_merge_pairs": tx.AUTO_MERGE, "steward_review_pairs": tx.STEWARD_REVIEW}
    counts = accepted.select(
        "borough",
        *[F.when(F.col("decision") == name, F.col("record_pairs")).otherwise(0).cast(COUNT).alias(c) for c, name in bands.items()],
    )
    if families is not None:
        counts = counts.unionByName(families.select("borough", *bands))
    bands = counts.groupBy("borough").agg(*[F.sum(c).cast(COUNT).alias(c) for c in bands])
    compared = block_pairs(per_copy).withColumnsRenamed(
        {"block": "borough", "pairs_compared": "total_pairs_compared"}
    )
    ledger = compared.join(bands, "borough", "left").fillna(0, ["auto_merge_pairs", "steward_review_pairs"])
    accepted_pairs = F.col("auto_merge_pairs") + F.col("steward_review_pairs")
    return ledger.withColumn("reject_pairs", (F.col("total_pairs_compared") - accepted_pairs).cast(COUNT))


def steward_queue(accepted: DataFrame, per_copy: DataFrame, as_of=None) -> DataFrame:
    """The pairs of golden records to review, best first: one row per pair of names.

    ``id_a`` and ``id_b`` are the least ids of the two names, which are those of their golden records; how many
    records and record pairs stand behind a row is in ``records_a``, ``records_b`` and ``record_pairs``. Ids break
    ties, which also lets Spark split a hot confidence.
    """
    least = per_copy.groupBy(F.col("block").alias("borough"), "name").agg(F.min("id").alias("id"))
    review = accepted.filter(F.col("decision") == tx.STEWARD_REVIEW)
    for side in ("a", "b"):
        review = review.join(least.withColumnsRenamed({"name": f"zone_{side}", "id": f"id_{side}"}), ["borough", f"zone_{side}"])
    return (
        review.select(
            "id_a",
            "id_b",
            "zone_a",
            "zone_b",
            "borough",
            "name_similarity",
            "match_confidence",
            "decision",
            "records_a",
            "records_b",
            "record_pairs",
        )
        .withColumns({"review_status": F.lit("PENDING"), "submitted_at_utc": moment(as_of)})
        .orderBy(F.desc("match_confidence"), "id_a", "id_b")
    )


def reject_partners(
    records: DataFrame,
    wanted: DataFrame,
    high: float = tx.HIGH_CONFIDENCE,
    review: float = tx.REVIEW_CONFIDENCE,
) -> DataFrame:
    """All rejected pairs of the records whose ``location_id`` is in ``wanted``, scored.

    The full reject relation is every pair of a block that was not accepted and grows with the square of the
    block; this lists the part of it that somebody asks about. Each pair comes once. The records of a block are dealt
    over tiles of bounded size, on both sides, so no task meets a whole block.
    """
    columns = ["borough_norm", "location_id", "zone_norm"]
    pool = records.filter(F.col("borough_norm").isNotNull() & F.col("location_id").isNotNull()).select(*columns)
    asked = wanted.select("location_id", F.lit(True).alias("asked")).distinct()
    marked = pool.join(asked, "location_id", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    sides = marked.groupBy("borough_norm").agg(
        F.ceil(F.count(F.when(F.col("asked"), 1)) / REJECT_TILE).cast("int").alias("rows"),
        F.ceil(F.count(F.lit(1)) / REJECT_TILE).cast("int").alias("cols"),
    )
    # Blocks without a record asked for leave here.
    dealt = marked.join(sides.filter("rows > 0"), "borough_norm")
    own = lambda parts: F.pmod(F.xxhash64("location_id", "zone_norm"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    x = dealt.filter("asked").select("*", own("rows").alias("row"), every("cols").alias("col")).alias("x")
    y = dealt.select("*", own("cols").alias("col"), every("rows").alias("row")).alias("y")
    x_first = F.col("x.location_id") < F.col("y.location_id")
    pairs = x.join(
        y,
        (F.col("x.borough_norm") == F.col("y.borough_norm"))
        & (F.col("x.row") == F.col("y.row"))
        & (F.col("x.col") == F.col("y.col"))
        & (F.col("x.location_id") != F.col("y.location_id"))
        & (~F.col("y.asked") | x_first),
    ).select(
        F.least("x.location_id", "y.location_id").alias("id_a"),
        F.greatest("x.location_id", "y.location_id").alias("id_b"),
        F.when(x_first, F.col("x.zone_norm")).otherwise(F.col("y.zone_norm")).alias("zone_a"),
        F.when(x_first, F.col("y.zone_norm")).otherwise(F.col("x.zone_norm")).alias("zone_b"),
        F.col("x.borough_norm").alias("borough"),
    )
    return score(pairs, high, review).filter(F.col("decision") == tx.REJECT)


def _totals(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: records in total and pairs per band."""
    pairs = ledger.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(COUNT).alias(c) for c in MATCH_COUNTS])
    rows = records.agg(F.count(F.lit(1)).alias("total_zone_rows"))
    # Two single rows, put beside each other by an aggregate: no join without a key.
    both = rows.unionByName(pairs, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("total_zone_rows", *MATCH_COUNTS)])


def match_audit(
    records: DataFrame, ledger: DataFrame, high: float, review: float, as_of=None, **context: str
) -> DataFrame:
    """One row: records, pairs per band, thresholds and ``context`` (paths, job name) as text columns."""
    extra = {name: F.lit(value) for name, value in context.items()}
    return _totals(records, ledger).withColumns(
        {
            "high_conf_threshold": F.lit(float(high)),
            "med_conf_threshold": F.lit(float(review)),
            **extra,
            "generated_at_utc": moment(as_of),
        }
    )


def mdm_scorecard(records: DataFrame, ledger: DataFrame, run_id: str, as_of=None) -> DataFrame:
    """One row per run: the metric's metadata, its observed value and the counts behind it."""
    found = F.col("auto_merge_pairs") + F.col("steward_review_pairs")
    rate = F.when(
        F.col("total_pairs_compared") > 0, F.round(found.cast("double") / F.col("total_pairs_compared").cast("double"), 6)
    ).otherwise(0.0)
    return _totals(records, ledger).select(
        F.lit(run_id).alias("run_id"),
        *[F.lit(value).alias(name) for name, value in MDM_SCORECARD.items()],
        rate.alias("observed_value"),
        F.col("total_zone_rows").alias("total_records"),
        F.col("total_pairs_compared").alias("pairs_compared"),
        "auto_merge_pairs",
        "steward_review_pairs",
        "reject_pairs",
        moment(as_of).alias("generated_at_utc"),
    )
