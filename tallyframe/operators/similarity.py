"""Similarity self-join: the name pairs within an edit-distance budget, without forming all pairs.

Filter of Pass-Join (Li, Deng, Wang, Feng: "Pass-Join: A Partition-based Method for Similarity Joins",
PVLDB 5(3), 2011): cut the shorter string into budget + 1 segments. A string within ``budget`` edits must hold
one of these segments unchanged near its old position, with at most i - 1 edits left of segment i and the
others right of it. Segments are therefore equi-join keys that Spark can shuffle on. Each candidate is verified
inside the join, so the result is exact.

With a budget of one edit there are only two segments, and numbered names share the first by the thousand. There
names meet by what the edit leaves instead (``_one_edit``): the deletion neighbourhoods of FastSS.

A segment that many names share ("STREET") makes a large group of candidates. ``hot_segments`` finds these
groups; given them, ``near_pairs`` cuts each into tiles of bounded size, which are spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Names of one segment that are compared in one tile.
NAMES_PER_TILE = 2_000
SIGNATURE = ("budget", "i", "cut_x", "segment")


def edit_budget(length: Column, floor: Column) -> Column:
    """The most edits that leave a similarity of ``floor`` when the longer name has ``length`` characters."""
    return F.floor(length * (1 - floor)).cast("int")


def _segment_start(length: Column, budget: Column, i: Column) -> Column:
    """Where segment ``i`` of budget + 1 begins; all have the same size, give or take one character."""
    return F.floor((i - 1) * length / (budget + 1)).cast("int") + 1


def _cut(strings: DataFrame, length: Column) -> DataFrame:
    """One row per segment of a string of ``length``: i, start and size; i is 0 for a string too short to be cut."""
    budget, i = F.col("budget"), F.col("i")
    numbers = F.when(length <= budget, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), budget + 1))
    start = _segment_start(length, budget, i)
    return strings.withColumn("i", F.explode(numbers)).withColumns(
        {"start": start, "size": _segment_start(length, budget, i + 1) - start}
    )


def _spread(names: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Names grow many times into segments: spread them over all tasks first, whatever their size in bytes."""
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Which characters occur, as bits; one edit changes two of them at most.
    letters = F.expr("aggregate(split(text, ''), 0L, (bits, c) -> bits | shiftleft(1L, pmod(ascii(c), 64)))")
    return names.repartition(tasks, *keys, "text").withColumns({"cut": F.length("text"), "letters": letters})


def _parted(cut: DataFrame, at: Column) -> DataFrame:
    """The segment at ``at`` and the text left and right of it; of a string too short to be cut, all is right."""
    whole = F.col("i") == 0
    return cut.withColumns(
        {
            "segment": F.when(whole, "").otherwise(F.col("text").substr(at, F.col("size"))),
            "left": F.when(whole, "").otherwise(F.col("text").substr(F.lit(1), at - 1)),
            "right": F.when(whole, F.col("text")).otherwise(F.col("text").substr(at + F.col("size"), F.col("cut"))),
        }
    )


def _segments(names: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The segments of every name, for each budget it can meet as the shorter one of a pair."""
    size, floor = F.col("size"), F.col("floor")
    budgets = F.sequence(edit_budget(size, floor), edit_budget(F.floor(size / floor).cast("int"), floor))
    met = _spread(names, keys).withColumn("budget", F.explode(budgets)).filter(F.col("budget") > 1)
    return _parted(_cut(met.drop("size"), F.col("cut")), F.col("start")).withColumnRenamed("cut", "cut_x")


def _probes(names: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The places of every name, as the longer one of a pair, where a segment of a shorter name may be."""
    cut, short, budget, i = F.col("cut"), F.col("cut_x"), F.col("budget"), F.col("i")
    met = _spread(names, keys).withColumn("budget", edit_budget(F.col("size"), F.col("floor")))
    met = met.filter(budget > 1).drop("size")
    met = met.withColumn("cut_x", F.explode(F.sequence(F.greatest(F.lit(0), cut - budget), cut)))
    gap, start, size = cut - short, F.col("start"), F.col("size")
    low = F.greatest(F.lit(1), start - (i - 1), start + gap - (budget + 1 - i))
    high = F.least(cut - size + 1, start + (i - 1), start + gap + (budget + 1 - i))
    places = F.when(i == 0, F.array(F.lit(0))).when(low <= high, F.sequence(low, high))
    return _parted(_cut(met, short).withColumn("at", F.explode(places)), F.col("at"))


def _without(place: Column) -> Column:
    """The text less the character at ``place``."""
    return F.concat(F.col("text").substr(F.lit(1), place - 1), F.col("text").substr(place + 1, F.length("text")))


def _one_edit(names: DataFrame, keys: Sequence[str], extras: Sequence[str]) -> DataFrame:
    """Pairs one edit apart whose longer name has a budget of one edit, each once: those that differ in one place have
    the same rest around it, and those of unequal length are the shorter one when the longer loses a character.

    So few names meet, however many begin or end alike. Columns as those of ``near_pairs``.
    """
    size, floor = F.col("size"), F.col("floor")
    allowed, allows = edit_budget(size, floor) == 1, edit_budget(size + 1, floor) == 1
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = names.repartition(tasks, *keys, "text").withColumn("cut", F.length("text"))

    def sided(rows: DataFrame, side: str, *own: str) -> DataFrame:
        return rows.select(*keys, *own, *[F.col(c).alias(f"{c}_{side}") for c in ("text", "unlike", *extras)])

    places = F.explode(F.sequence(F.lit(1), F.col("cut")))
    holes = dealt.filter(allowed & (F.col("cut") > 0)).withColumn("place", places).withColumn("rest", _without(F.col("place")))
    x, y = sided(holes, "x", "cut", "place", "rest"), sided(holes, "y", "cut", "place", "rest")
    replaced = x.hint("merge").join(y, [*keys, "cut", "place", "rest"]).filter("text_x < text_y")
    # Taking out either of two equal neighbours leaves the same.
    y = sided(holes.dropDuplicates([*keys, "text", "rest"]), "y", "rest")
    x = sided(dealt.filter(allows).withColumn("rest", F.col("text")), "x", "rest")
    shorter = x.hint("merge").join(y, [*keys, "rest"])
    sides = [f"{c}_{side}" for side in "xy" for c in ("text", "unlike", *extras)]
    met = replaced.select(*keys, *sides).unionByName(shorter.select(*keys, *sides))
    return met.filter("NOT coalesce(unlike_x = unlike_y, false)").drop("unlike_x", "unlike_y")


def hot_segments(names: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Segments with more candidates than a tile holds, and the number of parts to cut each side into.

    Candidates are the shorter names that have a segment times the places in longer names where it may be, so a
    segment of few shorter names and very many longer ones is cut as well. To be written to a table and read back, so
    that Spark knows its size when it plans ``near_pairs``.
    """
    on = [*keys, *SIGNATURE]
    shorter = _segments(names, keys).groupBy(*on).agg(F.count(F.lit(1)).alias("names"))
    longer = _probes(names, keys).groupBy(*on).agg(F.count(F.lit(1)).alias("places"))
    # Both sides are counted already, so neither is larger than the join that follows; a broadcast is not assumed.
    both = shorter.hint("merge").join(longer, on)
    parts = [F.ceil(F.col(c) / NAMES_PER_TILE).cast("int").alias(p) for c, p in (("names", "parts_x"), ("places", "parts_y"))]
    return both.filter(F.col("names") * F.col("places") > NAMES_PER_TILE**2).select(*on, *parts)


def _tiled(rows: DataFrame, hot: DataFrame, on: Sequence[str], own: str, other: str, text: str) -> DataFrame:
    """Give every row its own part of a hot segment, and one copy for each part of the other side."""
    known = rows.join(hot, on, "left").fillna(1, ["parts_x", "parts_y"])
    return (
        known.withColumn(f"part_{own}", F.pmod(F.xxhash64(text), f"parts_{own}").cast("int"))
        .withColumn(f"part_{other}", F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1)))
        .drop("parts_x", "parts_y")
    )


def near_pairs(names: DataFrame, keys: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Pairs of ``names`` that share ``keys`` and whose texts are within the edit budget of the longer one.

    ``names`` has the columns ``keys``; ``text``, which is compared and is distinct within keys; ``size``, the
    length the similarity is taken over (``size`` minus the length of ``text`` is the same within keys);
    ``floor``, the least similarity, which is above 0 and the same within keys; and ``unlike``, which two names
    of a pair must not share unless it is NULL. Returns keys, ``text_x``, ``text_y`` (each unordered pair once)
    and the remaining columns of both sides.
    """
    extras = [c for c in names.columns if c not in (*keys, "text", "size", "floor", "unlike")]
    on = [*keys, *SIGNATURE]

    def sided(rows: DataFrame, side: str) -> DataFrame:
        named = [F.col(c).alias(f"{c}_{side}") for c in ("text", "left", "right", "letters", "unlike", *extras)]
        return rows.select(*on, *named)

    shorter, longer = sided(_segments(names, keys), "x"), sided(_probes(names, keys), "y")
    if hot is not None:
        shorter = _tiled(shorter, hot, on, "x", "y", "text_x")
        longer = _tiled(longer, hot, on, "y", "x", "text_y")
        on = [*on, "part_x", "part_y"]

    # Cheap tests first. Whatever is left and right of the segment has to fit its share of the budget.
    near = F.expr(
        """
        bit_count(letters_x ^ letters_y) <= 2 * budget
        AND (length(text_y) > cut_x OR text_x < text_y)
        AND NOT coalesce(unlike_x = unlike_y, false)
        AND levenshtein(left_x, left_y, greatest(i - 1, 0)) >= 0
        AND levenshtein(right_x, right_y, budget + 1 - greatest(i, 1)) >= 0
        """
    )
    sides = [f"{c}_{side}" for side in "xy" for c in ("text", *extras)]
    # Spark's size estimates do not see the explodes, so it would broadcast a side that is not small.
    found = shorter.hint("merge").join(longer, on).filter(near).select(*keys, *sides).distinct()
    return found.unionByName(_one_edit(names, keys, extras))
