"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources. Documents with the same set of sources form a pattern. A flow routes words
from patterns to source quotas; each further copy of a pattern costs more, so repetition is spread before it deepens.
The flow sees one row per pattern, never a document, and parts of it that share no source are solved apart from each
other, on Spark. Source sizes, weights and targets are tables too. Within a pattern documents stand in a seeded order, and the flow
takes a prefix of their first copies, then of their second ones, and so on.

Positions in that order come from two levels: sums over hash buckets, and an exact running sum only inside the few
buckets that a boundary cuts. So no task sorts a whole source, however large it is.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.common import WORD_PATTERN, via_table
from tallyframe.llm.components import components

BUCKETS = 4096
#: Sources ranked, and patterns routed, in a task: about so many.
_SOURCES, _PATTERNS = 100_000, 5_000


def n_words(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def code_point_order(source: str | int | None) -> tuple:
    """Sorts sources by code point, or their places, NULL last."""
    return source is None, "" if source is None else source


def weighted_targets(sizes: Mapping[str | None, int], weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> dict[str | None, float]:
    """The share of all words that each source should give: weights repeat over the sources in their order, no target
    exceeds ``most`` times the source's size, and what is cut off is shared again by weight until none is above.

    For sources at hand; ``targets_of`` does the same for a table of them."""
    order = sorted(sizes, key=code_point_order)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, targets, open_ = float(sum(sizes.values())), {}, list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return targets | share
        for s in above:
            targets[s] = most * sizes[s]
            left -= targets[s]
        open_ = [s for s in open_ if s not in targets]
    return targets


def route(patterns: Mapping[tuple, int], quotas: Mapping[str | None, int], copies: int) -> dict[tuple, dict[str | None, int]]:
    """Words that each pattern sends to each of its sources: most words first, then least cost of repetition.

    Parts of the pattern and source graph that do not touch are solved one by one.
    """
    by_source = defaultdict(list)
    for pattern in patterns:
        for source in pattern:
            by_source[source].append(pattern)
    flows, done = {}, set()
    for first in patterns:
        if first in done:
            continue
        group, todo = [], [first]
        done.add(first)
        while todo:
            group.append(pattern := todo.pop())
            for source in pattern:
                for other in by_source[source]:
                    if other not in done:
                        done.add(other)
                        todo.append(other)
        flows |= _min_cost_flow({p: patterns[p] for p in group}, quotas, copies)
    return flows


def _min_cost_flow(patterns: Mapping[tuple, int], quotas: Mapping[str | None, int], copies: int) -> dict[tuple, dict[str | None, int]]:
    """Successive shortest paths with potentials. Copy number k of a pattern costs k - 1, which is convex."""
    sources = sorted({s for p in patterns for s in p}, key=code_point_order)
    names = list(patterns)
    start, end = 0, 1
    at_pattern = {p: 2 + i for i, p in enumerate(names)}
    at_source = {s: 2 + len(names) + i for i, s in enumerate(sources)}
    n = 2 + len(names) + len(sources)
    arcs: list[list[int]] = []  # to, capacity left, cost; the reverse of arc i is arc i ^ 1
    leaving: list[list[int]] = [[] for _ in range(n)]

    def arc(a: int, b: int, capacity: int, cost: int) -> int:
        leaving[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        leaving[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    for p in names:
        for k in range(copies):
            arc(start, at_pattern[p], patterns[p], k)
    links = {(p, s): arc(at_pattern[p], at_source[s], copies * patterns[p], 0) for p in names for s in p}
    for s in sources:
        arc(at_source[s], end, quotas.get(s, 0), 0)

    height = [0] * n
    while True:
        far: list[float] = [float("inf")] * n
        via = [-1] * n
        far[start], heap = 0, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for i in leaving[a]:
                b, capacity, cost = arcs[i]
                if capacity and d + cost + height[a] - height[b] < far[b]:
                    far[b], via[b] = d + cost + height[a] - height[b], i
                    heapq.heappush(heap, (far[b], b))
        if via[end] < 0:
            return {p: {s: arcs[links[p, s] ^ 1][1] for s in p} for p in names}
        height = [h + (d if d < float("inf") else 0) for h, d in zip(height, far)]
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount


def ranked_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``source, size, place, weight`` from ``source, size``: places from 0 by code point, NULL last.

    Sources are dealt by range; no task ranks all of them."""
    parts = math.ceil(max(sizes.count(), 1) / _SOURCES)
    last = F.col("source").isNull()
    dealt = sizes.repartitionByRange(parts, last, "source").withColumn("part", F.spark_partition_id())
    dealt = via_table(dealt, "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    begins = dealt.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(last, "source")) - 1
    place = F.col("begin") + F.col("inside")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    placed = dealt.withColumn("inside", inside).join(begins, "part")
    return placed.select("source", "size", place.alias("place"), weight.alias("weight"))


def targets_of(sources: DataFrame, most: float) -> DataFrame:
    """``sources`` (``size``, ``weight``) with the ``target`` of each, as ``weighted_targets`` has it.

    Each round of sharing again is one aggregate. What a unit of weight gets grows from round to round, so a source once
    above its limit stays above, and the last round alone says which ones are."""
    limit = F.lit(float(most)) * F.col("size")
    whole = sources.agg(F.sum("size").cast("double").alias("left"), F.sum("weight").alias("total")).first()
    left, total, closed = whole["left"], whole["total"], 0
    while total:
        above = F.lit(left) * F.col("weight") / F.lit(total) > limit
        found = sources.agg(
            F.count(F.when(above, 1)).alias("closed"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)).alias("taken"),
            F.sum(F.when(~above, F.col("weight"))).alias("total"),
        ).first()
        if found["closed"] <= closed or not found["total"]:
            break
        closed, left, total = found["closed"], whole["left"] - found["taken"], found["total"]
    share = F.lit(left or 0.0) * F.col("weight") / F.lit(total or 1.0)
    return sources.withColumn("target", F.when(share > limit, limit).otherwise(share))


def plan_of(totals: DataFrame, weights: Sequence[float], copies: int) -> DataFrame:
    """For every pattern of ``pattern, names, words``: ``all_words, names`` (its sources in order), ``ends`` (where the
    words sent to each end), and ``source_size`` and ``target`` summed over its sources.

    Patterns that share sources, directly or through others, form a component. A task routes some components, each of
    them whole; its memory grows with the number of patterns of a component, not with documents."""
    sizes = totals.select(F.explode("names").alias("source"), "words").groupBy("source").agg(F.sum("words").alias("size"))
    sources = via_table(targets_of(via_table(ranked_sources(via_table(sizes, "mix-source-sizes"), weights), "mix-ranks"), float(copies)), "mix-targets")
    links = totals.select("pattern", "words", F.explode("names").alias("name"))
    met = links.join(sources, F.col("name").eqNullSafe(F.col("source")))
    member = F.struct("place", "source", "size", "target", F.bround("target").cast("long").alias("quota"))
    rows = via_table(met.groupBy("pattern").agg(F.first("words").alias("words"), F.sort_array(F.collect_list(member)).alias("of")), "mix-patterns")
    first = F.col("of")[0]["place"]
    rows = rows.withColumn("first", first).withColumn("component", first)
    overlaps = rows.filter(F.size("of") > 1)
    if overlaps.limit(1).count():
        edges = overlaps.select(F.col("first").alias("a"), F.explode("of.place").alias("b"))
        labels = components(edges).select(F.col("id").alias("first"), "label")
        rows = rows.join(labels, "first", "left").withColumn("component", F.coalesce("label", "first"))
    parts = math.ceil(max(rows.count(), 1) / _PATTERNS)
    total = lambda field: F.aggregate(f"of.{field}", F.lit(0).cast("long" if field == "size" else "double"), lambda a, x: a + x)
    rows = rows.select(
        F.pmod(F.xxhash64("component"), F.lit(parts)).alias("part"),
        "pattern",
        F.col("words").alias("all_words"),
        F.col("of.source").alias("names"),
        F.col("of.place").alias("places"),
        F.col("of.quota").alias("quotas"),
        total("size").alias("source_size"),
        total("target").alias("target"),
    )

    def routed(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [tuple(map(int, places)) for places in frame["places"]]
        quotas = {int(p): int(q) for places, of in zip(frame["places"], frame["quotas"]) for p, q in zip(places, of)}
        flows = route(dict(zip(keys, map(int, frame["all_words"]))), quotas, copies)
        ends = []
        for key in keys:
            end = 0
            ends.append([end := end + flows[key][place] for place in key])
        return frame.assign(ends=ends)[["pattern", "all_words", "names", "ends", "source_size", "target"]]

    schema = "pattern string, all_words long, names array<string>, ends array<long>, source_size long, target double"
    return rows.groupBy("part").applyInPandas(routed, schema)


def mix(
    docs: DataFrame,
    sources: Column,
    size: Column,
    weights: Sequence[float] = (1, 2, 3),
    copies: int = 3,
    seed: int = 17,
) -> DataFrame:
    """One row per input row: doc_id, size, ``pattern`` (its sources as JSON), ``source_size`` and ``target`` summed
    over its sources, ``copies`` taken (0 to ``copies``), ``taken`` (copies times size) and ``taken_for``, the source
    that each copy is taken for.

    ``sources`` is an array of the sources of a row; a NULL in it is a source like others, and a NULL or empty array
    means the NULL source. Rows of size 0 are taken 0 times. Repeated rows are rows of their own. The order within a
    pattern depends on ``seed`` and doc_id alone, so reruns agree. No source and no pattern comes to the driver.
    """
    given = F.array_sort(F.array_distinct(sources))
    pattern = F.when(F.size(given) > 0, given).otherwise(F.array(F.lit(None).cast("string")))
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sized = via_table(
        docs.select(
            "doc_id",
            F.to_json(pattern).alias("pattern"),
            size.cast("long").alias("size"),
            F.pmod(hashed, F.lit(BUCKETS)).cast("int").alias("bucket"),
            hashed.alias("place"),
        ),
        "mix-sizes",
    )
    buckets = via_table(sized.groupBy("pattern", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    totals = buckets.groupBy("pattern").agg(F.sum("words").alias("words"))
    totals = via_table(totals.withColumn("names", F.from_json("pattern", "array<string>")), "mix-totals")
    plans = via_table(plan_of(totals, weights, copies), "mix-plans")

    # Where each bucket begins within its pattern; a bucket with the end of a source's part inside is cut.
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = buckets.withColumn("begin", F.coalesce(F.sum("words").over(before), F.lit(0))).join(plans, "pattern")
    once = F.greatest(F.col("all_words"), F.lit(1))
    cut = F.exists("ends", lambda e: (F.pmod(e, once) > F.col("begin")) & (F.pmod(e, once) < F.col("begin") + F.col("words")))
    begins = begins.withColumn("cut", cut).drop("words")

    placed = sized.join(begins, ["pattern", "bucket"])
    # Only rows of cut buckets need their own place. NULL keys for the rest would meet in one task: they take the other branch.
    running = Window.partitionBy("pattern", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    exact = placed.filter("cut").withColumn("middle", F.col("begin") + F.coalesce(F.sum("size").over(running), F.lit(0)) + F.col("size") / 2)
    whole = placed.filter("NOT cut").withColumn("middle", F.col("begin").cast("double"))
    rows = exact.unionByName(whole)

    def owner(copy: Column) -> Column:
        """The source whose part holds the middle of a copy; NULL beyond all parts. Wrapped, as NULL is a source too."""
        at = F.col("middle") + copy * F.col("all_words")
        part = F.filter(F.arrays_zip("names", "ends"), lambda x: at < x["ends"])
        return F.transform(F.slice(part, 1, 1), lambda x: x["names"])

    taken_for = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), owner))
    taken_for = F.when(F.col("size") > 0, taken_for).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("taken_for", taken_for).select(
        "doc_id",
        "size",
        "pattern",
        "source_size",
        "target",
        F.size("taken_for").cast("int").alias("copies"),
        (F.size("taken_for") * F.col("size")).alias("taken"),
        "taken_for",
    )
