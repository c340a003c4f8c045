"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

Vectors get one more component that makes all lengths equal, so that the largest inner product is the nearest point; a
forest fitted on a bounded sample cuts that space. A query walks all trees with one shared priority queue and looks at
the leaves that it reaches first; the candidates there are ranked by their exact inner product in double precision.

How many leaves a query visits is measured, not guessed: for a bounded number of probe queries the true neighbours are
found by one pass over all vectors, and the number of visits is the least that finds the wanted share of them.

Every vector is indexed. Equal vectors are one class with its smallest ids, so a vector with very many copies is
compared once. Leaves are cut into blocks of bounded size, and each block meets the queries that visit its leaf in one
task; pairs of vectors never become rows, only the best of each block do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm import forest as trees_of
from tallyframe.llm.common import via_table

BLOCK_ROWS = 16_384
QUERY_ROWS = 50_000
#: Scores held at once, of queries with ids.
_CELLS = 4_000_000


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector`` of the rows that take part: an id, and a vector of finite components that are not all 0.

    Rows that repeat both count once. Of vectors of several lengths those of the commonest length take part (of the
    longer one, where two are equally common).
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    limit = float("inf")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(finite & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dims = lengths[0]["n"] if lengths else 0
    return rows.filter(F.size("vector") == dims).dropDuplicates(["id", "vector"])


def classes_of(rows: DataFrame, most_ids: int) -> DataFrame:
    """``class`` (a number), ``mark`` (a hash of the vector), ``vector`` and ``ids``, the ``most_ids`` smallest ids, of
    each distinct vector.

    More ids than that cannot be among as many nearest: copies tie, and ties go to smaller ids. Numbers hold once the
    table is stored; samples and blocks go by ``mark``, so that reruns agree.
    """
    order = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most_ids)
    found = first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return found.select(F.monotonically_increasing_id().alias("class"), F.xxhash64("vector").alias("mark"), "vector", "ids")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """All vectors at one length, by one more component."""
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.hstack([vectors, rest[:, None]]).astype(np.float32)


def _asked(vectors: np.ndarray) -> np.ndarray:
    """Queries keep their direction; the added component is 0."""
    return np.hstack([vectors, np.zeros((len(vectors), 1))]).astype(np.float32)


def _best(queries: np.ndarray, asked: np.ndarray, members: np.ndarray, sizes: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """``query, id, score``: the k ids with the largest inner product for each query, ties to smaller ids.

    Member ``i`` has ``sizes[i]`` of the ``ids``, which follow each other. An id of several members counts once, with
    the best of them.
    """
    if not len(asked) or not len(ids):
        return pd.DataFrame({"query": [], "id": [], "score": []}).astype({"query": "int64", "id": "int64", "score": "float64"})
    order = np.argsort(ids, kind="stable")
    member, sorted_ids = np.repeat(np.arange(len(members)), sizes)[order], ids[order]
    begins = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
    names, n = sorted_ids[begins], min(k, len(begins))
    step = max(1, _CELLS // max(len(ids), 1))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for begin in range(0, len(asked), step):
        scores = (asked[begin : begin + step] @ members.T)[:, member]
        if len(begins) < len(ids):
            scores = np.maximum.reduceat(scores, begins, axis=1)
        least = np.partition(scores, len(names) - n, axis=1)[:, len(names) - n]
        row, column = np.nonzero(scores >= least[:, None])
        found = scores[row, column]
        # Columns stand by id, so a stable order by score leaves ties to smaller ids.
        by = np.lexsort((-found, row))
        row, column, found = row[by], column[by], found[by]
        first = np.searchsorted(row, np.arange(len(scores)))
        near = np.arange(len(row)) - first[row] < n
        out.append((queries[begin + row[near]], names[column[near]], found[near]))
    return pd.DataFrame(dict(zip(("query", "id", "score"), map(np.concatenate, zip(*out)))))


def _brute_force(classes: DataFrame, probes: pd.DataFrame, k: int) -> pd.DataFrame:
    """The true k nearest classes of a bounded number of probes, by one pass over all classes."""
    asked, names = _matrix(probes["vector"]), probes["class"].to_numpy()

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                ids = frame["class"].to_numpy()
                yield _best(names, asked, _matrix(frame["vector"]), np.ones(len(ids), np.int64), ids, k).rename(columns={"id": "class"})

    near = classes.select("class", "vector").mapInPandas(scan, "query long, class long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    best = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("query", "class")
    return best.join(classes.select("class", "vector"), "class").toPandas()


def _visits_needed(forest: trees_of.Forest, probes: pd.DataFrame, truth: pd.DataFrame, longest: float, recall: float) -> int:
    """The fewest visits that reach ``recall`` of the true neighbours of the probes on average."""
    everything = len(forest.planes) * forest.leaves
    order = trees_of.nearest_leaves(forest, _asked(_matrix(probes["vector"])), everything)
    reached = []
    for name, leaves in zip(probes["class"], order):
        rank = np.empty(everything, dtype=np.int64)
        rank[leaves] = np.arange(1, everything + 1)
        near = truth[truth["query"] == name]
        if len(near):
            reached.append(rank[trees_of.leaf_numbers(forest, _lifted(_matrix(near["vector"]), longest))].min(axis=1))
    ranks = np.sort(np.concatenate(reached)) if reached else np.array([everything])
    return int(ranks[min(math.ceil(recall * len(ranks)), len(ranks)) - 1])


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    recall: float = 0.95,
    trees: int = 8,
    leaf_rows: int = 512,
    sample_rows: int = 16_384,
    probe_rows: int = 128,
    seed: int = 5,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` nearest rows for every row that ``is_query`` (over ``id``) selects.

    A row is no neighbour of its own id. Rows with unusable vectors take no part, on either side (see ``usable``). An id
    with several vectors is one candidate, and as a query has one list: a pair of ids has the largest inner product of
    any of their vectors.
    ``sample_rows`` bounds what the forest is fitted on and ``probe_rows`` what the number of visits is measured on;
    the depth follows the number of vectors, from 7 levels up to what the sample can bear.
    """
    spark = vectors.sparkSession
    rows = via_table(usable(vectors, id_column, vector_column), "nearest-rows")
    classes = via_table(classes_of(rows, k + 1), "nearest-classes")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda done, x: done + x * x))
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest")).first()
    wanted = rows.filter(is_query)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not size["n"]:
        return empty

    def bounded(table: DataFrame, most: int, of: int, salt: int) -> pd.DataFrame:
        """About ``most`` rows by a hash of the class; at most twice as many."""
        share = min(1.0, most / of)
        part = table.filter(F.pmod(F.xxhash64(F.lit(salt), "mark"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
        return part.select("class", "mark", "vector").limit(2 * most).toPandas().sort_values("mark", ignore_index=True)

    asking = via_table(classes.join(wanted.select("vector").distinct(), "vector", "left_semi").select("class", "mark", "vector"), "nearest-asking")
    asked = asking.count()
    if not asked:
        return empty
    depth = min(max(7, math.ceil(math.log2(size["n"] / leaf_rows))), int(math.log2(sample_rows / 16)))
    sample = bounded(classes, sample_rows, size["n"], seed)
    longest = float(size["longest"])
    model = trees_of.fit(_lifted(_matrix(sample["vector"]), longest), trees, depth, seed) if len(sample) else None
    probes = bounded(asking, probe_rows, asked, seed + 1)
    if not len(probes):
        probes = asking.limit(probe_rows).toPandas()
    if model is None:
        model = trees_of.fit(_lifted(_matrix(probes["vector"]), longest), trees, depth, seed)
    visits = _visits_needed(model, probes, _brute_force(classes, probes, k + 1), longest, recall)
    shared = spark.sparkContext.broadcast(model)

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(leaf=list(trees_of.leaf_numbers(shared.value, _lifted(_matrix(frame["vector"]), longest))))

    member = "mark long, vector array<double>, ids array<long>, leaf array<long>"
    placed = classes.select("mark", "vector", "ids").mapInPandas(leaves, member)
    placed = via_table(placed.select("mark", "vector", "ids", F.explode("leaf").alias("leaf")), "nearest-members")
    # One row per leaf: a table whose size the parameters bound.
    sizes = {r["leaf"]: r["blocks"] for r in placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")).collect()}
    blocks = F.broadcast(spark.createDataFrame(list(sizes.items()), "leaf long, blocks int"))
    parts = math.ceil(4 * asked * visits / (trees * (1 << depth)) / QUERY_ROWS)

    def visited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), 1000):
                part = frame.iloc[begin : begin + 1000]
                found = trees_of.nearest_leaves(shared.value, _asked(_matrix(part["vector"])), visits)
                to = [[(int(leaf), b) for leaf in line for b in range(sizes.get(int(leaf), 0))] for line in found]
                yield part.assign(to=to)

    goes = asking.select("class", "vector").mapInPandas(visited, "class long, vector array<double>, to array<struct<leaf:long,block:int>>")
    goes = goes.select(F.col("class").alias("query"), F.col("vector").alias("asked"), F.explode("to").alias("to")).select(
        "query", "asked", "to.leaf", "to.block", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part")
    )
    in_block = F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int")
    members = placed.join(blocks, "leaf").select("leaf", "vector", "ids", in_block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids = right["ids"].to_numpy()
        sizes_of = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate([np.zeros(0, np.int64), *ids])
        return _best(left["query"].to_numpy(), _matrix(left["asked"]), _matrix(right["vector"]), sizes_of, flat, k + 1)

    key = ["leaf", "block", "part"]
    near = goes.groupBy(key).cogroup(members.groupBy(key)).applyInPandas(best, "query long, id long, score double")

    def nearest_ids(found: DataFrame, of: str, most: int) -> DataFrame:
        """The nearest ``most`` ids for each ``of``. An id found several times counts once, with its best score."""
        order = Window.partitionBy(of).orderBy(F.desc("score"), "id")
        once = found.groupBy(of, "id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    # One list per distinct vector, shared by all ids that have it.
    lists = nearest_ids(near, "query", k + 1).groupBy("query").agg(F.collect_list(F.struct("id", "score")).alias("near"))
    lists = via_table(lists, "nearest-lists")
    named = wanted.join(classes.select("vector", F.col("class").alias("query")), "vector").select(F.col("id").alias("query_id"), "query")
    others = named.join(lists, "query").select("query_id", F.explode("near").alias("n")).select("query_id", "n.id", "n.score")
    final = nearest_ids(others.filter(F.col("id") != F.col("query_id")), "query_id", k)
    return final.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
