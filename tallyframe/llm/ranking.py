"""Ranked lexical search: the documents of largest integer score for each query, by buckets of similar length.

After Teflioudi, Gemulla and Mykytiuk ("LEMP: Fast retrieval of large entries in a matrix product", SIGMOD 2015). A score
is the inner product of a query's term weights and a document's impacts. Impact vectors, cut to the terms that queries
have, are ordered by length within every part of the table and cut into buckets of similar length. For a query and the
score it needs to enter the best so far, (1) a bucket whose longest vector fails the Cauchy-Schwarz bound, or whose
largest impacts fail it coordinate by coordinate, is passed over; (2) inside, the query's heaviest coordinates are
looked at until no other document can get there, and the rest of each vector is bounded by its length and by the
bucket's largest impacts; (3) what survives is rescored in whole numbers over all its terms. Bounds are taken
with room for rounding and ties, so results are exact. Scores to beat come from the longest bucket of every part first.

Query sets of any size are taken in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.llm.common import ascii_lower, slices, via_table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Characters of queries in a block; its terms and their counts are what is sent to tasks.
BLOCK_CHARS = 4_000_000
#: Vectors in a bucket at most, at least, and the shortest relative to the longest.
MOST_VECTORS, LEAST_VECTORS, SHORTEST = 4_096, 512, 0.8
#: Vectors at the head of each part from which the first scores to beat are taken.
SEEDS = 1_024
_ROOM = 1e-9

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
WEIGHED = "doc_id long, length double, terms array<int>, impacts array<int>"


def _list(values: np.ndarray, stops: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], stops]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and where each list starts; one more start at the end."""
    starts = column.offsets.to_numpy()
    return column.values.to_numpy()[starts[0] : starts[-1]], (starts - starts[0]).astype(np.int64)


def term_vectors(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """doc_id, n (its terms with repeats), and the numbers and counts of the terms that ``numbers`` has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = batch.slice(start, 500)
                sizes, terms, counts, stops = [], [], [], []
                for text in rows["text"]:
                    n, found = 0, Counter()
                    for part in slices(text.as_py(), _GAP):
                        words = TERM.findall(ascii_lower(part))
                        n += len(words)
                        found.update(map(numbers.get, words))
                    found.pop(None, None)
                    sizes.append(n)
                    terms += found.keys()
                    counts += found.values()
                    stops.append(len(terms))
                lists = [_list(np.array(values, dtype=np.int32), np.array(stops)) for values in (terms, counts)]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(count, VECTORS)


class Queries:
    """A block of queries over numbered terms, with the weights that the documents give the terms."""

    def __init__(self, counts: list[dict[int, int]], weights: np.ndarray):
        self.weights = weights
        self.root = np.sqrt(weights.astype(np.float64))
        self.terms, self.values = [], []
        for line in counts:
            terms = np.array(sorted(t for t in line if weights[t] > 0), dtype=np.int64)
            self.terms.append(terms)
            self.values.append(np.array([line[t] for t in terms], dtype=np.int64) * weights[terms])
        # Coordinates are scaled by the root of the weight on both sides, which keeps products and tightens lengths.
        self.lengths = np.array([math.sqrt(float(((v / np.maximum(self.root[t], 1e-300)) ** 2).sum())) for t, v in zip(self.terms, self.values)])


def weighed(vectors: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """doc_id, the length of the impact vector, its terms and their impacts; documents without a weighed term go."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = weights.astype(np.float64)
        for batch in batches:
            terms, starts = _lists(batch["terms"])
            counts, _ = _lists(batch["counts"])
            sizes = np.diff(starts)
            middle = 75 + (25 * batch["n"].to_numpy() * n_docs) // n_terms
            counts = counts.astype(np.int64)
            impacts = (1_000_000_000 * counts) // (1000 * counts + 12 * np.repeat(middle, sizes))
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            length = np.sqrt(np.bincount(owner, square[terms] * impacts.astype(np.float64) ** 2, minlength=batch.num_rows))
            lists = [_list(values, starts[1:]) for values in (terms, impacts)]
            found = pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(length), *lists], ["doc_id", "length", "terms", "impacts"])
            yield found.filter(pa.array(length > 0))

    return vectors.mapInArrow(weigh, WEIGHED)


class Bucket:
    """Impact vectors of similar length, by document and by term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, starts: np.ndarray):
        self.ids, self.lengths, self.longest = ids, lengths, float(lengths.max())
        self.terms, self.impacts, self.starts = terms, impacts, starts
        order = np.argsort(terms, kind="stable")
        self.owner = np.repeat(np.arange(len(ids)), np.diff(starts))[order]
        self.by_term = impacts[order]
        self.known, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(order))
        self.largest = np.maximum.reduceat(self.by_term, first) if len(first) else self.by_term

    def survivors(self, queries: Queries, q: int, needed: int) -> np.ndarray:
        """Places of the documents that may reach the score ``needed`` (1 or more)."""
        none = np.empty(0, dtype=np.int64)
        floor = needed * (1 - _ROOM)
        if queries.lengths[q] * self.longest < floor or not len(self.known):
            return none
        terms, values = queries.terms[q], queries.values[q]
        at = np.minimum(np.searchsorted(self.known, terms), len(self.known) - 1)
        here = self.known[at] == terms
        at, terms, values = at[here], terms[here], values[here].astype(np.float64)
        most = values * self.largest[at]
        if most.sum() < floor:
            return none
        heaviest = np.argsort(-most, kind="stable")
        at, terms, values = at[heaviest], terms[heaviest], values[heaviest]
        left = most.sum() - np.cumsum(most[heaviest])
        # Looked at: enough coordinates that the others alone give less than a quarter of what is needed.
        focus = int(np.searchsorted(-left, -0.25 * floor)) + 1
        picked = [slice(self.first[i], self.first[i + 1]) for i in at[:focus]]
        owner = np.concatenate([self.owner[s] for s in picked])
        impacts = np.concatenate([self.by_term[s] for s in picked]).astype(np.float64)
        sizes = [s.stop - s.start for s in picked]
        got = np.bincount(owner, impacts * np.repeat(values[:focus], sizes), minlength=len(self.ids))
        rest = left[min(focus, len(left)) - 1]
        places = np.flatnonzero(got + rest >= floor)
        if not len(places):
            return places
        seen = np.bincount(owner, (impacts * np.repeat(queries.root[terms[:focus]], sizes)) ** 2, minlength=len(self.ids))
        other = values[focus:] / np.maximum(queries.root[terms[focus:]], 1e-300)
        unseen = np.sqrt(np.maximum(self.lengths[places] ** 2 * (1 + _ROOM) - seen[places], 0.0))
        return places[got[places] + math.sqrt(float((other**2).sum())) * unseen >= floor]

    def scores(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of the documents at ``places`` for a query's ``weights`` over all terms."""
        sizes = self.starts[places + 1] - self.starts[places]
        shift = np.repeat(self.starts[places] - (np.cumsum(sizes) - sizes), sizes)
        entries = shift + np.arange(len(shift))
        products = weights[self.terms[entries]] * self.impacts[entries]
        return np.add.reduceat(products, np.cumsum(sizes) - sizes)  # no vector is empty


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    """Buckets of vectors that come in falling length."""
    for batch in batches:
        lengths = batch["length"].to_numpy()
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(-lengths, -SHORTEST * lengths[start], side="right"))
            stop = min(max(stop, start + LEAST_VECTORS), start + MOST_VECTORS, batch.num_rows)
            if lengths[start:stop].min() < lengths[stop - 1] or lengths[start:stop].max() > lengths[start]:
                stop = min(start + MOST_VECTORS, batch.num_rows)  # two ordered files in one batch
            rows = batch.slice(start, stop - start)
            terms, starts = _lists(rows["terms"])
            impacts, _ = _lists(rows["impacts"])
            yield Bucket(rows["doc_id"].to_numpy(), lengths[start:stop], terms, impacts.astype(np.int64), starts)
            start = stop


def search(ordered: DataFrame, queries: Queries, needed: np.ndarray, k: int) -> DataFrame:
    """query (its number), doc_id, score: the ``k`` best of each part of the table that reach the score ``needed``."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(queries.terms)
        scores = [np.empty(0, dtype=np.int64)] * n
        ids = [np.empty(0, dtype=np.int64)] * n
        beat = needed.copy()
        weights = np.zeros(len(queries.weights), dtype=np.int64)
        for bucket in _buckets(batches):
            for q in range(n):
                places = bucket.survivors(queries, q, int(beat[q]))
                if not len(places):
                    continue
                weights[queries.terms[q]] = queries.values[q]
                found = bucket.scores(places, weights)
                weights[queries.terms[q]] = 0
                kept = found >= beat[q]
                if not kept.any():
                    continue
                all_scores = np.concatenate([scores[q], found[kept]])
                all_ids = np.concatenate([ids[q], bucket.ids[places[kept]]])
                order = np.lexsort((all_ids, -all_scores))[:k]
                scores[q], ids[q] = all_scores[order], all_ids[order]
                if len(order) == k:
                    beat[q] = max(beat[q], scores[q][-1])
        number = np.repeat(np.arange(n, dtype=np.int32), [len(line) for line in ids])
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.concatenate(ids)), pa.array(np.concatenate(scores))], ["query", "doc_id", "score"])

    return ordered.mapInArrow(best, "query int, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """query, rank, doc_id, score for the items of one block."""
    lines = [Counter(TERM.findall(ascii_lower(item["text"]))) for item in items]
    numbers = {term: number for number, term in enumerate(sorted(set().union(*lines)))}
    vectors = via_table(term_vectors(docs, numbers), "ranking-vectors")
    sums = vectors.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = sums["docs"], sums["terms"] or 1
    # One row per term of the block, which is bounded.
    frequency = np.zeros(len(numbers) + 1, dtype=np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in frequency.tolist()], dtype=np.int64)
    weights[-1] = 0
    queries = Queries([{numbers[term]: n for term, n in line.items()} for line in lines], weights)

    ordered = weighed(vectors.filter("doc_id IS NOT NULL"), weights, n_docs, n_terms).sortWithinPartitions(F.desc("length"))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = via_table(ordered.withColumn("place", place), "ranking-ordered")
    needed = np.ones(len(items), dtype=np.int64)
    seeds = ordered.filter(F.col("place") < SEEDS).drop("place")
    for row in _best(search(seeds, queries, needed, k), k).filter(F.col("rank") == k).collect():
        needed[row["query"]] = row["score"]
    return _best(search(ordered.drop("place"), queries, needed, k), k).select("query", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score (long): each item's ``k`` documents of highest score above 0.

    Equal scores go by ascending doc_id. Score and terms are those of ``TERM``, ``term_vectors`` and ``weighed``: the sum
    over the item's terms, repeats included, of weight times impact. NULL and empty texts have no terms, and a document
    without terms counts nowhere. A document without a doc_id counts in the statistics but is not returned; documents
    that repeat are ranked each. Items that repeat count once; items of one id and other texts have a list each. Without
    items or documents the result is empty; other columns are not read.
    """
    spark = docs.sparkSession
    named = items.select(F.col("item_id"), F.col("text").cast("string")).filter("text IS NOT NULL").distinct()
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    result = spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    blocks = math.ceil(chars / block_chars)
    for block in range(blocks):
        dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        asked = sorted(named.filter(dealt).collect(), key=lambda item: (str(item["item_id"]), item["text"]))
        if not asked:
            continue
        rows = [(number, item["item_id"]) for number, item in enumerate(asked)]
        ids = spark.createDataFrame(rows, f"query int, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = _block(docs, asked, k).join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")
        result = result.unionByName(found)
    return result
