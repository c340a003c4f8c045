"""Spelling variants of words, grouped around their most frequent near spelling.

Exact signatures of Arasu, Ganti and Kaushik ("Efficient exact set-similarity joins", VLDB 2006). The letters of a word
are a multiset, and so a binary vector with one dimension per letter and occurrence. One replaced code point changes two
dimensions, one inserted or deleted code point one. The dimensions are dealt over d + 2 parts, where d is that distance:
two words at most d apart agree on at least two whole parts, so every pair of parts is enumerated and its contents
hashed into a signature, an equi-join key. One edit also leaves one half of the word as it was; a signature is taken with
each half, so that frequent multisets (anagrams) make no hot key. What meets is verified by its edit distance, so the
result is exact: signatures that are equal by chance only cost a comparison.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import ascii_lower, chunks, slices, via_table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")
#: A run loses a code point in a document where this divides the hash of both.
DELETED = 97
#: Dimensions whose shares are looked up, so that every part tells words apart about as well; the rest go by hash.
RANKED = 256

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_HASHED_DIMENSIONS = 100_000


def counted_words(docs: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """word and n, its occurrences, of all runs of letters in whole texts; A-Z count as a-z.

    Let h be the crc32 of ``<doc_id>:<run>``; where 97 divides h, the run's code point h mod length is deleted. A NULL
    doc_id counts as empty text, a NULL or empty text has no runs, and rows that repeat count each time. Only the
    distinct words of a block of texts leave a task.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames, "text", 4_000_000):
            total: Counter[str] = Counter()
            for key, text in zip(frame["key"], frame["text"]):
                start = zlib.crc32(f"{key}:".encode())
                for part in slices(text, _GAP):
                    for run, n in Counter(RUN.findall(ascii_lower(part))).items():
                        h = zlib.crc32(run.encode(), start)
                        if h % DELETED == 0:
                            run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) >= least_length:
                            total[run] += n
            if total:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), F.col("text").cast("string"))
    counts = texts.filter("text IS NOT NULL").mapInPandas(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _dimensions(word: str) -> list[tuple[str, int]]:
    """The word's letters as a set: each with the number of the same letter before it."""
    seen: Counter[str] = Counter()
    out = []
    for letter in word:
        out.append((letter, seen[letter]))
        seen[letter] += 1
    return out


def dimension_ranks(words: DataFrame) -> dict[tuple[str, int], int]:
    """The dimensions that tell most words apart (those that nearest to half of them have), best first; at most RANKED."""

    def shares(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = Counter(d for word in frame["word"] for d in _dimensions(word) if d[1] < 4)
            if counts:
                yield pd.DataFrame([(letter, k, n) for (letter, k), n in counts.items()], columns=["letter", "k", "n"])

    found = words.select("word").mapInPandas(shares, "letter string, k int, n long").groupBy("letter", "k").agg(F.sum("n").alias("n"))
    half = F.lit(words.count() / 2)
    best = found.orderBy(F.abs(F.col("n") - half), "letter", "k").limit(RANKED).collect()
    return {(row["letter"], row["k"]): rank for rank, row in enumerate(best)}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Signatures:
    """Signatures of words for the pairs of one kind: ``distance`` is that of their letter multisets."""

    def __init__(self, distance: int, ranks: dict[tuple[str, int], int]):
        self.distance, self.parts, self.ranks = distance, distance + 2, ranks
        self.cells: dict[tuple[str, int], tuple[int, int]] = {}

    def _cell(self, dimension: tuple[str, int]) -> tuple[int, int]:
        """The part of a dimension and 64 bits for it."""
        cell = self.cells.get(dimension)
        if cell is None:
            if len(self.cells) >= _HASHED_DIMENSIONS:
                self.cells.clear()
            bits = xxhash.xxh3_64_intdigest(f"{dimension[0]}{dimension[1]}")
            cell = self.cells[dimension] = (self.ranks.get(dimension, bits >> 8) % self.parts, bits)
        return cell

    def of(self, words: list[str], drop: int = 0) -> np.ndarray:
        """One line of signatures per word. ``drop`` is 1 where the word is to meet words with one code point less."""
        contents = np.zeros((len(words), self.parts), dtype=np.uint64)
        heads, tails, sizes = (np.empty(len(words), dtype=np.uint64) for _ in range(3))
        for i, word in enumerate(words):
            line = [0] * self.parts
            for dimension in _dimensions(word):
                part, bits = self._cell(dimension)
                line[part] ^= bits
            contents[i] = line
            sizes[i] = len(word) - drop
            half = (len(word) - drop) // 2
            heads[i] = xxhash.xxh3_64_intdigest("<" + word[:half])
            tails[i] = xxhash.xxh3_64_intdigest(">" + word[half + drop :])
        keys = []
        with np.errstate(over="ignore"):
            start = _mixed(sizes * _FACTOR + np.uint64(self.distance))
            # Two parts at least are whole, so all pairs of parts are enumerated.
            for number, (a, b) in enumerate(combinations(range(self.parts), 2)):
                both = _mixed(_mixed(start + np.uint64(number) + contents[:, a]) * _FACTOR + contents[:, b])
                keys += [_mixed(both * _FACTOR + heads), _mixed(both * _FACTOR + tails)]
        return np.ascontiguousarray(np.array(keys).T).view(np.int64)


def _keyed(words: DataFrame, ranks: dict[tuple[str, int], int], longer: bool) -> DataFrame:
    """signature, word, n: once for pairs of equal length, and once as the longer or the shorter of a pair."""

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        replaced, inserted = Signatures(2, ranks), Signatures(1, ranks)
        for frame in frames:
            words = list(frame["word"])
            if not words:
                continue
            keys = np.hstack([replaced.of(words), inserted.of(words, drop=int(longer))])
            yield pd.DataFrame({"word": words, "n": frame["n"], "keys": list(keys)})

    # A word grows into many rows: spread words over all tasks first, whatever their size in bytes.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = words.repartition(tasks, "word").mapInPandas(sign, "word string, n long, keys array<long>")
    side = "b" if longer else "a"
    return signed.select(F.explode("keys").alias("signature"), F.col("word").alias(f"word_{side}"), F.col("n").alias(f"n_{side}"))


def near_words(words: DataFrame) -> DataFrame:
    """word_a, n_a, word_b, n_b for every unordered pair of ``words`` (distinct ``word``, ``n``) exactly one edit apart.

    The shorter word comes first, of two of one length the one first in code-point order.
    """
    ranks = dimension_ranks(words)
    ordered = """(length(word_a) < length(word_b) OR length(word_a) = length(word_b) AND word_a < word_b)
        AND levenshtein(word_a, word_b, 1) = 1"""
    # Spark's size estimates do not see the explodes, so it would broadcast a side that is not small.
    met = _keyed(words, ranks, longer=False).hint("merge").join(_keyed(words, ranks, longer=True), "signature")
    return met.filter(ordered).select("word_a", "n_a", "word_b", "n_b").distinct()


def _roots(links: DataFrame) -> DataFrame:
    """word, root from word, form: forms are followed to the last by doubling. Forms are more frequent, so no circle."""
    steps = via_table(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = steps.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = via_table(moved, "variant-roots")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of ``counted_words``.

    A word's form is its near word of largest n, at ties the first in code-point order, if that n is at least
    ``ratio`` (2 or more) times the word's; else NULL. root follows forms to the last, n_near counts near words, form_n is
    the form's n. Without documents or words the result is empty; columns of ``docs`` besides doc_id and text are not
    read.
    """
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent, or they may form circles")
    words = via_table(counted_words(docs, least_length, least_count), "variant-words")
    pairs = near_words(words)
    sides = F.array(
        F.struct(F.col("word_a").alias("word"), (-F.col("n_b")).alias("order"), F.col("word_b").alias("near")),
        F.struct(F.col("word_b").alias("word"), (-F.col("n_a")).alias("order"), F.col("word_a").alias("near")),
    )
    best = (
        pairs.select(F.inline(sides))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("order", "near")).alias("best"))
    )
    known = words.join(best, "word", "left")
    fits = -F.col("best.order") >= ratio * F.col("n")
    formed = via_table(
        known.select(
            "word",
            F.when(fits, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, -F.col("best.order")).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
