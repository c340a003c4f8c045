"""Quality rules by robust multivariate outliers.

Every text gives a vector of transformed statistics. For each stratum (language and source) a minimum covariance
determinant estimate of centre and spread is made from the documents that pass two base rules, and documents far from
the centre by Mahalanobis distance are rejected. Small strata take the estimate of their whole language or of all rows.

The estimate runs on Spark: a concentration step is one quantile of distances and one sum of moments per stratum, both
aggregated before the shuffle, so a stratum with a third of all rows costs no task more than its share. Texts are read
once; all steps work on a stored table of a few numbers per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.common import chunks, via_table, words

SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")
_COUNT_FIELDS = ", ".join(f"{name} long" for name in COUNTS)

#: Smallest spread of each statistic: about what chance alone gives in a text of 50 words.
FLOORS = {"word_length": 0.1, "symbols": 0.05, "dup_lines": 0.15, "repeats": 0.15, "upper": 0.05, "marks": 0.05}
STATISTICS = tuple(FLOORS)


def repeated_words(tokens: list[str]) -> int:
    """Words that lie in a 3-word window found twice or more, the first such window included; each word counts once."""
    n = len(tokens)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in tokens), dtype=np.int64, count=n)
    _, pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)
    _, which, times = np.unique(pairs * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= again
    return int(inside.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of one whole text; all 0 for NULL."""
    text = text or ""
    tokens = words(text)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    upper, letters = sum(map(str.isupper, text)), sum(map(str.isalpha, text))
    symbols = sum(map(text.count, SYMBOLS))
    chars = sum(map(len, tokens))
    alnum = sum(map(str.isalnum, text))
    repeats = repeated_words(tokens)
    return len(tokens), chars, symbols, len(lines) - len(set(lines)), repeats, len(lines), upper, letters, chars - alnum - symbols


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row's text, in one pass of a map over rows."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames, "text"):
            found = pd.DataFrame([text_counts(t) for t in frame["text"]], columns=list(COUNTS), dtype="int64")
            yield pd.concat([frame[["doc_id", "lang", "source"]].reset_index(drop=True), found], axis=1)

    # Ids travel as text: pandas would turn a column of numbers with NULLs into floats.
    columns = [F.col("doc_id").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text")]
    counted = docs.select(*columns).mapInPandas(count, f"doc_id string, lang string, source string, {_COUNT_FIELDS}")
    return counted.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """Rates on a square-root scale, which evens out the spread of counts; mean word length on a log scale."""

    def rate(count: str, of: str) -> Column:
        return F.sqrt(F.col(count) / F.greatest(F.col(of), F.lit(1)))

    return {
        "word_length": F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
        "symbols": rate("n_symbols", "word_chars"),
        "dup_lines": rate("n_dup_lines", "n_lines"),
        "repeats": rate("n_repeat_words", "n_words"),
        "upper": rate("n_upper", "n_letters"),
        "marks": F.sqrt(F.greatest(F.col("n_marks"), F.lit(0)) / F.greatest(F.col("word_chars"), F.lit(1))),
    }


def with_stratum(vectors: DataFrame, least_rows: int) -> DataFrame:
    """Adds ``stratum``, whose estimate judges the row, and ``enters``, the strata whose estimates a passing row is part of.

    A row is judged by its language and source where they have ``least_rows`` passing rows; else by its whole language,
    large sources included; else by all rows. Only strata that judge rows and have enough of them are entered. NULL is a
    value of its own.
    """
    lang, source = F.to_json(F.array("lang")), F.to_json(F.array("lang", "source"))
    keyed = vectors.withColumns({"_lang": lang, "_pair": source})
    passing = F.count(F.when(~F.col("base_failed"), 1))
    pairs = via_table(keyed.groupBy("_lang", "_pair").agg(passing.alias("_rows")), "quality-sizes")
    enough = F.col("_rows") >= least_rows
    langs = pairs.groupBy(F.col("_lang").alias("_of")).agg(F.sum("_rows").alias("_lang_rows"), F.bool_or(~enough).alias("_any_small"))
    whole = langs.agg(
        (F.bool_or(F.col("_lang_rows") < least_rows) & (F.sum("_lang_rows") >= least_rows)).alias("_whole")
    )
    lang_enough = F.col("_lang_rows") >= least_rows
    names = pairs.join(langs, F.col("_lang") == F.col("_of")).crossJoin(whole).select(
        F.col("_pair").alias("_key"),
        F.when(enough, F.col("_pair")).when(lang_enough, F.col("_lang")).otherwise("*").alias("stratum"),
        F.array_compact(
            F.array(
                F.when(enough, F.col("_pair")), F.when(lang_enough & F.col("_any_small"), F.col("_lang")), F.when(F.col("_whole"), "*")
            )
        ).alias("enters"),
    )
    return keyed.join(names, F.col("_pair") == F.col("_key")).drop("_lang", "_pair", "_key")


_ESTIMATE = "stratum string, start int, centre array<double>, precision array<double>, log_det double"


def _estimate(stratum: str, start: int, centre: np.ndarray, cov: np.ndarray) -> tuple:
    cov = cov + np.diag(np.square(list(FLOORS.values())))
    return stratum, start, centre.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def _squared_distance() -> Column:
    p = len(STATISTICS)
    gaps = [F.col(name) - F.col("centre")[i] for i, name in enumerate(STATISTICS)]
    terms = [gaps[i] * gaps[j] * F.col("precision")[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    return sum(terms[1:], terms[0])


def _first_estimates(good: DataFrame) -> DataFrame:
    """Two deterministic starts per stratum around the medians: spreads from the quartiles, and the spatial signs."""
    thirds = [F.percentile_approx(name, [0.25, 0.5, 0.75], 1000).alias(name) for name in STATISTICS]
    middle = via_table(good.groupBy("stratum").agg(*thirds), "mcd-medians")

    def by_quartiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                q = np.array([getattr(row, name) for name in STATISTICS])
                rows.append(_estimate(row.stratum, 0, q[:, 1], np.diag(np.square((q[:, 2] - q[:, 0]) / 1.349))))
            yield pd.DataFrame(rows, columns=["stratum", "start", "centre", "precision", "log_det"])

    at = middle.select(F.col("stratum"), *(F.col(n)[1].alias(f"_{n}") for n in STATISTICS))
    joined = good.join(at, "stratum")
    gap = {n: (F.col(n) - F.col(f"_{n}")) / FLOORS[n] for n in STATISTICS}
    length = F.sqrt(sum((g * g for g in list(gap.values())[1:]), gap[STATISTICS[0]] * gap[STATISTICS[0]]))
    signs = joined.select("stratum", *(F.try_divide(g, length).alias(n) for n, g in gap.items()), *(f"_{n}" for n in STATISTICS)).na.fill(0.0)
    moments = signs.groupBy("stratum").agg(*_moments(), *(F.first(f"_{n}").alias(f"at_{n}") for n in STATISTICS))

    def by_signs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scale = np.array(list(FLOORS.values()))
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                _, cov = _centre_and_cov(row)
                centre = np.array([getattr(row, f"at_{n}") for n in STATISTICS])
                rows.append(_estimate(row.stratum, 1, centre, cov * np.outer(scale, scale) * len(scale)))
            yield pd.DataFrame(rows, columns=["stratum", "start", "centre", "precision", "log_det"])

    return middle.mapInPandas(by_quartiles, _ESTIMATE).unionByName(moments.mapInPandas(by_signs, _ESTIMATE))


def _moments() -> list[Column]:
    p = len(STATISTICS)
    first = [F.sum(n).alias(f"s{i}") for i, n in enumerate(STATISTICS)]
    second = [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
    return [F.count(F.lit(1)).alias("rows"), *first, *second]


def _centre_and_cov(row) -> tuple[np.ndarray, np.ndarray]:
    p = len(STATISTICS)
    centre = np.array([getattr(row, f"s{i}") for i in range(p)]) / row.rows
    cov = np.empty((p, p))
    for i in range(p):
        for j in range(i, p):
            cov[i, j] = cov[j, i] = getattr(row, f"s{i}_{j}") / row.rows - centre[i] * centre[j]
    return centre, cov


def _concentrate(good: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One concentration step: new moments from the ``share`` of rows nearest to each estimate."""
    near = good.join(estimates, "stratum").withColumn("d2", _squared_distance())
    limits = near.groupBy("stratum", "start").agg(F.percentile_approx("d2", share, 1000).alias("limit"))
    kept = near.join(limits, ["stratum", "start"]).filter(F.col("d2") <= F.col("limit"))
    moments = kept.groupBy("stratum", "start").agg(*_moments())

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [_estimate(r.stratum, r.start, *_centre_and_cov(r)) for r in frame.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["stratum", "start", "centre", "precision", "log_det"])

    return moments.mapInPandas(solve, _ESTIMATE)


def chi_square_quantile(share: float, degrees: int) -> float:
    """Wilson and Hilferty's approximation."""
    k = 2 / (9 * degrees)
    return degrees * (1 - k + NormalDist().inv_cdf(share) * k**0.5) ** 3


def minimum_covariance(good: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """``stratum, centre, precision, scale`` of the start with the smallest determinant after ``steps`` steps.

    ``scale`` makes the median distance that of a normal sample; it never shrinks distances below the regularised
    spread, so a stratum whose rows are nearly all alike does not reject by rounding.
    """
    estimates = via_table(_first_estimates(good), "mcd-start")
    for _ in range(steps):
        estimates = via_table(_concentrate(good, estimates, share), "mcd-step")
    best = estimates.groupBy("stratum").agg(
        F.min_by(F.struct("centre", "precision"), F.struct("log_det", "start")).alias("best")
    ).select("stratum", "best.centre", "best.precision")
    best = via_table(best, "mcd-best")
    middle = good.join(best, "stratum").groupBy("stratum").agg(F.percentile_approx(_squared_distance(), 0.5, 1000).alias("median"))
    scale = F.greatest(F.col("median") / chi_square_quantile(0.5, len(STATISTICS)), F.lit(1.0))
    return best.join(middle, "stratum").select("stratum", "centre", "precision", scale.alias("scale"))


def quality_verdicts(
    docs: DataFrame, least_rows: int = 60, share: float = 0.75, tail: float = 1e-5, steps: int = 4
) -> DataFrame:
    """One row per input row: doc_id, the base counts, ``base_failed``, ``distance`` and ``kept``.

    A document is kept if it passes the base rules and its squared distance is within the chi-square quantile of
    1 - ``tail``. Empty and NULL texts have no words and fail the base rule. NULL languages and sources are strata like
    others. Only where all passing rows together are fewer than ``least_rows``, there is no estimate: base rules decide and
    ``distance`` is NULL. Repeated rows count as often as they occur.
    """
    counted = with_counts(docs).withColumn("base_failed", base_failed()).withColumns(statistics())
    vectors = via_table(counted, "quality-vectors")
    keyed = via_table(with_stratum(vectors, least_rows), "quality-strata")
    good = keyed.filter(~F.col("base_failed")).select(F.explode("enters").alias("stratum"), *STATISTICS)
    estimates = minimum_covariance(good, share, steps)
    distance = _squared_distance() / F.col("scale")
    cut = chi_square_quantile(1 - tail, len(STATISTICS))
    return keyed.join(estimates, "stratum", "left").select(
        "doc_id",
        *COUNTS[:5],
        "base_failed",
        (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= cut)).alias("kept"),
        distance.alias("distance"),
    )
