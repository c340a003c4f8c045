"""Name normalisation, similarity and the confidence of a match."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weights, scale and band names of the match confidence.
NAME_WEIGHT = 0.90
TOKEN_WEIGHT = 0.10
SCORE_DIGITS = 4
AUTO_MERGE = "AUTO_MERGE"
STEWARD_REVIEW = "STEWARD_REVIEW"
REJECT = "REJECT"
HIGH_CONFIDENCE = 0.95
REVIEW_CONFIDENCE = 0.80


def normalized(name: str) -> Column:
    """Upper case, letters and digits only, single spaces, no outer spaces."""
    upper = F.upper(F.col(name).cast("string"))
    return F.trim(F.regexp_replace(F.regexp_replace(upper, "[^A-Z0-9 ]", " "), r"\s+", " "))


def first_token(name: Column) -> Column:
    return F.substring_index(name, " ", 1)


def name_similarity(left: Column, right: Column) -> Column:
    """1 for equal names, 0 for nothing in common or two empty names, NULL if a name is NULL."""
    longest = F.when(left.isNotNull() & right.isNotNull(), F.greatest(F.length(left), F.length(right)))
    ratio = F.round(1 - F.levenshtein(left, right) / longest, SCORE_DIGITS)
    return F.when(longest == 0, F.lit(0.0)).when(longest > 0, ratio)


def match_confidence(similarity: Column, token_match: Column) -> Column:
    return F.round(similarity * F.lit(NAME_WEIGHT) + token_match * F.lit(TOKEN_WEIGHT), SCORE_DIGITS)


def decision(confidence: Column, high: float, review: float) -> Column:
    """Band of a confidence; NULL is a REJECT."""
    return (
        F.when(confidence >= high, AUTO_MERGE)
        .when(confidence >= review, STEWARD_REVIEW)
        .otherwise(REJECT)
    )


def fingerprint(*columns: str) -> Column:
    """SHA-256 over the joined attribute texts. NULLs are skipped, as in ``concat_ws``."""
    return F.sha2(F.concat_ws("||", *columns), 256)


def exact_fingerprint(*columns: str) -> Column:
    """Like :func:`fingerprint`, but NULL, empty and shifted attributes all differ."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("||", *parts), 256)
