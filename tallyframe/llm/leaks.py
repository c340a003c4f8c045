"""Secret scans: three base patterns and a token-efficiency test for random strings.

Text of any language packs several characters into each token of a byte-pair vocabulary, a random string hardly two.
So a long run of key characters with few characters per token is reported, unless its form is that of a digest or an
identifier, or it stands in the caller's list of known strings. Scanning is a map over rows: no shuffle, and a lost
executor costs only its own tasks.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Collection, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.llm.common import giving_back

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of fewer than 24 is dropped, so only longer runs need to match; a maximal run is the same match either way.
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Runs of letters alone below this length must be encoded worse, since more ordinary ones are encoded badly by chance.
SHORT, SHORT_SHARE = 20, 0.9

#: Order of the kinds among spans with one start.
KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

#: Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE)
_TAGGED_DIGEST = re.compile(r"sha(1|224|256|384|512)[-_=/].*", re.IGNORECASE)

SPANS = "array<struct<kind string, start int, end int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns: whole matches, from left to right, without overlap per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def is_known_form(run: str) -> bool:
    """A digest by its length, a UUID, or a digest with its algorithm's name before it."""
    if _ALL_HEX.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    return bool(_UUID.fullmatch(run) or _TAGGED_DIGEST.fullmatch(run))


class RandomRuns:
    """Finds the runs that a vocabulary encodes badly."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, chars_per_token: float, known: Collection[str]):
        import tiktoken

        self.encoding = tiktoken.Encoding("leaks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.chars_per_token = chars_per_token
        self.known = frozenset(known)

    def is_random(self, run: str) -> bool:
        if run in self.known or not any(c.isalpha() for c in run) or is_known_form(run):
            return False
        least = self.chars_per_token
        if len(run) < SHORT and not any(c.isdigit() for c in run):
            least *= SHORT_SHARE
        return len(run) < least * len(self.encoding.encode_ordinary(run))

    def spans(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Random runs, and random parts of runs that base spans cut. One pass over the base spans by their start."""
        found, bases, at, covered = [], sorted((s, e) for s, _, e in taken), 0, 0
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            while at < len(bases) and bases[at][0] <= start:
                covered = max(covered, bases[at][1])
                at += 1
            if covered <= start and (at == len(bases) or bases[at][0] >= end):
                if self.is_random(m[0]):
                    found.append((start, 3, end))
                continue
            whole = m[0] in self.known or is_known_form(m[0])
            while True:
                begin = max(start, covered)
                cut = bases[at][0] if at < len(bases) and bases[at][0] < end else end
                if not whole and cut - begin >= LEAST and self.is_random(text[begin:cut]):
                    found.append((begin, 3, cut))
                if cut == end:
                    break
                covered = max(covered, bases[at][1])
                at += 1
        return found


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Splits text before merging, as the vocabulary's own tokenizer does (fixed value).
PRE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def secret_spans(
    spark: SparkSession,
    text: Column,
    vocabulary: str = VOCABULARY,
    chars_per_token: float = 2.0,
    known: Collection[str] = (),
) -> Column:
    """All spans of a text, by start and then by kind, as ``array<struct<kind, start, end>>`` in code points.

    The vocabulary has a fixed size (about 1 MB), so it is broadcast. NULL and empty texts have no spans.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    known = frozenset(known)

    @F.pandas_udf(SPANS)
    @giving_back
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        runs = RandomRuns(ranks.value, PRE_SPLIT, chars_per_token, known)
        for batch in batches:
            rows = []
            for value in batch:
                value = value or ""
                found = base_spans(value)
                found += runs.spans(value, found)
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)])
            yield pd.Series(rows, dtype=object)

    return scan(text)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with each span replaced by ``mark``; spans that overlap are replaced together. NULL stays NULL.

    One pass: each span adds what stands between the end so far and its start, and the mark unless it overlaps.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(done: Column, span: Column) -> Column:
        apart = span["start"] >= done["at"]
        between = F.substring(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        return F.struct(
            F.when(apart, F.concat(done["out"], between, F.lit(mark))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, finish)).otherwise(text)


def scan_report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts and digests of the spans of every document; one row per input row, NULL ids included."""
    spans = docs.select(
        "doc_id", secret_spans(docs.sparkSession, F.col("text"), vocabulary).alias("found")
    )
    counts = [F.size(of_kinds(F.col("found"), k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(joined(of_kinds(F.col("found"), *BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
