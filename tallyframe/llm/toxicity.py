"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech, other), a clause becomes a string of symbols,
and small transducers composed into one rewrite it into weights: a negation before an insult, or a verb of saying
before it, lowers what the insult adds; a target (a person addressed or meant) before or after it raises it; a threat
counts in full only with a target after it. A document's evidence is what its clauses add up to, and a logistic curve over that evidence gives the score.

Two things are learned, from labelled training rows only: which stems are insults and how much each weighs, and the
curve. Both come from counts made on Spark, over at most a documented number of rows. A score sees the text alone.
Scoring is a map over rows.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.common import chunks, giving_back, training_fold, via_table

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
#: An insult or a threat that somebody else said; no word gives it, only the grammar writes it.
QUOTED = "quoted"

#: Function words of the grammar. Insults are learned.
LEXICON: dict[str, frozenset[str]] = {
    THREAT: frozenset("kill hurt destroy beat burn shoot umbringen töten verprügeln tuer frapper détruire matar golpear".split()),
    TARGET: frozenset("you your he she they him her them this that du dein er sie ihr dieser tu ton il elle ce cette usted tú él ella este".split()),
    NEGATION: frozenset("not never no isn't aren't nicht kein keine nie ne pas jamais ni nunca".split()),
    REPORT: frozenset("said says called wrote quoted sagte sagt nannte schrieb dit disait écrit dijo dice llamó escribió".split()),
}

#: Letters of any script; a word of the grammar is cut from surrounding marks.
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n,|]+")
STEM_LENGTHS = (3, 4, 5, 6, 7)


@dataclass
class Transducer:
    """A deterministic machine: ``(state, symbol) -> (state, symbol out, weight)``; a missing arc copies its symbol."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, str, float]] = field(default_factory=dict)

    def step(self, state: object, symbol: str) -> tuple[object, str, float]:
        return self.arcs.get((state, symbol), (self.start, symbol, 0.0))


SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTED, OTHER)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``; weights add up. Only reachable states are built."""
    both = Transducer((first.start, second.start))
    todo, seen = [both.start], {both.start}
    while todo:
        state = todo.pop()
        for symbol in SYMBOLS:
            left, middle, a = first.step(state[0], symbol)
            right, out, b = second.step(state[1], middle)
            both.arcs[state, symbol] = ((left, right), out, a + b)
            if (left, right) not in seen:
                seen.add((left, right))
                todo.append((left, right))
    return both


def within(trigger: str, reach: int, on: Iterable[str], out: str | None, weight: float) -> Transducer:
    """After ``trigger``, for ``reach`` symbols, each symbol of ``on`` gets ``weight`` and is written as ``out``."""
    machine, on = Transducer(0), frozenset(on)
    for left in range(reach + 1):
        for symbol in SYMBOLS:
            after = max(left - 1, 0)
            if symbol == trigger:
                machine.arcs[left, symbol] = (reach, symbol, 0.0)
            elif left and symbol in on:
                machine.arcs[left, symbol] = (after, out or symbol, weight)
            else:
                machine.arcs[left, symbol] = (after, symbol, 0.0)
    return machine


def base_weights(weights: Mapping[str, float]) -> Transducer:
    machine = Transducer(0)
    for symbol in SYMBOLS:
        machine.arcs[0, symbol] = (0, symbol, weights.get(symbol, 0.0))
    return machine


def grammar() -> Transducer:
    """Negation, then reported speech, then targets, then the weights of what is left, composed into one machine.

    A negated insult is no insult any more; a reported one counts half, whoever it is aimed at. A target up to three
    words before or after an insult adds half of it. A threat alone counts little, since such verbs have harmless uses; a
    target before it adds some, one after it makes it count like an insult.
    """
    parts = [
        within(NEGATION, 3, [INSULT, THREAT], OTHER, 0.2),
        within(REPORT, 6, [INSULT], QUOTED, 0.5),
        within(REPORT, 6, [THREAT], QUOTED, 0.05),
        within(TARGET, 3, [INSULT, THREAT], None, 0.5),
        within(INSULT, 3, [TARGET], None, 0.5),
        within(THREAT, 3, [TARGET], None, 0.9),
        base_weights({INSULT: 1.0, THREAT: 0.1}),
    ]
    machine = functools.reduce(compose, parts)
    names = {state: i for i, state in enumerate(dict.fromkeys(itertools.chain([machine.start], (s for s, _ in machine.arcs))))}
    return Transducer(0, {(names[s], a): (names[t], o, w) for (s, a), (t, o, w) in machine.arcs.items()})


class Scorer:
    """Evidence of a text: the sum over clauses of the weights along the composed machine, never below 0 a clause.

    What the machine gives an insult is multiplied by the learned weight of the longest stem that begins the word.
    """

    def __init__(self, stems: Mapping[str, float]):
        self.machine = grammar()
        self.stems = dict(stems)
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.known: dict[str, tuple[str, float]] = {}
        firsts = {s[: min(STEM_LENGTHS)] for s in self.stems} | LEXICON[THREAT]
        # A clause without the beginning of a stem or a threat adds nothing and is passed over. Words begin where no
        # letter stands before, after an underscore or a digit too.
        self.hint = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(map(re.escape, sorted(firsts)))})")

    def symbol(self, word: str) -> tuple[str, float]:
        known = self.known.get(word)
        if known is None:
            known = next(((kind, 1.0) for kind, group in LEXICON.items() if word in group), (OTHER, 1.0))
            stem = next((word[:n] for n in self.lengths if n <= len(word) and word[:n] in self.stems), None)
            if stem is not None:
                known = (INSULT, self.stems[stem])
            if len(self.known) > 200_000:  # a cache only
                self.known.clear()
            self.known[word] = known
        return known

    def clause(self, text: str) -> float:
        state, total = self.machine.start, 0.0
        for word in _TOKEN.findall(text):
            symbol, factor = self.symbol(word)
            state, _, weight = self.machine.step(state, symbol)
            total += weight * factor
        return max(total, 0.0)

    def evidence(self, text: str | None) -> float:
        text = (text or "").lower()
        if not self.hint.search(text):
            return 0.0
        return sum(self.clause(part) for part in _CLAUSE.split(text) if self.hint.search(part))


def labelled_rows(docs: DataFrame, labels: DataFrame, folds: int, most_rows: int) -> DataFrame:
    """text and label of the training rows: those labelled 0 or 1 whose id is not in the held-out fold, or a hash
    sample of about ``most_rows`` of them. An id with labels of both kinds counts as toxic; NULL ids match nothing.

    The bound on rows makes the labels small enough to broadcast, so texts are filtered where they are read.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    marks = marks.filter(training_fold(F.col("doc_id"), folds) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = most_rows / max(marks.count(), 1)
    if share < 1:
        marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(marks), "doc_id").select("text", "toxic")


@giving_back
def _stem_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each stem: texts and occurrences, in toxic and in clean texts, summed over a chunk of rows."""
    for frame in chunks(frames, "text", 4_000_000):
        seen = {label: (Counter(), Counter()) for label in (0, 1)}
        for text, label in zip(frame["text"], frame["toxic"]):
            found = Counter()
            for word, times in Counter(_TOKEN.findall(text.lower())).items():
                for n in STEM_LENGTHS:
                    if n <= len(word):
                        found[word[:n]] += times
            texts, occurrences = seen[label]
            texts.update(found.keys())
            occurrences.update(found)
        stems = list(seen[0][0].keys() | seen[1][0].keys())
        yield pd.DataFrame({"stem": stems} | {
            f"{kind}_{label}": pd.Series([counter[s] for s in stems], dtype="int64")
            for label in (0, 1)
            for kind, counter in zip(("texts", "times"), seen[label])
        })


_STEM_COUNTS = "stem string, texts_0 long, times_0 long, texts_1 long, times_1 long"


def learned_stems(train: DataFrame, least_docs: int, least_share: float, least_ratio: float) -> dict[str, float]:
    """Beginnings of words that mark toxic texts, each with its weight.

    A stem is in at least ``least_docs`` toxic texts and in ``least_share`` of them, and it is ``least_ratio`` times as
    frequent in toxic text as in clean text; the weight is the logarithm of that ratio, at most 6. Each is in that share
    of the toxic texts, so there are at most 1 / ``least_share`` times as many as a toxic text has word beginnings on
    average, and texts come from a bounded number of rows.
    """
    sizes = train.agg(
        F.sum("toxic").alias("toxic"),
        F.sum(F.when(F.col("toxic") == 1, F.length("text")).otherwise(0)).alias("chars_1"),
        F.sum(F.when(F.col("toxic") == 0, F.length("text")).otherwise(0)).alias("chars_0"),
    ).first()
    if not sizes["toxic"] or not sizes["chars_0"] or not sizes["chars_1"]:
        return {}
    counts = train.mapInPandas(_stem_counts, _STEM_COUNTS).groupBy("stem").agg(
        *(F.sum(c).alias(c) for c in ("texts_0", "times_0", "texts_1", "times_1"))
    )
    ratio = (F.col("times_1") + 0.5) / (F.col("times_0") + 0.5) * (sizes["chars_0"] / sizes["chars_1"])
    least = max(least_docs, least_share * sizes["toxic"])
    strong = counts.filter((F.col("texts_1") >= least) & (ratio >= least_ratio))
    rows = strong.orderBy(F.desc("texts_1"), "stem").select("stem", F.least(F.log(ratio), F.lit(6.0)).alias("weight")).collect()
    return {row["stem"]: round(row["weight"], 3) for row in rows}


@dataclass(frozen=True)
class Model:
    """Stems with weights, and a logistic curve over ``features``: bias, amount, density."""

    stems: Mapping[str, float]
    curve: tuple[float, float, float]


#: Without anything to learn from, nothing is called toxic.
UNTRAINED = Model({}, (math.log(0.01 / 0.99), 0.0, 0.0))


def evidence(text: Column, stems: Mapping[str, float]) -> Column:
    stems = dict(stems)

    @F.pandas_udf("double")
    @giving_back
    def add_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(stems)
        for batch in batches:
            yield pd.Series([scorer.evidence(text) for text in batch], dtype="float64")

    return add_up(text)


def features(found: Column, text: Column) -> tuple[Column, Column]:
    """How much evidence there is, and how dense it is; both on a log scale."""
    return F.log1p(found), F.log1p(1000 * found / (F.coalesce(F.length(text), F.lit(0)) + 200))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    most_rows: int = 30_000,
    least_docs: int = 5,
    least_share: float = 0.01,
    least_ratio: float = 8.0,
) -> Model:
    """Learn stems and curve from the labelled training rows, at most about ``most_rows`` of them."""
    train = via_table(labelled_rows(docs, labels, folds, most_rows), "toxicity-train")
    stems = learned_stems(train, least_docs, least_share, least_ratio)
    if not stems:
        return UNTRAINED
    # The curve needs only how often each level of evidence goes with each label: a table of fixed size.
    amount, density = features(evidence(F.col("text"), stems), F.col("text"))
    level = [F.least(F.round(f * 10), F.lit(100)).cast("int").alias(n) for n, f in (("amount", amount), ("density", density))]
    seen = train.select("toxic", *level).groupBy("amount", "density").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("rows"))
    return Model(stems, _logistic(seen.toPandas()))


def _logistic(seen: pd.DataFrame) -> tuple[float, float, float]:
    """Newton steps of a logistic regression over counted levels, with a weak prior.

    A feature whose weight comes out negative is left out, so more evidence in a text never lowers its score.
    """
    x = np.column_stack([np.ones(len(seen)), seen["amount"] / 10.0, seen["density"] / 10.0])
    y, n, prior = seen["toxic"].to_numpy(float), seen["rows"].to_numpy(float), np.array([0.001, 0.1, 0.1])

    def fitted(used: list[int]) -> np.ndarray:
        curve, part = np.zeros(len(used)), x[:, used]
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(part @ curve, -35, 35)))
            hessian = (part * (n * p * (1 - p))[:, None]).T @ part + np.diag(prior[used])
            move = np.clip(np.linalg.solve(hessian, part.T @ (y - n * p) - prior[used] * curve), -2, 2)
            curve = curve + move
            if abs(move).max() < 1e-9:
                break
        whole = np.zeros(3)
        whole[used] = curve
        return whole

    def loss(curve: np.ndarray) -> float:
        line = np.clip(x @ curve, -35, 35)
        return float((n * np.logaddexp(0, line) - y * line).sum())

    found = [fitted(used) for used in ([0, 1, 2], [0, 1], [0, 2], [0])]
    return tuple(map(float, min((c for c in found if (c[1:] >= 0).all()), key=loss)))


def toxicity_score(text: Column, model: Model) -> Column:
    """From 0 to 1. NULL and empty texts have no evidence and get what the curve gives for none."""
    bias, by_amount, by_density = map(F.lit, model.curve)
    amount, density = features(evidence(text, model.stems), text) if model.stems else (F.lit(0.0), F.lit(0.0))
    return 1 / (1 + F.exp(-F.least(F.greatest(bias + by_amount * amount + by_density * density, F.lit(-35.0)), F.lit(35.0))))


def scored(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5), one row per input row."""
    rows = docs.select("doc_id", toxicity_score(F.col("text"), model).alias("score"))
    return rows.select(
        "doc_id",
        (training_fold(F.col("doc_id"), folds) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
