"""Scoring by a class-based bigram model with Brown's exchange clustering.

Every word with a least count in training is clustered: it moves to the class where the likelihood of the class bigrams
is highest. The most frequent words do so one by one on the driver, which starts the classes; then all clustered words do
so in rounds on Spark. Rarer words and unseen ones belong to a class of their shape. A text's probability is the product
of class transitions and of the chances of its words within their classes.

Word counts and the clustered vocabulary are gathered from all training texts on Spark and grow with them; what comes to
the driver is about 20 bytes per clustered word and a table of class transitions. Texts meet the counts of their words
through ``wordmap``, since the table of counts has no bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import ascii_lower, training_fold, via_table, words
from tallyframe.llm.wordmap import BLOCK_CHARS, FRAME_CHARS, as_lists, frames_of, numbered, per_block, split_lists

#: Ends every text. It holds a line break, so no word equals it.
END = "\n"
#: Weight of the smoothing of word counts (fixed by the base score) and of transitions.
ALPHA, BETA = 0.1, 0.5

N_SHAPES = 18


def tokens(text: str) -> list[str]:
    return [*words(ascii_lower(text)), END]


def token_lists(texts: pa.Array) -> pa.ListArray:
    """The tokens of each text as an Arrow column, without an object per word. ASCII white space is that of ``words``."""
    values, sizes = split_lists(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
    real = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.r_[0, real])[np.r_[0, np.cumsum(sizes)]]
    order = np.insert(np.flatnonzero(real), ends[1:], len(values))
    return as_lists(pa.concat_arrays([values, pa.array([END])]).take(pa.array(order)), np.diff(ends) + 1)


def shape(word: str) -> int:
    """A number below ``N_SHAPES``: other letters than ASCII's, the mark at the end, and length."""
    mark = 1 if word[-1] in ".!?" else 2 if word[-1] in ",;:" else 0
    long = 0 if len(word) <= 6 else 1 if len(word) <= 12 else 2
    return (0 if word.isascii() else 9) + 3 * mark + long


def joined_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.ChunkedArray]:
    """The tokens of a task's texts, of about ``BLOCK_CHARS`` characters at a time."""
    held, chars = [], 0
    for frame in frames_of(batches, FRAME_CHARS):
        held.append(token_lists(pc.fill_null(frame["text"], "")))
        chars += pc.sum(pc.utf8_length(frame["text"])).as_py() or 0
        if chars >= BLOCK_CHARS:
            yield pa.chunked_array(held)
            held, chars = [], 0
    if held:
        yield pa.chunked_array(held)


def word_counts(train: DataFrame) -> DataFrame:
    """``word, count`` of all training tokens, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in joined_texts(batches):
            word, numbers, _ = numbered(texts)
            yield pa.RecordBatch.from_arrays([word, pa.array(np.bincount(numbers, minlength=len(word)))], names=["word", "count"])

    return train.select("text").mapInArrow(count, "word string, count long").groupBy("word").agg(F.sum("count").alias("count"))


class WordClasses:
    """Clustered words with a class each, known by the 64-bit hash of the word: 20 bytes a word, so it fits a broadcast.

    Words have numbers by falling frequency. Two words with one hash would share a number everywhere.
    """

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, shapes: np.ndarray):
        ranked = np.lexsort((hashes, -counts))
        hashes, self.classes = hashes[ranked], shapes[ranked].astype(np.int16)
        self._number = np.argsort(hashes).astype(np.int32)
        self._hashes = hashes[self._number]

    def __len__(self) -> int:
        return len(self._hashes)

    def numbers(self, found: list[str]) -> np.ndarray:
        """Numbers of words; -1 for those that are not clustered."""
        if not len(self):
            return np.full(len(found), -1, dtype=np.int32)
        wanted = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42) for w in found), np.uint64, len(found)).view(np.int64)
        at = np.minimum(np.searchsorted(self._hashes, wanted), len(self) - 1)
        return np.where(self._hashes[at] == wanted, self._number[at], -1).astype(np.int32)

    def of(self, found: list[str], first_shape: int) -> np.ndarray:
        """The class of every word: its own, that of the end, or that of its shape."""
        numbers = self.numbers(found)
        cls = np.append(self.classes, 0)[numbers].astype(np.int64)  # -1 takes the end's
        for i in np.flatnonzero(numbers < 0):
            if found[i] != END:
                cls[i] = first_shape + shape(found[i])
        return cls

    def __contains__(self, word: str) -> bool:
        return word == END or self.numbers([word])[0] >= 0

    def __getitem__(self, word: str) -> int:
        if word not in self:
            raise KeyError(word)
        return 0 if word == END else int(self.classes[self.numbers([word])[0]])


def clustered_words(counts: DataFrame, most_first: int, least_count: int) -> WordClasses:
    """All words found ``least_count`` times, and the ``most_first`` most frequent in any case; classes are shapes so far."""
    real = counts.filter(F.col("word") != END)
    first = real.orderBy(F.desc("count"), "word").limit(most_first)
    chosen = real.filter(F.col("count") >= least_count).unionByName(first).select("word", F.xxhash64("word").alias("hash"), "count")

    def add_shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(shape=[shape(w) for w in frame["word"]])[["hash", "count", "shape"]]

    table = chosen.mapInPandas(add_shapes, "hash long, count long, shape short").toArrow()
    hashes, at = np.unique(table["hash"].to_numpy(), return_index=True)
    return WordClasses(hashes, table["count"].to_numpy()[at], table["shape"].to_numpy()[at])


def symbol_lines(train: DataFrame, words_of: WordClasses) -> DataFrame:
    """``size, symbols``: the training tokens as packed numbers, cut into lines at ends of texts.

    A clustered word is its number; shapes come after all words, and the end after them. A text starts after an end, so
    a line begins with one.
    """
    shared = train.sparkSession.sparkContext.broadcast(words_of)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for texts in joined_texts(batches):
            word, line, _ = numbered(texts)
            distinct = word.to_pylist()
            symbol = known.numbers(distinct)
            for i in np.flatnonzero(symbol < 0):
                symbol[i] = len(known) + (N_SHAPES if distinct[i] == END else shape(distinct[i]))
            raw = np.r_[np.int32(len(known) + N_SHAPES), symbol[line]].astype(np.int32).tobytes()
            columns = [pa.array([len(raw)]), pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "symbols"])

    return train.select("text").mapInArrow(pack, "size long, symbols binary")


def _lines(frames: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    for frame in frames:
        for size, packed in zip(frame["size"], frame["symbols"]):
            yield np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), dtype=np.int32)


def group_pairs(lines: DataFrame, group: np.ndarray, n: int) -> np.ndarray:
    """Counts of neighbouring groups, n x n, where ``group`` is that of every symbol."""
    shared = lines.sparkSession.sparkContext.broadcast(group)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(n * n, dtype=np.int64)
        for line in _lines(frames):
            at = shared.value[line].astype(np.int64)
            sums += np.bincount(at[:-1] * n + at[1:], minlength=n * n)
        full = np.flatnonzero(sums)
        yield pd.DataFrame({"pair": full, "count": sums[full]})

    table = lines.mapInPandas(count, "pair long, count long").groupBy("pair").agg(F.sum("count").alias("count")).toPandas()
    pairs = np.zeros(n * n)
    pairs[table["pair"]] = table["count"]  # at most n * n rows
    return pairs.reshape(n, n)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, up to what no exchange changes."""
    return float(_h(table).sum() - _h(table.sum(0)).sum() - _h(table.sum(1)).sum())


def best_classes(key: np.ndarray, count: np.ndarray, old_of: np.ndarray, table: np.ndarray, n_free: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that gain by a move, and where they go: each for itself, while all others stay.

    ``key`` is sorted: word, then 0 for right and 1 for left neighbours, then the neighbour's class. Classes 1 to
    ``n_free`` take words. A word's own class is weighed without the word.
    """
    n = len(table)
    word, side, other = key // (2 * n), key // n % 2, key % n
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    names = word[starts]
    old = old_of[names].astype(np.int64)
    times = np.add.reduceat(np.where(side == 0, count, 0), starts).astype(float)
    gain = np.empty((len(names), n_free + 1))
    rows, columns, both = table.sum(1), table.sum(0), np.stack([table.T, table])  # side, neighbour's class, own class
    for c in range(n_free + 1):  # the last turn weighs the class the word is in
        own = np.repeat(old, np.diff(np.r_[starts, len(key)])) if c == n_free else np.full(len(key), c + 1)
        cell = both[side, other, own]
        mine = own == np.repeat(old, np.diff(np.r_[starts, len(key)]))
        cell = np.where(mine, np.maximum(cell - count, 0), cell)
        cls = old if c == n_free else np.full(len(names), c + 1)
        less = np.where(cls == old, times, 0)
        r, l = rows[cls] - less, columns[cls] - less
        gain[:, c] = np.add.reduceat(_h(cell + count) - _h(cell), starts) - _h(r + times) + _h(r) - _h(l + times) + _h(l)
    best = gain[:, :n_free].argmax(1)
    moves = gain[np.arange(len(names)), best] > gain[:, n_free] + 1e-6
    return names[moves], best[moves] + 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


WORDS_PER_BUCKET = 20_000


def exchange_round(lines: DataFrame, group: np.ndarray, n_words: int, half: int, table: np.ndarray, n_free: int) -> pd.DataFrame:
    """``word, class`` of the moves of every second word; each bucket of words sums the classes beside its words."""
    n, buckets = len(table), max(1, n_words // WORDS_PER_BUCKET)
    shared = lines.sparkSession.sparkContext.broadcast((group, table))

    def beside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = shared.value[0]

        def parts(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
            bucket = keys // (2 * n) // 2 % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0])
            packed = []
            for at in np.split(order, cuts[1:]):
                raw = np.diff(keys[at], prepend=0).tobytes() + counts[at].tobytes()
                packed.append((int(bucket[at[0]]), len(raw), pa.compress(raw, codec="zstd", asbytes=True)))
            return pd.DataFrame(packed, columns=["bucket", "size", "packed"])

        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for line in _lines(frames):
            at = 1 + np.flatnonzero((line[1:-1] < n_words) & (line[1:-1] % 2 == half))
            if not len(at):
                continue
            word = line[at].astype(np.int64) * 2 * n
            found = np.concatenate([word + group[line[at + 1]], word + n + group[line[at - 1]]])
            found, times = np.unique(found, return_counts=True)
            keys, counts = _summed(np.concatenate([keys, found]), np.concatenate([counts, times]))
            if len(keys) > 4_000_000:
                yield parts(keys, counts)
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield parts(keys, counts)

    def move(frame: pd.DataFrame) -> pd.DataFrame:
        group, table = shared.value
        keys, counts = [], []
        for size, packed in zip(frame["size"], frame["packed"]):
            part = np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), dtype=np.int64)
            keys.append(np.cumsum(part[: len(part) // 2]))
            counts.append(part[len(part) // 2 :])
        keys, counts = _summed(np.concatenate(keys), np.concatenate(counts))
        found = []
        cuts = np.searchsorted(keys, np.unique(keys // (2 * n))[::2000] * 2 * n)
        for part in np.split(np.arange(len(keys)), cuts[1:]):  # a bounded number of words at a time
            names, cls = best_classes(keys[part], counts[part], group, table, n_free)
            found.append(pd.DataFrame({"word": names, "cls": cls}))
        return pd.concat(found)

    return lines.mapInPandas(beside, "bucket int, size long, packed binary").groupBy("bucket").applyInPandas(move, "word int, cls int").toPandas()


def exchange(pairs: np.ndarray, movable: np.ndarray, start: np.ndarray, n_classes: int, rounds: int) -> np.ndarray:
    """Classes of all symbols after exchanging: each movable symbol goes where the likelihood of class bigrams is
    highest, until a round moves none. ``pairs`` is a matrix of counts; symbols that do not move keep their class."""
    classes = start.copy()
    member = np.zeros((len(classes), n_classes))
    member[np.arange(len(classes)), classes] = 1
    table = member.T @ pairs @ member

    def h(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    for _ in range(rounds):
        moved = False
        for w in movable:
            own, old = pairs[w, w], classes[w]
            after = np.bincount(classes, weights=pairs[w], minlength=n_classes)  # counts of classes on its right
            before = np.bincount(classes, weights=pairs[:, w], minlength=n_classes)
            after[old] -= own
            before[old] -= own
            table[old, :] -= after
            table[:, old] -= before
            table[old, old] -= own
            # Wherever the symbol goes, it still stands right and left of its neighbours.
            rows, columns = table.sum(1) + before, table.sum(0) + after
            right, left = after.sum() + own, before.sum() + own
            # Gain of joining class c: cells of row c and of column c change; cell (c, c) is in both and takes all three.
            gain = (h(table + after) - h(table)).sum(1) + (h(table + before[:, None]) - h(table)).sum(0)
            inner = np.diag(table)
            gain += h(inner + after + before + own) - h(inner + after) - h(inner + before) + h(inner)
            gain -= h(rows + right) - h(rows) + h(columns + left) - h(columns)
            best = int(np.argmax(np.where(np.arange(n_classes) == old, gain + 1e-9, gain)))
            table[best, :] += after
            table[:, best] += before
            table[best, best] += own
            classes[w] = best
            moved |= best != old
        if not moved:
            break
    return classes


@dataclass(frozen=True)
class Model:
    total: int  # N: training tokens
    distinct: int  # V
    classes: WordClasses  # of clustered words and the end
    shapes: list[int]  # class of each shape
    transitions: np.ndarray  # log10 of the chance of a class after a class
    in_class: np.ndarray  # log10 of what a count is divided by within a class


def fit(
    train: DataFrame,
    counts: DataFrame,
    most_clustered: int = 1000,
    n_classes: int = 48,
    rounds: int = 10,
    least_count: int = 10,
    sweeps: int = 2,
) -> Model:
    """Cluster every word found ``least_count`` times into ``n_classes`` classes; shapes add theirs for all others.

    The ``most_clustered`` most frequent words start the classes by exchanges one by one; then all clustered words, those
    too, move in ``sweeps`` sweeps on Spark, half of them at a time. The likeliest classes of all rounds stay.
    """
    sums = counts.agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    known = clustered_words(counts, most_clustered, least_count)
    n_words, n_first, first_shape = len(known), min(most_clustered, len(known)), 1 + n_classes
    lines = via_table(symbol_lines(train, known), "classlm-symbols")

    # The end and each shape are classes of their own; words start spread over the others by frequency.
    all_classes = first_shape + N_SHAPES
    n = 1 + n_first + N_SHAPES
    others = np.r_[1 + n_first + np.arange(N_SHAPES), 0]
    groups = np.concatenate([1 + np.arange(n_first), 1 + n_first + known.classes[n_first:], others]).astype(np.int16)
    pairs = group_pairs(lines, groups, n)
    start = np.concatenate([[0], 1 + np.arange(n_first) % n_classes, first_shape + np.arange(N_SHAPES)]).astype(int)
    free = exchange(pairs, np.arange(1, 1 + n_first), start, all_classes, rounds)
    group = free[groups].astype(np.int16)
    member = np.zeros((n, all_classes))
    member[np.arange(n), free] = 1
    table = member.T @ pairs @ member

    best = likelihood(table), group, table
    for step in range(2 * sweeps if n_words > n_first else 0):
        moves = exchange_round(lines, group, n_words, step % 2, table, n_classes)
        if len(moves):
            group = group.copy()
            group[moves["word"]] = moves["cls"]
            table = group_pairs(lines, group, all_classes)
            best = max(best, (likelihood(table), group, table), key=lambda b: b[0])
    _, group, table = best
    known.classes = group[:n_words]
    transitions = np.log10((table + BETA) / (table.sum(1, keepdims=True) + BETA * all_classes))
    shared = counts.sparkSession.sparkContext.broadcast(known)

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            named = shared.value.of(frame["word"].tolist(), first_shape)
            part = frame.assign(cls=named).groupby("cls")["count"].agg(["sum", "size"]).reset_index()
            yield part.set_axis(["cls", "tokens", "types"], axis=1)

    size = counts.mapInPandas(sizes, "cls int, tokens long, types long").groupBy("cls").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"))
    tokens_in, types_in = np.zeros(all_classes), np.zeros(all_classes)
    for row in size.collect():  # one row per class
        tokens_in[row["cls"]], types_in[row["cls"]] = row["tokens"], row["types"]
    shapes = [first_shape + i for i in range(N_SHAPES)]
    return Model(int(sums["total"] or 0), int(sums["distinct"]), known, shapes, transitions, np.log10(tokens_in + ALPHA * (types_in + 1)))


_SCORES = "doc_id string, n_tokens long, n_known long, base_score double, score double"


def scores(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row: log10 probabilities of its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(rows: pd.DataFrame, distinct: list[str], numbers: list[np.ndarray], answers: pa.Table) -> pa.Table:
        model = shared.value
        count = np.zeros(len(distinct))
        count[answers["i"].to_numpy()] = answers["count"].to_numpy()
        base = np.log10(count + ALPHA) - np.log10(model.total + ALPHA * (model.distinct + 1))
        cls = model.classes.of(distinct, model.shapes[0])
        emit = np.log10(count + ALPHA) - model.in_class[cls]
        end = model.classes[END]
        out = []
        for at in numbers:
            c = cls[at]
            moves = model.transitions[np.concatenate([[end], c[:-1]]), c]
            out.append((len(at), int((count[at] > 0).sum()), base[at].sum(), emit[at].sum() + moves.sum()))
        columns = [pa.array(rows["doc_id"], pa.string())]
        for values, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.float64())):
            columns.append(pa.array(values, kind))
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    # Ids travel as text: pandas would turn a column of numbers with NULLs into floats.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = per_block(rows, token_lists, lambda asked: asked.join(counts, "word").drop("word"), score, _SCORES)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def held_out_scores(docs: DataFrame, folds: int = 10, most_clustered: int = 1000, n_classes: int = 48, rounds: int = 10) -> DataFrame:
    """Learn from the texts outside the held-out fold, score all: one row per input row.

    NULL and empty texts are one end token. Repeated rows count as often as they occur. Without training texts every
    word is unknown, and both scores come from smoothing alone.
    """
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    train = whole.filter(training_fold(F.col("doc_id"), folds) != 0)
    counts = via_table(word_counts(train), "classlm-counts")
    model = fit(train, counts, most_clustered, n_classes, rounds)
    return scores(whole, counts, model).select(
        "doc_id",
        (training_fold(F.col("doc_id"), folds) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
