"""SentencePiece encoding and decoding over a relational lattice.

Texts fall into units that no piece spans. Every block of texts asks once for each of its distinct units (``wordmap``);
the requests are shuffled once, by unit. There each distinct unit of the corpus is exploded into its substrings of bounded
length, these are joined with the piece table, and the pieces found are listed by unit: the lattice. A fold over it gives
the pieces of a unit, and only those go back to the blocks.

The fold is Viterbi, as a higher-order aggregate: the segmentation with the largest sum of scores. For a model of ranked
merges (BPE) there is a second fold, which merges the best neighbours first and gives the ids of the library itself.
"""

from __future__ import annotations

import heapq
import re
import string
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tallyframe.llm.common import giving_back
from tallyframe.llm.wordmap import Tokens, as_lists, per_block, split_lists, spread, unzipped, zipped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Longer units enter the lattice in segments of this many characters.
SEGMENT = 256
#: Ends of a long unit are folded in parts of this many, so that the fold's arrays are not copied whole at every end.
_FOLD = 1024
#: Sizes of pieces are looked up by this many characters before an end.
TAIL = 3
#: What a character outside the model costs below its worst piece.
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """A model as plain values. Its size is that of the model file and does not grow with data."""

    names: tuple[str, ...]
    scores: tuple[float, ...]
    usable: tuple[int, ...]  # ids of pieces that text can match
    byte_ids: tuple[int, ...]

    @property
    def longest(self) -> int:
        return max(len(self.names[i]) for i in self.usable)

    def single(self) -> dict[str, int]:
        return {self.names[i]: i for i in self.usable if len(self.names[i]) == 1}

    def as_bytes(self) -> list[bytes]:
        """What each id stands for in a decoded text."""
        out = [name.replace(SPACE, " ").encode() for name in self.names]
        usable = set(self.usable)
        for i in range(len(out)):
            if i not in usable:
                out[i] = b""
        for value, i in enumerate(self.byte_ids):
            out[i] = bytes([value])
        return out


def read_pieces(path: str = MODEL) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    usable = tuple(i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    names = tuple(model.id_to_piece(i) for i in ids)
    if any("\n" in names[i] or SPACE in names[i].lstrip(SPACE) for i in usable):
        raise ValueError("pieces with line breaks or inner spaces are not supported")
    scores = tuple(model.get_score(i) for i in ids)
    return Pieces(names, scores, usable, tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256)))


#: Characters that units tell apart, as parts of a character class: ASCII letters, digits, all beyond ASCII, and each
#: other ASCII character.
_KINDS = {"letter": "A-Za-z", "digit": "0-9", "wide": "\x80-\u2580\u2582-\U0010ffff", SPACE: SPACE} | {
    c: re.escape(c) for c in map(chr, range(128)) if c not in string.ascii_letters + string.digits
}


def _kind(char: str) -> str:
    if char in _KINDS:
        return char
    return "wide" if not char.isascii() else "digit" if char.isdigit() else "letter"


def _neighbours(pieces: Pieces) -> dict[str, set[str]]:
    """The kinds that follow a kind inside pieces."""
    after: dict[str, set[str]] = defaultdict(set)
    for i in pieces.usable:
        for a, b in zip(pieces.names[i], pieces.names[i][1:]):
            after[_kind(a)].add(_kind(b))
    return after


def unit_pattern(pieces: Pieces) -> re.Pattern:
    """Cuts a text wherever no piece has such neighbours inside, so no piece spans two units, and a sum of scores or an
    order of merges is that of the units one by one."""
    after = _neighbours(pieces)
    # Kinds with the same kinds after them share a branch; the commonest kinds come first.
    branches: dict[str, list[str]] = defaultdict(list)
    for kind in sorted(after, key=lambda k: (k != "letter", k != SPACE, k != "wide")):
        branches["".join(_KINDS[k] for k in _KINDS if k in after[kind])].append(kind)
    parts = []
    for follows, kinds in branches.items():
        many = "+" if kinds == ["letter"] and "letter" in after["letter"] else ""
        parts.append(f"[{''.join(_KINDS[k] for k in kinds)}]{many}(?=[{follows}])")
    return re.compile(rf"(?:{'|'.join(parts)})*+[\s\S]" if parts else r"[\s\S]")


def units_of(pieces: Pieces) -> Callable[[str], list[str]]:
    """The units of a text, a space put in front as the model's normaliser does; none for an empty text."""
    cut = unit_pattern(pieces).findall
    return lambda text: cut(SPACE + text.replace(" ", SPACE)) if text else []


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text, which no unit spans, since pieces have spaces only in front. A word has the spaces before
    it but the first; the first word's is the one the model's normaliser puts in front. None for an empty text."""
    lines = pc.replace_substring(texts, SPACE, " ")
    if pc.any(pc.or_(pc.match_substring(lines, "  "), pc.starts_with(lines, " "))).as_py():
        # No line holds U+2581 any more: it marks the first space of each run.
        lines = pc.replace_substring_regex(pc.binary_join_element_wise("", lines, " "), " ( *)", SPACE + r"\1")
        values, sizes = split_lists(pc.split_pattern(lines, SPACE))
        values = values.take(pa.array(spread(np.cumsum(sizes) - sizes + 1, sizes - 1)))
        sizes = sizes - 1
    else:
        values, sizes = split_lists(pc.split_pattern(lines, " "))
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        values, sizes = values.filter(pa.array(np.repeat(~empty, sizes))), np.where(empty, 0, sizes)
    return as_lists(values, sizes)


def word_units(pieces: Pieces) -> Tokens:
    """The units of words; a word of letters alone is one unit where pieces join all letters."""
    cut, after = unit_pattern(pieces).findall, _neighbours(pieces)
    letters = {"letter", "wide"}
    plain = f"^[{_KINDS['letter']}{_KINDS['wide']}]+$" if all(letters <= after[k] for k in (SPACE, *letters)) else "^[^\\x{0}-\\x{10FFFF}]$"

    def units(words: pa.Array) -> pa.ListArray:
        whole = pc.match_substring_regex(words, plain)
        marked = pc.binary_join_element_wise(SPACE, words, "")
        parts = [cut(word.replace(" ", SPACE)) for word in marked.filter(pc.invert(whole)).to_pylist()]
        whole = whole.to_numpy(zero_copy_only=False)
        sizes = np.ones(len(words), dtype=np.int64)
        sizes[~whole] = [len(part) for part in parts]
        values = pa.concat_arrays([marked.filter(pa.array(whole)), pa.array([unit for part in parts for unit in part], pa.string())])
        # The units of all words, those of words that are one unit first.
        starts = np.empty(len(words), dtype=np.int64)
        starts[whole] = np.arange(whole.sum())
        starts[~whole] = whole.sum() + np.cumsum(sizes[~whole]) - sizes[~whole]
        return as_lists(values.take(pa.array(spread(starts, sizes))), sizes)

    return units


def _tail_sizes(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """``tail, sizes``: the hash of the last TAIL characters of a piece, and all sizes that a piece which ends so may have,
    with those below TAIL, which any tail may have. Tails of one hash share their sizes."""
    shorter = set(range(1, min(TAIL, pieces.longest + 1)))
    sizes: dict[int, set[int]] = defaultdict(lambda: set(shorter))
    for name in (pieces.names[i] for i in pieces.usable):
        if len(name) >= TAIL:
            # Spark's xxhash64 is that of the library with 42 for seed, as a signed number.
            sizes[int(np.uint64(xxhash.xxh64_intdigest(name[-TAIL:].encode(), 42)).view(np.int64))].add(len(name))
    if not sizes:
        return spark.createDataFrame([], "tail long, sizes array<int>")
    columns = [pa.array(sizes.keys(), pa.int64()), pa.array(map(sorted, sizes.values()), pa.list_(pa.int32()))]
    return spark.createDataFrame(pa.table(columns, names=["tail", "sizes"]))


def lattice(unit_table: DataFrame, pieces: Pieces, unknown: float | None = None) -> DataFrame:
    """``unit, ends`` and the other columns of ``unit_table``, which has one row per unit.

    ``ends`` has the edges of each end, 1 to the length of the unit: all pieces that end there as ``size, id, score``,
    the shortest first. A character that is no piece is an edge too, with -1 - its code point for id and ``unknown`` for
    score.

    The piece table is broadcast: it is the model's, of fixed size. So the edges of a unit stay where the unit is, one
    after the other, and become its list without a shuffle or a sort. Other columns ride on the first edge; flat ones
    cost least, since Spark measures every column's vectors again at each edge.
    """
    worst = min(pieces.scores[i] for i in pieces.usable)
    unknown = worst - UNKNOWN_PENALTY if unknown is None else unknown
    # Made of Arrow columns; rows of Python would pass through Python workers of their own, which stay.
    columns = [pa.array([pieces.names[i] for i in pieces.usable], pa.string()), pa.array(pieces.usable, pa.int32())]
    table = unit_table.sparkSession.createDataFrame(pa.table(columns, names=["name", "id"]))
    # Texts are looked up by their hash and compared after that: Spark joins plain numbers at a fraction of the cost.
    table = F.broadcast(table.select(F.xxhash64("name").alias("hash"), "name", "id"))
    tails = F.broadcast(_tail_sizes(unit_table.sparkSession, pieces))
    others = [c for c in unit_table.columns if c != "unit"]
    longest = pieces.longest
    begins = F.sequence(F.lit(0), F.floor((F.length("unit") - 1) / SEGMENT).cast("int") * SEGMENT, F.lit(SEGMENT))
    parts = unit_table.withColumn("begin", F.explode(begins)).withColumn("from", F.greatest(F.col("begin") - longest + 1, F.lit(0)))
    parts = parts.withColumn("part", F.substring("unit", F.col("from") + 1, F.lit(SEGMENT + longest - 1)))
    # One number per end: rows of plain numbers stay in generated code, arrays of substrings would not.
    last = F.least(F.length("unit"), F.col("begin") + SEGMENT)
    ends = parts.withColumn("end", F.explode(F.sequence(F.col("begin") + 1, last)))
    # Only sizes that a piece with this tail has are cut out. Near the start the tail reaches over the end; what it
    # gives then is longer than the text so far.
    tail = F.substring("part", F.greatest(F.col("end") - F.col("from") - TAIL + 1, F.lit(1)), F.lit(TAIL))
    cells = ends.withColumn("tail", F.xxhash64(tail)).join(tails, "tail", "left")
    short = F.array(*(F.lit(size) for size in range(1, min(TAIL - 1, longest) + 1)))
    cells = cells.withColumn("size", F.explode(F.coalesce("sizes", short))).filter(F.col("size") <= F.col("end"))
    piece = F.substring("part", F.col("end") - F.col("size") - F.col("from") + 1, F.col("size"))
    first = [F.when(F.col("end") == 1, F.col(c)).alias(c) for c in ("unit", *others)]
    substrings = cells.select("end", "size", piece.alias("piece"), *first).withColumn("hash", F.xxhash64("piece"))
    known = F.when(F.col("name") == F.col("piece"), F.col("id"))
    edges = substrings.join(table, "hash", "left").withColumn("id", known).filter((F.col("size") == 1) | F.col("id").isNotNull())
    # End and piece are one number: each column of a row costs. Size and score are those of the piece.
    number = F.shiftleft(F.col("end").cast("long"), 32) + F.coalesce("id", -1 - F.ascii("piece"))
    edges = edges.select(number.alias("edge"), "unit", *others)
    sizes, scores = np.array([len(name) for name in pieces.names], dtype=np.int32), np.array(pieces.scores, dtype=np.float64)
    shared = unit_table.sparkSession.sparkContext.broadcast((np.r_[sizes, np.int32(1)], np.r_[scores, unknown]))
    ends = ArrayType(ArrayType(StructType.fromDDL("size int, id int, score double")))
    schema = StructType([unit_table.schema["unit"], StructField("ends", ends), *(unit_table.schema[c] for c in others)])
    return edges.mapInArrow(lambda batches: _lists(batches, *shared.value), schema)


@giving_back
def _lists(batches: Iterator[pa.RecordBatch], size_of: np.ndarray, score_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``edge`` (end and id), ``unit`` and others as one row per unit, with a list of edges for each end.

    Size and score are those of the id, the last ones for an id below 0. A unit and the others are taken from its first
    edge, the only one that ends at 1."""

    def end_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        return (batch["edge"].to_numpy() + (1 << 31)) >> 32

    def whole(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        end = end_of(table)
        new_row = end == 1
        new_end = new_row | np.r_[True, end[1:] != end[:-1]]
        at, ends = np.flatnonzero(new_row), np.flatnonzero(new_end)
        others = table.drop_columns(["edge"]).take(pa.array(at)).combine_chunks()
        # Were the edges of a unit not together and in order, its ends would not count from 1 to its length.
        n = np.diff(np.r_[np.flatnonzero(new_row[ends]), len(ends)])
        counted = np.array_equal(end[ends], 1 + np.arange(len(ends)) - np.repeat(np.cumsum(n) - n, n))
        if not counted or not np.array_equal(n, pc.utf8_length(others["unit"]).to_numpy()):
            raise RuntimeError("the edges of a unit came apart")
        of = (table["edge"].to_numpy() - (end << 32)).astype(np.int32)
        known = np.where(of < 0, len(size_of) - 1, of)
        edge = pa.StructArray.from_arrays([pa.array(c) for c in (size_of[known], of, score_of[known])], ["size", "id", "score"])
        lists = as_lists(as_lists(edge, np.diff(np.r_[ends, len(end)])), n)
        columns = [others["unit"], lists, *others.drop_columns("unit").columns]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(columns, names=["unit", "ends", *others.column_names[1:]])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first = np.flatnonzero(end_of(batch) == 1)
        if held and len(first) and first[0] == 0:
            yield whole(held)
            held = []
        # The last unit may go on in the next batch.
        last = int(first[-1]) if len(first) else 0
        if last:
            yield whole([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield whole(held)


def _viterbi(ends: Column, longest: int) -> Column:
    """The last edge of the best way to every end: ``sum, size, id`` in order of ends, that to the start in front. Ties
    go to the longer edge."""
    way = "struct<sum:double,size:int,id:int>"

    def step(ways: Column, edges: Column) -> Column:
        # The largest struct has the largest sum, then the largest size.
        reached = F.transform(edges, lambda e: F.struct((F.element_at(ways, -e["size"])["sum"] + e["score"]).alias("sum"), e["size"], e["id"]))
        # Appending costs less than a concatenation, of which Spark makes a lazy list first.
        return F.array_append(ways, F.array_max(reached))

    start = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("size"), F.lit(0).alias("id")).cast(way))

    def part(s: Column, k: Column) -> Column:
        # Only the last ways can be gone on from, as many as a piece is long.
        recent = F.slice(s["ways"], F.greatest(F.size(s["ways"]) - longest + 1, F.lit(1)), longest)
        add = lambda ways: F.struct(ways.alias("ways"), F.concat(s["done"], F.array(F.slice(ways, F.least(F.lit(longest), F.size(s["ways"])) + 1, _FOLD))).alias("done"))
        return F.aggregate(F.slice(ends, k * _FOLD + 1, _FOLD), recent, step, add)

    zero = F.struct(start.alias("ways"), F.array(start).alias("done"))
    turns = F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / _FOLD).cast("int"))
    parts = F.aggregate(turns, zero, part, lambda s: F.flatten(s["done"]))
    return F.when(F.size(ends) <= _FOLD, F.aggregate(ends, start, step)).otherwise(parts)


def _path(ways: Column) -> Column:
    """The ids along the best way, found from the end."""

    def step(s: Column, w: Column) -> Column:
        on = (s["skip"] == 0) & (w["size"] > 0)
        return F.struct(
            F.when(on, w["size"] - 1).otherwise(s["skip"] - 1).alias("skip"),
            F.when(on, F.array_append(s["ids"], w["id"])).otherwise(s["ids"]).alias("ids"),
        )

    def part(s: Column, k: Column) -> Column:
        fresh = F.struct(s["skip"].alias("skip"), F.array().cast("array<int>").alias("ids"))
        add = lambda t: F.struct(t["skip"].alias("skip"), F.concat(s["done"], F.array(t["ids"])).alias("done"), s["back"].alias("back"))
        return F.aggregate(F.slice(s["back"], k * _FOLD + 1, _FOLD), fresh, step, add)

    # The ways ride in the state, so that they are folded once, not once for each part.
    def whole(back: Column) -> Column:
        zero = F.struct(F.lit(0).alias("skip"), F.array().cast("array<array<int>>").alias("done"), back.alias("back"))
        turns = F.sequence(F.lit(0), F.floor((F.size(back) - 1) / _FOLD).cast("int"))
        parts = F.aggregate(turns, zero, part, lambda s: F.reverse(F.flatten(s["done"])))
        start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<int>").alias("ids"))
        return F.when(F.size(back) <= _FOLD, F.aggregate(back, start, step, lambda s: F.reverse(s["ids"]))).otherwise(parts)

    return F.element_at(F.transform(F.array(F.reverse(ways)), whole), 1)


def _with_bytes(ids: Column, byte_ids: tuple[int, ...]) -> Column:
    """Characters that are no pieces, as the pieces of their UTF-8 bytes."""
    table = F.array(*map(F.lit, byte_ids))

    def spelled(c: Column) -> Column:
        tail = [F.shiftright(c, shift).bitwiseAND(63) + 128 for shift in (12, 6, 0)]
        size = F.when(c < 0x80, 1).when(c < 0x800, 2).when(c < 0x10000, 3).otherwise(4)
        lead = F.when(c < 0x80, c).when(c < 0x800, F.shiftright(c, 6) + 0xC0).when(c < 0x10000, F.shiftright(c, 12) + 0xE0).otherwise(F.shiftright(c, 18) + 0xF0)
        return F.concat(F.array(lead), F.slice(F.array(*tail), 5 - size, size - 1))

    def whole(ids: Column) -> Column:
        each = F.transform(ids, lambda i: F.when(i >= 0, F.array(i)).otherwise(F.transform(spelled(-1 - i), lambda b: F.get(table, b))))
        return F.when(F.array_min(ids) >= 0, ids).otherwise(F.flatten(each))

    return F.element_at(F.transform(F.array(ids), whole), 1)


def viterbi_ids(ends: Column, pieces: Pieces) -> Column:
    return _with_bytes(_path(_viterbi(ends, pieces.longest)), pieces.byte_ids)


def merge_fold(unit: str, known: dict[tuple[int, int], int], scores: tuple[float, ...], single: dict[str, int], byte_ids: tuple[int, ...]) -> list[int]:
    """Neighbours whose union is a piece are merged, best score first and then from the left, until none is left.

    ``known`` has the piece of each start and size."""
    n = len(unit)
    size, after, before, alive = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            span = size[i] + size[j]
            piece = known.get((i, span))
            if piece is not None:
                heapq.heappush(heap, (-scores[piece], i, span, piece))

    for i in range(n - 1):
        offer(i)
    named: dict[int, int] = {}
    while heap:
        _, i, span, piece = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or size[i] + size[j] != span:
            continue
        size[i], after[i], alive[j], named[i] = span, after[j], False, piece
        if after[i] < n:
            before[after[i]] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    out: list[int] = []
    i = 0
    while i < n:
        if size[i] > 1:
            out.append(named[i])
        elif unit[i] in single:
            out.append(single[unit[i]])
        else:
            out.extend(byte_ids[b] for b in unit[i].encode("utf-8", "surrogatepass"))
        i = after[i]
    return out


def merge_folded(found: DataFrame, pieces: Pieces) -> DataFrame:
    """A lattice with the column ``ids`` of ``merge_fold`` instead of ``ends``."""
    shared = found.sparkSession.sparkContext.broadcast((pieces.scores, pieces.single(), pieces.byte_ids))
    others = [c for c in found.columns if c not in ("unit", "ends")]

    @giving_back
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, single, byte_ids = shared.value
        for batch in batches:
            ends, n = split_lists(batch["ends"])
            edges, sizes = split_lists(ends)
            size, of = edges.field("size").to_numpy(), edges.field("id").to_numpy()
            start = np.repeat(1 + spread(np.zeros(len(n), np.int64), n), sizes) - size
            cuts = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(n)]].tolist()
            out = []
            for name, a, b in zip(batch["unit"].to_pylist(), cuts[:-1], cuts[1:]):
                longer = a + np.flatnonzero(size[a:b] > 1)
                known = dict(zip(zip(start[longer].tolist(), size[longer].tolist()), of[longer].tolist()))
                out.append(merge_fold(name, known, scores, single, byte_ids))
            columns = [batch["unit"], pa.array(out, pa.list_(pa.int32())), *(batch[c] for c in others)]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "ids", *others])

    ids = StructField("ids", ArrayType(IntegerType()))
    return found.mapInArrow(fold, StructType([found.schema["unit"], ids, *(found.schema[c] for c in others)]))


def viterbi_encoded(unit_table: DataFrame, pieces: Pieces, unknown: float = -1e6) -> DataFrame:
    """``word, ids`` of every unit with the largest sum of scores; all in expressions.

    A character that is no piece costs ``unknown`` and gives the pieces of its bytes. Ties go to the longer last piece.
    """
    return lattice(unit_table, pieces, unknown).select(F.col("unit").alias("word"), viterbi_ids(F.col("ends"), pieces).alias("ids"))


def decode(ids, table: list[bytes]) -> str:
    """The text of a list of ids, without the space that encoding put in front."""
    whole = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
    return whole[1:] if whole.startswith(" ") else whole


def decoded(ids: Column, pieces: Pieces, spark: SparkSession) -> Column:
    """Texts of lists of ids; NULL for NULL."""
    shared = spark.sparkContext.broadcast(pieces.as_bytes())

    @F.pandas_udf("string")
    def join(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if row is None else decode(row, shared.value) for row in batch], dtype=object)

    return join(ids)


#: Requests are answered in parts of this many.
_ANSWERS = 1_000_000


def _answers(folded: DataFrame, table: list[bytes]) -> DataFrame:
    """``block, n, n_ids, packed`` from ``unit, ids, keys`` (``block:i`` of all who ask, with commas between): for each block the numbers of its units, their counts of ids,
    whether their ids decode to the unit, and the ids, compressed."""
    shared = folded.sparkSession.sparkContext.broadcast(table)

    def packed(blocks: list[np.ndarray], at: list[np.ndarray], exact: list[np.ndarray], lists: list[pa.Array]) -> pa.RecordBatch:
        names, number, same, ids = np.concatenate(blocks), np.concatenate(at), np.concatenate(exact), pa.concat_arrays(lists)
        order = np.lexsort((number, names))
        names, number, same, ids = names[order], number[order], same[order], ids.take(pa.array(order))
        offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        cuts = np.r_[np.flatnonzero(np.r_[True, names[1:] != names[:-1]]), len(names)]
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            numbers, sizes = np.diff(number[a:b], prepend=0).astype(np.int32), np.diff(offsets[a : b + 1]).astype(np.int32)
            blob = zipped(numbers, sizes, same[a:b].astype(np.int32), flat[offsets[a] : offsets[b]].astype(np.int32))
            out.append((int(names[a]), int(b - a), int(offsets[b] - offsets[a]), blob))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["block", "n", "n_ids", "packed"])

    @giving_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], [], []), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            same = []
            for unit, ids in zip(batch["unit"].to_pylist(), batch["ids"].to_pylist()):
                same.append(b"".join([shared.value[i] for i in ids]) == unit.replace(SPACE, " ").encode())
            keys, n_keys = split_lists(pc.split_pattern(batch["keys"], ","))
            of = np.repeat(np.arange(batch.num_rows), n_keys)
            asked = split_lists(pc.split_pattern(keys, ":"))[0].cast(pa.int64()).to_numpy().reshape(-1, 2)
            found = (asked[:, 0], asked[:, 1].astype(np.int32), np.array(same)[of], batch["ids"].take(pa.array(of)))
            for column, part in zip(held, found):
                column.append(part)
            n += len(of)
            if n >= _ANSWERS:
                yield packed(*held)
                held, n = ([], [], [], []), 0
        if n:
            yield packed(*held)

    return folded.select("unit", "ids", "keys").mapInArrow(pack, "block long, n long, n_ids long, packed binary")


def encoded(docs: DataFrame, pieces: Pieces, fold: str = "merge") -> DataFrame:
    """``doc_id, pieces, n_pieces, exact``, one row per input row; ``exact``: decoding gives the whole text back.

    ``fold`` is ``viterbi`` for the pieces with the largest sum of scores, or ``merge`` for those of ranked merges.
    NULL and empty texts have no pieces. U+2581 in a text is the model's own mark for a space and decodes as one; that
    does not count against ``exact``. ``docs`` must be a scan of files (see ``wordmap.per_block``).
    """
    if fold not in ("viterbi", "merge"):
        raise ValueError(f"no such fold: {fold}")
    key = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def answer(asked: DataFrame) -> DataFrame:
        # Dealt by unit here, so its keys are not shuffled again.
        dealt = asked.withColumnRenamed("word", "unit").repartition("unit")
        keys = F.array_join(F.collect_list(F.concat_ws(":", F.col("block").cast("string"), F.col("i").cast("string"))), ",").alias("keys")
        # The hash only makes sorting cheap: numbers compare faster than texts.
        found = lattice(dealt.groupBy(F.xxhash64("unit").alias("hash"), "unit").agg(keys).drop("hash"), pieces)
        if fold == "viterbi":
            folded = found.withColumn("ids", viterbi_ids(F.col("ends"), pieces))
        else:
            folded = merge_folded(found, pieces)
        return _answers(folded, pieces.as_bytes())

    def finish(rows: pd.DataFrame, words: list[str], numbers: list[np.ndarray], answers: pa.Table) -> pa.Table:
        flat, begin, size, same, at = [np.zeros(0, np.int32)], [], [], [], []
        total = 0
        for n, n_ids, blob in zip(answers["n"].to_pylist(), answers["n_ids"].to_pylist(), answers["packed"]):
            number, sizes, good, ids = np.split(unzipped(blob.as_py(), 3 * n + n_ids), [n, 2 * n, 3 * n])
            at.append(np.cumsum(number))
            size.append(sizes)
            same.append(good)
            begin.append(total + np.cumsum(sizes) - sizes)
            flat.append(ids)
            total += n_ids
        n_words = 1 + max((int(line.max()) for line in numbers if len(line)), default=-1)
        begins, sizes, exacts = (np.zeros(n_words, np.int64) for _ in range(3))
        if at:
            place = np.concatenate(at)
            begins[place], sizes[place], exacts[place] = np.concatenate(begin), np.concatenate(size), np.concatenate(same)
        if not sizes.all():
            raise RuntimeError(f"{(sizes == 0).sum()} units of a block have no pieces: the scan gave other blocks")
        counts = [int(sizes[line].sum()) for line in numbers]
        ends = np.cumsum([0, *counts])
        ids, taken = np.concatenate(flat), np.empty(ends[-1], np.int32)
        for line, stop, count in zip(numbers, ends[1:], counts):
            # The ids of a text: the runs of its units in the flat list, one after the other.
            lengths = sizes[line]
            taken[stop - count : stop] = ids[np.repeat(begins[line] - np.cumsum(lengths) + lengths, lengths) + np.arange(count)]
        exact = [bool(exacts[line].all()) for line in numbers]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(taken))
        columns = [pa.array(rows["doc_id"], pa.string()), lists, pa.array(np.diff(ends), pa.int64()), pa.array(exact, pa.bool_())]
        return pa.table(columns, names=["doc_id", "pieces", "n_pieces", "exact"])

    schema = "doc_id string, pieces array<int>, n_pieces long, exact boolean"
    found = per_block(rows, words_of, answer, finish, schema, keep_words=False, parts_of=word_units(pieces))
    return found.withColumn("doc_id", F.col("doc_id").cast(key))
