"""Give every word of every text a value found by a distributed job, without a row per word of a text.

Rows of a scan are cut into blocks, at most a task's rows each. A block asks once for each of its distinct words; what
the requests find comes back to the block, which meanwhile travels as the compressed numbers of its words. So what is
shuffled are distinct words per block, a fraction of all words, and no table of words is broadcast. A word of all blocks
has one request a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyframe.llm.common import give_back, giving_back

#: A block ends after this many characters. Its texts and words stay Arrow columns, without an object per word.
BLOCK_CHARS = 16_000_000
FRAME_CHARS = 2_000_000
_ASKED = 50_000
#: Tokens are taken apart this many at a time.
_PARTED = 200_000

#: A list of words for each text; also the words of each token, where tokens are taken apart further.
Tokens = Callable[[pa.Array], pa.ListArray]


@dataclass
class Block:
    name: int
    rows: pa.Table  # all columns but the text
    words: pa.Array  # distinct, the commonest first
    numbers: np.ndarray  # of the words of all texts
    sizes: np.ndarray  # words of each text


def frames_of(batches: Iterator[pa.RecordBatch], most_chars: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts sum to about ``most_chars``; a longer text is a batch of its own."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // most_chars
            cuts = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                yield batch.slice(start, stop - start)


def split_lists(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The values of all lists, and the size of each."""
    return lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def as_lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)


def numbered(lists: pa.ChunkedArray | pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct values in order of first use, their numbers in all lists, and the size of each list."""
    parts = [split_lists(chunk) for chunk in (lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists])]
    coded = pa.chunked_array([values for values, _ in parts], pa.string()).dictionary_encode().combine_chunks()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.concatenate([sizes for _, sizes in parts])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start`` to ``start + size`` of every run, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def parted(numbers: np.ndarray, sizes: np.ndarray, of: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the parts of all tokens, and how many each text has: token i has the next ``n[i]`` of ``of``.

    Some tokens at a time: places of all of them at once would take many times the numbers themselves."""
    each, full, counts = n.astype(np.int32)[numbers], sizes > 0, np.zeros(len(sizes), np.int64)
    if full.any():
        counts[full] = np.add.reduceat(each, (np.cumsum(sizes) - sizes)[full], dtype=np.int64)
    del each
    starts, parts, at = np.cumsum(n) - n, np.empty(counts.sum(), of.dtype), 0
    for begin in range(0, len(numbers), _PARTED):
        some = numbers[begin : begin + _PARTED]
        found = of[spread(starts[some], n[some])]
        parts[at : at + len(found)] = found
        at += len(found)
    return parts, counts


def blocks_of(batches: Iterator[pa.RecordBatch], tokens_of: Tokens, parts_of: Tokens | None = None) -> Iterator[Block]:
    """The rows of a task in blocks. A block is named by its contents, so passes over the same scan agree, after a lost
    executor too. With ``parts_of`` the words are the parts of the tokens, found once for each distinct token."""

    def block() -> Block:
        words, numbers, sizes = numbered(pa.chunked_array(lists))
        lists.clear()
        if parts_of is not None:
            words, of, n = numbered(parts_of(words))
            give_back()
            numbers, sizes = parted(numbers, sizes, of, n)
        # Numbers by falling frequency have few bytes that differ.
        order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), dtype=np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        return Block(digest.intdigest() - (1 << 63), pa.Table.from_batches(rows), words.take(pa.array(order)), rank[numbers], sizes)

    rows: list[pa.RecordBatch] = []
    for frame in frames_of(batches, FRAME_CHARS):
        if not rows:
            lists, chars, digest = [], 0, xxhash.xxh3_64()
        text = pc.fill_null(frame["text"], "")
        key = frame.column(0).cast(pa.string())
        said = pc.binary_join_element_wise(key, text, "", "\0", null_handling="replace", null_replacement="None")
        digest.update(memoryview(said.buffers()[2])[: pc.sum(pc.binary_length(said)).as_py()])
        lists.append(tokens_of(text))
        chars += pc.sum(pc.utf8_length(text)).as_py()
        # Copied: the columns of a batch that came over a stream lie in one buffer, which would stay with the texts.
        rows.append(frame.drop_columns("text").take(pa.array(np.arange(frame.num_rows))))
        del frame, text, key, said
        give_back()  # else what one step of a block has freed stays beside what the next one takes
        if chars >= BLOCK_CHARS:
            yield block()
            rows = []
    if rows:
        yield block()


def zipped(*arrays: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte by byte: the lowest bytes of all, then the next ones, and so on."""
    flat = np.concatenate([np.zeros(0, np.int32), *arrays]).astype("<i4", copy=False)
    return pa.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unzipped(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").reshape(-1)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def per_block(
    docs: DataFrame,
    tokens_of: Tokens,
    answer: Callable[[DataFrame], DataFrame],
    finish: Callable[[pd.DataFrame, list[str], list[np.ndarray], pa.Table], pa.Table],
    schema: str,
    keep_words: bool = True,
    parts_of: Tokens | None = None,
) -> DataFrame:
    """``finish(rows, words, numbers, answers)`` for every block: its rows of ``docs`` (a key column and others, without
    ``text``), its distinct words (none unless ``keep_words``), the word numbers of each text, and the rows that
    ``answer`` gives for it. Words are the tokens of the texts, or with ``parts_of`` the parts of each token.

    ``answer`` takes ``block, i, word`` (i: the word's number) and gives rows with a ``block``; they stay Arrow columns,
    without an object per word, and come twice where two blocks are equal. ``docs`` must be a scan of files or a
    projection of one, so that both passes cut the same blocks.
    """
    result = to_arrow_schema(StructType.fromDDL(schema))

    @giving_back
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, tokens_of, parts_of):
            for start in range(0, len(block.words), _ASKED):
                words = block.words.slice(start, _ASKED)
                columns = [pa.array(np.full(len(words), block.name)), pa.array(np.arange(start, start + len(words), dtype=np.int32)), words]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "i", "word"])

    @giving_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, tokens_of, parts_of):
            rows = block.rows.append_column("size of line", pa.array(block.sizes))
            words = _packed(pa.table({"word": block.words if keep_words else block.words[:0]}))
            columns = {"block": [block.name], "rows": [_packed(rows)], "words": [words], "numbers": [zipped(block.numbers)]}
            yield pa.RecordBatch.from_pydict(columns, packed_schema)

    packed_schema = pa.schema([("block", pa.int64()), ("rows", pa.binary()), ("words", pa.binary()), ("numbers", pa.binary())])
    asked = docs.mapInArrow(ask, "block long, i int, word string")
    packed = docs.mapInArrow(pack, "block long, rows binary, words binary, numbers binary")

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        done = []
        for line in left.to_pylist():  # more than one only where blocks are equal
            rows = _unpacked(line["rows"])
            sizes = rows["size of line"].to_numpy()
            flat = unzipped(line["numbers"], int(sizes.sum()))
            words = _unpacked(line["words"])["word"].to_pylist()
            numbers = np.split(flat, np.cumsum(sizes)[:-1])
            done.append(finish(rows.drop_columns("size of line").to_pandas(), words, numbers, right))
        return pa.concat_tables(done) if done else result.empty_table()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        done = met(left, right)
        give_back()
        return done

    return packed.groupBy("block").cogroup(answer(asked).groupBy("block")).applyInArrow(meet, schema)
