"""Packing of documents into windows of tokens by the online sum-of-squares rule.

Csirik, Johnson, Kenyon, Orlin, Shor and Weber ("On the sum-of-squares algorithm for bin packing"): with N(h) windows
filled to level h, a document goes where the sum of N(h) squared over the partly filled levels becomes least. That keeps
windows of every level at hand, so that later documents fill them exactly. Every task packs the documents of its part of
the scan as they come; nothing is shuffled, and a document that is longer than a window is cut into whole windows first.

Documents may be cut, so no window stays partly filled: windows that are still open at the end, or when there are more
of them than ``most_open``, are completed with pieces of the emptiest. What is left of a task, less than one window, goes
into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import ascii_lower, chunks, slices
from tallyframe.llm.wordmap import split_lists, spread

#: White space between which texts can be encoded apart: the vocabulary drops it, and no token crosses it.
_GAP = re.compile("[ \n\t\r]")
#: Lower-case letters that no normal form changes; such a word is one unit for the merges.
_LETTERS = re.compile("[a-z\u00DF-\u00F6\u00F8-\u00FF]+")
#: A full stop or comma that may belong to a longer run of marks.
_RUN_OF_MARKS = re.compile("[^a-z0-9 \u00DF-\u00F6\u00F8-\u00FF][.,] ")
#: Words whose ids a worker remembers, and the longest of them.
MOST_WORDS, LONGEST_WORD = 600_000, 40
FRAME_IDS = 2_000_000
_PART_CHARS = 1_000_000
_TASK_SEQUENCES = 1 << 40


def _byte_letters() -> dict[str, str]:
    """How the letters beyond ASCII stand in a byte-level vocabulary: a character per byte, its own if it is printable."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    shown = dict(zip(printable, printable)) | {byte: 256 + i for i, byte in enumerate(others)}
    # Capitals stand for other bytes there, but words hold small letters only.
    return {chr(code): "".join(chr(shown[byte]) for byte in chr(code).encode()) for code in range(0xDF, 0x100)}


class WordEncoder:
    """Ids of texts by a byte-level tokenizer with word ends. The ids of a word are found once and remembered."""

    def __init__(self, path: str, last: int | None):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.byte_letters = _byte_letters()
        self.tail = np.array([] if last is None else [last], dtype="<u4")
        self._forget()

    def _forget(self) -> None:
        # Between two spaces is an empty word, which has no ids.
        self.numbers: dict[str, int] = {"": 0}
        self.starts, self.ids = np.zeros(2, dtype=np.int64), np.empty(0, dtype="<u4")

    def _learn(self, words: list[str]) -> None:
        """Words of letters go to the merges at once, without the patterns of the tokenizer; others through all of it."""
        plain, others = [], []
        for word in words:
            (plain if _LETTERS.fullmatch(word) else others).append(word)
        found, stops, n = [self.ids], [self.starts], len(self.ids)
        for start in range(0, len(plain), 500):
            line = " ".join(plain[start : start + 500])
            for letter in () if line.isascii() else set(line).intersection(self.byte_letters):
                line = line.replace(letter, self.byte_letters[letter])
            ids = np.array(self.merges.encode(line).ids, dtype="<u4")
            found.append(ids)
            stops.append(n + 1 + np.flatnonzero(self.is_end[ids]))
            n += len(ids)
        lines = [line.ids for line in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        found.append(np.fromiter(chain.from_iterable(lines), dtype="<u4"))
        stops.append(n + np.cumsum([len(line) for line in lines], dtype=np.int64))
        self.numbers.update(zip(plain + others, range(len(self.numbers), len(self.numbers) + len(words))))
        self.ids, self.starts = np.concatenate(found), np.concatenate(stops)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text and the last id; a NULL or empty text has the last id only."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[int] = []
        lines: list[str] = []
        chars = 0
        for i, text in enumerate(texts):
            for part in slices(text, _GAP, _PART_CHARS):
                held.append(i)
                lines.append(self._line(part))
                chars += len(part)
                if chars > _PART_CHARS:
                    self._look_up(held, lines, found)
                    held, lines, chars = [], [], 0
        self._look_up(held, lines, found)
        return [np.concatenate([*parts, self.tail]).astype("<u4", copy=False) for parts in found]

    def _look_up(self, held: list[int], lines: list[str], found: list[list[np.ndarray]]) -> None:
        """Adds the ids of each line to ``found``, at its place in ``held``."""
        if not lines:
            return
        # Words are split and numbered as Arrow columns; only distinct ones become objects, and each is looked for once.
        words, n_words = split_lists(pc.split_pattern(pa.array(lines, pa.large_string()), " "))
        coded = words.dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        at = np.fromiter(map(self.numbers.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        unknown = np.flatnonzero(at < 0).tolist()
        long = [k for k in unknown if len(distinct[k]) > LONGEST_WORD]
        fresh = [k for k in unknown if len(distinct[k]) <= LONGEST_WORD]
        if fresh and len(self.numbers) + len(fresh) > MOST_WORDS:
            self._forget()
            fresh = [k for k, word in enumerate(distinct) if word and len(word) <= LONGEST_WORD]
        self._learn([distinct[k] for k in fresh])
        at[fresh] = [self.numbers[distinct[k]] for k in fresh]
        # Long words are not remembered: their ids are appended for this look-up alone.
        at[long] = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(long))
        longs = [np.array(self.tokenizer.encode(distinct[k], add_special_tokens=False).ids, dtype="<u4") for k in long]
        ids = np.concatenate([self.ids, *longs]) if long else self.ids
        stops = np.r_[self.starts, len(self.ids) + np.cumsum([len(line) for line in longs], dtype=np.int64)]
        starts, sizes = stops[at][which], (stops[at + 1] - stops[at])[which]
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(n_words)]
        for i, line in zip(held, np.split(ids[spread(starts, sizes)], ends[:-1])):
            found[i].append(line)

    @staticmethod
    def _line(text: str) -> str:
        """A text whose words between spaces can be encoded apart."""
        # Marks of special tokens are told by their case; all other letters are lower-cased by the tokenizer anyway.
        line = text if "<|" in text else ascii_lower(text)
        for gap in "\n\t\r":
            line = line.replace(gap, " ")
        return line if _RUN_OF_MARKS.search(line) else line.replace(". ", " . ").replace(", ", " , ")


@lru_cache(maxsize=1)
def _encoder(path: str, last: int | None) -> WordEncoder:
    """One per worker process, so that later tasks find the words of earlier ones."""
    return WordEncoder(path, last)


@dataclass
class Piece:
    """Ids of a document from ``start`` on; ``row`` stands for the document."""

    row: tuple
    start: int
    ids: np.ndarray

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return Piece(self.row, self.start, self.ids[:size]), Piece(self.row, self.start + size, self.ids[size:])


class Levels:
    """Windows that are partly filled, by their level, and the sum-of-squares rule."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level of the window that gets a piece of ``size``; 0 is a new window. The fullest of equally good ones."""
        before, after = self.counts[: self.window - size + 1], self.counts[size:]
        # Moving a window from h to h + size adds 2 N(h + size) + 1 and takes 2 N(h) - 1; full and new ones do not count.
        change = 2 * after + 1 - (2 * before - 1)
        change[-1] -= 1 + 2 * after[-1]
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        if size < self.window:
            change[0] = 2 * after[0] + 1
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def put(self, piece: Piece) -> list[Piece] | None:
        """Place a piece of at most one window; returns the window if that fills it."""
        size = len(piece.ids)
        return self._fill(self.level_for(size), piece)

    def _fill(self, level: int, piece: Piece) -> list[Piece] | None:
        held: list[Piece] = []
        if level:
            held = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        held.append(piece)
        filled = level + len(piece.ids)
        if filled == self.window:
            return held
        self.open[filled].append(held)
        self.counts[filled] += 1
        self.n_open += 1
        return None

    def settle(self) -> Iterator[list[Piece]]:
        """Complete the fullest windows with pieces of the emptiest until one at most is open."""
        levels = [level for level in range(1, self.window) for _ in self.open[level]]
        held = [pieces for level in range(1, self.window) for pieces in self.open[level]]
        self.__init__(self.window)
        low, high = 0, len(held) - 1
        while low < high:
            gap = self.window - levels[high]
            while gap and low < high:
                last = held[low].pop()
                if len(last.ids) > gap:
                    rest, last = last.cut(len(last.ids) - gap)
                    held[low].append(rest)
                held[high].append(last)
                gap, levels[low] = gap - len(last.ids), levels[low] - len(last.ids)
                low += not held[low]
            if gap:
                levels[high] = self.window - gap
            else:
                yield held[high]
                high -= 1
        if low == high and held[low]:
            self.open[levels[low]].append(held[low])
            self.counts[levels[low]] = self.n_open = 1

    def rest(self) -> Iterator[list[Piece]]:
        """The one open window as sequences whose lengths are powers of two, the longest first."""
        pieces = [piece for level in self.open for window in level for piece in window]
        left = sum(len(piece.ids) for piece in pieces)
        while left:
            room, sequence = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                first = pieces.pop(0)
                if len(first.ids) > room:
                    first, other = first.cut(room)
                    pieces.insert(0, other)
                sequence.append(first)
                room -= len(first.ids)
            yield sequence


def sequences_of(documents: Iterator[tuple[tuple, np.ndarray]], window: int, most_open: int) -> Iterator[list[Piece]]:
    """The sequences of ``documents`` (a row and its ids), each a list of pieces."""
    levels = Levels(window)
    for row, ids in documents:
        whole = len(ids) - len(ids) % window
        for start in range(0, whole, window):
            yield [Piece(row, start, ids[start : start + window])]
        if whole < len(ids):
            # A copy, so that an open window does not hold the ids of a whole long document.
            filled = levels.put(Piece(row, whole, ids[whole:].copy()))
            if filled is not None:
                yield filled
            elif levels.n_open > most_open:
                yield from levels.settle()
    yield from levels.settle()
    yield from levels.rest()


def pack(
    docs: DataFrame, tokenizer: str, last: int | None = 1, window: int = 2048, most_open: int = 4096
) -> DataFrame:
    """One row per piece: doc_id, start, ids (little-endian unsigned 32-bit numbers), doc_tokens, sequence_id, offset.

    Each document is its ids by the tokenizer, then ``last``. Every id lies in exactly one piece; a sequence is filled
    from offset 0 without gaps, to ``window`` ids or to a power of two. A NULL or empty text is the last id alone; rows
    that repeat are packed each by itself; a NULL doc_id stays NULL; extra columns are not read. Sequences are numbered
    by the part of the scan, so reruns over the same files agree. ``most_open`` bounds what a task holds: when more
    windows are open, they are completed by cutting. ``tokenizer`` must drop white space and encode word by word.
    """

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(tokenizer, last)

        def documents() -> Iterator[tuple[tuple, np.ndarray]]:
            for frame in chunks(frames, "text", _PART_CHARS):
                for key, ids in zip(frame["doc_id"], encoder.encode_all(list(frame["text"]))):
                    yield (key, len(ids)), ids

        number = TaskContext.get().partitionId() * _TASK_SEQUENCES
        rows, held = [], 0
        for pieces in sequences_of(documents(), window, most_open):
            offset = 0
            for piece in pieces:
                key, n = piece.row
                rows.append((key, piece.start, piece.ids.tobytes(), n, number, offset))
                offset += len(piece.ids)
            number, held = number + 1, held + offset
            if held >= FRAME_IDS:
                yield pd.DataFrame(rows, columns=names)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    # Ids travel as text, since whole numbers that may be NULL do not survive pandas.
    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    pieces = texts.mapInPandas(
        packed, "doc_id string, start long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, its length, and its pieces in order (offset, doc_id, start, ids).

    A sequence has at most one piece per id of a window, so no group is unbounded.
    """
    piece = F.struct("offset", "doc_id", "start", "ids")
    length = F.sum(F.octet_length("ids") / 4).cast("long").alias("length")
    return pieces.groupBy("sequence_id").agg(length, F.sort_array(F.collect_list(piece)).alias("pieces"))


def piece_report(pieces: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece."""
    length = (F.octet_length("ids") / 4).cast("long").alias("length")
    return pieces.select(
        "doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
