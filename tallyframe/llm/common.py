"""What the operators of this package share: words, the scan of a table, intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.sources.scratch import scratch_folder, via_table

__all__ = [
    "WORD", "WORD_PATTERN", "ascii_lower", "chunks", "give_back", "giving_back", "scratch_folder", "slices", "table", "training_fold", "via_table", "words",
]

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
words = WORD.findall

def ascii_lower(text: str) -> str:
    """A-Z in lower case, all else as it is. Lower case of bytes changes those letters only."""
    if text.isascii():
        return text.lower()
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def training_fold(key: Column, folds: int) -> Column:
    """The remainder of crc32 of a key's text; fold 0 is held out. A NULL key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def chunks(frames: Iterable[pd.DataFrame], column: str, most_chars: int = 8_000_000) -> Iterator[pd.DataFrame]:
    """The same rows in frames whose texts sum to about ``most_chars``, so that memory does not follow text length.

    A text longer than that is a frame of its own.
    """
    for frame in frames:
        sizes = frame[column].map(len, na_action="ignore").fillna(0).to_numpy(dtype="int64")
        part = (sizes.cumsum() - sizes) // most_chars
        if not len(part) or part[-1] == 0:
            yield frame
        else:
            for _, piece in frame.groupby(part, sort=False):
                yield piece.reset_index(drop=True)


#: What malloc.h calls M_TRIM_THRESHOLD and M_MMAP_THRESHOLD.
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3


def give_back() -> None:
    """What Arrow and the C library keep of freed memory goes back to the machine. Called at the end of a task, so that a
    worker that waits for the next one, of another stage perhaps, does not add to that stage's memory."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # C libraries other than glibc have no such call
        library = ctypes.CDLL(None)
        # From now on large arrays go back as soon as they are free, also those of what follows the last call of a task.
        library.mallopt(_MMAP_THRESHOLD, 4 << 20)
        library.mallopt(_TRIM_THRESHOLD, 16 << 20)
        library.malloc_trim(0)


def giving_back(step: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A step from batches to batches with ``give_back`` after it, when what the step itself held is free too."""

    @functools.wraps(step)
    def whole(*args: object) -> Iterator:
        yield from step(*args)
        give_back()

    return whole


def slices(text: str | None, gap: re.Pattern, most_chars: int = 2_000_000) -> Iterator[str]:
    """A text in parts of about ``most_chars``, so that the words of a very long text are never all held at once.

    Cuts lie before a match of ``gap``, a character that no word holds; without one, a part is longer. NULL has none.
    """
    start = 0
    while text and start < len(text):
        stop = len(text)
        if stop - start > most_chars and (found := gap.search(text, start + most_chars)):
            stop = found.start()
        yield text if start == 0 and stop == len(text) else text[start:stop]
        start = stop
