"""What Python workers hold: memory that is free goes back, and no step starts workers that it does not need."""

import subprocess
import sys
import weakref

import numpy as np
import pyarrow as pa

from tallyframe.llm import common, pieces, wordmap


def test_freed_memory_goes_back_though_some_stays_above_it():
    # One small object in a hundred stays, so that the C library cannot shorten its heap from the end.
    code = """
import re
from tallyframe.llm.common import give_back
held = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
give_back()
before, rows = held(), [bytes(20_000) for _ in range(10_000)]
assert held() > before + 150
rows = rows[::100]
give_back()
print(held() - before)
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    assert int(said) < 50


def test_a_step_is_free_of_its_own_rows_when_it_gives_back(monkeypatch):
    class Rows:
        pass

    gone, seen = [], []
    monkeypatch.setattr(common, "give_back", lambda: seen.append(all(rows() is None for rows in gone)))

    @common.giving_back
    def step(batches):
        for batch in batches:
            rows = Rows()
            gone.append(weakref.ref(rows))
            yield batch

    assert list(step(iter([1, 2, 3]))) == [1, 2, 3]
    assert len(gone) == 3 and seen == [True]


def test_the_tables_of_a_lattice_need_no_python_workers(spark):
    model = pieces.read_pieces()
    tails = pieces._tail_sizes(spark, model)
    assert "PythonRDD" not in tails._jdf.queryExecution().toRdd().toDebugString()
    found = {row["tail"]: row["sizes"] for row in tails.collect()}
    assert len(found) > 1000 and all(sizes == sorted(set(sizes)) for sizes in found.values())


def test_tokens_are_taken_apart_some_at_a_time(monkeypatch):
    monkeypatch.setattr(wordmap, "_PARTED", 3)
    of, n = np.array([5, 6, 7, 8], dtype=np.int32), np.array([1, 0, 3])
    numbers, sizes = np.array([2, 0, 1, 1, 2, 2, 0], dtype=np.int32), np.array([0, 2, 2, 0, 3, 0])
    parts, counts = wordmap.parted(numbers, sizes, of, n)
    assert parts.tolist() == [6, 7, 8, 5, 6, 7, 8, 6, 7, 8, 5] and counts.tolist() == [0, 4, 0, 0, 7, 0]
    parts, counts = wordmap.parted(numbers[:0], np.array([0, 0]), of, n)
    assert parts.tolist() == [] and counts.tolist() == [0, 0]


def test_a_block_does_not_keep_the_batches_it_read():
    table = pa.table({"doc_id": ["1", "2", None], "text": ["a b " * 50_000, None, ""]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    source = pa.ipc.open_stream(pa.BufferReader(sink.getvalue()))
    (block,) = wordmap.blocks_of(iter(source), lambda texts: pa.compute.split_pattern(texts, " "))
    assert block.rows["doc_id"].to_pylist() == ["1", "2", None] and block.sizes.tolist() == [100_001, 1, 1]
    held = {b.address for b in block.rows["doc_id"].chunk(0).buffers() if b is not None}
    whole = sink.getvalue()
    assert not any(whole.address <= at < whole.address + whole.size for at in held)
