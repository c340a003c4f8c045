"""Near copies: MinHash with tensored banding, confirmed on full shingle sets, joined into components.

Table keys pair a band of one small collection of minhashes with a band of another, so m * m tables need only 2 * m
bands. With m = 9 and bands of 3, a pair at similarity 0.8 shares no key once in 320 times, at 0.85 once in 2,600; a
component is lost only where all its links are.

A bucket never expands into all its pairs. First its members are compared with two of them. Only what remains in
different components is paired, each pair in the first table that it shares, and only if an exact bound does not rule
it out: sets of n and m shingles are similar enough if at most a ninth of n + m stand in one of them alone, and every
bit in which their odd sketches differ proves one such shingle. Equal sets are one class from the start, so copies
cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.common import giving_back, via_table
from tallyframe.llm.components import components
from tallyframe.llm.shingles import Bands, Shingler, same_set_key
from tallyframe.llm.wordmap import as_lists, frames_of

COLLECTION, ROWS = 9, 3
#: Bits of an odd sketch: whether a part of the hash space holds an odd number of shingles.
SKETCH_BITS = 1024
SKETCH_WORDS = SKETCH_BITS // 64
#: Rows come back from a worker in frames whose texts sum to this many characters.
FRAME_CHARS = 2_000_000
#: Ids up to this many (16 bytes each) are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: A task makes the table keys of about this many classes. An aggregate by key holds nearly all of them, each key being
#: rare, and a task that reads a small file makes very many.
TASK_CLASSES = 10_000


def _arrays(rows: Sequence[np.ndarray]) -> pa.ListArray:
    return as_lists(pa.array(np.concatenate(rows)), np.array([len(row) for row in rows]))


def signatures(docs: DataFrame, shingle: int, collection: int, rows: int) -> DataFrame:
    """``doc_id, n, high, low, bands`` of every row: set size, 128 bits that name the set, and its band keys.

    Texts stay Arrow columns; one at a time becomes an object, so a worker does not hold a batch of them twice."""

    @giving_back
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands = Shingler(shingle), Bands(collection, rows)
        for frame in frames_of(batches, FRAME_CHARS):
            out = []
            for text in frame["text"]:
                found = shingler.set_of(text.as_py())
                out.append((len(found), *same_set_key(found), bands.of(found) if len(found) else none))
            n, high, low, keys = zip(*out)
            columns = [frame["doc_id"], *(pa.array(c, pa.int64()) for c in (n, high, low)), _arrays(keys)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "high", "low", "bands"])

    none = np.empty(0, dtype=np.int64)
    named = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(sign, "doc_id string, n long, high long, low long, bands array<long>")
    return named.withColumn("doc_id", F.col("doc_id").cast("long"))


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``id, n, hashes, odd`` of the classes in ``wanted`` (id, high, low), from the text of the document ``id``."""
    ids = wanted.select("id").distinct()
    few = ids.count() <= MOST_BROADCAST
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids) if few else ids, "id", "left_semi")

    @giving_back
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for frame in frames_of(batches, FRAME_CHARS):
            out = []
            for text in frame["text"]:
                found = shingler.set_of(text.as_py())
                counts = np.bincount(found >> np.uint64(54), minlength=SKETCH_BITS)
                odd = np.packbits((counts & 1).astype(np.uint8)).view(np.int64)
                out.append((len(found), *same_set_key(found), found.view(np.int64), odd))
            n, high, low, hashes, sketches = zip(*out)
            columns = [frame["id"], *(pa.array(c, pa.int64()) for c in (n, high, low)), _arrays(hashes), _arrays(sketches)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "high", "low", "hashes", "odd"])

    built = texts.mapInArrow(build, "id long, n long, high long, low long, hashes array<long>, odd array<long>")
    # An id may stand on several rows with different texts: the class is that of the wanted set.
    return built.join(wanted, ["id", "high", "low"], "left_semi").dropDuplicates(["id", "high", "low"]).select("id", "n", "hashes", "odd")


def _similar(shared: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n_a + n_b - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("set_b"))
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("set_a"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return both.filter(_similar(shared, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _fits(n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether the sizes alone allow the similarity."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _relabelled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets that still hold several components, with the component of each."""
    known = buckets.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = known.groupBy("key").agg(F.min("label").alias("low_label"), F.max("label").alias("high_label")).filter("low_label <> high_label").select("key")
    return known.join(mixed, "key")


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges: only components move, so the work follows the new edges."""
    if labels is None:
        return via_table(components(edges), "nearcopies-labels")
    ends = edges.select(F.col("a").alias("id"), "b").join(labels, "id", "left").select(F.coalesce("label", "id").alias("a"), F.col("b").alias("id"))
    ends = ends.join(labels, "id", "left").select("a", F.coalesce("label", "id").alias("b"))
    moved = components(ends)
    target = moved.select(F.col("id").alias("label"), F.col("label").alias("to"))
    old = labels.join(target, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    new = moved.join(labels.select("id"), "id", "left_anti")
    return via_table(old.unionByName(new), "nearcopies-labels")


def _last_pairs(mixed: DataFrame, classes: DataFrame, sets: DataFrame, collection: int, percent: int) -> DataFrame:
    """Pairs from different components of one bucket, each once, unless sizes or sketches rule them out."""
    sketch = sets.select("id", "odd").join(classes.select("id", "n", "bands"), "id")
    rows = mixed.join(sketch, "id").select("key", "i", "j", "id", "label", "n", "bands", "odd")
    left = rows.select("key", "i", "j", *(F.col(c).alias(f"{c}_a") for c in ("id", "label", "n", "bands", "odd")))
    right = rows.select("key", *(F.col(c).alias(f"{c}_b") for c in ("id", "label", "n", "bands", "odd")))

    def none_before(place: str, begin: int) -> Column:
        """No band of the collection before ``place`` is equal. Plain comparisons, so that Spark compiles them."""
        earlier = F.lit(True)
        for k in range(collection - 1):
            earlier = earlier & ((F.lit(k) >= F.col(place)) | (F.get("bands_a", F.lit(begin + k)) != F.get("bands_b", F.lit(begin + k))))
        return earlier

    apart = F.bit_count(F.get("odd_a", F.lit(0)).bitwiseXOR(F.get("odd_b", F.lit(0))))
    for k in range(1, SKETCH_WORDS):
        apart = apart + F.bit_count(F.get("odd_a", F.lit(k)).bitwiseXOR(F.get("odd_b", F.lit(k))))
    sizes = F.col("n_a") + F.col("n_b")
    return left.join(
        right,
        (left["key"] == right["key"])
        & (F.col("id_a") < F.col("id_b"))
        & (F.col("label_a") != F.col("label_b"))
        & _fits(F.col("n_a"), F.col("n_b"), percent)
        # 100 (sizes - apart) / 2 >= percent (sizes + apart) / 2, for the shingles that stand in one set alone
        & ((100 + percent) * apart <= (100 - percent) * sizes)
        & none_before("i", 0)
        & none_before("j", collection),
    ).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, collection: int = COLLECTION, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Documents are linked where 100 * intersection >= ``percent`` * union of their shingle sets; ``component_id`` is the
    smallest doc_id reachable, and ``kept`` marks it. Empty and NULL texts have empty sets and are linked with nothing.
    A row with a NULL doc_id is neither compared nor linked: its component is NULL and it is kept. Rows that repeat a
    doc_id are compared by their own texts, and all of them are kept if that id is kept.
    """
    signed = via_table(signatures(docs, shingle, collection, rows), "nearcopies-signatures")
    named = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("high", "low").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = via_table(classes, "nearcopies-classes")

    tables = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(collection - 1)),
            lambda i: F.transform(
                F.sequence(F.lit(0), F.lit(collection - 1)),
                lambda j: F.struct(
                    i.alias("i"),
                    j.alias("j"),
                    F.xxhash64(i, j, F.get("bands", i), F.get("bands", j + collection)).alias("key"),
                ),
            ),
        )
    )
    dealt = classes.repartition(classes.count() // TASK_CLASSES + 1, "id")
    keys = dealt.select("id", "n", F.explode(tables).alias("t")).select("id", "n", "t.i", "t.j", "t.key")
    # Two members stand for a bucket: that with the least id, and that with the least hash. Aggregates of plain
    # numbers need no sort, which aggregates of structs would.
    place = F.xxhash64("key", "id")
    heads = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("most"), F.min(place).alias("least")).filter("first <> most").drop("most")
    buckets = via_table(keys.join(heads, "key"), "nearcopies-buckets")
    wanted = classes.select("id", "high", "low").join(buckets.select("id").distinct(), "id", "left_semi")
    sets = via_table(full_sets(docs, via_table(wanted, "nearcopies-wanted"), shingle), "nearcopies-sets")

    named_heads = buckets.filter((F.col("id") == F.col("first")) | (place == F.col("least"))).select("key", F.col("id").alias("head"), F.col("n").alias("n_head"))
    pairs = buckets.join(named_heads, "key").filter((F.col("id") != F.col("head")) & _fits(F.col("n"), F.col("n_head"), percent))
    pairs = pairs.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
    labels = _merged(None, confirmed(pairs, sets, percent))

    mixed = via_table(_relabelled(buckets.select("key", "i", "j", "id"), labels), "nearcopies-mixed")
    pairs = via_table(_last_pairs(mixed, classes, sets, collection, percent), "nearcopies-last")
    edges = via_table(confirmed(pairs, sets, percent), "nearcopies-edges")
    if not edges.isEmpty():
        labels = _merged(labels, edges)

    found = classes.join(labels, "id", "left").select("high", "low", F.coalesce("label", "id").alias("label"))
    known = named.join(found, ["high", "low"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"))
    alone = signed.filter("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
