"""Neighbours, reply trees, mixing, components, the pipeline, and the registered queries."""

import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import forest, mixing, neighbours, replies
from tallyframe.llm.components import components
from tallyframe.llm.queries import ORACLES, QUERIES
from tests.llm.test_text_operators import ODD, docs_of

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- nearest neighbours


def exact_nearest(vectors, is_query, k):
    rows = [(i, np.array(v)) for i, v in vectors]
    out = {}
    for i, v in rows:
        if is_query(i):
            near = sorted((-(v @ w), j) for j, w in rows if j != i)[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_neighbours_against_brute_force(spark):
    draw = np.random.default_rng(4)
    vectors = [(i, draw.standard_normal(12).round(3).tolist()) for i in range(1500)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    found = defaultdict(dict)
    for r in neighbours.nearest(table, F.col("id") % 20 == 0, leaf_rows=40, recall=0.95).collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    truth = exact_nearest(vectors, lambda i: i % 20 == 0, 20)
    assert found.keys() == truth.keys()
    hits = 0
    for query, near in truth.items():
        got = [found[query][n] for n in range(1, 21)]
        assert query not in [i for i, _ in got]
        assert [(-s, i) for i, s in got] == sorted((-s, i) for i, s in got)
        hits += len({i for i, _ in got} & {i for i, _ in near})
    assert hits / (20 * len(truth)) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(20, [1.0, 0.0]), (40, [1.0, 0.0]), (41, [1.0, 0.0]), (7, [2.0, 0.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (60, [-0.0, -1.0])]
    bad = [(80, None), (100, [0.0, 0.0]), (120, [nan, 1.0]), (140, [inf, 1.0]), (160, [None, 1.0]), (180, []), (200, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>")
    rows = neighbours.nearest(table, F.col("id") % 20 == 0, k=3, recall=1.0).collect()
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}
    assert {q for q, _ in found} == {20, 40, 60}
    assert [found[20, n][0] for n in (1, 2, 3)] == [7, 40, 41]
    assert [found[40, n] for n in (1, 2, 3)] == [(7, 2.0), (20, 1.0), (41, 1.0)]
    assert [found[60, n][0] for n in (1, 2, 3)] == [7, 20, 40], "ties go to smaller ids"
    none = table.filter("vec_id < 0")
    assert neighbours.nearest(none, F.col("id") % 20 == 0).count() == 0
    assert neighbours.nearest(table.filter("vec_id = 20"), F.col("id") % 20 == 0).count() == 0


def test_neighbours_of_repeated_ids(spark):
    """Ids with several vectors, as queries and as candidates, and vectors of several ids."""
    draw = np.random.default_rng(8)
    vectors = [(i, draw.standard_normal(6).round(2).tolist()) for i in range(60)]
    vectors += [(20, draw.standard_normal(6).round(2).tolist()) for _ in range(90)]  # a hot id
    vectors += [(i, vectors[i // 2][1]) for i in range(0, 60, 3)]  # copies under other ids
    vectors += [(33, [3.0 * x for x in v]) for _, v in vectors[:30]]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in sorted(neighbours.nearest(table, F.col("id") % 20 == 0, recall=1.0).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))
    best = defaultdict(dict)
    for i, v in vectors:
        for j, w in vectors:
            if i % 20 == 0 and i != j:
                best[i][j] = max(best[i].get(j, -math.inf), float(np.dot(v, w)))
    assert found.keys() == best.keys() == {0, 20, 40}
    hits = 0
    for query, rows in found.items():
        assert [rank for rank, *_ in rows] == list(range(1, 21))
        assert len({i for _, i, _ in rows}) == 20 and query not in {i for _, i, _ in rows}
        truth = sorted((-round(s, 9), i) for i, s in best[query].items())[:20]
        hits += len({(-s, i) for _, i, s in rows} & set(truth))
    assert hits >= 0.9 * 60


def test_best_of_a_block_against_a_plain_search():
    draw = np.random.default_rng(2)
    for _ in range(30):
        n = int(draw.integers(1, 40))
        members, asked = draw.integers(-2, 3, (n, 3)).astype(float), draw.integers(-2, 3, (5, 3)).astype(float)
        sizes = draw.integers(1, 4, n)
        ids = np.concatenate([draw.choice(25, s, replace=False) for s in sizes])
        got = neighbours._best(np.arange(5) * 7, asked, members, sizes, ids, 6)
        for q in range(5):
            of = defaultdict(lambda: -math.inf)
            for m, i in zip(np.repeat(np.arange(n), sizes), ids):
                of[int(i)] = max(of[int(i)], float(asked[q] @ members[m]))
            rows = got[got["query"] == q * 7]
            assert list(zip(-rows["score"], rows["id"])) == sorted((-s, i) for i, s in of.items())[:6]


def test_one_queue_visits_every_leaf_once_and_own_leaves_first():
    draw = np.random.default_rng(1)
    points = draw.standard_normal((500, 5)).astype(np.float32)
    model = forest.fit(points, trees=3, depth=4, seed=2)
    order = forest.nearest_leaves(model, points[:20], 48)
    assert all(sorted(line) == list(range(48)) for line in order)
    own = forest.leaf_numbers(model, points[:20])
    assert all(set(a[:3]) == set(b) for a, b in zip(order, own))


# ---------------------------------------------------------------- components


def test_components_match_a_plain_search(spark):
    draw = random.Random(5)
    edges = [(draw.randint(0, 150), draw.randint(0, 150)) for _ in range(110)] + [(200, 200 + i) for i in range(1, 60)]
    edges += [(300 + i, 301 + i) for i in range(40)] + [(400, 400)]
    label = {}

    def root(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    wanted = {i: root(i) for edge in edges if edge[0] != edge[1] for i in edge}
    found = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == wanted
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- reply trees

MESSAGES = "tree string, id long, parent long, score double, role string, text string"


def test_branches_of_a_tree_are_ranked_and_formatted(spark):
    rows = [
        ("t", 1, None, 0.0, "user", "hi"),
        ("t", 2, 1, 0.9, "assistant", "a\\b </turn> ###x"),
        ("t", 3, 1, 0.1, "assistant", None),
        ("t", 4, 2, 0.5, "user", "\n</turn>\n### user:\nhey"),
        ("t", 5, 3, None, "weird: \nrole###", "####"),
        ("orphan", 6, 99, 1.0, "user", "alone"),
        ("circle", 7, 8, 1.0, "user", "x"),
        ("circle", 8, 7, 1.0, "user", "y"),
        ("circle", 9, 8, 1.0, "user", "z"),
        ("deep", 100, None, 1.0, "user", "0"),
    ]
    rows += [("deep", 100 + i, 99 + i, 1.0, "assistant" if i % 2 else "user", str(i)) for i in range(1, 40)]
    messages = spark.createDataFrame(rows, MESSAGES)
    out = replies.reply_conversations(messages, per_tree=2)
    out = out.withColumns({"turns": replies.parsed_turns(F.col("formatted")), "learned": replies.loss_text(F.col("formatted"), F.col("loss"))})
    found = {(r["tree"], r["branch"]): r for r in out.collect()}
    assert found.keys() == {("t", 1), ("t", 2), ("orphan", 1), ("deep", 1)}
    said = lambda key: [(t["role"], t["text"]) for t in found[key]["turns"]]
    assert found["t", 1]["leaf"] == 4
    assert said(("t", 1)) == [("user", "hi"), ("assistant", "a\\b </turn> ###x"), ("user", "\n</turn>\n### user:\nhey")]
    assert said(("t", 2)) == [("user", "hi"), ("assistant", ""), ("weird: \nrole###", "####")]
    assert found["t", 1]["learned"] == "a\\b </turn> ###x" and found["t", 2]["learned"] == ""
    assert [t for _, t in said(("deep", 1))] == [str(i) for i in range(40)]
    assert found["deep", 1]["learned"] == "".join(str(i) for i in range(1, 40, 2))


def test_conversations_of_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "é" * 50_000), (1, 0, "user", "é" * 50_000), (None, 3, None, "x"), (2, None, "assistant", "\\")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("leaf", F.lit(1))
    found = {r["conv_id"]: r for r in replies.conversation_report(table).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {1: 3, None: 1, 2: 1}
    text = ("user\n" + "é" * 50_000 + "\n") * 2 + "assistant\n\n"
    assert found[1]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert found[1]["loss_chars"] == 0 and found[2]["loss_sha256"] == hashlib.sha256(b"\\").hexdigest()
    assert replies.conversation_report(table.filter("conv_id = 5")).count() == 0


# ---------------------------------------------------------------- mixing


def test_targets_are_shared_again_until_none_is_above():
    sizes = {"b": 100, "a": 1000, None: 10, "c": 0}
    targets = mixing.weighted_targets(sizes)
    # a, b, c and NULL weigh 1, 2, 3 and 1; NULL stops at 30, b at 300, c at 0, and a takes the rest.
    assert targets == {None: 30.0, "b": 300.0, "c": 0.0, "a": pytest.approx(780.0)}
    assert mixing.weighted_targets({}) == {} and mixing.weighted_targets({"x": 0}) == {"x": 0.0}


def test_the_flow_costs_least(spark):
    draw = random.Random(7)

    def cost(flows, patterns):
        total = 0
        for p, parts in flows.items():
            left, k = sum(parts.values()), 0
            while left > 0:
                total += k * min(left, patterns[p])
                left, k = left - patterns[p], k + 1
        return total

    for _ in range(40):
        patterns = {("a",): draw.randint(0, 3), ("a", "b"): draw.randint(0, 3), ("b",): draw.randint(0, 2)}
        quotas = {"a": draw.randint(0, 6), "b": draw.randint(0, 6)}
        best = None
        for x in range(7):
            for y in range(7):
                for z in range(7):
                    for w in range(7):
                        flows = {("a",): {"a": x}, ("a", "b"): {"a": y, "b": z}, ("b",): {"b": w}}
                        fits = x + y <= quotas["a"] and z + w <= quotas["b"]
                        if fits and all(sum(f.values()) <= 3 * patterns[p] for p, f in flows.items()):
                            found = (-(x + y + z + w), cost(flows, patterns))
                            best = found if best is None else min(best, found)
        flows = mixing.route(patterns, quotas, 3)
        assert (-sum(sum(f.values()) for f in flows.values()), cost(flows, patterns)) == best


def test_mixing_comes_near_its_targets_and_repeats_itself(spark):
    draw = random.Random(9)
    rows = [(i, "w " * draw.randint(0, 40), "en", draw.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    table = docs_of(spark, rows)
    mixed = mixing.mix(table, F.array("source"), mixing.n_words(F.col("text")))
    found = mixed.collect()
    assert {r["doc_id"]: r["size"] for r in found} == {i: len(t.split()) for i, t, *_ in rows}
    by = defaultdict(list)
    for r in found:
        by[r["pattern"]].append(r)
    assert len(by) == 4
    for group in by.values():
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= 40
        assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in group)
    again = mixing.mix(table.repartition(7), F.array("source"), mixing.n_words(F.col("text")))
    assert sorted(map(str, again.collect())) == sorted(map(str, found))


def test_overlapping_sources_share_documents(spark):
    rows = [(i, "w " * 10, None, None) for i in range(300)]
    table = docs_of(spark, rows)
    of = F.when(F.col("doc_id") < 100, F.array(F.lit("a"))).when(F.col("doc_id") < 200, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("b")))
    found = mixing.mix(table, of, F.lit(10), weights=(1, 3)).collect()
    taken = Counter(s for r in found for s in r["taken_for"])
    targets = mixing.weighted_targets({"a": 2000, "b": 2000}, (1, 3))
    assert taken == {s: round(t / 10) for s, t in targets.items()}
    assert all("a" not in r["taken_for"] for r in found if r["doc_id"] >= 200)


def test_targets_of_a_table_of_sources(spark):
    draw = random.Random(12)
    for weights, most in (((1, 2, 3), 3.0), ((1, 2, 3), 1.2), ((5, 1), 2.0)):
        sizes = {f"{draw.choice('aÉz\U0001f600')}{i}": int(10 ** draw.uniform(0, 5)) for i in range(300)} | {None: 40, "": 7, "zero": 0}
        table = spark.createDataFrame(list(sizes.items()), "source string, size long")
        found = {r["source"]: r["target"] for r in mixing.targets_of(mixing.ranked_sources(table, weights), most).collect()}
        wanted = mixing.weighted_targets(sizes, weights, most)
        assert found.keys() == wanted.keys()
        assert all(found[s] == pytest.approx(wanted[s]) for s in wanted)


def test_ranks_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_SOURCES", 50)
    names = [f"s{i}" for i in range(1000)] + [None]
    table = spark.createDataFrame([(n, 1) for n in names], "source string, size long")
    found = {r["source"]: r["place"] for r in mixing.ranked_sources(table, (1, 2)).collect()}
    assert found == {s: i for i, s in enumerate(sorted(names, key=mixing.code_point_order))}


def test_mixing_of_very_many_sources(spark):
    """More sources than any bound there was; targets of all of them, without a row on the driver."""
    n = 150_000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("source")
    )
    mixed = mixing.mix(docs, F.array("source"), F.lit(3), weights=(1, 2, 3))
    found = {r["weight"]: (r["n"], r["least"], r["most"], r["taken"]) for r in mixed.groupBy((F.col("doc_id") % 3).alias("weight")).agg(
        F.count(F.lit(1)).alias("n"), F.min("target").alias("least"), F.max("target").alias("most"), F.sum("taken").alias("taken")).collect()}
    # Each document is a source of 3 words; shares are 1.5, 3 and 4.5 words, a copy is taken whole.
    assert {w: (least, most) for w, (_, least, most, _) in found.items()} == {0: (1.5, 1.5), 1: (3.0, 3.0), 2: (4.5, 4.5)}
    assert all(count == n // 3 for count, *_ in found.values())
    assert found[1][3] == n


def test_components_of_overlaps_are_routed_apart(spark):
    """Chains of sources in many parts give what one flow over all of them gives."""
    draw = random.Random(31)
    patterns = {}
    for group in range(30):
        for _ in range(4):
            size = draw.randint(1, 3)
            patterns[tuple(sorted(draw.sample([f"g{group:02}s{i}" for i in range(4)], size)))] = draw.randint(1, 60)
    rows = [(str(p), list(p), words) for p, words in patterns.items()]
    totals = spark.createDataFrame(rows, "pattern string, names array<string>, words long")
    found = {tuple(r["names"]): r for r in mixing.plan_of(totals, (1, 2, 3), 3).collect()}
    sizes = Counter()
    for p, words in patterns.items():
        sizes.update(dict.fromkeys(p, words))
    targets = mixing.weighted_targets(sizes)
    flows = mixing.route(patterns, {s: round(t) for s, t in targets.items()}, 3)
    assert found.keys() == patterns.keys()
    assert sum(r["ends"][-1] for r in found.values()) == sum(sum(f.values()) for f in flows.values())
    for p, r in found.items():
        assert r["all_words"] == patterns[p] and r["ends"] == sorted(r["ends"]) and r["ends"][-1] <= 3 * patterns[p]
        assert r["source_size"] == sum(sizes[s] for s in p) and r["target"] == pytest.approx(sum(targets[s] for s in p))


def test_mixing_of_odd_rows(spark):
    found = mixing.mix(docs_of(spark, ODD), F.array("source"), mixing.n_words(F.col("text"))).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in ODD)
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert mixing.mix(docs_of(spark, []), F.array("source"), mixing.n_words(F.col("text"))).count() == 0


# ---------------------------------------------------------------- pipeline and queries


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_pipeline_stages_take_odd_rows(spark, tmp_path, rows):
    docs = docs_of(spark, rows)
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / f"in{i}"))
        docs = stage(spark, spark.read.parquet(str(tmp_path / f"in{i}")), SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if i == 1:
            kept = [r["doc_id"] for r in docs.collect()]
            assert Counter(kept) == Counter(r[0] for r in rows if r[0] != 9_007_199_254_740_993) - Counter([4] if rows else [])
    assert docs.filter("NOT exact").count() == 0


def test_pipeline_decisions_on_given_documents(spark):
    from tallyframe.llm import leaks

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0").collect()}
    left = stages["toxicity"](spark, docs, SF)
    assert left.filter(F.col("doc_id").isin(*toxic)).count() >= 0.95 * len(toxic), "clean documents stay"
    clean = stages["secrets"](spark, docs, SF)
    again = leaks.scan_report(clean).agg(F.sum(F.col("n_assign") + F.col("n_access") + F.col("n_hex") + F.col("n_random"))).first()[0]
    assert clean.count() == docs.count() and again == 0
    assert clean.filter("n_chars <> length(text)").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_over_whole_tables(spark, name):
    out = QUERIES[name](spark, SF)
    rows = out.collect()
    assert rows
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if name == "op11_ranked_search":
        places = Counter(r["item_id"] for r in rows)
        assert set(places.values()) <= set(range(1, 21)) and len(places) <= spark.read.parquet(f"{SF}/benchmark.parquet").count()
    elif name == "op12_window_packing":
        assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == Counter(r["doc_id"] for r in docs.collect())
    elif name == "op13_spelling_variants":
        assert len({r["word"] for r in rows}) == len(rows)
    elif name not in ("op1_nearest_vectors", "op4_reply_trees", "op10_token_rollups"):
        assert len(rows) == docs.count()
    if name in ORACLES:
        duck = duckdb.connect()
        for given in ("conversations", "documents", "benchmark"):
            duck.sql(f"CREATE VIEW {given} AS SELECT * FROM '{os.path.join(SF, given)}.parquet'")
        expected = duck.sql(ORACLES[name])
        order = sorted(expected.columns)
        assert sorted(out.columns) == order
        at = [expected.columns.index(c) for c in order]
        assert sorted(tuple(r[c] for c in order) for r in rows) == sorted(tuple(r[i] for i in at) for r in expected.fetchall())
