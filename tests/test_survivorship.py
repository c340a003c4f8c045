"""Survivors of merged names and families of numbered names, against brute force and on hard shapes."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import text as tx
from tallyframe.operators import matching, stewardship, survivorship
from tallyframe.operators.linked import connected
from tallyframe.plans import daily


def records_of(spark, rows):
    """rows: id, name, block."""
    return matching.normalize(spark.createDataFrame(rows, "LocationID long, Zone string, Borough string"))


def labels(spark, links, kind="long"):
    found = connected(spark.createDataFrame(links, f"a {kind}, b {kind}")).collect()
    assert len({r["node"] for r in found}) == len(found)
    return {r["node"]: r["label"] for r in found}


def test_components_of_odd_links(spark):
    found = labels(spark, [(1, 2), (2, 1), (2, 3), (5, 5), (None, 7), (8, None), (9, 10), (9, 10)])
    assert set(found) == {1, 2, 3, 5, 9, 10}
    assert found[1] == found[2] == found[3] in (1, 2, 3) and found[5] == 5 and found[9] == found[10] != found[1]
    assert labels(spark, []) == {}


def test_components_against_union_find(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)]
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[root(a)] = root(b)
    found = labels(spark, links)
    assert all((found[a] == found[b]) == (root(a) == root(b)) for a, b in combinations(parent, 2))


@pytest.mark.parametrize("shape", ["chain", "star"])
def test_components_of_a_hundred_thousand(spark, shape):
    n = 100_000
    ids = spark.range(n)
    other = F.col("id") + 1 if shape == "chain" else F.lit(n // 2)
    found = connected(ids.select(F.col("id").alias("a"), other.alias("b")))
    row = found.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels")).first()
    assert row["labels"] == 1 and row["n"] == (n + 1 if shape == "chain" else n)


DIRTY = [
    (3, "Harbor Point Terminal North", "Q"), (1, "Harbor Point Terminal Norta", "Q"), (9, "Harbor Point Terminal Nortaa", "Q"),
    (4, "harbor point TERMINAL north", "Q"), (2, "Harbor Point Terminal North", "B"), (7, "Elsewhere", "Q"),
    (None, "Harbor Point Terminal North", "Q"), (8, None, "Q"), (6, "Elsewhere", None), (5, "", "Q"),
]


def test_members_chain_to_the_least_id(spark):
    found = {r["match_key"]: r for r in daily.merged_members(records_of(spark, DIRTY), 0.95).collect()}
    q = "Q::HARBOR POINT TERMINAL "
    assert {k: r["survivor_id"] for k, r in found.items()} == {
        f"{q}NORTH": 1, f"{q}NORTA": 1, f"{q}NORTAA": 1, "B::HARBOR POINT TERMINAL NORTH": 2, "Q::ELSEWHERE": 7, "Q::": 5,
    }
    assert [found[f"{q}{n}"]["mdm_state"] for n in ("NORTA", "NORTH", "NORTAA")] == ["ACTIVE", "MERGED", "MERGED"]
    assert found[f"{q}NORTH"]["records"] == 2
    clusters = {r["survivor_key"]: (r["names"], r["records"], r["last_id"]) for r in survivorship.golden_clusters(daily.merged_members(records_of(spark, DIRTY), 0.95)).collect()}
    assert clusters[f"{q}NORTA"] == (3, 4, 9) and len(clusters) == 4


def test_merged_golden_records_stay_and_name_their_survivor(spark):
    records = records_of(spark, DIRTY)
    golden = matching.golden(records, "2024-01-01 00:00:00")
    merged = survivorship.merge_golden(golden, daily.merged_members(records, 0.95), "2024-02-01 00:00:00")
    assert merged.columns == [*golden.columns, "survivor_id", "survivor_key"]
    assert merged.count() == golden.count()
    rows = {r["match_key"]: r for r in merged.collect() if r["mdm_state"] == "MERGED"}
    assert {k: r["survivor_id"] for k, r in rows.items()} == {"Q::HARBOR POINT TERMINAL NORTH": 1, "Q::HARBOR POINT TERMINAL NORTAA": 1}
    assert {r["survivorship_rule"] for r in rows.values()} == {survivorship.MERGE_RULE}
    states = {r["mdm_state"]: r["record_count"] for r in stewardship.lifecycle(merged, "job").collect()}
    assert states["MERGED"] == 2 and states["ACTIVE"] == golden.count() - 2


def test_members_of_nothing(spark):
    assert daily.merged_members(records_of(spark, [])).count() == 0


def plain_score(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        line = [i]
        for j, y in enumerate(b, 1):
            line.append(min(line[-1] + 1, rows[-1][j] + 1, rows[-1][j - 1] + (x != y)))
        rows.append(line)
    longest = max(len(a), len(b))
    like = round(1 - rows[-1][-1] / longest + 1e-12, 4) if longest else 0.0
    return round(like * 0.9 + (a.split(" ")[0] == b.split(" ")[0]) * 0.1 + 1e-12, 4)


def numbered(n, digits=4):
    return [(i + 1, f"WarehouseStorageDepot {i:0{digits}d}", "Q") for i in range(n)]


MIXED = [
    *numbered(60), (61, "WarehouseStorageDepot 0003", "Q"), (3, "WarehouseStorageDepot 0009", "Q"),
    *[(100 + i, f"Supercalifragilisticexpialidocious{'x' * 20} {i}", "Q") for i in range(8)],
    *[(200 + i, f"Pier {name}", "Q") for i, name in enumerate(["Alpha", "Alphb", "Omega Long Name"])],
    (300, "Single", "B"), (301, "", "B"), (302, None, "B"), *[(400 + i, f"WarehouseStorageDepot {i}", "B") for i in range(3)],
]


def test_families_against_all_pairs(spark):
    high, review = 0.95, 0.8
    records = records_of(spark, MIXED)
    per_copy, classes = daily.name_tables(records)
    found = {(r["borough"], r["token"]): r.asDict() for r in matching.family_groups(per_copy, classes, high, review).collect()}
    rows = [(i, name.upper(), block) for i, name, block in MIXED if name is not None]
    wanted = {}
    for (i, a, x), (j, b, y) in combinations(rows, 2):
        if x == y and i != j and a != b and a.split(" ")[0] == b.split(" ")[0]:
            auto, both = wanted.setdefault((x, a.split(" ")[0]), [0, 0]), plain_score(a, b)
            auto[0] += both >= high
            auto[1] += high > both >= review
    assert set(found) == {("Q", "WAREHOUSESTORAGEDEPOT"), ("B", "WAREHOUSESTORAGEDEPOT"), ("Q", "SUPERCALIFRAGILISTICEXPIALIDOCIOUS" + "X" * 20)}
    for key, row in found.items():
        assert [row["auto_merge_pairs"], row["steward_review_pairs"]] == wanted[key]
        assert row["record_pairs"] == sum(wanted[key])
    assert found["Q", "WAREHOUSESTORAGEDEPOT"]["names"] == 60 and found["Q", "WAREHOUSESTORAGEDEPOT"]["records"] == 62


def test_grouped_and_listed_pairs_make_one_ledger(spark):
    records = records_of(spark, MIXED)
    per_copy, accepted = daily.accept(records)
    grouped_copy, others, families = daily.accept_grouped(records)
    listed = {r["borough"]: r for r in matching.block_ledger(per_copy, accepted).collect()}
    assert {r["borough"]: r for r in matching.block_ledger(grouped_copy, others, families).collect()} == listed
    tokens = {r["token"] for r in families.collect()}
    assert not [r for r in others.collect() if r["token_a"] == r["token_b"] in tokens and r["zone_a"] != r["zone_b"]]


def test_partners_of_asked_members(spark):
    records = records_of(spark, MIXED)
    _, classes = daily.name_tables(records)
    asked = spark.createDataFrame([("Q", "WAREHOUSESTORAGEDEPOT 0007"), ("Q", "WAREHOUSESTORAGEDEPOT 0008"), ("B", "SINGLE"), ("Q", "PIER ALPHA")], "block string, name string")
    pairs = [(r["zone_a"], r["zone_b"]) for r in matching.family_partners(classes, asked).collect()]
    assert len(pairs) == len(set(pairs)) == 59 + 58
    assert all(a < b and (a[-4:] in ("0007", "0008") or b[-4:] in ("0007", "0008")) for a, b in pairs)


def test_ten_thousand_numbered_names_make_few_rows(spark):
    records = records_of(spark, numbered(10_000))
    per_copy, accepted, families = daily.accept_grouped(records)
    row = families.first()
    assert families.count() == 1 and accepted.count() == 0
    assert row["names"] == 10_000 and row["record_pairs"] == 10_000 * 9_999 // 2
    # One of four digits differs.
    assert row["auto_merge_pairs"] == 10_000 * 36 // 2
    members = daily.merged_members(records)
    assert members.agg(F.countDistinct("survivor_id")).first()[0] == 1


def test_close_families_at_the_bound(spark):
    per_copy, classes = daily.name_tables(records_of(spark, [(1, "Token ab", "Q"), (2, "Token xy", "Q"), (3, "Token", "B"), (4, "Token abc", "B")]))
    least = {b: plain_score("TOKEN AB", "TOKEN XY") if b == "Q" else plain_score("TOKEN", "TOKEN ABC") for b in "QB"}
    for block, score in least.items():
        assert {r["block"] for r in matching.close_families(classes, score).collect()} >= {block}
        assert block not in {r["block"] for r in matching.close_families(classes, score + 0.0001).collect()}
    assert tx.HIGH_CONFIDENCE > least["Q"]
