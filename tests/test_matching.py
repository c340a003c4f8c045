"""Matching against brute force on small dirty fixtures."""

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import conform, matching, similarity, stewardship
from tallyframe.operators.similarity import near_pairs
from tallyframe.sources.scratch import via_table


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def half_up(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.0001"), ROUND_HALF_UP))


def scored(a, b, high, review):
    if a is None or b is None:
        return None, None, "REJECT"
    longest = max(len(a), len(b))
    similarity = half_up(1 - edits(a, b) / longest) if longest else 0.0
    token = 1.0 if a.split(" ")[0] == b.split(" ")[0] else 0.0
    confidence = half_up(similarity * 0.9 + token * 0.1)
    band = "AUTO_MERGE" if confidence >= high else "STEWARD_REVIEW" if confidence >= review else "REJECT"
    return similarity, confidence, band


def brute_pairs(rows, high, review):
    """All record pairs as (id_a, id_b, zone_a, zone_b, block, similarity, confidence, band)."""
    found = []
    for r, s in combinations([r for r in rows if r[0] is not None and r[2] is not None], 2):
        (i, x, p), (j, y, q) = (r, s) if r[0] < s[0] else (s, r)
        if p == q and i != j:
            found.append((i, j, x, y, p, *scored(x, y, high, review)))
    return found


WORDS = ["MAIN", "MAINE", "NORTH", "NORT", "PARK", "PARC", "HILL", "HILLS", "A", "AB", "ST 1", "ST 2", "EAST END"]


def dirty_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        name = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.3 and name:
            cut = rng.randrange(len(name))
            name = (name[:cut] + rng.choice("XYZ") + name[cut + rng.randint(0, 1):]).strip()
        rows.append((i, " ".join(name.split()), rng.choice(["B1", "B1", "B1", "B2"])))
    rows += [(500 + i, "MAIN STREET", "B1") for i in range(8)]
    rows += [(600, None, "B1"), (601, "", "B1"), (602, "", "B1"), (None, "PARK", "B1"), (603, "PARK", None)]
    rows += [(700, "NORTH PARK A", "B1"), (700, "NORTH PARK B", "B1"), (700, "NORTH PARK B", "B1"), (701, "NORTH PARK B", "B1")]
    return rows


def records_of(spark, rows):
    return spark.createDataFrame(rows, "location_id int, zone_norm string, borough_norm string").cache()


def golden_pairs(rows, high, review):
    """The pairs of names to review, with the least id of each name and the records and record pairs behind them."""
    least, records, pairs = {}, Counter(), Counter()
    for i, name, block in rows:
        if i is not None and block is not None:
            records[block, name] += 1
            least[block, name] = min(i, least.get((block, name), i))
    for _, _, x, y, block, similarity, confidence, band in brute_pairs(rows, high, review):
        if band == "STEWARD_REVIEW":
            pairs[min(x, y), max(x, y), block, similarity, confidence, band] += 1
    return Counter(
        (least[p[2], p[0]], least[p[2], p[1]], *p, records[p[2], p[0]], records[p[2], p[1]], n) for p, n in pairs.items()
    )


@pytest.mark.parametrize("high, review", [(0.95, 0.80), (0.90, 0.55), (1.0, 0.85), (0.6, 0.31)])
def test_bands_queue_and_ledger_equal_brute_force(spark, high, review):
    rows = dirty_rows(seed=int(review * 100))
    per_copy = matching.copies(records_of(spark, rows)).cache()
    pairs = brute_pairs(rows, high, review)

    accepted = matching.accepted_names(per_copy, high, review).cache()
    wanted = Counter((min(p[2:4]), max(p[2:4]), *p[4:]) for p in pairs if p[7] != "REJECT")
    found = {
        (r.zone_a, r.zone_b, r.borough, r.name_similarity, r.match_confidence, r.decision): int(r.record_pairs)
        for r in accepted.collect()
    }
    assert found == dict(wanted) and found

    queue = matching.steward_queue(accepted, per_copy).collect()
    assert Counter(tuple(r)[:11] for r in queue) == golden_pairs(rows, high, review) and queue
    assert [r.match_confidence for r in queue] == sorted((r.match_confidence for r in queue), reverse=True)
    assert {r.review_status for r in queue} == {"PENDING"}

    ledger = {r.borough: r for r in matching.block_ledger(per_copy, accepted).collect()}
    for block in ("B1", "B2"):
        bands = Counter(p[7] for p in pairs if p[4] == block)
        line = ledger[block]
        assert line.total_pairs_compared == sum(bands.values())
        assert (line.auto_merge_pairs, line.steward_review_pairs, line.reject_pairs) == (
            bands["AUTO_MERGE"], bands["STEWARD_REVIEW"], bands["REJECT"],
        )


def test_names_equal_but_not_merged_at_a_high_above_one(spark):
    """Pairs inside one class reach the queue when the band says so."""
    rows = [(i, "SAME NAME", "B") for i in range(7)] + [(3, "SAME NAME", "B")]
    per_copy = matching.copies(records_of(spark, rows))
    queue = matching.steward_queue(matching.accepted_names(per_copy, high=1.5, review=0.8), per_copy)
    assert Counter(tuple(r)[:11] for r in queue.collect()) == golden_pairs(rows, 1.5, 0.8)


def test_copies_of_two_names_cost_one_row(spark):
    rows = [(i, "NORTH PARK A", "B") for i in range(300)] + [(1000 + i, "NORTH PARK B", "B") for i in range(300)]
    per_copy = matching.copies(records_of(spark, rows))
    queue = matching.steward_queue(matching.accepted_names(per_copy, review=0.8), per_copy).collect()
    assert [(r.id_a, r.id_b, r.records_a, r.records_b, int(r.record_pairs)) for r in queue] == [(0, 1000, 300, 300, 90_000)]


def test_keys_beyond_32_bits_stay(spark):
    wide = [(3_000_000_000 + i, f"PARK {i}", "B") for i in range(3)]
    zones = spark.createDataFrame(wide, "LocationID bigint, Zone string, Borough string")
    records = matching.normalize(zones)
    assert sorted(r.LocationID for r in matching.golden(records).collect()) == [w[0] for w in wide]
    assert matching.copies(records).count() == 3
    as_text = matching.normalize(zones.withColumn("LocationID", F.col("LocationID").cast("string")))
    assert as_text.filter("location_id IS NULL").count() == 0
    trips = spark.createDataFrame([(3_000_000_000,), (7_000_000_000,), (None,)], "PULocationID bigint")
    lost = stewardship.orphans_of(trips, zones, "PULocationID", "X").collect()
    assert {r.PULocationID_int for r in lost} == {7_000_000_000, None}
    with pytest.raises(Exception, match="does not fit into int"):
        conform.dim_export(zones.withColumn("service_zone", F.lit("s"))).collect()


def test_rejects_of_asked_records(spark):
    rows = dirty_rows(seed=5)
    records = records_of(spark, rows)
    rejected = [p for p in brute_pairs(rows, 0.95, 0.80) if p[7] == "REJECT"]
    asked = {3, 4, 600, 700}
    wanted = spark.createDataFrame([(i,) for i in asked], "location_id int")
    found = matching.reject_partners(records, wanted).select(
        "id_a", "id_b", "zone_a", "zone_b", "borough", "name_similarity", "match_confidence", "decision"
    )
    assert Counter(map(tuple, found.collect())) == Counter(p for p in rejected if p[0] in asked or p[1] in asked)
    everybody = records.select("location_id")
    assert matching.reject_partners(records, everybody).count() == len(rejected)


@pytest.mark.parametrize("tile", [1, 7, 5_000])
def test_rejects_do_not_depend_on_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(matching, "REJECT_TILE", tile)
    rows = dirty_rows(seed=6)
    records = records_of(spark, rows)
    asked = sorted({r[0] for r in rows if r[0] is not None})[::2]
    found = matching.reject_partners(records, spark.createDataFrame([(i,) for i in asked], "location_id int"))
    rejected = [p for p in brute_pairs(rows, 0.95, 0.80) if p[7] == "REJECT" and (p[0] in asked or p[1] in asked)]
    assert Counter((r["id_a"], r["id_b"], r["zone_a"], r["zone_b"]) for r in found.collect()) == Counter(p[:4] for p in rejected)


def test_a_large_block_is_dealt_over_tiles(spark, monkeypatch):
    """One block holds all records: none of the tiles that meet holds more than a bounded part of it."""
    monkeypatch.setattr(matching, "REJECT_TILE", 100)
    records = records_of(spark, [(i, f"N{i}X{i * 7919 % 1000}", "ONE") for i in range(2_000)])
    found = matching.reject_partners(records, spark.createDataFrame([(i,) for i in range(0, 2_000, 500)], "location_id int"))
    assert found.count() + found.select("id_a", "id_b").distinct().count() == 2 * found.count()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Join Inner") and "col#" in line)
    assert "row#" in join and "borough_norm#" in join


def test_review_threshold_must_be_selective(spark):
    with pytest.raises(ValueError, match="review threshold"):
        matching.accepted_names(matching.copies(records_of(spark, [(1, "A", "B")])), review=0.1)


@pytest.mark.parametrize("floor, tile", [(0.3, None), (0.5, 3), (0.7777, None), (0.7777, 2), (0.8889, None)])
def test_near_pairs_equal_brute_force(spark, monkeypatch, floor, tile):
    rng = random.Random(int(floor * 1000))
    texts = {"".join(rng.choice("AB ") for _ in range(rng.randint(0, 14))) for _ in range(150)}
    texts |= {"".join(rng.choice("ABC") for _ in range(rng.randint(8, 40))) for _ in range(40)}
    for base in list(texts)[:60]:
        if base:
            cut = rng.randrange(len(base))
            texts.add(base[:cut] + rng.choice(["", "A", "BB"]) + base[cut + 1:])
    names = spark.createDataFrame([("k", t) for t in sorted(texts)], "k string, text string")
    names = names.withColumns({"size": F.length("text"), "floor": F.lit(floor), "unlike": F.lit(None).cast("string")})
    hot = None
    if tile is not None:
        monkeypatch.setattr(similarity, "NAMES_PER_TILE", tile)
        hot = via_table(similarity.hot_segments(names, ["k"]), "hot")
        assert hot.count() > 0
    found = near_pairs(names, ["k"], hot).collect()
    pairs = Counter(frozenset((r.text_x, r.text_y)) for r in found)
    wanted = set()
    for a, b in combinations(texts, 2):
        longest = max(len(a), len(b))
        if edits(a, b) <= int(longest * (1 - floor)):
            wanted.add(frozenset((a, b)))
    assert set(pairs) == wanted and wanted
    assert set(pairs.values()) == {1}


def test_a_segment_of_few_short_and_many_long_names_is_cut(spark, monkeypatch):
    monkeypatch.setattr(similarity, "NAMES_PER_TILE", 20)
    # The short names fit one tile; with 300 longer ones they make more candidates than a tile holds.
    rows = [("k", f"STREET {i:02d}") for i in range(12)] + [("k", f"STREET {i:03d}") for i in range(300)]
    names = spark.createDataFrame(rows, "k string, text string").withColumns(
        {"size": F.length("text"), "floor": F.lit(0.75), "unlike": F.lit(None).cast("string")}
    )
    hot = via_table(similarity.hot_segments(names, ["k"]), "hot")
    assert hot.filter("parts_x = 1 AND parts_y > 1").count() > 0
    found = {tuple(sorted((r.text_x, r.text_y))) for r in near_pairs(names, ["k"], hot).collect()}
    assert found == {tuple(sorted((r.text_x, r.text_y))) for r in near_pairs(names, ["k"]).collect()} and found


def test_no_plan_holds_a_nested_loop_or_cross_product(spark, capsys):
    records = records_of(spark, dirty_rows(seed=1))
    per_copy = matching.copies(records)
    accepted = matching.accepted_names(per_copy)
    for df in (accepted, matching.steward_queue(accepted, per_copy), matching.block_ledger(per_copy, accepted)):
        df.explain()
        plan = capsys.readouterr().out
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_normalize_and_golden(spark):
    zones = spark.createDataFrame(
        [
            ("7", "Astoria / Park", " queens "), ("2", "astoria-park", "Queens"), ("x", "!!", "Queens"),
            ("9", None, "Queens"), ("4.0", "Jörg  Straße", None), (None, "ASTORIA PARK", "QUEENS"),
        ],
        "LocationID string, Zone string, Borough string",
    )
    rows = {r.Zone: r for r in matching.normalize(zones).collect()}
    assert rows["Astoria / Park"].zone_norm == rows["astoria-park"].zone_norm == "ASTORIA PARK"
    assert rows["!!"].zone_norm == "" and rows["!!"].location_id is None
    assert rows[None].zone_norm is None and rows[None].match_key == "QUEENS"
    assert rows["Jörg  Straße"].location_id == 4 and rows["Jörg  Straße"].match_key == "J RG STRASSE"

    golden = {r.match_key: r for r in matching.golden(matching.normalize(zones), "2024-01-01").collect()}
    assert golden["QUEENS::ASTORIA PARK"].LocationID is None, "a NULL id sorts first"
    assert golden["QUEENS::ASTORIA PARK"].mdm_state == "ACTIVE"
    assert len(golden) == 4

    unblocked = matching.normalize(zones.drop("Borough"))
    assert {r.borough_norm for r in unblocked.collect()} == {"UNKNOWN"}
    with pytest.raises(ValueError):
        matching.normalize(zones.drop("Zone"))


def test_golden_keeps_one_row_per_key_and_task_before_the_shuffle(spark, capsys):
    keyed = records_of(spark, [(1, "A", "B"), (2, "A", "C")]).withColumn("match_key", F.col("zone_norm"))
    matching.golden(keyed).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_audit_of_no_records(spark):
    records = records_of(spark, [])
    per_copy = matching.copies(records)
    ledger = matching.block_ledger(per_copy, matching.accepted_names(per_copy))
    audit = matching.match_audit(records, ledger, 0.95, 0.8, job_name="j").first()
    assert (audit.total_zone_rows, audit.total_pairs_compared, audit.reject_pairs) == (0, 0, 0)
    assert matching.mdm_scorecard(records, ledger, "r").first().observed_value == 0.0


def test_numbered_names_one_edit_apart_share_no_hot_segment(spark, monkeypatch):
    monkeypatch.setattr(similarity, "NAMES_PER_TILE", 20)
    texts = [f" {i:06d}" for i in range(0, 1000, 7)] + [f" {i:06d}0" for i in range(0, 90, 7)] + ["", " ", "0"]
    names = spark.createDataFrame([("k", t, len(t) + 9) for t in texts], "k string, text string, size int")
    names = names.withColumns({"floor": F.lit(0.89), "unlike": F.lit(None).cast("string")})
    assert similarity.hot_segments(names, ["k"]).count() == 0
    pairs = Counter(frozenset((r.text_x, r.text_y)) for r in near_pairs(names, ["k"]).collect())
    wanted = {frozenset(p) for p in combinations(texts, 2) if edits(*p) <= int((max(map(len, p)) + 9) * (1 - 0.89))}
    assert set(pairs) == wanted and set(pairs.values()) == {1}
