"""Dimension history, stewardship and run audit."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.text import exact_fingerprint, fingerprint
from tallyframe.operators import history, runs, stewardship

ZONE = "location_id int, borough string, zone_name string, service_zone string"
D1, D2, D3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def by_key(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.location_id, []).append(r)
    return {k: sorted(v, key=lambda r: r.effective_start_ts) for k, v in found.items()}


def test_history_over_three_loads(spark):
    first = spark.createDataFrame([(1, "Q", "a", "s"), (2, "Q", "b", "s"), (3, None, "c", "s"), (None, "Q", "n", "s"), (None, "Q", "m", "s")], ZONE)
    assert history.without_key(first, "location_id").count() == 2
    dim = history.apply_history(first, None, as_of=D1)
    assert {r.is_current for r in dim.collect()} == {True}

    second = spark.createDataFrame([(1, "Q", "a", "s"), (2, "Q", "b", "new"), (4, "Q", "d", "s"), (None, "Q", "n", "s")], ZONE)
    dim = history.apply_history(second, dim, as_of=D2)
    rows = by_key(dim)
    assert {k: len(v) for k, v in rows.items()} == {1: 1, 2: 2, 3: 1, 4: 1}, "a NULL key has no history"
    closed, current = rows[2]
    assert (closed.is_current, closed.effective_end_ts, closed.service_zone) == (False, D2, "s")
    assert (current.is_current, current.effective_start_ts, current.effective_end_ts) == (True, D2, None)
    assert rows[3][0].is_current, "a key missing from the feed stays"

    again = history.apply_history(second, dim, as_of=D3)
    assert sorted(map(str, again.collect())) == sorted(map(str, dim.collect())), "a repeated load changes nothing"

    third = spark.createDataFrame([(2, "Q", "b", "s")], ZONE)
    rows = by_key(history.apply_history(third, dim, as_of=D3))
    assert [r.is_current for r in rows[2]] == [False, False, True]
    assert sum(r.is_current for r in rows[2]) == 1 and rows[2][2].record_hash == rows[2][0].record_hash


def test_a_value_that_moves_to_another_attribute_is_a_change(spark):
    first = spark.createDataFrame([(1, None, "a", "b"), (2, "", "a", "b")], ZONE)
    second = spark.createDataFrame([(1, "a", None, "b"), (2, None, "a", "b")], ZONE)
    dim = history.apply_history(second, history.apply_history(first, None, as_of=D1), as_of=D2)
    assert {k: [r.is_current for r in v] for k, v in by_key(dim).items()} == {1: [False, True], 2: [False, True]}


def test_duplicate_keys_are_refused(spark):
    twice = spark.createDataFrame([(1, "Q", "a", "s"), (1, "Q", "b", "s")], ZONE)
    with pytest.raises(ValueError, match="duplicate"):
        history.apply_history(twice, None)


def test_fingerprints(spark):
    df = spark.createDataFrame([(None, "a", "b"), ("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert len({r[0] for r in df.select(fingerprint("x", "y", "z")).collect()}) == 1, "NULLs are skipped"
    assert len({r[0] for r in df.select(exact_fingerprint("x", "y", "z")).collect()}) == 3
    feed = spark.createDataFrame([("7", "Q", "a", "s")], "location_id string, borough string, zone_name string, service_zone string")
    row = history.zone_feed(feed).first()
    assert row.location_id == 7 and len(row.hashdiff) == 64


def test_orphans_once_per_missing_key(spark):
    trips = spark.createDataFrame([(1, "1", 2), (2, "x", 2), (3, None, None), (4, "9", 9), (5, "2", 9)], "id int, PULocationID string, DOLocationID int")
    master = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "LocationID string")
    rows = stewardship.orphans(trips, master, "job", as_of=D1).collect()
    found = sorted((r.id, r.orphan_type) for r in rows)
    pickup, dropoff = "PICKUP_NOT_IN_MASTER", "DROPOFF_NOT_IN_MASTER"
    assert found == sorted([(2, pickup), (3, pickup), (3, dropoff), (4, pickup), (4, dropoff), (5, dropoff)])
    assert rows[0].asDict().keys() >= {"PULocationID_int", "DOLocationID_int", "job_name", "detected_at_utc"}
    singly = [stewardship.orphans_of(trips, master, k, t) for k, t in stewardship.ORPHAN_TYPES.items()]
    assert sorted((r.id, r.orphan_type) for df in singly for r in df.collect()) == found
    with pytest.raises(ValueError):
        stewardship.orphans(trips.drop("DOLocationID"), master, "job")


def test_orphans_with_a_hot_key_and_no_broadcast(spark):
    """A third of the trips share one missing key, and Spark has to shuffle."""
    n = 30_000
    trips = spark.range(n).select(
        "id",
        F.when(F.col("id") < n // 3, 77).otherwise(F.col("id") % 50).cast("int").alias("PULocationID"),
        F.lit(1).alias("DOLocationID"),
    )
    master = spark.range(50).select(F.col("id").alias("LocationID"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert stewardship.orphans(trips, master, "job").count() == n // 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lifecycle_and_summary(spark):
    master = spark.createDataFrame([(1, "ACTIVE"), (2, "RETIRED"), (3, "ACTIVE")], "LocationID int, mdm_state string")
    assert {r.mdm_state: r.record_count for r in stewardship.lifecycle(master, "j").collect()} == {"ACTIVE": 2, "RETIRED": 1}
    assert [tuple(r)[:2] for r in stewardship.lifecycle(master.drop("mdm_state"), "j").collect()] == [("ACTIVE", 3)]
    trips = spark.range(5)
    summary = stewardship.run_summary(master, trips, trips.limit(0), "j", D1, orphans_out_path="/o")
    row = summary.first()
    assert (row.zones_count, row.trips_count, row.orphans_count, row.orphans_out_path) == (3, 5, 0, "/o")
    entry = stewardship.activity(summary, "r1").first()
    assert (entry.details, entry.actor) == ("zones=3, trips=5, orphans=0", "SYSTEM")


def test_run_audit(spark):
    events = [
        runs.run_event(spark, "a", runs.STARTED, "daily", as_of=D1),
        runs.run_event(spark, "a", runs.SUCCEEDED, "daily", as_of=D2),
        runs.run_event(spark, "b", runs.STARTED, "daily", as_of=D1),
        runs.run_event(spark, "b", runs.FAILED, "daily", error_message="boom", as_of=D1),
        runs.run_event(spark, "c", runs.STARTED, "daily", as_of=D3),
    ]
    log = events[0]
    for event in events[1:]:
        log = log.unionByName(event)
    rows = {r.run_id: r for r in runs.run_audit(log).collect()}
    assert (rows["a"].status, rows["a"].started_at, rows["a"].ended_at) == ("SUCCEEDED", D1, D2)
    assert (rows["b"].status, rows["b"].error_message) == ("FAILED", "boom")
    assert (rows["c"].status, rows["c"].ended_at) == ("STARTED", None)
    other = runs.run_event(spark, "b", runs.SUCCEEDED, "load_feed", as_of=D2)
    status = {(r.run_id, r.job_name): r.status for r in runs.run_audit(log.unionByName(other)).collect()}
    assert (status["b", "daily"], status["b", "load_feed"]) == ("FAILED", "SUCCEEDED")
    assert runs.absent_rows(log, other, ("run_id", "job_name")).count() == 1
    assert runs.absent_rows(log, events[0], "run_id").count() == 0
    assert runs.absent_rows(log, runs.run_event(spark, "d", runs.STARTED), "run_id").count() == 1
    assert runs.new_run_id(spark) != runs.new_run_id(spark)
