"""Ingest, enrichment, quality gate, conformed tables: edge rows by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.columns import first_present, pick, pick_any_case, require
from tallyframe.operators import conform, quality
from tallyframe.operators.enrich import enrich
from tallyframe.operators.ingest import validate

T0 = datetime(2024, 1, 1, 10, 0, 0)
T1 = datetime(2024, 1, 1, 10, 30, 30)


def test_column_lookup(spark):
    df = spark.createDataFrame([(1, 2)], "b int, LocationID int")
    assert first_present(df, ["a", "b"]) == "b" and first_present(df, ["B"]) is None
    assert pick(df, "x", "LocationID") == "LocationID"
    assert pick_any_case(df, "locationid") == "LocationID"
    for call in (lambda: pick(df, "x"), lambda: pick_any_case(df, "x"), lambda: require(df, "b", "x")):
        with pytest.raises(ValueError):
            call()


TRIPS = [
    (1, T0, T1, 5.0),
    (2, T0, T0, 5.0),  # no duration is kept
    (3, T1, T0, 5.0),
    (4, None, T1, 5.0),
    (5, T0, None, 5.0),
    (6, T0, T1, 0.0),
    (7, T0, T1, -1.0),
    (8, T0, T1, None),
]


@pytest.mark.parametrize("prefix", ["tpep_", "lpep_", ""])
def test_validate_keeps_plausible_trips(spark, prefix):
    trips = spark.createDataFrame(
        TRIPS, f"id int, {prefix}pickup_datetime timestamp, {prefix}dropoff_datetime timestamp, fare_amount double"
    )
    rows = validate(trips, as_of="2024-06-01").collect()
    assert sorted(r.id for r in rows) == [1, 2]
    assert rows[0].pickup_date == date(2024, 1, 1) and rows[0].governance_zone == "validated"
    assert sorted(r.id for r in validate(trips.drop("fare_amount")).collect()) == [1, 2, 6, 7, 8]
    with pytest.raises(ValueError):
        validate(trips.drop(f"{prefix}dropoff_datetime"))


def test_validate_prefers_the_first_variant_and_reads_text(spark):
    trips = spark.createDataFrame(
        [("2024-01-01 10:00:00", "2023-01-01 00:00:00", "2024-01-01 11:00:00", "7.5"), ("bad", "2023-01-01", "2024-01-01", "1")],
        "tpep_pickup_datetime string, pickup_datetime string, dropoff_datetime string, fare_amount string",
    )
    rows = validate(trips).collect()
    assert [r.pickup_ts for r in rows] == [T0]


def test_validation_filters_reach_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "trips")
    spark.createDataFrame(
        TRIPS, "id int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, fare_amount double"
    ).write.parquet(path)
    validate(spark.read.parquet(path)).select("id").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("IsNotNull(tpep_pickup_datetime)", "IsNotNull(tpep_dropoff_datetime)", "GreaterThan(fare_amount,0.0)"):
        assert part in pushed
    assert "Exchange" not in plan


def test_enrich_roles_duplicates_and_unreadable_keys(spark):
    trips = spark.createDataFrame(
        [(1, T0, T1, 10, 20), (2, datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000), None, 99)],
        "id int, pickup_ts timestamp, dropoff_ts timestamp, PULocationID int, DOLocationID int",
    )
    zones = spark.createDataFrame(
        [("10", "Q", "Ten", "S"), ("20", "B", "Twenty", "S"), ("20", "B", "Twenty again", "S"), ("N/A", "?", "?", "?")],
        "LocationID string, Borough string, Zone string, service_zone string",
    )
    rows = sorted(enrich(trips, zones, as_of="2024-06-01").collect(), key=lambda r: (r.id, r.do_zone or ""))
    assert [(r.id, r.pu_zone, r.do_zone) for r in rows] == [
        (1, "Ten", "Twenty"), (1, "Ten", "Twenty again"), (2, None, None),
    ]
    assert rows[0].trip_duration_min == 30.5 and rows[2].trip_duration_min == 1 / 60.0
    assert rows[0].governance_zone == "curated"
    assert "do_zone" not in enrich(trips.drop("DOLocationID"), zones).columns


GATE = "VendorID int, pickup_datetime timestamp, dropoff_datetime timestamp, fare_amount double, passenger_count double"
GATE_ROWS = [
    (1, T0, T1, 1.0, 1.0),
    (None, T0, T1, None, None),
    (1, None, T1, -1.0, 8.0),
    (1, T1, T0, 0.0, 9.0),
]


def test_gate_flags_and_split(spark):
    trips = spark.createDataFrame(GATE_ROWS, GATE)
    rules = quality.trip_rules(trips)
    assert [r.name for r in rules] == [
        "vendor_not_null", "pickup_not_null", "dropoff_not_null", "pickup_before_dropoff",
        "fare_amount_non_negative", "passenger_count_range",
    ]
    failed = [r.failed_rules for r in quality.flag(trips, rules).collect()]
    assert failed == [
        [],
        ["vendor_not_null"],
        ["pickup_not_null", "pickup_before_dropoff", "fare_amount_non_negative"],
        ["pickup_before_dropoff", "passenger_count_range"],
    ]
    good, bad = quality.passed(trips, rules), quality.quarantined(trips, rules)
    assert good.columns == trips.columns and good.count() == 1
    assert bad.count() == 3 and "dq_pass" not in bad.columns and {"failed_rules", "vendor_not_null"} <= set(bad.columns)


def test_gate_reports(spark):
    trips = spark.createDataFrame(GATE_ROWS, GATE)
    summary = quality.summarize(trips, quality.trip_rules(trips), "2024-06-01", base_source="INPUT")
    row = summary.first()
    assert (row.total_rows, row.passed_rows, row.failed_rows, row.pickup_before_dropoff_fail_count) == (4, 1, 3, 2)
    card = {r.business_metric: r for r in quality.scorecard(summary, "r1").collect()}
    assert len(card) == 6
    assert card["% trips with dropoff before pickup"].observed_value == 0.5
    zone = card["% trips missing pickup zone"]
    assert (zone.failed_rows, zone.pass_fail) == (0, "PASS"), "a rule that was not run counts as passed"
    domain = quality.by_domain(quality.scorecard(summary, "r1")).first()
    assert (domain.failed_rules, domain.total_rules, domain.avg_rule_fail_rate) == (3, 6, pytest.approx(1 / 6))


def test_gate_on_no_rows_and_no_rules(spark):
    empty = spark.createDataFrame([], GATE)
    summary = quality.summarize(empty, quality.trip_rules(empty))
    assert tuple(summary.first()[:3]) == (0, 0, 0)
    assert {r.observed_value for r in quality.scorecard(summary, "r").collect()} == {0.0}
    other = spark.createDataFrame([(1,)], "x int")
    row = quality.flag(other, quality.trip_rules(other)).first()
    assert row.dq_pass is True and row.failed_rules == []
    assert quality.passed(other, []).count() == 1 and quality.quarantined(other, []).count() == 0


def test_gate_prefers_plain_over_lpep_and_falls_back_to_derived_times(spark):
    assert quality.GATE_PICKUP_NAMES.index("pickup_datetime") < quality.GATE_PICKUP_NAMES.index("lpep_pickup_datetime")
    derived = spark.createDataFrame([(T0, T1)], "pickup_ts timestamp, dropoff_ts timestamp")
    assert [r.name for r in quality.trip_rules(derived)] == ["pickup_not_null", "dropoff_not_null", "pickup_before_dropoff"]


def test_summary_reads_only_rule_columns(spark, tmp_path, capsys):
    path = str(tmp_path / "wide")
    spark.createDataFrame(GATE_ROWS, GATE).withColumn("unused", F.lit("x")).write.parquet(path)
    trips = spark.read.parquet(path)
    quality.summarize(trips, quality.trip_rules(trips)).explain("formatted")
    schema = next(line for line in capsys.readouterr().out.splitlines() if "ReadSchema" in line)
    assert "unused" not in schema and "VendorID" in schema


def test_exports_and_staging(spark):
    zones = spark.createDataFrame([("1", "Q", "Z", None)], "LocationID string, Borough string, Zone string, ServiceZone string")
    assert conform.dim_export(zones).columns == ["location_id", "borough", "zone", "service_zone"]
    trips = spark.createDataFrame(
        [(T0, T1, 1, 2, 3, 2.9, 1.5, 2.5, 0.5, 3.0, 1, "extra column")],
        "pickup_datetime timestamp, lpep_dropoff_datetime timestamp, PULocationID bigint, do_location_id int, VendorID int, "
        "passenger_count double, trip_distance double, fare_amount double, tip_amount double, total_amount double, "
        "payment_type int, other string",
    )
    fact = conform.fact_export(trips)
    assert fact.columns == list(conform.FACT_TRIP) and fact.first().passenger_count == 2
    with pytest.raises(ValueError):
        conform.fact_export(trips.drop("tip_amount"))
    feed = spark.createDataFrame([("5", "Q", "Z", "S"), ("x", "Q", "Z", "S")], "LOCATIONID string, borough string, ZONE string, Service_Zone string")
    staged = conform.zone_staging(feed, "r1", "2024-06-01")
    assert staged.columns == ["location_id", "borough", "zone_name", "service_zone", "ingested_at", "run_id"]
    assert [r.location_id for r in staged.collect()] == [5, None]


def test_certified_minutes_are_whole_and_only_current_zones_join(spark):
    fact = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 50), datetime(2024, 1, 1, 0, 1, 10), 1, 9, 1, 1, 1.0, 1.0, 0.0, 4.0, 1)],
        "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int, dropoff_location_id int, vendor_id int, "
        "passenger_count int, trip_distance double, fare_amount double, tip_amount double, total_amount double, payment_type int",
    )
    dim = spark.createDataFrame(
        [(1, "Q", "old", "S", False), (1, "Q", "new", "S", True), (9, "B", "gone", "S", None)],
        "location_id int, borough string, zone string, service_zone string, is_current boolean",
    )
    row = conform.certified_trips(fact, dim).first()
    assert (row.trip_minutes, row.pu_zone, row.do_zone) == (0, "new", None)
    assert len(row) == 18
    top = conform.top_boroughs(conform.certified_trips(fact, dim)).first()
    assert (top.pu_borough, top.trips, top.avg_total) == ("Q", 1, 4.0)


def test_enrich_with_hot_and_null_keys_and_no_broadcast(spark):
    """A third of the trips share one zone and a third have none, and Spark has to shuffle."""
    n = 30_000
    key = F.when(F.col("id") < n // 3, 7).when(F.col("id") >= 2 * n // 3, F.col("id") % 50).cast("int")
    trips = spark.range(n).select(
        "id", F.lit(T0).alias("pickup_ts"), F.lit(T1).alias("dropoff_ts"), key.alias("PULocationID")
    )
    zones = spark.range(40).select(
        F.col("id").cast("string").alias("LocationID"), F.lit("Q").alias("Borough"),
        F.concat(F.lit("zone "), F.col("id")).alias("Zone"), F.lit("S").alias("service_zone"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = enrich(trips, zones)
        assert rows.count() == n
        assert rows.filter("pu_zone IS NULL").count() == n // 3 + n // 3 // 50 * 10
        assert rows.filter("pu_zone <> concat('zone ', PULocationID)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
