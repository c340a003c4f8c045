"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.casts import whole_minutes
from tallyframe.operators import conform, history, matching, quality, runs, stewardship, survivorship
from tallyframe.operators.enrich import enrich
from tallyframe.operators.ingest import validate
from tallyframe.plans import daily, sample_tables as st, serving
from tallyframe.plans.sample_tables import AS_OF, JOB, RUN_ID
from tallyframe.sources import buckets, readers, tablelog, writers
from tallyframe.sources.scratch import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None):
    """Register a query under its function name, with its SQL."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: st.plain(build(spark, folder))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


NOW = f"TIMESTAMP '{AS_OF}'"

# ---------------------------------------------------------------- ingest and enrichment

VALIDATED_SQL = f"""
    validated AS (
        SELECT *, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
               CAST(tpep_pickup_datetime AS date) AS pickup_date, 'validated' AS governance_zone,
               {NOW} AS ingested_at, 'NYC_TLC' AS source_system
        FROM trips
        WHERE tpep_dropoff_datetime >= tpep_pickup_datetime AND fare_amount > 0
    )"""

CURATED_SQL = f"""
    curated AS (
        SELECT v.* REPLACE ('curated' AS governance_zone),
               (floor(epoch(dropoff_ts)) - floor(epoch(pickup_ts))) / 60.0 AS trip_duration_min,
               pu.LocationID AS pu_location_id, pu.Zone AS pu_zone, pu.Borough AS pu_borough,
               pu.service_zone AS pu_service_zone,
               dz.LocationID AS do_location_id, dz.Zone AS do_zone, dz.Borough AS do_borough,
               dz.service_zone AS do_service_zone,
               {NOW} AS curated_at
        FROM validated v
        LEFT JOIN zones pu ON v.PULocationID = pu.LocationID
        LEFT JOIN zones dz ON v.DOLocationID = dz.LocationID
    )"""


def _validated(spark, folder):
    return validate(st.trips(spark, folder), as_of=AS_OF)


def _curated(spark, folder):
    return enrich(_validated(spark, folder), st.zones(spark, folder), as_of=AS_OF)


@registered(f"WITH {st.TRIPS_SQL}, {VALIDATED_SQL} SELECT * FROM validated")
def validated_trips(spark, folder):
    return _validated(spark, folder)


@registered(
    f"""WITH {st.TRIPS_SQL}, {VALIDATED_SQL}
    SELECT pickup_date, count(*) AS trips FROM validated GROUP BY pickup_date"""
)
def validated_by_date(spark, folder):
    path = scratch_folder(spark, "validated")
    writers.overwrite_partitioned(_validated(spark, folder), path, "pickup_date")
    return readers.read_parquet(spark, path).groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))


@registered(f"WITH {st.TRIPS_SQL}, {st.ZONES_SQL}, {VALIDATED_SQL}, {CURATED_SQL} SELECT * FROM curated")
def curated_trips(spark, folder):
    return _curated(spark, folder)


# ---------------------------------------------------------------- conformed tables and serving

DIM_SQL = """
    dim_zone AS (
        SELECT CAST(LocationID AS int) AS location_id, Borough AS borough, Zone AS zone, service_zone FROM zones
    )"""

FACT_SQL = """
    fact_trip AS (
        SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
               CAST(PULocationID AS int) AS pickup_location_id, CAST(DOLocationID AS int) AS dropoff_location_id,
               CAST(VendorID AS int) AS vendor_id, CAST(passenger_count AS int) AS passenger_count,
               CAST(trip_distance AS double) AS trip_distance, CAST(fare_amount AS double) AS fare_amount,
               CAST(tip_amount AS double) AS tip_amount, CAST(total_amount AS double) AS total_amount,
               CAST(payment_type AS int) AS payment_type
        FROM trips
    )"""

CERTIFIED_SQL = """
    certified AS (
        SELECT pickup_datetime, dropoff_datetime, date_sub('minute', pickup_datetime, dropoff_datetime) AS trip_minutes,
               vendor_id, passenger_count, trip_distance, payment_type, fare_amount, tip_amount, total_amount,
               pickup_location_id, pu.zone AS pu_zone, pu.borough AS pu_borough, pu.service_zone AS pu_service_zone,
               dropoff_location_id, dz.zone AS do_zone, dz.borough AS do_borough, dz.service_zone AS do_service_zone
        FROM fact_trip f
        LEFT JOIN dim_zone pu ON f.pickup_location_id = pu.location_id
        LEFT JOIN dim_zone dz ON f.dropoff_location_id = dz.location_id
    )"""

SERVED_SQL = f"WITH {st.TRIPS_SQL}, {st.ZONES_SQL}, {DIM_SQL}, {FACT_SQL}, {CERTIFIED_SQL}"

TOP_SQL = f"""{SERVED_SQL}
    SELECT pu_borough, count(*) AS trips, round(avg(total_amount), 2) AS avg_total
    FROM certified GROUP BY pu_borough ORDER BY trips DESC, pu_borough NULLS LAST LIMIT 20"""


def _dimension(spark, folder):
    """The zones as a type 2 dimension: current rows, and a closed version of each that must not join."""
    zones = conform.dim_export(st.zones(spark, folder))
    values = ("borough", "zone", "service_zone")
    first = history.apply_history(zones, None, "location_id", values, st.EARLIER, checked=True)
    closed = first.withColumns(
        {"zone": F.lit("closed"), "is_current": F.lit(False), "effective_end_ts": F.lit(AS_OF).cast("timestamp")}
    )
    return first.unionByName(closed)


def _rounded(top):
    return top.withColumn("avg_total", F.round("avg_total", 2))


@registered(f"WITH {st.ZONES_SQL}, {DIM_SQL} SELECT * FROM dim_zone")
def dim_zone_export(spark, folder):
    return conform.dim_export(st.zones(spark, folder))


@registered(f"WITH {st.TRIPS_SQL}, {FACT_SQL} SELECT * FROM fact_trip")
def fact_trip_export(spark, folder):
    return conform.fact_export(st.trips(spark, folder))


@registered(f"{SERVED_SQL} SELECT * FROM certified")
def certified_trip_zone(spark, folder):
    return conform.certified_trips(conform.fact_export(st.trips(spark, folder)), _dimension(spark, folder))


@registered(f"{SERVED_SQL} SELECT trip_minutes, count(*) AS trips FROM certified GROUP BY trip_minutes")
def trip_minutes(spark, folder):
    """Over the fact alone: the certified join keeps every trip once and adds nothing that this counts."""
    facts = conform.fact_export(st.trips(spark, folder))
    minutes = facts.select(whole_minutes("pickup_datetime", "dropoff_datetime").alias("trip_minutes"))
    return minutes.groupBy("trip_minutes").agg(F.count(F.lit(1)).alias("trips"))


@registered(TOP_SQL)
def top_boroughs(spark, folder):
    facts, dim = conform.fact_export(st.trips(spark, folder)), _dimension(spark, folder)
    return _rounded(conform.top_boroughs(conform.certified_trips(facts, dim)))


def _export_and_serve(spark, folder):
    """Exports, databases, external tables and view, in databases of their own; returns the curated database."""
    root, token = scratch_folder(spark, "serving"), uuid.uuid4().hex[:12]
    writers.overwrite(_dimension(spark, folder), f"{root}/dim_zone")
    writers.overwrite(conform.fact_export(st.trips(spark, folder)), f"{root}/fact_trip")
    serving.serve(spark, f"zone_master_{token}", f"trip_curated_{token}", f"{root}/dim_zone", f"{root}/fact_trip")
    return f"trip_curated_{token}"


@registered(f"{SERVED_SQL} SELECT * FROM certified")
def certified_view_sql(spark, folder):
    return serving.certified_view(spark, _export_and_serve(spark, folder))


@registered(TOP_SQL)
def top_boroughs_sql(spark, folder):
    return _rounded(serving.top_boroughs_sql(spark, _export_and_serve(spark, folder)))


@registered(
    f"""WITH {st.TRIPS_SQL}, {st.ZONES_SQL}, {DIM_SQL}, {FACT_SQL}
    SELECT 'dim_zone' AS loaded, count(*) AS row_count, count(DISTINCT location_id) AS ids FROM dim_zone
    UNION ALL
    SELECT 'fact_trip', count(*), count(DISTINCT pickup_location_id) FROM fact_trip"""
)
def replace_load(spark, folder):
    root, database = scratch_folder(spark, "warehouse"), f"warehouse_{uuid.uuid4().hex[:12]}"
    spark.sql("CREATE DATABASE IDENTIFIER(:db) LOCATION :path", args={"db": database, "path": f"{root}/{database}"})
    dim_path, fact_path = f"{root}/dim_zone", f"{root}/fact_trip"
    writers.overwrite(conform.dim_export(st.zones(spark, folder)), dim_path)
    writers.overwrite(conform.fact_export(st.trips(spark, folder)), fact_path)
    # The second load replaces the first.
    daily.load_warehouse(spark, dim_path, fact_path, database)
    daily.load_warehouse(spark, dim_path, fact_path, database)

    def counted(table, key):
        return spark.table(f"{database}.{table}").agg(
            F.lit(table).alias("loaded"),
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(key).alias("ids"),
        )

    return counted("dim_zone", "location_id").unionByName(counted("fact_trip", "pickup_location_id"))


# ---------------------------------------------------------------- quality gate

RULES_SQL = {
    "vendor_not_null": "VendorID IS NOT NULL",
    "pickup_not_null": "tpep_pickup_datetime IS NOT NULL",
    "dropoff_not_null": "tpep_dropoff_datetime IS NOT NULL",
    "pickup_before_dropoff": "tpep_pickup_datetime <= tpep_dropoff_datetime",
    "pu_location_not_null": "PULocationID IS NOT NULL",
    "do_location_not_null": "DOLocationID IS NOT NULL",
    **{f"{name}_non_negative": f"({name} IS NULL OR {name} >= 0)" for name in quality.AMOUNTS},
    "passenger_count_range": "(passenger_count IS NULL OR passenger_count BETWEEN 0 AND 8)",
    "ratecode_range": "(RatecodeID IS NULL OR RatecodeID BETWEEN 1 AND 6)",
}

_FLAGS = ", ".join(f"coalesce({test}, false) AS {name}" for name, test in RULES_SQL.items())
_ALL = " AND ".join(RULES_SQL)
_FAILED = ", ".join(f"CASE WHEN NOT {name} THEN '{name}' END" for name in RULES_SQL)
FLAGGED_SQL = f"""
    marked AS (SELECT *, {_FLAGS} FROM trips),
    flagged AS (SELECT *, ({_ALL}) AS dq_pass, concat_ws('|', {_FAILED}) AS failed_rules FROM marked)"""

SUMMARY_SQL = f"""
    summary AS (
        SELECT count(*) AS total_rows, count(*) FILTER (dq_pass) AS passed_rows,
               count(*) FILTER (NOT dq_pass) AS failed_rows,
               {", ".join(f"count(*) FILTER (NOT {name}) AS {name}_fail_count" for name in RULES_SQL)},
               'check' AS job_name, 'INPUT' AS base_source, {NOW} AS generated_at_utc
        FROM flagged
    )"""

_CARD_LINES = " UNION ALL ".join(
    f"SELECT '{meta.domain}' AS domain, '{meta.quality_dimension}' AS quality_dimension, "
    f"'{meta.business_metric}' AS business_metric, '{meta.owner}' AS owner, '{meta.threshold}' AS threshold, "
    f"'{meta.action_on_failure}' AS action_on_failure, {name}_fail_count AS failed_rows, total_rows FROM summary"
    for name, meta in quality.TRIP_GOVERNANCE.items()
)
CARD_SQL = f"""
    lines AS ({_CARD_LINES}),
    card AS (
        SELECT '{RUN_ID}' AS run_id, '{AS_OF}' AS generated_at_utc, domain, quality_dimension, business_metric, owner,
               threshold, action_on_failure,
               CAST(round(CAST(CAST(failed_rows / total_rows AS varchar) AS decimal(38, 20)), 6) AS double)
                   AS observed_value,
               CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS pass_fail, failed_rows, total_rows
        FROM lines
    )"""
GATE_SQL = f"WITH {st.TRIPS_SQL}, {FLAGGED_SQL}"


def _summary(spark, folder):
    trips = st.trips(spark, folder)
    return quality.summarize(trips, quality.trip_rules(trips), AS_OF, job_name=JOB, base_source="INPUT")


def _card(spark, folder):
    return quality.scorecard(_summary(spark, folder), RUN_ID)


@registered(f"{GATE_SQL} SELECT * FROM flagged")
def dq_flags(spark, folder):
    trips = st.trips(spark, folder)
    return quality.flag(trips, quality.trip_rules(trips))


@registered(f"{GATE_SQL} SELECT t.* EXCLUDE (dq_pass, failed_rules, {', '.join(RULES_SQL)}) FROM flagged t WHERE dq_pass")
def dq_passed(spark, folder):
    trips = st.trips(spark, folder)
    return quality.passed(trips, quality.trip_rules(trips))


@registered(f"{GATE_SQL} SELECT * EXCLUDE (dq_pass) FROM flagged WHERE NOT dq_pass")
def dq_quarantine(spark, folder):
    trips = st.trips(spark, folder)
    return quality.quarantined(trips, quality.trip_rules(trips))


@registered(f"{GATE_SQL}, {SUMMARY_SQL} SELECT * FROM summary")
def dq_summary(spark, folder):
    return _summary(spark, folder)


@registered(f"{GATE_SQL}, {SUMMARY_SQL}, {CARD_SQL} SELECT * FROM card")
def dq_scorecard(spark, folder):
    return _card(spark, folder)


@registered(
    f"""{GATE_SQL}, {SUMMARY_SQL}, {CARD_SQL}
    SELECT run_id, domain, round(avg(observed_value), 6) AS avg_rule_fail_rate,
           count(*) FILTER (pass_fail = 'FAIL') AS failed_rules, count(*) AS total_rules, {NOW} AS generated_at_utc
    FROM card GROUP BY run_id, domain"""
)
def dq_by_domain(spark, folder):
    result = quality.by_domain(_card(spark, folder), AS_OF)
    return result.withColumn("avg_rule_fail_rate", F.round("avg_rule_fail_rate", 6))


_FAIL_COUNTS = ", ".join(f"{name}_fail_count" for name in RULES_SQL)


@registered(
    f"""{GATE_SQL}, {SUMMARY_SQL}
    SELECT origin, total_rows, passed_rows, failed_rows, {_FAIL_COUNTS}, {NOW} AS generated_at_utc
    FROM summary, (VALUES ('observed'), ('stored')) AS origins(origin)"""
)
def dq_observed(spark, folder):
    """What was counted while the flagged rows were stored, beside the counts of the stored rows."""
    trips = st.trips(spark, folder)
    rules = quality.trip_rules(trips)
    flagged, seen = daily.store_flagged(trips, rules)
    observed = quality.observed_summary(spark, seen, rules, AS_OF, origin="observed")
    return observed.unionByName(quality.count_flags(flagged, rules, AS_OF, origin="stored"))


_LIMIT_LINES = " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, '{meta.action_on_failure}' AS action_on_failure, "
    f"CAST({quality.TRIP_LIMITS[name]} AS double) AS limit_share, {name}_fail_count AS failed_rows, total_rows FROM summary"
    for name, meta in quality.TRIP_GOVERNANCE.items()
)


@registered(
    f"""{GATE_SQL}, {SUMMARY_SQL}, limits AS ({_LIMIT_LINES})
    SELECT *, CASE WHEN failed_rows = 0 THEN 'PASS'
                   WHEN action_on_failure = 'Block load' AND failed_rows / total_rows >= limit_share THEN 'BLOCK'
                   ELSE 'WARN' END AS verdict
    FROM limits"""
)
def dq_enforced(spark, folder):
    return quality.enforce(_summary(spark, folder))


# ---------------------------------------------------------------- matching

MATCH_SQL = f"WITH {st.RECORDS_SQL}, {st.SCORED_SQL}"

LEDGER_SQL = """
    ledger AS (
        SELECT borough_norm AS borough, count(*) AS records,
               CAST(coalesce(max(pairs), 0) AS bigint) AS total_pairs_compared,
               CAST(coalesce(max(auto_pairs), 0) AS bigint) AS auto_merge_pairs,
               CAST(coalesce(max(review_pairs), 0) AS bigint) AS steward_review_pairs,
               CAST(coalesce(max(rejected), 0) AS bigint) AS reject_pairs
        FROM records
        LEFT JOIN (
            SELECT borough AS block, count(*) AS pairs, count(*) FILTER (decision = 'AUTO_MERGE') AS auto_pairs,
                   count(*) FILTER (decision = 'STEWARD_REVIEW') AS review_pairs,
                   count(*) FILTER (decision = 'REJECT') AS rejected
            FROM scored GROUP BY borough
        ) banded ON block = borough_norm
        GROUP BY borough_norm
    )"""

TOTALS_SQL = """
    totals AS (
        SELECT CAST(sum(records) AS bigint) AS total_zone_rows,
               CAST(sum(total_pairs_compared) AS bigint) AS total_pairs_compared,
               CAST(sum(auto_merge_pairs) AS bigint) AS auto_merge_pairs,
               CAST(sum(steward_review_pairs) AS bigint) AS steward_review_pairs,
               CAST(sum(reject_pairs) AS bigint) AS reject_pairs
        FROM ledger
    )"""


def _ledger(spark, folder):
    records = st.part_records(spark, folder)
    return records, matching.block_ledger(*daily.accept(records))


@registered(
    f"""WITH {st.RECORDS_SQL}
    SELECT *, borough_norm || '::' || zone_norm AS match_key FROM records"""
)
def match_normalized(spark, folder):
    return st.part_records(spark, folder)


@registered(
    f"""{MATCH_SQL}, classes AS (SELECT borough_norm, zone_norm, count(*) AS n FROM records GROUP BY ALL)
    SELECT borough, least(zone_a, zone_b) AS zone_a, greatest(zone_a, zone_b) AS zone_b,
           any_value(a.n) AS records_a, any_value(b.n) AS records_b,
           CAST(count(*) AS bigint) AS record_pairs, name_similarity,
           split_part(least(zone_a, zone_b), ' ', 1) AS token_a,
           split_part(greatest(zone_a, zone_b), ' ', 1) AS token_b,
           token_match, match_confidence, decision
    FROM scored
    JOIN classes a ON a.borough_norm = borough AND a.zone_norm = least(zone_a, zone_b)
    JOIN classes b ON b.borough_norm = borough AND b.zone_norm = greatest(zone_a, zone_b)
    WHERE decision <> 'REJECT'
    GROUP BY ALL"""
)
def match_pairs(spark, folder):
    return daily.accept(st.part_records(spark, folder))[1]


@registered(
    f"""{MATCH_SQL}, golden_ids AS (
        SELECT borough_norm, zone_norm, min(location_id) AS id, count(*) AS n FROM records GROUP BY ALL
    )
    SELECT any_value(a.id) AS id_a, any_value(b.id) AS id_b, least(zone_a, zone_b) AS zone_a,
           greatest(zone_a, zone_b) AS zone_b, borough, name_similarity, match_confidence, decision,
           any_value(a.n) AS records_a, any_value(b.n) AS records_b, CAST(count(*) AS bigint) AS record_pairs,
           'PENDING' AS review_status, {NOW} AS submitted_at_utc
    FROM scored
    JOIN golden_ids a ON a.borough_norm = borough AND a.zone_norm = least(zone_a, zone_b)
    JOIN golden_ids b ON b.borough_norm = borough AND b.zone_norm = greatest(zone_a, zone_b)
    WHERE decision = 'STEWARD_REVIEW'
    GROUP BY borough, least(zone_a, zone_b), greatest(zone_a, zone_b), name_similarity, match_confidence, decision"""
)
def steward_queue(spark, folder):
    per_copy, accepted = daily.accept(st.part_records(spark, folder))
    return matching.steward_queue(accepted, per_copy, AS_OF)


@registered(f"{MATCH_SQL}, {LEDGER_SQL} SELECT * FROM ledger")
def match_ledger(spark, folder):
    return _ledger(spark, folder)[1]


@registered(
    f"""{MATCH_SQL}, {LEDGER_SQL}, {TOTALS_SQL}
    SELECT *, CAST(0.95 AS double) AS high_conf_threshold, CAST(0.80 AS double) AS med_conf_threshold,
           'check' AS job_name, {NOW} AS generated_at_utc FROM totals"""
)
def match_audit(spark, folder):
    records, ledger = _ledger(spark, folder)
    return matching.match_audit(records, ledger, 0.95, 0.80, AS_OF, job_name=JOB)


_MDM_TEXTS = ", ".join(f"'{value}' AS {name}" for name, value in matching.MDM_SCORECARD.items())


@registered(
    f"""{MATCH_SQL}, {LEDGER_SQL}, {TOTALS_SQL}
    SELECT '{RUN_ID}' AS run_id, {_MDM_TEXTS},
           round(CAST(auto_merge_pairs + steward_review_pairs AS double) / CAST(total_pairs_compared AS double), 6)
               AS observed_value,
           total_zone_rows AS total_records, total_pairs_compared AS pairs_compared, auto_merge_pairs,
           steward_review_pairs, reject_pairs, {NOW} AS generated_at_utc
    FROM totals"""
)
def mdm_scorecard(spark, folder):
    records, ledger = _ledger(spark, folder)
    return matching.mdm_scorecard(records, ledger, RUN_ID, AS_OF)


GOLDEN_SQL = f"""
    golden AS (
        SELECT location_id AS LocationID, Zone, Borough, zone_norm, borough_norm,
               borough_norm || '::' || zone_norm AS match_key, 'ACTIVE' AS mdm_state,
               {NOW} AS created_at_utc, {NOW} AS updated_at_utc,
               'min(location_id) per match_key' AS survivorship_rule
        FROM records
        QUALIFY row_number() OVER (PARTITION BY borough_norm, zone_norm ORDER BY location_id) = 1
    )"""


@registered(f"WITH {st.RECORDS_SQL}, {GOLDEN_SQL} SELECT * FROM golden")
def golden_master(spark, folder):
    return matching.golden(st.part_records(spark, folder), AS_OF)


# ---------------------------------------------------------------- survivors and families

MEMBERS_SQL = f"""
    links AS (SELECT DISTINCT borough, zone_a, zone_b FROM scored WHERE match_confidence >= 0.80 AND zone_a <> zone_b),
    both_ways AS (FROM links UNION SELECT borough, zone_b, zone_a FROM links),
    keys AS (
        SELECT borough_norm AS borough, zone_norm AS name, min(location_id) AS id, count(*) AS n FROM records GROUP BY ALL
    ),
    reached AS (
        SELECT borough, name, name AS other FROM keys
        UNION
        SELECT r.borough, r.name, l.zone_b FROM reached r JOIN both_ways l ON l.borough = r.borough AND l.zone_a = r.other
    ),
    members AS (
        SELECT r.borough, r.name, r.borough || '::' || r.name AS match_key, any_value(k.id) AS location_id,
               any_value(k.n) AS records, min(o.id) AS survivor_id, arg_min(r.borough || '::' || o.name, o.id) AS survivor_key
        FROM reached r JOIN keys k ON k.borough = r.borough AND k.name = r.name
        JOIN keys o ON o.borough = r.borough AND o.name = r.other
        GROUP BY r.borough, r.name
    )"""
MERGED_SQL = f"WITH RECURSIVE {st.RECORDS_SQL}, {st.SCORED_SQL}, {MEMBERS_SQL}"
_STATE = "CASE WHEN match_key = survivor_key THEN 'ACTIVE' ELSE 'MERGED' END AS mdm_state"
#: The given names have no AUTO_MERGE pairs at 0.95 besides equal ones.
MERGE_AT = 0.80


@registered(f"{MERGED_SQL} SELECT *, {_STATE} FROM members")
def golden_members(spark, folder):
    return daily.merged_members(st.part_records(spark, folder), MERGE_AT)


@registered(
    f"""{MERGED_SQL}
    SELECT borough, survivor_id, survivor_key, count(*) AS names, CAST(sum(records) AS bigint) AS records,
           max(location_id) AS last_id
    FROM members GROUP BY ALL"""
)
def golden_clusters(spark, folder):
    return survivorship.golden_clusters(daily.merged_members(st.part_records(spark, folder), MERGE_AT))


@registered(
    f"""{MERGED_SQL}, states AS (SELECT {_STATE} FROM members)
    SELECT mdm_state, count(*) AS record_count, 'check' AS job_name, {NOW} AS snapshot_at_utc FROM states GROUP BY mdm_state"""
)
def lifecycle_after_merge(spark, folder):
    """The states of golden records once close names are merged."""
    records = st.part_records(spark, folder)
    merged = survivorship.merge_golden(matching.golden(records, AS_OF), daily.merged_members(records, MERGE_AT), AS_OF)
    return stewardship.lifecycle(merged, JOB, AS_OF)


_TOKEN = "split_part(zone_norm, ' ', 1)"
_REST = f"(length(zone_norm) - length({_TOKEN}))"
_LIKE = st.round4_sql(f"1 - (max({_REST}) - least(min({_REST}), 1)) / max(length(zone_norm))")
FAMILY_REVIEW = 0.55


@registered(
    f"""WITH {st.CUSTOMER_RECORDS_SQL}, {st.SCORED_SQL}, families AS (
        SELECT borough_norm AS borough, {_TOKEN} AS token, count(DISTINCT zone_norm) AS names, count(*) AS records
        FROM records GROUP BY ALL
        HAVING count(DISTINCT zone_norm) > 1
           AND {st.round4_sql(f"{_LIKE} * CAST(0.9 AS double) + CAST(0.1 AS double)")} >= {FAMILY_REVIEW}
    )
    SELECT f.borough, token, any_value(names) AS names, any_value(records) AS records, count(*) AS record_pairs,
           count(*) FILTER (decision = 'AUTO_MERGE') AS auto_merge_pairs,
           count(*) FILTER (decision <> 'AUTO_MERGE') AS steward_review_pairs
    FROM families f JOIN scored s
      ON s.borough = f.borough AND split_part(zone_a, ' ', 1) = token AND split_part(zone_b, ' ', 1) = token
    WHERE zone_a <> zone_b
    GROUP BY f.borough, token"""
)
def match_families(spark, folder):
    """Numbered names: all pairs of a family are accepted, and it comes as one row."""
    per_copy, classes = daily.name_tables(st.customer_records(spark, folder))
    return matching.family_groups(per_copy, classes, 0.95, FAMILY_REVIEW)


# ---------------------------------------------------------------- stewardship

_KEYED = "*, PULocationID AS PULocationID_int, DOLocationID AS DOLocationID_int"


def _orphans_sql(key: str, kind: str, columns: str) -> str:
    return f"""SELECT {columns}, '{kind}' AS orphan_type FROM trips
        WHERE NOT EXISTS (SELECT 1 FROM master WHERE LocationID = {key})"""


ORPHANS_SQL = f"""
    orphans AS (
        {_orphans_sql("PULocationID", "PICKUP_NOT_IN_MASTER", _KEYED)}
        UNION ALL
        {_orphans_sql("DOLocationID", "DROPOFF_NOT_IN_MASTER", _KEYED)}
    )"""


@registered(
    f"""WITH {st.TRIPS_SQL}, {st.GAPPED_SQL}
    {_orphans_sql("PULocationID", "PICKUP_NOT_IN_MASTER", "*, PULocationID AS PULocationID_int")}"""
)
def orphans_pickup(spark, folder):
    return stewardship.orphans_of(
        st.trips(spark, folder), st.gapped_master(spark, folder), "PULocationID", "PICKUP_NOT_IN_MASTER"
    )


@registered(
    f"""WITH {st.TRIPS_SQL}, {st.GAPPED_SQL}
    {_orphans_sql("DOLocationID", "DROPOFF_NOT_IN_MASTER", "*, DOLocationID AS DOLocationID_int")}"""
)
def orphans_dropoff(spark, folder):
    return stewardship.orphans_of(
        st.trips(spark, folder), st.gapped_master(spark, folder), "DOLocationID", "DROPOFF_NOT_IN_MASTER"
    )


@registered(
    f"""WITH {st.TRIPS_SQL}, {st.GAPPED_SQL}, {ORPHANS_SQL}
    SELECT *, 'check' AS job_name, {NOW} AS detected_at_utc FROM orphans"""
)
def orphans_all(spark, folder):
    return stewardship.orphans(st.trips(spark, folder), st.gapped_master(spark, folder), JOB, as_of=AS_OF)


@registered(
    f"""WITH {st.RECORDS_SQL}, {GOLDEN_SQL}
    SELECT mdm_state, count(*) AS record_count, 'check' AS job_name, {NOW} AS snapshot_at_utc
    FROM golden GROUP BY mdm_state"""
)
def lifecycle_snapshot(spark, folder):
    return stewardship.lifecycle(matching.golden(st.part_records(spark, folder), AS_OF), JOB, AS_OF)


@registered(
    f"SELECT 'ACTIVE' AS mdm_state, count(*) AS record_count, 'check' AS job_name, {NOW} AS snapshot_at_utc FROM part"
)
def lifecycle_default(spark, folder):
    return stewardship.lifecycle(st.part_records(spark, folder), JOB, AS_OF)


RUN_COUNTS_SQL = f"""WITH {st.TRIPS_SQL}, {st.GAPPED_SQL}, {ORPHANS_SQL},
    counts AS (
        SELECT (SELECT count(*) FROM orphans) AS orphans_count, (SELECT count(*) FROM master) AS zones_count,
               (SELECT count(*) FROM trips) AS trips_count
    )"""


def _run_summary(spark, folder):
    trips, master = st.trips(spark, folder), st.gapped_master(spark, folder)
    found = stewardship.orphans(trips, master, JOB, as_of=AS_OF)
    return stewardship.run_summary(master, trips, found, JOB, AS_OF, orphans_out_path="orphans")


@registered(
    f"""{RUN_COUNTS_SQL}
    SELECT 'check' AS job_name, 'orphans' AS orphans_out_path, *, {NOW} AS generated_at_utc FROM counts"""
)
def run_summary(spark, folder):
    return _run_summary(spark, folder)


@registered(
    f"""{RUN_COUNTS_SQL}
    SELECT '{RUN_ID}' AS run_id, 'PIPELINE_RUN_SUMMARY' AS event_type, 'SYSTEM' AS actor,
           'zones=' || zones_count || ', trips=' || trips_count || ', orphans=' || orphans_count AS details,
           'check' AS job_name, {NOW} AS event_time_utc
    FROM counts"""
)
def steward_activity(spark, folder):
    return stewardship.activity(_run_summary(spark, folder), RUN_ID, AS_OF)


@registered(
    f"""WITH {st.TRIPS_SQL}, {VALIDATED_SQL}, {st.RECORDS_SQL}, {GOLDEN_SQL}
    SELECT 'master_zones' AS table_name, 'tables/master_zones' AS table_path,
           'tables/master_zones/version=0' AS version_path, CAST(0 AS bigint) AS version, {NOW} AS timestamp,
           'WRITE' AS operation, 'parquet' AS data_format, count(*) AS num_output_rows, '{RUN_ID}' AS run_id,
           'check' AS job_name, {NOW} AS captured_at_utc FROM golden
    UNION ALL SELECT 'curated_trips', 'tables/curated_trips', 'tables/curated_trips/version=0', 0, {NOW}, 'WRITE',
           'parquet', count(*), '{RUN_ID}', 'check', {NOW} FROM trips
    UNION ALL SELECT 'curated_trips', 'tables/curated_trips', 'tables/curated_trips/version=1', 1, {NOW}, 'WRITE',
           'parquet', count(*), '{RUN_ID}', 'check', {NOW} FROM validated"""
)
def history_audit(spark, folder):
    root = scratch_folder(spark, "history")
    tables, log = f"{root}/tables", f"{root}/log"
    golden = matching.golden(st.part_records(spark, folder), AS_OF)
    tablelog.publish(golden, tables, log, "master_zones", None, RUN_ID, AS_OF)
    tablelog.publish(st.trips(spark, folder), tables, log, "curated_trips", None, RUN_ID, AS_OF)
    tablelog.publish(_validated(spark, folder), tables, log, "curated_trips", None, RUN_ID, AS_OF)
    histories = {
        name: tablelog.table_history(spark, tables, log, name) for name in ("master_zones", "curated_trips")
    }
    audit = tablelog.history_audit(histories, JOB, AS_OF)
    # The folder of this call has a random name; what stands below it is compared.
    below = {c: F.regexp_extract(c, r"(tables/.*)$", 1) for c in ("table_path", "version_path")}
    return audit.withColumns(below)


# ---------------------------------------------------------------- dimension history

@registered(
    f"""WITH {st.CUSTOMER_ZONES_SQL}
    SELECT * EXCLUDE (c_mktsegment), sha256(concat_ws('||', borough, zone_name, service_zone)) AS hashdiff
    FROM customer_zones"""
)
def scd2_hashdiff(spark, folder):
    return history.zone_feed(st.customer_zones(spark, folder))


@registered(
    f"""WITH {st.CUSTOMER_ZONES_SQL}
    SELECT * EXCLUDE (c_mktsegment), {st.ZONE_HASH_SQL} AS record_hash,
           {NOW} AS effective_start_ts, CAST(NULL AS timestamp) AS effective_end_ts, true AS is_current,
           'NYC_TLC' AS source_system
    FROM customer_zones"""
)
def scd2_initial(spark, folder):
    return history.apply_history(st.customer_zones(spark, folder), None, as_of=AS_OF)


@registered(
    f"""WITH {st.INCOMING_SQL}, {st.EXISTING_SQL},
    hashed AS (
        SELECT *, {st.ZONE_HASH_SQL} AS new_hash FROM incoming
    ),
    changed AS (
        SELECT dim.location_id FROM dim JOIN hashed USING (location_id) WHERE is_current AND record_hash <> new_hash
    )
    SELECT location_id, borough, zone_name, service_zone, record_hash, effective_start_ts,
           CASE WHEN is_current AND location_id IN (FROM changed) THEN {NOW} ELSE effective_end_ts END
               AS effective_end_ts,
           is_current AND location_id NOT IN (FROM changed) AS is_current, source_system
    FROM dim
    UNION ALL
    SELECT location_id, borough, zone_name, service_zone, new_hash, {NOW}, NULL, true, 'NYC_TLC'
    FROM hashed
    WHERE location_id IN (FROM changed) OR location_id NOT IN (SELECT location_id FROM dim WHERE is_current)"""
)
def scd2_apply(spark, folder):
    return history.apply_history(st.incoming_zones(spark, folder), st.existing_dimension(spark, folder), as_of=AS_OF)


@registered(ORACLES["scd2_apply"])
def scd2_bucketed(spark, folder):
    """The same load into a dimension that is kept in buckets of its key."""
    database = f"dimension_{uuid.uuid4().hex[:12]}"
    location = f"{scratch_folder(spark, 'dimension')}/{database}"
    spark.sql("CREATE DATABASE IDENTIFIER(:db) LOCATION :path", args={"db": database, "path": location})
    dimension = buckets.BucketedDimension(database, "zones", buckets=8)
    dimension.replace(spark, st.existing_dimension(spark, folder))
    dimension.load(spark, st.incoming_zones(spark, folder), AS_OF)
    return dimension.read(spark)


# ---------------------------------------------------------------- staging and run audit

@registered(
    f"""SELECT CAST(c_custkey AS int) AS location_id, c_mktsegment AS borough, c_name AS zone_name,
           'Area ' || c_nationkey AS service_zone, {NOW} AS ingested_at, '{RUN_ID}' AS run_id
    FROM customer"""
)
def zone_feed_staging(spark, folder):
    path = scratch_folder(spark, "feed")
    writers.listing_csv(st.feed_of_customers(spark, folder), path)
    return daily.stage_feed(spark, path, "csv", True, RUN_ID, AS_OF)


@registered(
    f"""WITH {st.RUN_EVENTS_SQL}, ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY run_id, job_name ORDER BY event_at DESC, status_rank DESC, error_message DESC NULLS LAST) AS rn,
            min(CASE WHEN status = 'STARTED' THEN event_at END) OVER (PARTITION BY run_id, job_name) AS started_at
        FROM run_events
    )
    SELECT run_id, job_name, trigger_type, data_owner, status, started_at,
           CASE WHEN status <> 'STARTED' THEN event_at END AS ended_at, error_message
    FROM ranked WHERE rn = 1"""
)
def run_audit_latest(spark, folder):
    return runs.run_audit(st.run_events(spark, folder))


@registered(
    f"""WITH {st.RUN_EVENTS_SQL}
    SELECT run_id, min(event_at) AS event_at FROM run_events
    WHERE run_id NOT IN (SELECT CAST(user_id AS varchar) FROM events WHERE event_type = 'error' AND value > 150)
    GROUP BY run_id"""
)
def run_audit_insert(spark, folder):
    events = st.run_events(spark, folder)
    first = events.groupBy("run_id").agg(F.min("event_at").alias("event_at"))
    costly = st.table(spark, folder, "events").filter("event_type = 'error' AND value > 150")
    return runs.absent_rows(costly.select(F.col("user_id").cast("string").alias("run_id")), first, "run_id")


# ---------------------------------------------------------------- keys, bases, reports and versions

WIDE = 10_000_000_000


@registered(
    f"""WITH {st.TRIPS_SQL}, wide AS (
        SELECT l_orderkey * {WIDE} AS PULocationID, l_linenumber FROM trips
    ), master AS (SELECT DISTINCT o_orderkey * {WIDE} AS LocationID FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT *, PULocationID AS "PULocationID_int", 'PICKUP_NOT_IN_MASTER' AS orphan_type FROM wide
    WHERE NOT EXISTS (SELECT 1 FROM master WHERE LocationID = PULocationID)"""
)
def orphans_wide_keys(spark, folder):
    """Keys beyond 32 bits keep their width on both sides."""
    trips = st.trips(spark, folder).select((F.col("l_orderkey") * F.lit(WIDE)).alias("PULocationID"), "l_linenumber")
    orders = st.table(spark, folder, "orders").filter("o_orderkey % 5 <> 0")
    master = orders.select((F.col("o_orderkey") * F.lit(WIDE)).alias("LocationID"))
    return stewardship.orphans_of(trips, master, "PULocationID", "PICKUP_NOT_IN_MASTER")


@registered(
    f"""WITH {st.RECORDS_SQL}, {GOLDEN_SQL}
    SELECT * REPLACE ("LocationID" * {WIDE} AS "LocationID") FROM golden"""
)
def golden_wide_keys(spark, folder):
    parts = st.table(spark, folder, "part").select(
        (F.col("p_partkey") * F.lit(WIDE)).alias("LocationID"), F.col("p_name").alias("Zone"), F.col("p_brand").alias("Borough")
    )
    return matching.golden(matching.normalize(parts), AS_OF)


@registered(
    f"""WITH {st.TRIPS_SQL}, {st.ZONES_SQL}, {VALIDATED_SQL}, {CURATED_SQL}
    SELECT pickup_date, count(*) AS trips, count(pu_zone) AS with_zone FROM curated GROUP BY pickup_date"""
)
def curated_by_date(spark, folder):
    """Written by date, read, enriched, and written by date again without a second shuffle by date."""
    root = scratch_folder(spark, "curated")
    writers.overwrite_partitioned(_validated(spark, folder), f"{root}/validated", "pickup_date")
    validated = readers.read_parquet(spark, f"{root}/validated")
    enriched = enrich(validated, st.zones(spark, folder), as_of=AS_OF)
    writers.overwrite_partitioned(enriched, f"{root}/curated", "pickup_date", laid_out=True)
    curated = readers.read_parquet(spark, f"{root}/curated")
    return curated.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"), F.count("pu_zone").alias("with_zone"))


@registered(
    f"""WITH {st.TRIPS_SQL}, {VALIDATED_SQL}
    SELECT 'INPUT' AS base_source, count(*) AS trips FROM trips
    UNION ALL SELECT 'CURATED', count(*) FROM validated"""
)
def gate_base_source(spark, folder):
    """The base of the quality gate before and after there is a curated table."""
    root = scratch_folder(spark, "base")
    tables, log = f"{root}/tables", f"{root}/log"
    found = None
    for name, build in (("validated", st.trips), ("curated", _validated)):
        tablelog.publish(build(spark, folder), tables, log, name, None, RUN_ID, AS_OF)
        base, source = tablelog.choose_latest(spark, tables, log, "curated", "validated")
        counted = base.agg(F.lit(source).alias("base_source"), F.count(F.lit(1)).alias("trips"))
        found = counted if found is None else found.unionByName(counted)
    return found


@registered(
    f"""WITH {st.TRIPS_SQL}, {st.ZONES_SQL}, {VALIDATED_SQL}, {CURATED_SQL}
    SELECT pu_borough, do_zone, count(*) AS trips FROM curated GROUP BY pu_borough, do_zone"""
)
def enrich_from_csv(spark, folder):
    """The zone lookup comes as CSV text and meets integer trip keys."""
    path = scratch_folder(spark, "zones")
    writers.listing_csv(st.zones(spark, folder), path)
    lookup, _ = readers.read_optional(spark, path)
    enriched = enrich(_validated(spark, folder), lookup, as_of=AS_OF)
    return enriched.groupBy("pu_borough", "do_zone").agg(F.count(F.lit(1)).alias("trips"))


@registered(
    f"""{GATE_SQL}, {SUMMARY_SQL}, {CARD_SQL}
    SELECT 'csv' AS report, CAST(2 * count(*) AS bigint) AS lines, CAST(2 * sum(failed_rows) AS bigint) AS failed_rows FROM card
    UNION ALL SELECT 'json', 1, failed_rows FROM summary"""
)
def report_roundtrip(spark, folder):
    """The scorecard appended twice as CSV and the summary as JSON, both read back."""
    root = scratch_folder(spark, "reports")
    card = _card(spark, folder)
    for _ in range(2):
        writers.report_csv(card, f"{root}/card")
    writers.report_json(_summary(spark, folder), f"{root}/summary")
    lines = readers.read_csv(spark, f"{root}/card")
    report = spark.read.json(f"{root}/summary")

    def total(df, kind):
        return df.agg(F.lit(kind).alias("report"), F.count(F.lit(1)).alias("lines"), F.sum(F.col("failed_rows").cast("bigint")).alias("failed_rows"))

    return total(lines, "csv").unionByName(total(report, "json"))


@registered(
    f"""WITH {st.TRIPS_SQL}, {VALIDATED_SQL}
    SELECT l_orderkey, l_linenumber, governance_zone FROM validated"""
)
def latest_version(spark, folder):
    """A table published twice is read in its second version, which has gained columns; the first is untouched."""
    root = scratch_folder(spark, "versions")
    tablelog.publish(st.trips(spark, folder), f"{root}/tables", f"{root}/log", "trips", None, RUN_ID, AS_OF)
    tablelog.publish(_validated(spark, folder), f"{root}/tables", f"{root}/log", "trips", None, RUN_ID, AS_OF)
    latest = tablelog.read_latest(spark, f"{root}/tables", f"{root}/log", "trips")
    return latest.select("l_orderkey", "l_linenumber", "governance_zone")


@registered(
    f"""WITH {st.TRIPS_SQL}, {VALIDATED_SQL}
    SELECT source_system, count(*) AS trips FROM (
        SELECT NULL AS source_system FROM trips UNION ALL SELECT source_system FROM validated
    ) GROUP BY source_system"""
)
def evolved_table(spark, folder):
    """Both versions read as one table: the columns of either, NULL where a version lacks one."""
    root = scratch_folder(spark, "evolved")
    paths = [
        tablelog.publish(build(spark, folder), f"{root}/tables", f"{root}/log", "trips", None, RUN_ID, AS_OF)
        for build in (st.trips, _validated)
    ]
    both = readers.read_parquet(spark, *paths, evolve=True)
    return both.groupBy("source_system").agg(F.count(F.lit(1)).alias("trips"))


@registered(
    f"""WITH {st.TRIPS_SQL}
    SELECT l_orderkey, l_linenumber, passenger_count + CAST(0.5 AS double) AS passenger_count,
           CAST(NULL AS int) AS "RatecodeID", trip_distance
    FROM trips"""
)
def evolved_write(spark, folder):
    """Three versions: the second gains a column and widens one, the third loses one and widens again; the last is read."""
    root = scratch_folder(spark, "evolved-write")
    trips = st.trips(spark, folder).withColumn("RatecodeID", F.col("RatecodeID").cast("int"))
    keys, counted = ("l_orderkey", "l_linenumber"), F.col("passenger_count")
    for columns in (
        (counted.cast("int"), "RatecodeID"),
        (counted.cast("bigint"), "RatecodeID", "trip_distance"),
        ((counted + F.lit(0.5)).alias("passenger_count"), "trip_distance"),
    ):
        tablelog.publish(trips.select(*keys, *columns), f"{root}/tables", f"{root}/log", "trips", None, RUN_ID, AS_OF, evolve=True)
    return tablelog.read_latest(spark, f"{root}/tables", f"{root}/log", "trips")


@registered(
    f"""WITH {st.TRIPS_SQL}, {VALIDATED_SQL}, last_dates AS (
        SELECT DISTINCT pickup_date FROM validated ORDER BY pickup_date DESC LIMIT 3
    ), fresh AS (
        SELECT * FROM validated WHERE pickup_date IN (FROM last_dates) AND payment_type <> 1
    )
    SELECT pickup_date, count(*) AS trips, CAST(sum(passenger_count) AS bigint) AS passengers FROM (
        FROM validated WHERE pickup_date NOT IN (SELECT pickup_date FROM fresh) UNION ALL FROM fresh
    ) GROUP BY pickup_date"""
)
def refreshed_dates(spark, folder):
    """The trips by date after the last dates have come anew, without one payment type; a date that has none stays."""
    path = scratch_folder(spark, "refreshed")
    validated = _validated(spark, folder)
    writers.overwrite_dates(validated, path, "pickup_date")
    last = readers.read_parquet(spark, path).select("pickup_date").distinct().orderBy(F.desc("pickup_date")).limit(3)
    writers.overwrite_dates(validated.join(last, "pickup_date", "left_semi").filter("payment_type <> 1"), path, "pickup_date")
    after = readers.read_parquet(spark, path)
    return after.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("passenger_count").cast("bigint").alias("passengers")
    )


def _broken_feed(spark, folder):
    path = scratch_folder(spark, "broken-feed")
    st.broken_lines(spark, folder).write.text(path)
    return readers.read_checked(spark, path, {"LocationID": "int", "Borough": "string", "Zone": "string", "service_zone": "string"}, header=False)


@registered(
    f"""WITH {st.BROKEN_SQL}
    SELECT line, CASE WHEN kind IN ('text', 'wide') THEN 'LocationID' END AS column_name,
           CASE WHEN kind IN ('text', 'wide') THEN split_part(line, ',', 1) END AS value,
           CASE WHEN kind IN ('text', 'wide') THEN 'not int' ELSE 'number of fields' END AS reason
    FROM broken WHERE kind <> 'good'"""
)
def feed_rejects(spark, folder):
    """What is wrong with the lines of a feed that cannot be read."""
    return _broken_feed(spark, folder)[1].select("line", "column_name", "value", "reason")


@registered(
    f"""WITH {st.BROKEN_SQL}
    SELECT 'kept' AS part, count(*) AS lines, count(DISTINCT split_part(line, ',', 1)) AS ids FROM broken WHERE kind = 'good'
    UNION ALL SELECT 'rejected', count(*), 0 FROM broken WHERE kind <> 'good'"""
)
def feed_checked(spark, folder):
    """Every line of the feed is either kept or rejected."""
    kept, rejects = _broken_feed(spark, folder)
    return kept.agg(
        F.lit("kept").alias("part"), F.count(F.lit(1)).alias("lines"), F.countDistinct("LocationID").alias("ids")
    ).unionByName(rejects.agg(F.lit("rejected").alias("part"), F.countDistinct("line_id").alias("lines"), F.lit(0).cast("bigint").alias("ids")))


@registered(
    f"""{MATCH_SQL}, asked AS (
        SELECT borough_norm AS block, min(location_id) AS id FROM records GROUP BY borough_norm
    )
    SELECT DISTINCT id_a, id_b, zone_a, zone_b, borough, name_similarity, match_confidence FROM scored JOIN asked ON block = borough
    WHERE decision = 'REJECT' AND (id_a = id OR id_b = id)"""
)
def rejects_of_asked(spark, folder):
    """The rejected pairs of the first record of each block: bounded by the records asked for."""
    records = st.part_records(spark, folder)
    asked = records.groupBy("borough_norm").agg(F.min("location_id").alias("location_id")).select("location_id")
    found = matching.reject_partners(records, asked)
    return found.select("id_a", "id_b", "zone_a", "zone_b", "borough", "name_similarity", "match_confidence")
