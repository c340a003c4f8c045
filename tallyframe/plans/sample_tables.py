"""Trips, zones, masters and run events derived from the given tables, always from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyframe.operators import history, matching

AS_OF = "2024-06-01 00:00:00"
EARLIER = "2023-01-01 00:00:00"
RUN_ID = "run-1"
JOB = "check"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Types that compare across engines: timestamps without zone, arrays as text, pair counts as bigint."""
    simple = {}
    for field in df.schema:
        if isinstance(field.dataType, T.TimestampType):
            simple[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            simple[field.name] = F.concat_ws("|", field.name)
        elif isinstance(field.dataType, T.DecimalType):
            simple[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(simple)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per line item."""
    orders = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.nullif(F.col("l_suppkey") % 40, F.lit(0)).alias("VendorID"),
        F.col("o_orderdate").cast("timestamp").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").cast("timestamp").alias("tpep_dropoff_datetime"),
        F.nullif("c_nationkey", F.lit(7)).alias("PULocationID"),
        F.nullif("s_nationkey", F.lit(11)).alias("DOLocationID"),
        (F.col("l_quantity").cast("int") % 12).alias("passenger_count"),
        F.col("l_linenumber").alias("RatecodeID"),
        (F.col("l_quantity") / 4).alias("trip_distance"),
        F.col("c_acctbal").alias("fare_amount"),
        F.col("l_tax").alias("tip_amount"),
        F.col("s_acctbal").alias("tolls_amount"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("l_discount").alias("extra"),
        (F.col("l_orderkey") % 4 + 1).alias("payment_type"),
    )


TRIPS_SQL = """
    trips AS (
        SELECT l_orderkey, l_partkey, l_linenumber,
               nullif(l_suppkey % 40, 0) AS VendorID,
               o_orderdate AS tpep_pickup_datetime, l_shipdate AS tpep_dropoff_datetime,
               nullif(c_nationkey, 7) AS PULocationID, nullif(s_nationkey, 11) AS DOLocationID,
               CAST(l_quantity AS int) % 12 AS passenger_count, l_linenumber AS RatecodeID,
               l_quantity / 4 AS trip_distance, c_acctbal AS fare_amount, l_tax AS tip_amount,
               s_acctbal AS tolls_amount, o_totalprice AS total_amount, l_discount AS extra,
               1 + l_orderkey % 4 AS payment_type
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    )"""


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per nation, as text columns like a CSV lookup."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("Zone "), F.substring("r_name", 1, 2)).alias("service_zone"),
    )


ZONES_SQL = """
    zones AS (
        SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
               'Zone ' || substr(r_name, 1, 2) AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey
    )"""


def gapped_master(spark: SparkSession, folder: str) -> DataFrame:
    """A zone master that lacks one region, so that trips can be orphans."""
    return table(spark, folder, "nation").filter("n_regionkey <> 3").select(F.col("n_nationkey").alias("LocationID"))


GAPPED_SQL = "master AS (SELECT n_nationkey AS LocationID FROM nation WHERE n_regionkey <> 3)"


def part_records(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised master records: one per part, blocked by brand."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("LocationID"), F.col("p_name").alias("Zone"), F.col("p_brand").alias("Borough")
    )
    return matching.normalize(parts)


def customer_records(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised master records with numbered names: one per customer, blocked by market segment."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("LocationID"), F.col("c_name").alias("Zone"), F.col("c_mktsegment").alias("Borough")
    )
    return matching.normalize(customers)


def _norm_sql(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(upper({column}), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def round4_sql(expression: str) -> str:
    """Half-up on the decimal text of the double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({expression} AS varchar) AS decimal(38, 20)), 4) AS double)"


RECORDS_SQL = f"""
    records AS (
        SELECT p_partkey AS location_id, p_name AS Zone, p_brand AS Borough,
               {_norm_sql('p_name')} AS zone_norm, {_norm_sql('p_brand')} AS borough_norm
        FROM part
    )"""

CUSTOMER_RECORDS_SQL = f"""
    records AS (
        SELECT c_custkey AS location_id, c_name AS Zone, c_mktsegment AS Borough,
               {_norm_sql('c_name')} AS zone_norm, {_norm_sql('c_mktsegment')} AS borough_norm
        FROM customer
    )"""

SCORED_SQL = f"""
    paired AS (
        SELECT a.location_id AS id_a, b.location_id AS id_b, a.zone_norm AS zone_a, b.zone_norm AS zone_b,
               a.borough_norm AS borough
        FROM records a JOIN records b ON a.borough_norm = b.borough_norm AND a.location_id < b.location_id
    ),
    likened AS (
        SELECT *, CASE WHEN greatest(length(zone_a), length(zone_b)) = 0 THEN 0.0
                  ELSE {round4_sql('1 - levenshtein(zone_a, zone_b) / greatest(length(zone_a), length(zone_b))')}
                  END AS name_similarity,
               CASE WHEN split_part(zone_a, ' ', 1) = split_part(zone_b, ' ', 1) THEN 1.0 ELSE 0.0 END AS token_match
        FROM paired
    ),
    confident AS (
        SELECT *, {round4_sql('name_similarity * CAST(0.9 AS double) + token_match * CAST(0.1 AS double)')}
                  AS match_confidence
        FROM likened
    ),
    scored AS (
        SELECT *, CASE WHEN match_confidence >= 0.95 THEN 'AUTO_MERGE'
                       WHEN match_confidence >= 0.80 THEN 'STEWARD_REVIEW' ELSE 'REJECT' END AS decision
        FROM confident
    )"""


def feed_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A zone feed with one zone per customer."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("LocationID"),
        F.col("c_mktsegment").alias("Borough"),
        F.col("c_name").alias("Zone"),
        F.concat(F.lit("Area "), F.col("c_nationkey")).alias("service_zone"),
    )


def broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same feed as text lines, of which some have a key that is no number or too wide, or other numbers of fields."""
    key = F.col("c_custkey").cast("string")
    last = F.col("c_custkey") % 10
    first = F.when(last == 3, F.concat(F.lit("x"), key)).when(last == 9, F.concat(key, F.lit("0000000000"))).otherwise(key)
    area = F.concat(F.lit("Area "), F.col("c_nationkey"))
    ends = F.when(last == 5, F.concat_ws(",", area, F.lit("more"))).when(last != 7, area)
    return table(spark, folder, "customer").select(F.concat_ws(",", first, "c_mktsegment", "c_name", ends).alias("value"))


BROKEN_SQL = """
    broken AS (
        SELECT CASE c_custkey % 10 WHEN 3 THEN 'text' WHEN 9 THEN 'wide' WHEN 5 THEN 'more' WHEN 7 THEN 'less'
               ELSE 'good' END AS kind,
               concat_ws(',', CASE kind WHEN 'text' THEN 'x' || c_custkey WHEN 'wide' THEN c_custkey || '0000000000'
                                        ELSE CAST(c_custkey AS varchar) END,
                         c_mktsegment, c_name,
                         CASE kind WHEN 'more' THEN 'Area ' || c_nationkey || ',more' WHEN 'less' THEN NULL
                                   ELSE 'Area ' || c_nationkey END) AS line
        FROM customer
    )"""


def customer_zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per customer; accounts in debt have another service zone, and one nation lacks its borough."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("location_id"),
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("borough"),
        F.when(F.col("c_nationkey") == 3, F.col("c_mktsegment")).otherwise(F.col("c_name")).alias("zone_name"),
        F.when(F.col("c_acctbal") < 0, "Debit").otherwise("Regular").alias("service_zone"),
        "c_mktsegment",
    )


def incoming_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Today's zones: one segment is missing, so that keys of the dimension are absent from the feed."""
    return customer_zones(spark, folder).filter("c_mktsegment <> 'BUILDING'").drop("c_mktsegment")


CUSTOMER_ZONES_SQL = """
    customer_zones AS (
        SELECT CAST(c_custkey AS int) AS location_id, CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS borough,
               CASE WHEN c_nationkey = 3 THEN c_mktsegment ELSE c_name END AS zone_name,
               CASE WHEN c_acctbal < 0 THEN 'Debit' ELSE 'Regular' END AS service_zone, c_mktsegment
        FROM customer
    )"""

INCOMING_SQL = f"""{CUSTOMER_ZONES_SQL},
    incoming AS (SELECT * EXCLUDE (c_mktsegment) FROM customer_zones WHERE c_mktsegment <> 'BUILDING')"""


def exact_hash_sql(*columns: str) -> str:
    parts = (f"coalesce(CAST(length({c}) AS varchar) || ':' || {c}, '-')" for c in columns)
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


ZONE_HASH_SQL = exact_hash_sql("borough", "zone_name", "service_zone")


def existing_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Yesterday's dimension: customers up to a balance of 8000, all Regular, plus a closed version of the rich.

    The nation that lacks its borough today lacked its zone name then: the same texts, shifted by one attribute.
    """
    known = (
        table(spark, folder, "customer")
        .filter("c_acctbal <= 8000")
        .select(
            F.col("c_custkey").cast("int").alias("location_id"),
            F.col("c_mktsegment").alias("borough"),
            F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("zone_name"),
            F.lit("Regular").alias("service_zone"),
            "c_acctbal",
        )
    )
    current = history.apply_history(known, None, as_of=EARLIER, checked=True)
    closed = (
        history.apply_history(
            known.filter("c_acctbal > 5000").withColumn("service_zone", F.lit("Old")),
            None,
            as_of="2020-01-01 00:00:00",
            checked=True,
        )
        .withColumn("effective_end_ts", F.lit(EARLIER).cast("timestamp"))
        .withColumn("is_current", F.lit(False))
    )
    return current.unionByName(closed)


EXISTING_SQL = f"""
    known AS (
        SELECT CAST(c_custkey AS int) AS location_id, c_mktsegment AS borough,
               CASE WHEN c_nationkey <> 3 THEN c_name END AS zone_name, 'Regular' AS service_zone, c_acctbal
        FROM customer WHERE c_acctbal <= 8000
    ),
    dim AS (
        SELECT location_id, borough, zone_name, service_zone, {ZONE_HASH_SQL} AS record_hash,
               TIMESTAMP '{EARLIER}' AS effective_start_ts, CAST(NULL AS timestamp) AS effective_end_ts,
               true AS is_current, 'NYC_TLC' AS source_system
        FROM known
        UNION ALL
        SELECT location_id, borough, zone_name, 'Old', {exact_hash_sql("borough", "zone_name", "'Old'")},
               TIMESTAMP '2020-01-01 00:00:00', TIMESTAMP '{EARLIER}', false, 'NYC_TLC'
        FROM known WHERE c_acctbal > 5000
    )"""


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a run event of its user's run, under one of two jobs."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.when(F.col("event_id") % 3 == 0, "load_feed").otherwise("daily").alias("job_name"),
        F.lit("manual").alias("trigger_type"),
        F.lit("analytics-team").alias("data_owner"),
        F.when(kind == "error", "FAILED").when(kind == "purchase", "SUCCEEDED").otherwise("STARTED").alias("status"),
        F.when(kind == "error", F.col("props")).alias("error_message"),
        F.col("ts").cast("timestamp").alias("event_at"),
    )


RUN_EVENTS_SQL = """
    run_events AS (
        SELECT CAST(user_id AS varchar) AS run_id,
               CASE WHEN event_id % 3 = 0 THEN 'load_feed' ELSE 'daily' END AS job_name, 'manual' AS trigger_type,
               'analytics-team' AS data_owner,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'STARTED' END AS status,
               CASE event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END AS status_rank,
               CASE WHEN event_type = 'error' THEN props END AS error_message, ts AS event_at
        FROM events
    )"""
