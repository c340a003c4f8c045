"""SQL layer: databases, external tables over the exports, the certified view, ordered script runs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F


class Script(NamedTuple):
    name: str
    database: str
    sql: str


class ScriptError(RuntimeError):
    """A script failed; ``statuses`` tells how far the run came."""

    def __init__(self, message: str, statuses: DataFrame):
        super().__init__(message)
        self.statuses = statuses


MASTER, CURATED = "master", "curated"

# Names and folders are parameters of the statements, so nothing is pasted into SQL text.
SERVING_SCRIPTS = [
    Script("master_database", "default", "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:master)"),
    Script("curated_database", "default", "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:curated)"),
    Script(
        "dim_zone",
        MASTER,
        """
        CREATE TABLE IF NOT EXISTS IDENTIFIER(:master || '.dim_zone') (
            location_id INT,
            borough STRING,
            zone STRING,
            service_zone STRING,
            record_hash STRING,
            effective_start_ts TIMESTAMP,
            effective_end_ts TIMESTAMP,
            is_current BOOLEAN,
            source_system STRING
        ) USING PARQUET LOCATION :dim_path
        """,
    ),
    Script(
        "fact_trip",
        CURATED,
        """
        CREATE TABLE IF NOT EXISTS IDENTIFIER(:curated || '.fact_trip') (
            pickup_datetime TIMESTAMP,
            dropoff_datetime TIMESTAMP,
            pickup_location_id INT,
            dropoff_location_id INT,
            vendor_id INT,
            passenger_count INT,
            trip_distance DOUBLE,
            fare_amount DOUBLE,
            tip_amount DOUBLE,
            total_amount DOUBLE,
            payment_type INT
        ) USING PARQUET LOCATION :fact_path
        """,
    ),
    # A table that is there already moves to the new export.
    Script("dim_zone_folder", MASTER, "ALTER TABLE IDENTIFIER(:master || '.dim_zone') SET LOCATION :dim_path"),
    Script("fact_trip_folder", CURATED, "ALTER TABLE IDENTIFIER(:curated || '.fact_trip') SET LOCATION :fact_path"),
    Script(
        "certified_view",
        CURATED,
        """
        CREATE OR REPLACE VIEW IDENTIFIER(:curated || '.vw_certified_trip_zone') AS
        SELECT trip.pickup_datetime,
               trip.dropoff_datetime,
               timestampdiff(MINUTE, trip.pickup_datetime, trip.dropoff_datetime) AS trip_minutes,
               trip.vendor_id, trip.passenger_count, trip.trip_distance, trip.payment_type,
               trip.fare_amount, trip.tip_amount, trip.total_amount,
               trip.pickup_location_id,
               origin.zone AS pu_zone, origin.borough AS pu_borough, origin.service_zone AS pu_service_zone,
               trip.dropoff_location_id,
               target.zone AS do_zone, target.borough AS do_borough, target.service_zone AS do_service_zone
        FROM IDENTIFIER(:curated || '.fact_trip') AS trip
        LEFT JOIN (SELECT * FROM IDENTIFIER(:master || '.dim_zone') WHERE is_current) AS origin
               ON origin.location_id = trip.pickup_location_id
        LEFT JOIN (SELECT * FROM IDENTIFIER(:master || '.dim_zone') WHERE is_current) AS target
               ON target.location_id = trip.dropoff_location_id
        """,
    ),
]

TOP_BOROUGHS_SQL = """
    SELECT pu_borough, count(*) AS trips, avg(total_amount) AS avg_total
    FROM IDENTIFIER(:curated || '.vw_certified_trip_zone')
    GROUP BY pu_borough
    ORDER BY trips DESC, pu_borough NULLS LAST
    LIMIT 20
"""

STATUS_SCHEMA = "position int, script string, database string, status string, error string"


#: What a semicolon inside does not end: quoted text and names, and comments.
_OPAQUE = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
_PART = re.compile(rf"({_OPAQUE}|;)", re.DOTALL)
_COMMENT = re.compile(r"--|/\*")


def statements(sql: str) -> list[str]:
    """The statements of a script, split at semicolons outside quotes and comments; those of comments alone are left out."""
    found, current, says = [], [], False
    for part in [*_PART.split(sql), ";"]:
        if part != ";":
            current.append(part)
            says = says or bool(part.strip() and not _COMMENT.match(part))
        elif says:
            found.append("".join(current).strip())
        if part == ";":
            current, says = [], False
    return found


def read_scripts(spark: SparkSession, folder: str, database: str = "default") -> list[Script]:
    """The statements of the script files in a folder, in the order of file names, named ``<file>#<number>``."""
    files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    return [
        Script(f"{file['name']}#{number}", database, sql)
        for file in sorted(files.collect(), key=lambda file: file["name"])
        for number, sql in enumerate(statements(file["value"]), start=1)
    ]


def run_scripts(spark: SparkSession, scripts: Sequence[Script], parameters: Mapping[str, str]) -> DataFrame:
    """Run one-statement scripts in order; returns a status row each. The first failure ends the run."""
    statuses = []
    for position, script in enumerate(scripts, start=1):
        database = parameters.get(script.database, script.database)
        try:
            spark.sql(script.sql, args=dict(parameters))
        except PySparkException as error:
            statuses.append((position, script.name, database, "FAILED", str(error)))
            raise ScriptError(
                f"script {script.name} failed: {error}", spark.createDataFrame(statuses, STATUS_SCHEMA)
            ) from error
        statuses.append((position, script.name, database, "SUCCEEDED", None))
    return spark.createDataFrame(statuses, STATUS_SCHEMA)


def serve(spark: SparkSession, master: str, curated: str, dim_path: str, fact_path: str) -> DataFrame:
    """Databases, external tables and certified view over two exports; returns the script statuses."""
    parameters = {MASTER: master, CURATED: curated, "dim_path": dim_path, "fact_path": fact_path}
    statuses = run_scripts(spark, SERVING_SCRIPTS, parameters)
    for table in (f"{master}.dim_zone", f"{curated}.fact_trip"):
        spark.catalog.refreshTable(table)
    return statuses


def certified_view(spark: SparkSession, curated: str) -> DataFrame:
    return spark.table(f"{curated}.vw_certified_trip_zone")


def top_boroughs_sql(spark: SparkSession, curated: str) -> DataFrame:
    return spark.sql(TOP_BOROUGHS_SQL, args={CURATED: curated})
