"""Conformed dimension, fact and certified join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.casts import as_int, as_timestamp, moment, whole_minutes
from tallyframe.functions.columns import pick, pick_any_case

# Output column -> (type, source names in order of preference).
DIM_ZONE = {
    "location_id": ("int", ("LocationID", "location_id", "locationId")),
    "borough": ("string", ("Borough", "borough")),
    "zone": ("string", ("Zone", "zone")),
    "service_zone": ("string", ("service_zone", "ServiceZone", "serviceZone")),
}
FACT_TRIP = {
    "pickup_datetime": ("timestamp", ("pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime")),
    "dropoff_datetime": ("timestamp", ("dropoff_datetime", "tpep_dropoff_datetime", "lpep_dropoff_datetime")),
    "pickup_location_id": ("int", ("pickup_location_id", "PULocationID", "pu_location_id")),
    "dropoff_location_id": ("int", ("dropoff_location_id", "DOLocationID", "do_location_id")),
    "vendor_id": ("int", ("vendor_id", "VendorID")),
    "passenger_count": ("int", ("passenger_count",)),
    "trip_distance": ("double", ("trip_distance",)),
    "fare_amount": ("double", ("fare_amount",)),
    "tip_amount": ("double", ("tip_amount",)),
    "total_amount": ("double", ("total_amount",)),
    "payment_type": ("int", ("payment_type",)),
}
FEED_COLUMNS = {"locationid": "location_id", "borough": "borough", "zone": "zone_name", "service_zone": "service_zone"}


def _typed(df: DataFrame, name: str, to: str) -> Column:
    if to == "int":
        return as_int(df, name)
    return as_timestamp(name) if to == "timestamp" else F.col(name).try_cast(to)


def conform(df: DataFrame, layout: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Exactly the columns of ``layout``, from whichever source names ``df`` has; a missing one is an error."""
    return df.select(*[_typed(df, pick(df, *names), to).alias(out) for out, (to, names) in layout.items()])


def dim_export(zones: DataFrame) -> DataFrame:
    return conform(zones, DIM_ZONE)


def fact_export(trips: DataFrame) -> DataFrame:
    return conform(trips, FACT_TRIP)


def zone_staging(feed: DataFrame, run_id: str, as_of=None) -> DataFrame:
    """A zone feed in its six staging columns; source names are matched in any case."""
    columns = []
    for source, out in FEED_COLUMNS.items():
        found = pick_any_case(feed, source)
        columns.append(_typed(feed, found, "int" if out == "location_id" else "string").alias(out))
    return feed.select(*columns).withColumns({"ingested_at": moment(as_of), "run_id": F.lit(run_id)})


def certified_trips(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Trips with whole minutes and the current zone of both ends; trips without a zone stay.

    ``dim`` is a type 2 dimension, of which only current rows join.
    """
    current = dim.filter("is_current")
    joined = facts
    for role, key in (("pu", "pickup_location_id"), ("do", "dropoff_location_id")):
        zone = current.select(
            F.col("location_id").alias(f"_{role}"),
            *[F.col(c).alias(f"{role}_{c}") for c in ("zone", "borough", "service_zone")],
        )
        joined = joined.join(zone, F.col(key) == F.col(f"_{role}"), "left")
    return joined.select(
        "pickup_datetime",
        "dropoff_datetime",
        whole_minutes("pickup_datetime", "dropoff_datetime").alias("trip_minutes"),
        "vendor_id",
        "passenger_count",
        "trip_distance",
        "payment_type",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "pickup_location_id",
        "pu_zone",
        "pu_borough",
        "pu_service_zone",
        "dropoff_location_id",
        "do_zone",
        "do_borough",
        "do_service_zone",
    )


def top_boroughs(certified: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` pickup boroughs with most trips, and their mean total; the name breaks ties."""
    return (
        certified.groupBy("pu_borough")
        .agg(F.count(F.lit(1)).alias("trips"), F.avg("total_amount").alias("avg_total"))
        .orderBy(F.desc("trips"), F.asc_nulls_last("pu_borough"))
        .limit(n)
    )
