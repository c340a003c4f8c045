"""Validated trips to curated trips: one dimension joined in several roles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from tallyframe.functions.casts import as_whole, data_type, fractional_minutes, moment

# Trip key of each role and the prefix of its columns; zone attributes and their output names.
ZONE_ROLES = {"PULocationID": "pu", "DOLocationID": "do"}
ZONE_ATTRIBUTES = {"Zone": "zone", "Borough": "borough", "service_zone": "service_zone"}


def join_role(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    prefix: str,
    dim_key: str = "LocationID",
    attributes: Mapping[str, str] = ZONE_ATTRIBUTES,
) -> DataFrame:
    """Left join ``dim`` on ``key``, its columns named ``<prefix>_…``; a duplicate dim key multiplies facts.

    There is no broadcast hint: Spark broadcasts the dimension when its size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges, where AQE splits a hot or NULL
    key over several tasks.
    """
    key_type = data_type(facts, key)
    if isinstance(key_type, T.IntegralType):
        role_key = as_whole(dim, dim_key, key_type.simpleString())
    else:
        role_key = F.col(dim_key).try_cast(key_type)
    role = dim.select(
        role_key.alias(f"{prefix}_location_id"),
        *[F.col(name).alias(f"{prefix}_{out}") for name, out in attributes.items()],
    )
    return facts.join(role, F.col(key) == F.col(f"{prefix}_location_id"), "left")


def enrich(trips: DataFrame, dim: DataFrame, roles: Mapping[str, str] = ZONE_ROLES, as_of=None) -> DataFrame:
    """The curated table: duration in minutes and the zone attributes of each role whose key the trips have."""
    curated = trips.withColumn("trip_duration_min", fractional_minutes("pickup_ts", "dropoff_ts"))
    for key, prefix in roles.items():
        if key in trips.columns:
            curated = join_role(curated, dim, key, prefix)
    return curated.withColumns({"governance_zone": F.lit("curated"), "curated_at": moment(as_of)})
