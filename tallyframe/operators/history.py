"""Type 2 dimension history: hash the attributes, close changed rows, add new ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.casts import as_int, moment
from tallyframe.functions.text import exact_fingerprint, fingerprint

# Attributes of a zone and the history columns of a type 2 dimension.
ZONE_KEY = "location_id"
ZONE_VALUES = ("borough", "zone_name", "service_zone")
HISTORY = ("record_hash", "effective_start_ts", "effective_end_ts", "is_current", "source_system")


def zone_feed(incoming: DataFrame) -> DataFrame:
    """The four typed columns of a zone feed and their ``hashdiff``."""
    typed = incoming.select(
        as_int(incoming, ZONE_KEY).alias(ZONE_KEY), *[F.col(c).cast("string").alias(c) for c in ZONE_VALUES]
    )
    return typed.withColumn("hashdiff", fingerprint(*ZONE_VALUES))


def check_unique(df: DataFrame, key: str) -> None:
    """Raise if a key other than NULL occurs twice. Counts per key are combined before the shuffle; one row comes back."""
    twice = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError(f"duplicate business keys in column {key}")


def without_key(incoming: DataFrame, key: str) -> DataFrame:
    """The rows that ``apply_history`` leaves out because their key is NULL."""
    return incoming.filter(F.col(key).isNull())


def _version(columns: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in columns.items()])


def apply_history(
    incoming: DataFrame,
    dim: DataFrame | None,
    key: str = ZONE_KEY,
    attributes: Sequence[str] = ZONE_VALUES,
    as_of=None,
    source_system: str = "NYC_TLC",
    hash_of=exact_fingerprint,
    checked: bool = False,
) -> DataFrame:
    """The whole dimension after ``incoming``.

    A new key starts a row at ``as_of``; equal attributes keep the current row; another value of any attribute
    closes the current row at ``as_of`` and starts a new one; keys missing from ``incoming`` and closed rows stay.
    Attributes are compared themselves, NULL equal to NULL, so rows hashed in another way are not touched. One
    shuffle of each side on the business key, which is unique among current rows, so it cannot be skewed. Rows
    with a NULL key have no identity and stay out; see ``without_key``. Unless ``checked`` says that the caller has
    made sure of unique incoming keys, a job that looks for repeated ones runs first.
    """
    incoming = incoming.filter(F.col(key).isNotNull())
    if not checked:
        check_unique(incoming, key)
    fresh = incoming.select(key, *attributes).withColumn("record_hash", hash_of(*attributes))
    now, forever = moment(as_of), F.lit(None).cast("timestamp")
    if dim is None:
        return fresh.withColumns(
            {
                "effective_start_ts": now,
                "effective_end_ts": forever,
                "is_current": F.lit(True),
                "source_system": F.lit(source_system),
            }
        )

    columns = (key, *attributes, *HISTORY)
    # Keys stay columns of their own and are compared plainly, so that a dimension in buckets is not shuffled. A current
    # row without a key meets nothing, since the feed has none.
    old = dim.filter("is_current").select(F.col(key).alias("_old_key"), _version({c: F.col(c) for c in columns}).alias("old"))
    new = fresh.select(F.col(key).alias("_new_key"), _version({c: F.col(c) for c in (key, *attributes, "record_hash")}).alias("new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    known, arrived = F.col("old").isNotNull(), F.col("new").isNotNull()
    equal = F.lit(True)
    for name in attributes:
        equal = equal & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    starts = arrived & (~known | ~equal)
    kept = {c: F.col(f"old.{c}") for c in columns}
    closed = {
        **kept,
        "effective_end_ts": F.when(starts, now).otherwise(kept["effective_end_ts"]),
        "is_current": ~starts,
    }
    started = {
        **{c: F.col(f"new.{c}") for c in (key, *attributes, "record_hash")},
        "effective_start_ts": now,
        "effective_end_ts": forever,
        "is_current": F.lit(True),
        "source_system": F.lit(source_system),
    }
    versions = F.array_compact(
        F.array(F.when(known, _version(closed)), F.when(starts, _version(started)))
    )
    current = both.select(F.inline(versions))
    return current.unionByName(dim.filter(~F.coalesce("is_current", F.lit(False))).select(*columns))
