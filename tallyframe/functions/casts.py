"""Casts that turn bad values into NULL, also under ANSI mode."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T


def data_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_whole(df: DataFrame, name: str, to: str | None = None) -> Column:
    """An integer key, of the column's own integral type or else bigint, so that no key is narrowed.

    Text such as ``"7.0"`` counts as 7; anything unreadable is NULL.
    """
    value, own = F.col(name), data_type(df, name)
    to = to or (own.simpleString() if isinstance(own, T.IntegralType) else "bigint")
    if isinstance(own, T.StringType):
        return F.coalesce(value.try_cast(to), value.try_cast("double").try_cast(to))
    return value.try_cast(to)


def as_int(df: DataFrame, name: str) -> Column:
    """A whole number for a layout that fixes int: unreadable values are NULL, but one that int cannot hold is an error."""
    value = as_whole(df, name, "bigint")
    fits = value.isNull() | value.between(-(2**31), 2**31 - 1)
    message = F.concat(F.lit(f"{name} does not fit into int: "), value.cast("string"))
    return F.when(fits, value.try_cast("int")).otherwise(F.raise_error(message).cast("int"))


def as_number(df: DataFrame, name: str) -> Column:
    """The column itself when it is numeric, so that tests on it reach the scan; else its double value or NULL."""
    value = F.col(name)
    return value if isinstance(data_type(df, name), T.NumericType) else value.try_cast("double")


def as_timestamp(name: str) -> Column:
    """Timestamps with and without zone, dates and text to TIMESTAMP."""
    return F.col(name).try_cast("timestamp")


def moment(as_of: datetime | str | Column | None) -> Column:
    """The clock of an operator: a given instant, or the time of the query when none is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def fractional_minutes(start: str, end: str) -> Column:
    """Minutes between two timestamps, counted in whole seconds of each side."""
    return (F.unix_seconds(F.col(end)) - F.unix_seconds(F.col(start))) / F.lit(60.0)


def whole_minutes(start: str, end: str) -> Column:
    """Full minutes elapsed, truncated toward zero."""
    return F.timestamp_diff("MINUTE", F.col(start), F.col(end))
