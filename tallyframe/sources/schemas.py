"""Reconciling the schema of new rows with that of the table they go to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Whole types from narrow to wide, with the decimal digits that hold all their values.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
#: The largest whole number up to which a double holds every one.
EXACT_DOUBLE = 2**53
MOST_DIGITS = 38


class SchemaConflict(ValueError):
    """Two types of one column have no type that holds the values of both, or the new one is narrower."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both, or None. Whole numbers widen to larger ones, then to double."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole = [kind for kind in WHOLE if kind in (a, b)]
    if len(whole) == 2:
        return whole[-1]
    reals = (T.FloatType(), T.DoubleType())
    if a in (*WHOLE, *reals) and b in (*WHOLE, *reals):
        return T.DoubleType()
    sides = [T.DecimalType(WHOLE[kind], 0) if kind in WHOLE else kind for kind in (a, b)]
    if all(isinstance(kind, T.DecimalType) for kind in sides):
        scale = max(kind.scale for kind in sides)
        digits = max(kind.precision - kind.scale for kind in sides) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else None
    return None


def _raised(name: str, own: T.DataType, to: T.DataType) -> Column:
    """The column in a wider type; a whole number that double cannot hold exactly is an error."""
    value = F.col(f"`{name}`")
    if own == T.LongType() and to == T.DoubleType():
        message = F.concat(F.lit(f"{name} does not fit into double: "), value.cast("string"))
        fits = value.isNull() | value.between(-EXACT_DOUBLE, EXACT_DOUBLE)
        return F.when(fits, value.cast("double")).otherwise(F.raise_error(message).cast("double"))
    return value.cast(to)


def reconciled(df: DataFrame, last: T.StructType, upcast: bool = False) -> DataFrame:
    """``df`` in the union of its own schema and ``last``, the schema of the table's last version.

    The table's columns come first and keep their names and order; columns that ``df`` lacks are NULL, and new ones
    follow. A column that arrives wider widens the table. One that arrives narrower is an error, or is raised to the
    table's type with ``upcast``; types without a common one are an error. Names are matched in any case.
    """
    incoming = {field.name.lower(): field for field in df.schema}
    if len(incoming) < len(df.columns):
        raise SchemaConflict(f"columns that differ in case only: {df.columns}")
    columns, conflicts = [], []
    for field in last:
        found = incoming.pop(field.name.lower(), None)
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        both = wider(field.dataType, found.dataType)
        if both is None or (both != found.dataType and not upcast):
            conflicts.append(f"{field.name} is {field.dataType.simpleString()}, arrives as {found.dataType.simpleString()}")
        else:
            columns.append(_raised(found.name, found.dataType, both).alias(field.name))
    if conflicts:
        raise SchemaConflict("; ".join(conflicts))
    return df.select(*columns, *[F.col(f"`{field.name}`") for field in df.schema if field.name.lower() in incoming])
