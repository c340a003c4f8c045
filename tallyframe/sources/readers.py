"""Scans: folders of Parquet or CSV, optional tables, table probes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.sources.scratch import via_table

_BAD_LINE = "_bad_line"


def read_parquet(spark: SparkSession, *paths: str, evolve: bool = False) -> DataFrame:
    """Parquet folders as one table; ``evolve`` merges the schemas of files written at different times."""
    return spark.read.option("mergeSchema", evolve).parquet(*paths)


def read_csv(spark: SparkSession, path: str, header: bool = True, infer: bool = False, schema=None) -> DataFrame:
    """CSV as text columns, with a given ``schema``, or with inferred types at the price of a second pass."""
    reader = spark.read.option("header", header).option("inferSchema", infer and schema is None)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_feed(spark: SparkSession, path: str, fmt: str, header: bool = True, infer: bool = False) -> DataFrame:
    """A feed that comes as ``csv`` (as text, unless types are to be inferred) or ``parquet``."""
    kind = fmt.strip().lower()
    if kind == "csv":
        return read_csv(spark, path, header=header, infer=infer)
    if kind == "parquet":
        return read_parquet(spark, path)
    raise ValueError(f"feed format must be csv or parquet, not {fmt!r}")


def read_checked(
    spark: SparkSession, path: str, types: Mapping[str, str], header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The readable lines of a CSV feed in their types, and a table of what was wrong with the others.

    ``types`` names the type of columns; with a header they are matched in any case and the rest is text, without one
    they are all the columns in order. Each line that is not blank is either kept or rejected. Rejects have line_id (of
    this read), file, line, and for each bad value its column_name, value and reason; a line with too few or too many
    fields has one reject without a column. The feed is parsed once, into a stored table.
    """
    if header:
        wanted = {name.lower(): kind for name, kind in types.items()}
        named = {name: wanted.get(name.lower(), "string") for name in read_csv(spark, path).columns}
    else:
        named = dict(types)
    text = ", ".join(f"`{name}` string" for name in named)
    typed = ", ".join(f"`{name}` {kind}" for name, kind in named.items())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_LINE}
    reader = spark.read.schema(f"{typed}, {_BAD_LINE} string").option("header", header).options(**options)
    lines = reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    stored = via_table(lines.withColumn("_line_id", F.monotonically_increasing_id()), "feed-lines")
    kept = stored.filter(F.col(_BAD_LINE).isNull()).select(*[F.col(f"`{name}`") for name in named])

    # The fields of a bad line as text; if even that fails, it has another number of fields.
    fields = F.from_csv(F.col(_BAD_LINE), f"{text}, {_BAD_LINE} string", options)
    parsed = stored.filter(F.col(_BAD_LINE).isNotNull()).select(
        F.col("_line_id").alias("line_id"), F.col("_file").alias("file"), F.col(_BAD_LINE).alias("line"), fields.alias("fields")
    )

    def reject(name: str | None, value: Column, reason: str) -> Column:
        return F.struct(
            F.lit(name).cast("string").alias("column_name"), value.cast("string").alias("value"), F.lit(reason).alias("reason")
        )

    none = F.lit(None)
    bad = [
        F.when(F.col("fields")[name].isNotNull() & F.col("fields")[name].try_cast(kind).isNull(), reject(name, F.col("fields")[name], f"not {kind}"))
        for name, kind in named.items()
        if kind != "string"
    ]
    found = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<column_name:string,value:string,reason:string>>")
    whole = F.when(F.col("fields")[_BAD_LINE].isNotNull(), F.array(reject(None, none, "number of fields")))
    rejects = whole.when(F.size(found) == 0, F.array(reject(None, none, "unreadable"))).otherwise(found)
    return kept, parsed.select("line_id", "file", "line", F.inline(rejects))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The latest state of a table folder."""
    return spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether ``path`` can be read as a table. Only 'there is no such table' counts as no; other errors pass."""
    try:
        read_table(spark, path, fmt).limit(1).count()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return False
        raise
    return True


def read_optional(spark: SparkSession, path: str) -> tuple[DataFrame | None, int | None]:
    """A CSV lookup and its row count, or two Nones with a printed warning: the caller goes on without it."""
    try:
        lookup = read_csv(spark, path)
        return lookup, lookup.count()
    except Exception as error:  # noqa: BLE001 - any failure means "no lookup"
        print(f"WARNING: lookup {path} could not be read: {error}")
        return None, None
