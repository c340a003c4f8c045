"""Row-level quality gate: rules, flags, pass/quarantine split, report and scorecards.

Rules are plain Boolean columns, so flagging is a projection inside the scan stage. Where both halves of the split and
the counts are wanted, ``observe`` counts while the flagged rows are written, and one pass over the base serves all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallyframe.functions.casts import as_number, as_timestamp, moment
from tallyframe.functions.columns import first_present

# Time columns in the order the gate looks for them, and the amounts that may not be negative.
GATE_PICKUP_NAMES = ("tpep_pickup_datetime", "pickup_datetime", "lpep_pickup_datetime", "pickup_ts")
GATE_DROPOFF_NAMES = ("tpep_dropoff_datetime", "dropoff_datetime", "lpep_dropoff_datetime", "dropoff_ts")
AMOUNTS = ("trip_distance", "fare_amount", "total_amount", "tip_amount", "tolls_amount", "extra")


class Rule(NamedTuple):
    name: str
    holds: Column


class Governance(NamedTuple):
    """Who owns a rule, what it measures and what is agreed to happen when it fails (text only)."""

    domain: str
    quality_dimension: str
    business_metric: str
    owner: str
    threshold: str
    action_on_failure: str


# The six governed rules.
TRIP_GOVERNANCE = {
    "vendor_not_null": Governance(
        "trips", "Completeness", "% trips missing VendorID", "Data Steward", "< 1%", "Block load"
    ),
    "pickup_not_null": Governance(
        "trips", "Completeness", "% trips missing pickup datetime", "Data Steward", "< 0.1%", "Block load"
    ),
    "dropoff_not_null": Governance(
        "trips", "Completeness", "% trips missing dropoff datetime", "Data Steward", "< 0.1%", "Block load"
    ),
    "pickup_before_dropoff": Governance(
        "trips", "Validity", "% trips with dropoff before pickup", "Data Owner", "0%", "Quarantine bad rows"
    ),
    "pu_location_not_null": Governance(
        "trips", "Completeness", "% trips missing pickup zone", "Data Steward", "< 0.5%", "Quarantine bad rows"
    ),
    "do_location_not_null": Governance(
        "trips", "Completeness", "% trips missing dropoff zone", "Data Steward", "< 0.5%", "Quarantine bad rows"
    ),
}


# The governed thresholds as shares that must not be reached, and the action that stops a load.
TRIP_LIMITS = {
    "vendor_not_null": 0.01,
    "pickup_not_null": 0.001,
    "dropoff_not_null": 0.001,
    "pickup_before_dropoff": 0.0,
    "pu_location_not_null": 0.005,
    "do_location_not_null": 0.005,
}
BLOCK_LOAD = "Block load"


def present(column: str) -> Column:
    return F.col(column).isNotNull()


def absent_or(df: DataFrame, column: str, low: int, high: int | None = None) -> Column:
    """NULL, or at least ``low`` and at most ``high``."""
    number = as_number(df, column)
    return F.col(column).isNull() | (number >= low if high is None else number.between(low, high))


def trip_rules(trips: DataFrame) -> list[Rule]:
    """The rules that apply to the columns ``trips`` has, in report order."""
    start, end = first_present(trips, GATE_PICKUP_NAMES), first_present(trips, GATE_DROPOFF_NAMES)
    candidates = [
        ("vendor_not_null", ["VendorID"], lambda c: present(c)),
        ("pickup_not_null", [start], lambda c: present(c)),
        ("dropoff_not_null", [end], lambda c: present(c)),
        ("pickup_before_dropoff", [start, end], lambda a, b: as_timestamp(a) <= as_timestamp(b)),
        ("pu_location_not_null", ["PULocationID"], lambda c: present(c)),
        ("do_location_not_null", ["DOLocationID"], lambda c: present(c)),
        *[(f"{name}_non_negative", [name], lambda c: absent_or(trips, c, 0)) for name in AMOUNTS],
        ("passenger_count_range", ["passenger_count"], lambda c: absent_or(trips, c, 0, 8)),
        ("ratecode_range", ["RatecodeID"], lambda c: absent_or(trips, c, 1, 6)),
    ]
    return [
        Rule(name, test(*needs)) for name, needs, test in candidates if all(need in trips.columns for need in needs)
    ]


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add one Boolean per rule, ``dq_pass`` and ``failed_rules``. A rule that is NULL has failed."""
    flagged = df.withColumns({rule.name: F.coalesce(rule.holds, F.lit(False)) for rule in rules})
    names = [rule.name for rule in rules]
    failed = F.array(*[F.when(~F.col(name), F.lit(name)) for name in names]).cast("array<string>")
    return flagged.withColumns(
        {"dq_pass": reduce(and_, [F.col(name) for name in names], F.lit(True)), "failed_rules": F.array_compact(failed)}
    )


def passed(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that hold every rule, with the columns of ``df`` only."""
    return df.filter(reduce(and_, [F.coalesce(rule.holds, F.lit(False)) for rule in rules], F.lit(True)))


def quarantined(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The other rows, with their flags and ``failed_rules``."""
    return flag(df, rules).filter(~F.col("dq_pass")).drop("dq_pass")


def _counts(rules: Sequence[Rule]) -> list[Column]:
    """What is counted over flagged rows."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("dq_pass").alias("passed_rows"),
        F.count_if(~F.col("dq_pass")).alias("failed_rows"),
        *[F.count_if(~F.col(rule.name)).alias(f"{rule.name}_fail_count") for rule in rules],
    ]


def _described(counts: DataFrame, as_of, context: Mapping[str, str]) -> DataFrame:
    extra = {name: F.lit(value) for name, value in context.items()}
    return counts.withColumns({**extra, "generated_at_utc": moment(as_of)})


def count_flags(flagged: DataFrame, rules: Sequence[Rule], as_of=None, **context: str) -> DataFrame:
    """The row of ``summarize`` from rows that carry their flags already."""
    return _described(flagged.agg(*_counts(rules)), as_of, context)


def summarize(df: DataFrame, rules: Sequence[Rule], as_of=None, **context: str) -> DataFrame:
    """One row: total, passed and failed rows, ``<rule>_fail_count`` per rule, and ``context`` as text columns."""
    return count_flags(flag(df, rules), rules, as_of, **context)


def observe(flagged: DataFrame, rules: Sequence[Rule], observation: Observation) -> DataFrame:
    """``flagged`` unchanged; the first action on it also leaves the counts of ``summarize`` in ``observation``."""
    return flagged.observe(observation, *_counts(rules))


def observed_summary(
    spark: SparkSession, observation: Observation, rules: Sequence[Rule], as_of=None, **context: str
) -> DataFrame:
    """The row of ``summarize`` from what was observed: no table is read."""
    names = ["total_rows", "passed_rows", "failed_rows", *[f"{rule.name}_fail_count" for rule in rules]]
    seen = observation.get
    counts = spark.createDataFrame([tuple(seen.get(name, 0) for name in names)], ", ".join(f"{name} bigint" for name in names))
    return _described(counts, as_of, context)


def enforce(
    summary: DataFrame,
    limits: Mapping[str, float] = TRIP_LIMITS,
    governance: Mapping[str, Governance] = TRIP_GOVERNANCE,
) -> DataFrame:
    """One row per governed rule: its failing share, its limit, and PASS, WARN or BLOCK.

    PASS: no row failed. BLOCK: the share is not below the limit, and the rule's action is to block. Everything else is
    WARN, so also a breach whose rows are quarantined. A rule without a limit never blocks; one that was not run passes.
    """
    rows = []
    for name, meta in governance.items():
        count = f"{name}_fail_count"
        failures = F.col(count) if count in summary.columns else F.lit(0)
        rows.append(
            F.struct(
                F.lit(name).alias("rule_name"),
                F.lit(meta.action_on_failure).alias("action_on_failure"),
                F.lit(limits.get(name)).cast("double").alias("limit_share"),
                failures.cast("bigint").alias("failed_rows"),
            )
        )
    lines = summary.select("total_rows", F.inline(F.array(*rows)))
    share = F.when(F.col("total_rows") > 0, F.col("failed_rows") / F.col("total_rows")).otherwise(0.0)
    breach = (F.col("action_on_failure") == BLOCK_LOAD) & (share >= F.col("limit_share"))
    verdict = F.when(F.col("failed_rows") == 0, "PASS").when(breach, "BLOCK").otherwise("WARN")
    return lines.select("rule_name", "action_on_failure", "limit_share", "failed_rows", "total_rows", verdict.alias("verdict"))


def scorecard(
    summary: DataFrame, run_id: str, governance: Mapping[str, Governance] = TRIP_GOVERNANCE
) -> DataFrame:
    """One row per governed rule; a rule that was not run counts as 0 failures.

    Unpivots the one-row summary in place, so nothing is collected.
    """
    rows = []
    for name, meta in governance.items():
        count = f"{name}_fail_count"
        failures = F.col(count) if count in summary.columns else F.lit(0)
        rows.append(
            F.struct(
                *[F.lit(value).alias(field) for field, value in meta._asdict().items()],
                failures.cast("bigint").alias("failed_rows"),
            )
        )
    lines = summary.select("generated_at_utc", "total_rows", F.inline(F.array(*rows)))
    share = F.when(F.col("total_rows") > 0, F.round(F.col("failed_rows") / F.col("total_rows"), 6)).otherwise(0.0)
    return lines.select(
        F.lit(run_id).alias("run_id"),
        F.col("generated_at_utc").cast("string").alias("generated_at_utc"),
        *Governance._fields,
        share.alias("observed_value"),
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("pass_fail"),
        "failed_rows",
        "total_rows",
    )


def by_domain(card: DataFrame, as_of=None) -> DataFrame:
    """Mean failure share, failed rules and rules of each run and domain."""
    return (
        card.groupBy("run_id", "domain")
        .agg(
            F.avg("observed_value").alias("avg_rule_fail_rate"),
            F.count_if(F.col("pass_fail") == "FAIL").alias("failed_rules"),
            F.count(F.lit(1)).alias("total_rules"),
        )
        .withColumn("generated_at_utc", moment(as_of))
    )
