"""Runs as a whole: one pass of the gate, limits that block, outputs that are published together."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import quality
from tallyframe.plans import daily
from tallyframe.sources import manifest, tablelog, writers
from tests.test_storage import raw  # noqa: F401 - fixture

def two_rules():
    return [quality.Rule("small", F.col("x") < 3), quality.Rule("even", F.col("x") % 2 == 0)]


def test_flags_are_stored_and_counted_in_one_pass(spark, tmp_path, capsys):
    rules, path = two_rules(), str(tmp_path / "base")
    spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "x int").write.parquet(path)
    flagged, seen = daily.store_flagged(spark.read.parquet(path), rules)
    observed = quality.observed_summary(spark, seen, rules, "2024-01-01 00:00:00", job_name="j")
    row = observed.first().asDict()
    assert {k: v for k, v in row.items() if k != "generated_at_utc"} == {
        "total_rows": 5, "passed_rows": 2, "failed_rows": 3, "small_fail_count": 2, "even_fail_count": 3, "job_name": "j",
    }
    again = quality.summarize(spark.read.parquet(path), rules, "2024-01-01 00:00:00", job_name="j")
    assert observed.schema.names == again.schema.names and observed.first() == again.first()
    assert sorted(r.x for r in flagged.filter("dq_pass").collect()) == [0, 2]
    assert {r.x: r.failed_rules for r in flagged.filter("NOT dq_pass").collect()} == {1: ["even"], 3: ["small", "even"], None: ["small", "even"]}
    capsys.readouterr()
    for rows in (flagged.filter("dq_pass").select("x"), flagged.filter("NOT dq_pass"), observed):
        rows.explain("formatted")
        plan = capsys.readouterr().out
        assert path not in plan, "nothing reads the base again"
    flagged.filter("dq_pass").explain("formatted")
    assert "PartitionFilters: [isnotnull(dq_pass" in capsys.readouterr().out, "each half reads its own files"


def test_an_empty_base_counts_nothing(spark):
    rules = two_rules()
    for base in (spark.createDataFrame([], "x int"), spark.range(9).select(F.col("id").cast("int").alias("x")).filter("x > 99")):
        flagged, seen = daily.store_flagged(base, rules)
        assert flagged.count() == 0
        assert quality.observed_summary(spark, seen, rules).first()["total_rows"] == 0


def summary_of(spark, total, **failures):
    fields = {"total_rows": total, **{f"{name}_fail_count": n for name, n in failures.items()}}
    return spark.createDataFrame([tuple(fields.values())], ", ".join(f"{name} long" for name in fields))


def test_verdicts_at_their_limits(spark):
    def verdicts(summary, limits=quality.TRIP_LIMITS):
        return {r.rule_name: r.verdict for r in quality.enforce(summary, limits).collect()}

    below = verdicts(summary_of(spark, 1000, vendor_not_null=9, pickup_before_dropoff=500, pu_location_not_null=400))
    assert below == {
        "vendor_not_null": "WARN", "pickup_not_null": "PASS", "dropoff_not_null": "PASS",
        "pickup_before_dropoff": "WARN", "pu_location_not_null": "WARN", "do_location_not_null": "PASS",
    }
    assert verdicts(summary_of(spark, 1000, vendor_not_null=10))["vendor_not_null"] == "BLOCK"
    assert verdicts(summary_of(spark, 1000, vendor_not_null=10), {})["vendor_not_null"] == "WARN"
    assert set(verdicts(summary_of(spark, 0)).values()) == {"PASS"}


def test_a_blocked_load_leaves_the_last_version(spark, tmp_path, raw):  # noqa: F811
    lake = daily.Lake(str(tmp_path / "lake"))
    first = daily.Run("b1", datetime(2024, 6, 1), master_db="block_master", curated_db="block_curated")
    daily.daily(spark, *raw, lake, first)
    before = manifest.published_paths(spark, lake.root)
    second = daily.Run("b2", datetime(2024, 6, 2), master_db="block_master", curated_db="block_curated", limits=quality.TRIP_LIMITS)
    with pytest.raises(daily.GateBlocked, match="vendor_not_null"):
        daily.daily(spark, *raw, lake, second)
    assert manifest.published_paths(spark, lake.root) == before
    log = {(r.run_id, r.status) for r in spark.read.json(lake.log).filter("table_name = 'curated'").select("run_id", F.lit("").alias("status")).collect()}
    assert ("b1", "") in log
    assert daily.published(spark, lake, "curated").count() == 2
    assert "vendor_not_null" in {r.run_id: r for r in daily.run_statuses(spark, lake).collect()}["b2"].error_message


@pytest.mark.parametrize("dies_at", ["lifecycle"])
def test_a_run_that_dies_between_outputs_leaves_the_old_set(spark, tmp_path, raw, monkeypatch, dies_at):  # noqa: F811
    lake = daily.Lake(str(tmp_path / "lake"))
    names = {"master_db": f"die_{dies_at}_m", "curated_db": f"die_{dies_at}_c"}
    daily.daily(spark, *raw, lake, daily.Run("d1", datetime(2024, 6, 1), **names))
    paths = manifest.published_paths(spark, lake.root)
    tables = [name for name in paths if not name.endswith("_csv") and name not in ("dq_report", "match_audit")]

    def contents():
        return {name: sorted(map(str, daily.published(spark, lake, name).collect())) for name in tables}

    before = contents()
    assert {"quarantine", "steward_queue", "rejects", "orphans", "lifecycle", "history_audit", "run_summary"} <= set(before)
    write = writers.overwrite

    def dies(df, path, *more):
        if path.endswith(dies_at):
            raise OSError("disk gone")
        write(df, path, *more)

    monkeypatch.setattr(writers, "overwrite", dies)
    with pytest.raises(OSError):
        daily.daily(spark, *raw, lake, daily.Run("d2", datetime(2024, 6, 2), **names))
    assert manifest.published_paths(spark, lake.root) == paths and contents() == before
    monkeypatch.setattr(writers, "overwrite", write)
    daily.daily(spark, *raw, lake, daily.Run("d3", datetime(2024, 6, 3), **names))
    after = manifest.published_paths(spark, lake.root)
    assert set(after) == set(paths) and not set(after.values()) & set(paths.values())
    assert [r.run_id for r in manifest.manifests(spark, lake.root).orderBy("position").collect()] == ["d1", "d3"]


def test_no_run_is_published_before_the_first(spark, tmp_path):
    lake = daily.Lake(str(tmp_path / "lake"))
    assert manifest.published_paths(spark, lake.root) == {}
    with pytest.raises(ValueError):
        daily.published(spark, lake, "quarantine")


def test_a_run_that_merges_and_groups(spark, tmp_path, raw):  # noqa: F811
    lake = daily.Lake(str(tmp_path / "lake"))
    run = daily.Run("m1", datetime(2024, 6, 1), master_db="merge_m", curated_db="merge_c", high=0.9, merge=True, group_families=True)
    daily.daily(spark, *raw, lake, run)
    master = tablelog.read_latest(spark, lake.tables, lake.log, "master_zones")
    assert {r.LocationID: (r.mdm_state, r.survivor_id) for r in master.collect()} == {
        1: ("ACTIVE", None), 3: ("MERGED", 1), 4: ("ACTIVE", None), 5: ("ACTIVE", None),
    }
    assert {r.mdm_state: r.record_count for r in daily.published(spark, lake, "lifecycle").collect()} == {"ACTIVE": 3, "MERGED": 1}
    assert daily.published(spark, lake, "golden_members").count() == 4
    assert "families" in manifest.published_paths(spark, lake.root)
