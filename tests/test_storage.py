"""Readers, writers, table log, SQL serving and the daily run."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import runs
from tallyframe.plans import daily, serving
from tallyframe.sources import manifest, readers, scratch, tablelog, writers

T0 = datetime(2024, 1, 1, 10, 0, 0)


def test_readers(spark, tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,A,S\n2,Bronx,B,S\n")
    assert dict(readers.read_csv(spark, str(csv)).dtypes)["LocationID"] == "string"
    assert dict(readers.read_csv(spark, str(csv), infer=True).dtypes)["LocationID"] == "int"
    assert readers.read_csv(spark, str(csv), schema="a bigint, b string, c string, d string").first().a == 1
    parquet = str(tmp_path / "zones")
    readers.read_csv(spark, str(csv)).write.parquet(parquet)
    assert readers.read_feed(spark, parquet, " Parquet ").count() == 2
    assert daily.stage_feed(spark, str(csv), "csv", True, "r").count() == 2
    with pytest.raises(ValueError):
        readers.read_feed(spark, parquet, "orc")
    with pytest.raises(ValueError):
        daily.stage_feed(spark, str(csv), "csv", False, "r")
    assert readers.read_optional(spark, str(csv))[1] == 2
    assert readers.read_optional(spark, str(tmp_path / "none")) == (None, None)


def test_table_probe(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(b)
    assert readers.table_exists(spark, b) and not readers.table_exists(spark, a)


def test_schema_evolution_on_read(spark, tmp_path):
    a, b = str(tmp_path / "t/a"), str(tmp_path / "t/b")
    spark.range(2).write.parquet(a)
    spark.range(2).withColumn("extra", F.lit(1)).write.parquet(b)
    assert readers.read_parquet(spark, a, b, evolve=True).columns == ["id", "extra"]


def test_partitioned_overwrite_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(90).select("id", F.when(F.col("id") < 30, 0).otherwise(F.col("id") % 5).alias("d"))
    writers.overwrite_partitioned(df, path, "d")
    writers.overwrite_partitioned(df.filter("d < 2"), path, "d")
    assert sorted(p.name for p in (tmp_path / "t").glob("d=*")) == ["d=0", "d=1"]
    assert spark.read.parquet(path).count() == df.filter("d < 2").count()


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "x int, tags array<string>")
    path = str(tmp_path / "csv")
    writers.report_csv(df, path)
    writers.report_csv(df, path)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 2
    assert [r.tags for r in readers.read_csv(spark, path).collect()] == ["a|b", "a|b"]
    writers.report_json(df, str(tmp_path / "json"))
    files = list((tmp_path / "json").glob("part-*.json"))
    assert len(files) == 1 and json.loads(files[0].read_text()) == {"x": 1, "tags": ["a", "b"]}
    writers.listing_csv(df, str(tmp_path / "listing"))
    assert readers.read_csv(spark, str(tmp_path / "listing")).count() == 1
    assert writers.table_format(spark) == "parquet"


def test_scratch_folder_follows_the_session(spark):
    folder = scratch.scratch_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != scratch.scratch_folder(spark, "x")
    assert scratch.via_table(spark.range(4), "x").count() == 4


def test_publish_reads_its_own_table_and_keeps_history(spark, tmp_path):
    root, log = str(tmp_path / "tables"), str(tmp_path / "log")
    assert not tablelog.has_versions(spark, root, log, "t")
    with pytest.raises(ValueError):
        tablelog.read_latest(spark, root, log, "t")
    tablelog.publish(spark.range(10), root, log, "t", run_id="r0", as_of=T0)
    tablelog.publish(tablelog.read_latest(spark, root, log, "t").filter("id < 4"), root, log, "t", run_id="r1", as_of=T0)
    assert tablelog.read_latest(spark, root, log, "t").count() == 4
    tablelog.publish(spark.range(1), root, log, "other")
    histories = {n: tablelog.table_history(spark, root, log, n) for n in ("t", "other")}
    audit = tablelog.history_audit(histories, "job", T0)
    found = sorted((r.table_name, r.version, r.num_output_rows, r.run_id) for r in audit.collect() if r.table_name == "t")
    assert found == [("t", 0, 10, "r0"), ("t", 1, 4, "r1")]
    assert audit.count() == 3


def test_history_from_a_delta_log_without_delta(spark, tmp_path):
    logs = tmp_path / "t" / "_delta_log"
    logs.mkdir(parents=True)
    for version, operation in enumerate(["WRITE", "MERGE"]):
        lines = [{"commitInfo": {"timestamp": 1700000000000 + version, "operation": operation}}, {"add": {"path": "p"}}]
        (logs / f"{version:020d}.json").write_text("\n".join(map(json.dumps, lines)))
    rows = tablelog.delta_history(spark, str(tmp_path / "t"), has_delta=False).orderBy("version").collect()
    assert [(r.version, r.operation) for r in rows] == [(0, "WRITE"), (1, "MERGE")]


def test_replace_table_keeps_the_definition(spark, tmp_path):
    spark.sql("CREATE DATABASE loads LOCATION :p", args={"p": str(tmp_path / "loads")})
    spark.sql("CREATE TABLE loads.t (id BIGINT, name STRING) USING PARQUET")
    writers.replace_table(spark.createDataFrame([("a", 1), ("b", 2)], "name string, id bigint"), "loads.t")
    writers.replace_table(spark.createDataFrame([("c", 3)], "name string, id bigint"), "loads.t")
    assert [tuple(r) for r in spark.table("loads.t").collect()] == [(3, "c")]


def test_scripts_stop_at_the_first_failure(spark):
    scripts = [
        serving.Script("one", "default", "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:curated)"),
        serving.Script("two", serving.CURATED, "SELECT * FROM IDENTIFIER(:curated || '.nothing')"),
        serving.Script("three", "default", "SELECT 1"),
    ]
    with pytest.raises(serving.ScriptError) as failure:
        serving.run_scripts(spark, scripts, {"curated": "scripts_db"})
    rows = failure.value.statuses.orderBy("position").collect()
    assert [(r.script, r.database, r.status) for r in rows] == [("one", "default", "SUCCEEDED"), ("two", "scripts_db", "FAILED")]
    assert "nothing" in rows[1].error


@pytest.fixture
def raw(spark, tmp_path):
    zones = tmp_path / "zones.csv"
    zones.write_text(
        "LocationID,Borough,Zone,service_zone\n1,Queens,Astoria Park,Boro\n2,Queens,Astoria-Park,Boro\n"
        "3,Queens,Astoria Parks,Boro\n4,Bronx,Hill,Boro\n5,Queens,Astoria Paris Road,Boro\n"
    )
    trips = [
        (1, T0, datetime(2024, 1, 1, 10, 20), 1, 4, 5.0, 1),
        (1, T0, datetime(2024, 1, 1, 10, 20), 2, 99, 5.0, 1),
        (None, T0, datetime(2024, 1, 2, 10, 20), 1, 4, 5.0, 1),
        (1, T0, datetime(2024, 1, 1, 9, 0), 1, 4, 5.0, 1),
    ]
    schema = (
        "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, "
        "DOLocationID int, fare_amount double, passenger_count int"
    )
    df = spark.createDataFrame(trips, schema).withColumns(
        {**{c: F.lit(1.0) for c in ("trip_distance", "tip_amount", "total_amount")}, "payment_type": F.lit(1)}
    )
    df.write.parquet(str(tmp_path / "trips"))
    return str(tmp_path / "trips"), str(zones)


def test_daily_run_end_to_end_twice(spark, tmp_path, raw):
    trips, zones = raw
    lake = daily.Lake(str(tmp_path / "lake"))
    spark.sql("CREATE DATABASE daily_wh LOCATION :p", args={"p": str(tmp_path / "wh")})
    for number in (1, 2):
        run = daily.Run(f"r{number}", datetime(2024, 6, number), master_db="daily_master", curated_db="daily_curated", review=0.8)
        statuses = daily.daily(spark, trips, zones, lake, run, warehouse="daily_wh")
        assert {r.status for r in statuses.collect()} == {"SUCCEEDED"}

        read = lambda name: daily.published(spark, lake, name)
        assert tablelog.read_latest(spark, lake.tables, lake.log, "curated").count() == 2
        assert [r.failed_rules for r in read("quarantine").collect()] == [["vendor_not_null"]]
        report = spark.read.json(manifest.published_paths(spark, lake.root)["dq_report"]).first()
        assert (report["total_rows"], report["passed_rows"], report["base_source"]) == (3, 2, "CURATED")
        assert read("steward_queue").count() == 0 or read("steward_queue").first().review_status == "PENDING"
        ledger = {r.borough: r for r in read("rejects").collect()}
        assert ledger["QUEENS"].total_pairs_compared == 6
        master = tablelog.read_latest(spark, lake.tables, lake.log, "master_zones")
        assert sorted(r.LocationID for r in master.collect()) == [1, 3, 4, 5]
        # Zone 2 was merged into 1, zone 99 never existed.
        assert sorted(r.orphan_type for r in read("orphans").collect()) == ["DROPOFF_NOT_IN_MASTER", "PICKUP_NOT_IN_MASTER"]
        certified = serving.certified_view(spark, "daily_curated")
        assert certified.count() == 2 and certified.filter("pu_zone is not null").count() == 1
        assert spark.table("daily_wh.fact_trip").count() == 2
        top = serving.top_boroughs_sql(spark, "daily_curated").collect()
        assert {(r.pu_borough, r.trips) for r in top} == {("Queens", 1), (None, 1)}
        assert spark.table("daily_master.dim_zone").count() == 4, "an unchanged dimension gains no rows"

    audit = {r.run_id: r.status for r in daily.run_statuses(spark, lake).collect()}
    assert audit == {"r1": "SUCCEEDED", "r2": "SUCCEEDED"}
    log = spark.read.option("header", True).csv(lake.folder("steward_log"))
    assert {r.run_id for r in log.collect()} == {"r1", "r2"}


def test_a_failing_export_leaves_the_view_readable(spark, tmp_path, raw, monkeypatch):
    lake = daily.Lake(str(tmp_path / "lake"))
    run = daily.Run("e1", datetime(2024, 6, 1), master_db="kept_master", curated_db="kept_curated")
    daily.daily(spark, *raw, lake, run)
    before = sorted(map(str, serving.certified_view(spark, "kept_curated").collect()))
    write = writers.overwrite

    def dies(df, path, *more):
        if path.endswith("export_fact_trip"):
            raise OSError("disk gone")
        write(df, path, *more)

    monkeypatch.setattr(writers, "overwrite", dies)
    with pytest.raises(OSError):
        daily.daily(spark, *raw, lake, daily.Run("e2", datetime(2024, 6, 2), master_db="kept_master", curated_db="kept_curated"))
    assert sorted(map(str, serving.certified_view(spark, "kept_curated").collect())) == before


def test_zones_without_a_readable_key_do_not_stop_the_day(spark, tmp_path, raw):
    lake = daily.Lake(str(tmp_path / "lake"))
    zones = tmp_path / "odd_zones.csv"
    zones.write_text((tmp_path / "zones.csv").read_text() + "x,Queens,No Key,Boro\ny,Bronx,Nor This,Boro\n")
    daily.daily(spark, raw[0], str(zones), lake, daily.Run("k1", master_db="odd_master", curated_db="odd_curated"))
    assert daily.published(spark, lake, "zones_without_key").count() == 2
    assert spark.table("odd_master.dim_zone").filter("location_id is null").count() == 0


def test_a_second_layout_by_date_needs_no_shuffle(spark, tmp_path, capsys):
    rows = spark.range(100).withColumn("d", (F.col("id") % 5).cast("string"))
    writers.overwrite_partitioned(rows, str(tmp_path / "a"), "d")
    again = spark.read.parquet(str(tmp_path / "a")).withColumn("x", F.lit(1))
    again.explain()
    assert "Exchange" not in capsys.readouterr().out
    writers.overwrite_partitioned(again, str(tmp_path / "b"), "d", laid_out=True)
    files = list((tmp_path / "b").glob("d=*/part-*"))
    assert len(files) <= 5 * len(list((tmp_path / "a").glob("d=*/part-*")))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 100


def test_feed_text_is_not_changed_by_guessed_types(spark, tmp_path):
    feed = tmp_path / "feed.csv"
    feed.write_text("LocationID,Borough,Zone,service_zone\n7,007,1.50,2024-01-01\n")
    row = daily.stage_feed(spark, str(feed), "csv", True, "r").first()
    assert (row.location_id, row.borough, row.zone_name, row.service_zone) == (7, "007", "1.50", "2024-01-01")


def test_daily_run_records_a_failure(spark, tmp_path, raw):
    lake = daily.Lake(str(tmp_path / "lake"))
    with pytest.raises(Exception):
        daily.daily(spark, raw[0], str(tmp_path / "no_zones.csv"), lake, daily.Run("bad"))
    row = daily.run_statuses(spark, lake).first()
    assert row.status == runs.FAILED and "no_zones.csv" in row.error_message


def test_feed_load_appends_and_runs_scripts_in_order(spark, tmp_path, raw):
    lake = daily.Lake(str(tmp_path / "lake"))
    scripts = [
        serving.Script("02_table", "feed_db", "CREATE TABLE feed_db.seen AS SELECT :run_id AS run_id, :job_name AS job"),
        serving.Script("01_database", "default", "CREATE DATABASE feed_db"),
    ]
    statuses = daily.load_feed(spark, raw[1], "csv", True, lake, daily.Run("f1"), scripts)
    assert [r.script for r in statuses.orderBy("position").collect()] == ["01_database", "02_table"]
    assert tuple(spark.table("feed_db.seen").first()) == ("f1", "load_feed")
    assert daily.load_feed(spark, raw[1], "csv", True, lake, daily.Run("f2")).count() == 0
    staged = spark.read.parquet(lake.folder("staging/zones_incoming"))
    assert {r.run_id: r["count"] for r in staged.groupBy("run_id").count().collect()} == {"f1": 5, "f2": 5}
    with pytest.raises(ValueError):
        daily.load_feed(spark, raw[1], "xml", True, lake, daily.Run("f3"))
    assert {r.run_id: r.status for r in daily.run_statuses(spark, lake).collect()} == {
        "f1": "SUCCEEDED", "f2": "SUCCEEDED", "f3": "FAILED",
    }
