"""Loads that change tables: schemas that grow, feeds with bad lines, changed dates, bucketed history, logs, scripts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tallyframe.operators import history, runs
from tallyframe.plans import daily, serving
from tallyframe.sources import readers, schemas, tablelog, writers
from tallyframe.sources.buckets import BucketedDimension

T0 = datetime(2024, 1, 1)


# ---------------------------------------------------------------- schemas


def test_wider_types(spark):
    kinds = {name: T.StructType.fromDDL(f"x {name}")[0].dataType for name in (
        "tinyint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(20,0)", "decimal(38,30)", "string", "date", "timestamp", "array<int>",
    )}
    wanted = {
        ("tinyint", "int"): "int", ("int", "bigint"): "bigint", ("bigint", "double"): "double", ("float", "int"): "double",
        ("float", "double"): "double", ("decimal(5,2)", "int"): "decimal(12,2)", ("decimal(20,0)", "decimal(5,2)"): "decimal(22,2)",
        ("decimal(38,30)", "bigint"): None, ("string", "int"): None, ("date", "timestamp"): None, ("array<int>", "int"): None,
    }
    for (a, b), both in wanted.items():
        for x, y in ((a, b), (b, a)):
            found = schemas.wider(kinds[x], kinds[y])
            assert (found and found.simpleString()) == both
    assert all(schemas.wider(kind, kind) == kind for kind in kinds.values())


def test_reconciled_schema(spark):
    last = T.StructType.fromDDL("a int, b string, c bigint, gone array<int>")
    df = spark.createDataFrame([(1, 2.5, "new", "x")], "A bigint, c double, d string, B string")
    found = schemas.reconciled(df, last)
    assert found.dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("gone", "array<int>"), ("d", "string")]
    assert tuple(found.first()) == (1, "x", 2.5, None, "new")
    narrow = spark.createDataFrame([(1,), (None,)], "c int")
    with pytest.raises(schemas.SchemaConflict, match="c is bigint, arrives as int"):
        schemas.reconciled(narrow, last)
    assert schemas.reconciled(narrow, last, upcast=True).dtypes[2] == ("c", "bigint")
    with pytest.raises(schemas.SchemaConflict, match="b is string"):
        schemas.reconciled(spark.createDataFrame([(1,)], "b int"), last, upcast=True)
    double = T.StructType.fromDDL("x double")
    exact = spark.createDataFrame([(2**53,), (None,)], "x bigint")
    assert [r.x for r in schemas.reconciled(exact, double, upcast=True).collect()] == [float(2**53), None]
    with pytest.raises(Exception, match="does not fit into double"):
        schemas.reconciled(spark.createDataFrame([(2**53 + 1,)], "x bigint"), double, upcast=True).collect()


def test_a_conflict_publishes_nothing(spark, tmp_path):
    root, log = str(tmp_path / "t"), str(tmp_path / "log")
    tablelog.publish(spark.createDataFrame([(1.0,)], "x double"), root, log, "t", evolve=True)
    with pytest.raises(schemas.SchemaConflict):
        tablelog.publish(spark.createDataFrame([("a",)], "x string"), root, log, "t", evolve=True)
    assert tablelog.latest(spark, log, "t")[1] == 0 and tablelog.read_latest(spark, root, log, "t").first().x == 1.0


# ---------------------------------------------------------------- feeds with bad lines


def test_bad_lines_are_listed_and_no_line_is_lost(spark, tmp_path):
    feed = tmp_path / "feed.csv"
    lines = ["1,Queens,A,S", "x,Queens,B,S", "3,Queens", "4,Queens,D,S,more", "", ",Queens,E,S", '6,"Queens, North",F,S', "99999999999,Bronx,G,S", "x,Queens,B,S"]
    feed.write_text("LOCATIONID,Borough,Zone,service_zone\n" + "\n".join(lines) + "\n")
    kept, rejects = readers.read_checked(spark, str(feed), {"LocationID": "int"})
    assert [(r.LOCATIONID, r.Borough) for r in kept.collect()] == [(1, "Queens"), (None, "Queens"), (6, "Queens, North")]
    assert kept.dtypes[0] == ("LOCATIONID", "int")
    found = sorted(((r.line, r.column_name, r.value, r.reason) for r in rejects.collect()), key=str)
    assert found == sorted([
        ("x,Queens,B,S", "LOCATIONID", "x", "not int"), ("x,Queens,B,S", "LOCATIONID", "x", "not int"),
        ("3,Queens", None, None, "number of fields"), ("4,Queens,D,S,more", None, None, "number of fields"),
        ("99999999999,Bronx,G,S", "LOCATIONID", "99999999999", "not int"),
    ], key=str)
    assert kept.count() + rejects.select("line_id").distinct().count() == len([x for x in lines if x])
    assert rejects.first().file.endswith("feed.csv")


def test_several_bad_values_of_a_line(spark, tmp_path):
    feed = tmp_path / "feed.csv"
    feed.write_text("1,2024-01-01,a\nx,never,b\n")
    kept, rejects = readers.read_checked(spark, str(feed), {"n": "int", "d": "date", "t": "string"}, header=False)
    assert kept.count() == 1
    assert sorted((r.column_name, r.value, r.reason) for r in rejects.collect()) == [("d", "never", "not date"), ("n", "x", "not int")]


def test_a_checked_load_stages_readable_lines_only(spark, tmp_path):
    feed = tmp_path / "zones.csv"
    feed.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,A,S\nx,Queens,B,S\n")
    lake = daily.Lake(str(tmp_path / "lake"))
    daily.load_feed(spark, str(feed), "csv", True, lake, daily.Run("c1"), checked=True)
    assert [r.location_id for r in spark.read.parquet(lake.folder("staging/zones_incoming")).collect()] == [1]
    assert [(r.value, r.run_id) for r in spark.read.parquet(lake.folder("feed_rejects")).collect()] == [("x", "c1")]


# ---------------------------------------------------------------- changed dates


def test_only_the_dates_that_come_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).select("id", (F.col("id") % 8).cast("int").alias("d"))
    writers.overwrite_dates(rows, path, "d")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("d=*/part-*")}
    writers.overwrite_dates(rows.filter("d < 2 AND id > 9").withColumn("id", -F.col("id")), path, "d")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("d=*/part-*")}
    kept = {p for p in before if p.parent.name not in ("d=0", "d=1")}
    assert all(after[p] == before[p] for p in kept) and kept == set(before) & set(after)
    assert {r.d: r.n for r in spark.read.parquet(path).groupBy("d").agg(F.sum("id").alias("n")).collect()}[0] == -(16 + 24 + 32)


def test_refreshed_trips(spark, tmp_path):
    schema = "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, DOLocationID int, fare_amount double"
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,A,S\n")
    lake, run = daily.Lake(str(tmp_path / "lake")), daily.Run("f1", T0)

    def load(name, rows):
        spark.createDataFrame([(1, datetime(2024, 1, d), datetime(2024, 1, d, 1), 1, 2, fare) for d, fare in rows], schema).write.parquet(str(tmp_path / name))
        return [r.pickup_date.day for r in daily.refresh_trips(spark, str(tmp_path / name), str(zones), lake, run).collect()]

    assert load("a", [(1, 5.0), (1, 6.0), (2, 7.0), (3, 8.0)]) == []
    assert load("b", [(1, 9.0), (3, -1.0), (4, 1.0)]) == [3]
    for table in ("validated", "curated"):
        found = spark.read.parquet(lake.folder(f"by_date/{table}"))
        assert sorted((r.pickup_date.day, r.fare_amount) for r in found.collect()) == [(1, 9.0), (2, 7.0), (3, 8.0), (4, 1.0)]
    assert found.filter("pu_zone = 'A'").count() == 4


# ---------------------------------------------------------------- type 2 history in buckets


@pytest.fixture
def dimension(spark, tmp_path):
    name = f"buckets_{tmp_path.name.replace('-', '_')}"
    spark.sql("CREATE DATABASE IDENTIFIER(:db) LOCATION :path", args={"db": name, "path": str(tmp_path / "db")})
    return BucketedDimension(name, "zones", buckets=6)


def zones_of(spark, rows):
    return spark.createDataFrame(rows, "location_id int, borough string, zone_name string, service_zone string")


def test_a_load_shuffles_its_feed_alone(spark, dimension, capsys):
    dimension.load(spark, zones_of(spark, [(i, "Q", f"zone {i}", "S") for i in range(200)]), T0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed = zones_of(spark, [(1, "Q", "zone 1", "S"), (2, "Q", "new", "S"), (900, "Q", "more", "S")])
        capsys.readouterr()
        dimension.changes(spark, feed, datetime(2024, 2, 1), checked=True).explain("formatted")
        plan = capsys.readouterr().out
        tree = plan.split("\n\n")[0]
        assert tree.count("Exchange") == 1 and "Bucketed: true" in plan
        assert "hashpartitioning(_new_key" in plan and "FullOuter" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_bucketed_history_equals_the_plain_one(spark, dimension):
    days = [
        [(1, "Q", "a", "S"), (2, "Q", "b", None), (3, "Q", "c", "S"), (None, "Q", "none", "S")],
        [(1, "Q", "a", "S"), (2, "Q", "b", "S"), (4, "B", "d", "S")],
        [(2, "Q", "b", None), (4, "B", "dd", "S")],
    ]
    plain = None
    for number, rows in enumerate(days, start=1):
        feed = zones_of(spark, rows)
        whole = history.apply_history(feed, plain, as_of=datetime(2024, 1, number))
        kept = whole.collect()
        plain = spark.createDataFrame(kept, whole.schema)
        dimension.load(spark, feed, datetime(2024, 1, number))
        found = dimension.read(spark)
        assert found.columns == plain.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, kept))
    assert dimension.version(spark) == 2 and dimension.read(spark).filter("NOT is_current").count() == 3


def test_a_load_that_dies_is_not_seen_and_can_be_repeated(spark, dimension, monkeypatch):
    dimension.load(spark, zones_of(spark, [(1, "Q", "a", "S")]), T0)
    before = dimension.read(spark).collect()
    feed = zones_of(spark, [(1, "Q", "b", "S")])
    sql = spark.sql

    def dies(text, *more, **named):
        if "CREATE OR REPLACE VIEW" in text:
            raise OSError("gone")
        return sql(text, *more, **named)

    monkeypatch.setattr(spark, "sql", dies)
    with pytest.raises(OSError):
        dimension.load(spark, feed, datetime(2024, 2, 1))
    monkeypatch.setattr(spark, "sql", sql)
    assert dimension.read(spark).collect() == before and dimension.version(spark) == 0
    dimension.load(spark, feed, datetime(2024, 2, 1))
    assert sorted((r.zone_name, r.is_current) for r in dimension.read(spark).collect()) == [("a", False), ("b", True)]


# ---------------------------------------------------------------- event log and scripts


def test_a_start_reads_one_part_of_the_event_log(spark, tmp_path, capsys):
    lake = daily.Lake(str(tmp_path / "lake"))
    for number in range(5):
        daily.log_event(spark, lake, daily.Run(f"r{number}", T0), runs.STARTED)
    daily.log_event(spark, lake, daily.Run("r3", T0), runs.STARTED)
    daily.log_event(spark, lake, daily.Run("r3", T0), runs.SUCCEEDED)
    found = daily.events_of(spark, lake, "r3")
    assert sorted(r.status for r in found.collect()) == ["STARTED", "SUCCEEDED"]
    capsys.readouterr()
    found.explain("formatted")
    bucket = spark.range(1).select(runs.event_bucket(F.lit("r3"))).first()[0]
    plan = capsys.readouterr().out
    assert f"(bucket#" in plan and f"= {bucket})" in plan and "PartitionFilters" in plan
    assert len(found.inputFiles()) >= 2
    assert {r.run_id: r.status for r in daily.run_statuses(spark, lake).collect()}["r3"] == "SUCCEEDED"


def test_statements_end_outside_quotes_and_comments():
    script = """-- first; not here
    CREATE TABLE a AS SELECT ';' AS x, "b;c" AS y, 'it\\'s; me' AS z; /* ; */
    ; SELECT `odd;name` FROM a -- end; of line
    WHERE x <> '--;' ;
    -- nothing more;
    """
    found = serving.statements(script)
    assert len(found) == 2 and found[0].startswith("-- first") and found[1].endswith("'--;'")
    assert serving.statements("") == [] == serving.statements(" ;; -- x\n")
    assert serving.statements("SELECT 1") == ["SELECT 1"]


def test_scripts_of_a_folder_run_in_name_order_until_one_fails(spark, tmp_path):
    folder = tmp_path / "scripts"
    folder.mkdir()
    (folder / "02_more.sql").write_text("SELECT * FROM script_db.missing; CREATE TABLE script_db.never (x INT) USING PARQUET;")
    (folder / "01_first.sql").write_text("CREATE DATABASE script_db;\nCREATE TABLE script_db.t USING PARQUET AS SELECT :run_id AS id, ';' AS x;\n")
    scripts = serving.read_scripts(spark, str(folder))
    assert [s.name for s in scripts] == ["01_first.sql#1", "01_first.sql#2", "02_more.sql#1", "02_more.sql#2"]
    with pytest.raises(serving.ScriptError) as failure:
        serving.run_scripts(spark, scripts, {"run_id": "s1"})
    rows = [(r.script, r.status) for r in failure.value.statuses.orderBy("position").collect()]
    assert rows == [("01_first.sql#1", "SUCCEEDED"), ("01_first.sql#2", "SUCCEEDED"), ("02_more.sql#1", "FAILED")]
    assert tuple(spark.table("script_db.t").first()) == ("s1", ";")
    assert not spark.catalog.tableExists("script_db.never")
