"""The daily run: every stage in order over a lake folder, with run events around it.

Each stage reads what the one before has written, so a lost executor repeats part of one stage at most. All outputs of
a run have folders of their own, which its manifest names when the run is complete: ``published`` reads whole runs only,
and a run that dies leaves the last one as it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyframe.functions import text as tx
from tallyframe.operators import conform, history, matching, quality, runs, stewardship, survivorship
from tallyframe.operators.enrich import enrich
from tallyframe.operators.ingest import derive_times, validate
from tallyframe.plans import serving
from tallyframe.sources import manifest, readers, tablelog, writers
from tallyframe.sources.scratch import scratch_folder, via_table


@dataclass(frozen=True)
class Lake:
    """Folders of a lake, all below ``root``."""

    root: str

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def tables(self) -> str:
        return self.folder("tables")

    @property
    def log(self) -> str:
        return self.folder("table_log")


@dataclass(frozen=True)
class Run:
    """What a run is given: its id and clock, thresholds, the databases it serves, and what it does beyond reporting."""

    run_id: str
    as_of: object = None
    high: float = tx.HIGH_CONFIDENCE
    review: float = tx.REVIEW_CONFIDENCE
    master_db: str = "zone_master"
    curated_db: str = "trip_curated"
    trigger_type: str = "manual"
    data_owner: str = "analytics-team"
    #: Failing shares that stop the publication of curated trips, such as ``quality.TRIP_LIMITS``; None for none.
    limits: Mapping[str, float] | None = None
    #: Whether names that AUTO_MERGE keep one golden record, and families of close names come as one row.
    merge: bool = False
    group_families: bool = False


def _read(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return tablelog.read_latest(spark, lake.tables, lake.log, table)


def _publish(
    df: DataFrame, lake: Lake, table: str, run: Run, partition: str | None = None, laid_out: bool = False
) -> str:
    return tablelog.publish(df, lake.tables, lake.log, table, partition, run.run_id, run.as_of, laid_out)


def published(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """An output of the last complete run."""
    return manifest.read_published(spark, lake.root, name)


def validate_trips(spark: SparkSession, raw_trips: str, lake: Lake, run: Run, outputs: manifest.Outputs) -> None:
    trips = readers.read_parquet(spark, raw_trips)
    outputs.bind("validated", _publish(validate(trips, as_of=run.as_of), lake, "validated", run, "pickup_date"))


def refresh_trips(spark: SparkSession, raw_trips: str, zones_csv: str, lake: Lake, run: Run) -> DataFrame:
    """Replace the dates that ``raw_trips`` has, whole, in the validated and curated trips by date; touch no other.

    For feeds that deliver some dates anew, beside the versions of the daily run. Returns the dates of which no trip is
    valid (``pickup_date``): nothing replaces those, so their old trips stay.
    """
    raw = derive_times(readers.read_parquet(spark, raw_trips))
    fresh = via_table(validate(readers.read_parquet(spark, raw_trips), as_of=run.as_of), "fresh-trips")
    zones = readers.read_csv(spark, zones_csv)
    writers.overwrite_dates(fresh, lake.folder("by_date/validated"), "pickup_date")
    writers.overwrite_dates(enrich(fresh, zones, as_of=run.as_of), lake.folder("by_date/curated"), "pickup_date")
    dates = raw.select("pickup_date").dropna().distinct()
    return dates.join(fresh.select("pickup_date").distinct(), "pickup_date", "left_anti")


def curate_trips(spark: SparkSession, zones_csv: str, lake: Lake, run: Run) -> None:
    zones = readers.read_csv(spark, zones_csv)
    trips = enrich(_read(spark, lake, "validated"), zones, as_of=run.as_of)
    _publish(trips, lake, "curated", run, "pickup_date", laid_out=True)


class GateBlocked(RuntimeError):
    """Failing rows reached a limit that blocks the load; curated trips were not published."""


def store_flagged(base: DataFrame, rules: Sequence[quality.Rule]) -> tuple[DataFrame, Observation]:
    """The flagged rows, stored apart by ``dq_pass``, and their counts, from one pass over ``base``."""
    seen = Observation()
    flagged = quality.flag(base, rules)
    path = scratch_folder(base.sparkSession, "flagged")
    quality.observe(flagged, rules, seen).write.partitionBy("dq_pass").parquet(path)
    return base.sparkSession.read.schema(flagged.schema).parquet(path), seen


def gate_trips(spark: SparkSession, lake: Lake, run: Run, outputs: manifest.Outputs) -> None:
    """Split the base into a new curated version and the quarantine; report on the base.

    The base is read once; summary, quarantine and curated trips come from what that pass stored and counted.
    """
    base, source = tablelog.choose_latest(spark, lake.tables, lake.log, "curated", "validated")
    rules = quality.trip_rules(base)
    flagged, seen = store_flagged(base, rules)
    quarantine = outputs.folder("quarantine")
    writers.overwrite(flagged.filter("NOT dq_pass").drop("dq_pass"), quarantine)
    summary = quality.observed_summary(
        spark,
        seen,
        rules,
        run.as_of,
        job_name="quality_gate",
        base_source=source,
        input_path=tablelog.table_folder(lake.tables, "validated"),
        curated_delta_path=tablelog.table_folder(lake.tables, "curated"),
        quarantine_path=quarantine,
    )
    writers.report_json(summary, outputs.folder("dq_report"))
    card = quality.scorecard(summary, run.run_id)
    writers.report_csv(card, lake.folder("quality_scorecard"))
    writers.report_csv(quality.by_domain(card, run.as_of), lake.folder("quality_by_domain"))
    if run.limits is not None:
        verdicts = quality.enforce(summary, run.limits)
        blocked = [row["rule_name"] for row in verdicts.filter("verdict = 'BLOCK'").collect()]
        if blocked:
            raise GateBlocked(f"load blocked by {', '.join(blocked)}")
    by_date = "pickup_date" if "pickup_date" in base.columns else None
    passed = flagged.filter("dq_pass").select(base.columns)
    outputs.bind("curated", _publish(passed, lake, "curated", run, by_date, laid_out=True))


def accept(
    records: DataFrame, high: float = tx.HIGH_CONFIDENCE, review: float = tx.REVIEW_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """The stored copies of the records, and the accepted names.

    Each step is written to a table, so the records are read once and Spark knows sizes when it plans the next step.
    """
    per_copy, classes = name_tables(records)
    hot = via_table(matching.hot_names(classes, review), "hot-names")
    return per_copy, via_table(matching.accepted_names(per_copy, high, review, classes, hot), "accepted-names")


def name_tables(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The copies of the records and their name classes, stored."""
    per_copy = via_table(matching.copies(records), "copies")
    return per_copy, via_table(matching.name_classes(per_copy), "name-classes")


def accept_grouped(
    records: DataFrame, high: float = tx.HIGH_CONFIDENCE, review: float = tx.REVIEW_CONFIDENCE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like ``accept``, with the families whose names are all accepted as one row each instead of all their pairs.

    Returns the copies, the accepted names of other pairs, and the families. Numbered names make a row per name this way,
    where pairs grow with the square.
    """
    per_copy, classes = name_tables(records)
    close = via_table(matching.close_families(classes, review), "close-families")
    hot = via_table(matching.hot_names(classes, review, close), "hot-names")
    accepted = via_table(matching.accepted_names(per_copy, high, review, classes, hot, close), "accepted-names")
    return per_copy, accepted, via_table(matching.family_groups(per_copy, classes, high, review), "families")


def merged_members(records: DataFrame, high: float = tx.HIGH_CONFIDENCE) -> DataFrame:
    """Where every match key of the records goes when names that AUTO_MERGE at ``high`` keep one survivor."""
    per_copy, classes = name_tables(records)
    links = via_table(survivorship.merge_links(classes, high), "merge-links")
    return survivorship.golden_members(per_copy, links)


def match_zones(spark: SparkSession, zones_csv: str, lake: Lake, run: Run, outputs: manifest.Outputs) -> None:
    records = matching.normalize(readers.read_csv(spark, zones_csv))
    families = None
    if run.group_families:
        per_copy, accepted, families = accept_grouped(records, run.high, run.review)
        writers.overwrite(families, outputs.folder("families"))
    else:
        per_copy, accepted = accept(records, run.high, run.review)
    ledger = via_table(matching.block_ledger(per_copy, accepted, families), "block-ledger")

    queue_path, rejects_path = outputs.folder("steward_queue"), outputs.folder("rejects")
    writers.overwrite(matching.steward_queue(accepted, per_copy, run.as_of), queue_path)
    writers.listing_csv(readers.read_parquet(spark, queue_path), outputs.folder("approval_queue_csv"))
    writers.overwrite(ledger, rejects_path)
    golden = matching.golden(records, run.as_of)
    if run.merge:
        members = outputs.folder("golden_members")
        writers.overwrite(merged_members(records, run.high), members)
        golden = survivorship.merge_golden(golden, readers.read_parquet(spark, members), run.as_of)
    master_path = outputs.bind("master_zones", _publish(golden, lake, "master_zones", run))

    audit = matching.match_audit(
        records,
        ledger,
        run.high,
        run.review,
        run.as_of,
        raw_zones_path=zones_csv,
        master_out_path=master_path,
        master_format=writers.table_format(spark),
        steward_queue_path=queue_path,
        rejects_path=rejects_path,
        job_name="match_zones",
    )
    writers.report_json(audit, outputs.folder("match_audit"))
    writers.report_csv(matching.mdm_scorecard(records, ledger, run.run_id, run.as_of), lake.folder("mdm_scorecard"))


def steward(spark: SparkSession, lake: Lake, run: Run, outputs: manifest.Outputs) -> None:
    job = "stewardship"
    master, trips = _read(spark, lake, "master_zones"), _read(spark, lake, "curated")
    orphans_path, lifecycle_path = outputs.folder("orphans"), outputs.folder("lifecycle")
    history_path = outputs.folder("history_audit")
    writers.overwrite(stewardship.orphans(trips, master, job, as_of=run.as_of), orphans_path)
    found = readers.read_parquet(spark, orphans_path)
    writers.listing_csv(found, outputs.folder("orphans_csv"))
    writers.overwrite(stewardship.lifecycle(master, job, run.as_of), lifecycle_path)

    histories = {
        name: tablelog.table_history(spark, lake.tables, lake.log, table)
        for name, table in (("master_zones", "master_zones"), ("curated_trips", "curated"))
    }
    writers.overwrite(tablelog.history_audit(histories, job, run.as_of), history_path)
    summary = stewardship.run_summary(
        master,
        trips,
        found,
        job,
        run.as_of,
        master_zones_path=histories["master_zones"][1],
        curated_trips_path=histories["curated_trips"][1],
        orphans_out_path=orphans_path,
        lifecycle_snapshot_path=lifecycle_path,
        audit_history_out_path=history_path,
    )
    summary_path = outputs.folder("run_summary")
    writers.overwrite(summary, summary_path)
    told = stewardship.activity(readers.read_parquet(spark, summary_path), run.run_id, run.as_of)
    writers.report_csv(told, lake.folder("steward_log"))


def export(spark: SparkSession, lake: Lake, run: Run, outputs: manifest.Outputs) -> tuple[str, str]:
    """Dimension history and fact as plain Parquet, in new folders; returns them.

    The tables that serve are pointed at the new folders only when both are complete, so a run that dies here
    leaves them readable. Zones without a readable key cannot have a history; they are listed and the run goes on.
    """
    known = tablelog.has_versions(spark, lake.tables, lake.log, "dim_zone")
    dim = _read(spark, lake, "dim_zone") if known else None
    zones = conform.dim_export(_read(spark, lake, "master_zones"))
    attributes = ("borough", "zone", "service_zone")
    writers.overwrite(history.without_key(zones, "location_id"), outputs.folder("zones_without_key"))
    whole = history.apply_history(zones, dim, "location_id", attributes, run.as_of)
    outputs.bind("dim_zone", _publish(whole, lake, "dim_zone", run))
    dim_path, fact_path = outputs.folder("export_dim_zone"), outputs.folder("export_fact_trip")
    writers.overwrite(_read(spark, lake, "dim_zone"), dim_path)
    writers.overwrite(conform.fact_export(_read(spark, lake, "curated")), fact_path)
    return dim_path, fact_path


def load_warehouse(spark: SparkSession, dim_path: str, fact_path: str, database: str) -> None:
    """Replace the warehouse copies of the exports."""
    for table, path in (("dim_zone", dim_path), ("fact_trip", fact_path)):
        writers.replace_table(readers.read_parquet(spark, path), f"{database}.{table}")


def log_event(
    spark: SparkSession, lake: Lake, run: Run, status: str, error: str | None = None, job_name: str = "daily"
) -> None:
    """Append a run event; a second STARTED of the same run and job is ignored."""
    path = lake.folder("run_events")
    event = runs.run_event(
        spark, run.run_id, status, job_name, run.trigger_type, run.data_owner, error, run.as_of
    )
    if status == runs.STARTED and readers.table_exists(spark, path):
        event = runs.absent_rows(events_of(spark, lake, run.run_id), event, ("run_id", "job_name"))
    event.withColumn("bucket", runs.event_bucket(F.col("run_id"))).write.mode("append").partitionBy("bucket").parquet(path)


def events_of(spark: SparkSession, lake: Lake, run_id: str) -> DataFrame:
    """The events of one run, from the one part of the log that may hold them."""
    log = readers.read_parquet(spark, lake.folder("run_events"))
    return log.filter((F.col("bucket") == runs.event_bucket(F.lit(run_id))) & (F.col("run_id") == run_id)).drop("bucket")


def daily(
    spark: SparkSession, raw_trips: str, zones_csv: str, lake: Lake, run: Run, warehouse: str | None = None
) -> DataFrame:
    """Run every stage; returns the statuses of the SQL scripts. A failure is logged and raised."""
    log_event(spark, lake, run, runs.STARTED)
    try:
        outputs = manifest.Outputs(lake.root, run.run_id)
        validate_trips(spark, raw_trips, lake, run, outputs)
        curate_trips(spark, zones_csv, lake, run)
        gate_trips(spark, lake, run, outputs)
        match_zones(spark, zones_csv, lake, run, outputs)
        steward(spark, lake, run, outputs)
        dim_path, fact_path = export(spark, lake, run, outputs)
        statuses = serving.serve(spark, run.master_db, run.curated_db, dim_path, fact_path)
        if warehouse is not None:
            load_warehouse(spark, dim_path, fact_path, warehouse)
        manifest.commit(spark, lake.root, outputs, run.as_of)
    except Exception as error:
        log_event(spark, lake, run, runs.FAILED, str(error))
        raise
    log_event(spark, lake, run, runs.SUCCEEDED)
    return statuses


def run_statuses(spark: SparkSession, lake: Lake) -> DataFrame:
    return runs.run_audit(readers.read_parquet(spark, lake.folder("run_events")).drop("bucket"))


def stage_feed(spark: SparkSession, path: str, fmt: str, header: bool, run_id: str, as_of=None) -> DataFrame:
    """A zone feed from storage in staging form, ready for ``writers.append_jdbc`` or a table append."""
    return conform.zone_staging(readers.read_feed(spark, path, fmt, header), run_id, as_of)


@dataclass(frozen=True)
class Database:
    """A table reached over JDBC."""

    url: str
    table: str
    properties: Mapping[str, str]


def load_feed(
    spark: SparkSession,
    path: str,
    fmt: str,
    header: bool,
    lake: Lake,
    run: Run,
    scripts: Sequence[serving.Script] | str = (),
    database: Database | None = None,
    checked: bool = False,
) -> DataFrame:
    """Append a zone feed to the staging table, in the lake or a database, then run ``scripts`` in name order.

    ``scripts`` are given or stand in a folder, and may use the parameters ``:run_id``, ``:job_name``, ``:master`` and
    ``:curated``. With ``checked``, lines of a CSV feed that cannot be read go to the lake's ``feed_rejects`` instead of
    becoming NULLs. Start and outcome are logged. Returns the statuses of the scripts.
    """
    job = "load_feed"
    log_event(spark, lake, run, runs.STARTED, job_name=job)
    try:
        if checked and fmt.strip().lower() == "csv":
            types = {name: "int" if name == "locationid" else "string" for name in conform.FEED_COLUMNS}
            kept, rejects = readers.read_checked(spark, path, types, header)
            staged = conform.zone_staging(kept, run.run_id, run.as_of)
            rejects.withColumn("run_id", F.lit(run.run_id)).write.mode("append").parquet(lake.folder("feed_rejects"))
        else:
            staged = stage_feed(spark, path, fmt, header, run.run_id, run.as_of)
        if database is None:
            staged.write.mode("append").parquet(lake.folder("staging/zones_incoming"))
        else:
            writers.append_jdbc(staged, database.url, database.table, database.properties)
        parameters = {
            "run_id": run.run_id, "job_name": job, serving.MASTER: run.master_db, serving.CURATED: run.curated_db,
        }
        if isinstance(scripts, str):
            ordered = serving.read_scripts(spark, scripts)
        else:
            ordered = sorted(scripts, key=lambda script: script.name)
        statuses = serving.run_scripts(spark, ordered, parameters)
    except Exception as error:
        log_event(spark, lake, run, runs.FAILED, str(error), job)
        raise
    log_event(spark, lake, run, runs.SUCCEEDED, job_name=job)
    return statuses
