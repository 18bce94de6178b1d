"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import session
from skyledger.functions import bands, clean
from skyledger.functions.time import (
    age_minutes,
    age_text,
    local_date,
    local_time,
    partition_date,
    partition_hour,
    stale_tier,
)
from skyledger.operators import audits, batch_checks, duplicates, joins, ranking, rules, upserts
from skyledger.plans import alerts as alert_plans
from skyledger.plans import ingest, marts, quality, release, runlog, serving, views
from skyledger.schema import (
    CLEAN_COLUMNS,
    DAILY_SUMMARY_CONTRACT,
    LOCATION_SUMMARY_CONTRACT,
    LOGICAL_KEY,
    POLLUTANTS,
    alert_contract,
    clean_contract,
    current_contract,
    fact_contract,
)
from skyledger.sources import adapter, raw
from skyledger.sources.tables import collectable_points as collectable
from skyledger.sources.tables import partition_parts, skipped_batches, valid_history

CREATED = "2024-02-01 00:00:00"
HISTORY_POINT, HISTORY_LOCATION = "P7", "L7"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _created():
    return F.lit(CREATED).cast("timestamp")


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times, as other engines return them."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


class Tables:
    """The adapted tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._args = (session.prepare(spark), folder)

    def __getattr__(self, name: str):
        return getattr(adapter, name)(*self._args)


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_times(function(Tables(spark, folder)))

    REGISTRY[function.__name__.rstrip("_")] = run
    return function


def _grading(t: Tables) -> quality.Grading:
    return quality.grade(t.dirty_readings, t.points, t.locations, adapter.SOURCE, _created())


def _current(t: Tables) -> DataFrame:
    return marts.current(marts.latest_batch(t.readings), t.locations, _created())


def _nearest(t: Tables) -> DataFrame:
    """All readings, nearest hour per point, the earlier one on a tie."""
    readings = t.readings
    return ranking.nearest_in_time(
        readings, marts.snapshot_hour(readings), tie="past", then=[F.col("ingested_at").desc()]
    )


def _all_current(t: Tables) -> DataFrame:
    """The current mart taken over the whole history instead of one batch."""
    return marts.current(t.readings, t.locations, _created())


def _daily(t: Tables) -> DataFrame:
    return marts.daily_summary(t.readings, t.locations, _created())


def _day_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Facts before the last day of ingestion, and the unique rows of that day."""
    readings = t.readings
    day = F.to_date("ingested_at")
    last = readings.agg(F.max(day)).scalar()
    before = ranking.latest_wins(readings.where(day < last), LOGICAL_KEY)
    incoming = ranking.latest_wins(readings.where(day == last), LOGICAL_KEY)
    return before, incoming


# --- scans -----------------------------------------------------------------


@query
def scan_partitioned_history(t):
    instant = F.col("ingested_at")
    parts = t.readings.withColumns(
        {"partition_date": partition_date(instant), "partition_hour": partition_hour(instant)}
    )
    return parts.groupBy("partition_date", "partition_hour", "batch_id").agg(
        F.count(F.lit(1)).alias("record_count"), F.max("ingested_at").alias("last_ingested_at")
    )


@query
def partition_parts_(t):
    instant = F.col("ingested_at")
    path = F.concat(
        F.lit("clean/date="),
        partition_date(instant),
        F.when(F.col("reading_id") % 10 == 3, "/").otherwise("/hour="),
        partition_hour(instant),
        F.lit("/batch_id="),
        F.col("batch_id"),
        F.lit("/data.parquet"),
    )
    return t.readings.select("reading_id", *partition_parts(path))


@query
def valid_batches(t):
    return audits.batch_validity(t.readings)


@query
def valid_history_rows(t):
    return valid_history(t.readings).select("reading_id", "batch_id", "point_id", "forecast_time")


@query
def skipped_batches_(t):
    return skipped_batches(t.readings)


@query
def location_dimension(t):
    return joins.distinct_dimension(
        t.points.select("location_id", "point_id", "point_name"), "location_id", "point_id"
    )


@query
def active_points(t):
    return joins.active_points(t.points, t.locations).select("point_id", "location_id", "region")


@query
def latest_loadable_batch(t):
    return runlog.latest_loadable_batch(t.stage_summaries, "data_quality", "valid_records")


@query
def batch_identity_check(t):
    return runlog.identity_check(t.stage_summaries, t.readings, "transform", "records_transformed")


@query
def latest_valid_mart(t):
    return runlog.latest_valid_mart(t.stage_summaries)


@query
def latest_batch_rows(t):
    return serving.latest_batch_rows(t.facts).select("point_id", "forecast_time", "us_aqi", "batch_id")


# --- sinks as set operations -------------------------------------------------


@query
def fact_upsert(t):
    before, incoming = _day_split(t)
    return upserts.upsert(before, incoming, LOGICAL_KEY).select(
        "point_id", "forecast_time", "source", "batch_id", "us_aqi", "pm10", "ingested_at"
    )


@query
def upsert_counts(t):
    before, incoming = _day_split(t)
    return upserts.upsert_counts(before, incoming, LOGICAL_KEY, "forecast_time")


@query
def dimension_upsert(t):
    first = F.lit("2023-01-01 00:00:00").cast("timestamp")
    existing = t.points.withColumns({"created_at": first, "updated_at": first})
    seen = t.readings.groupBy("point_id").agg(
        F.max("location_id").alias("location_id"),
        F.concat(F.max("point_name"), F.lit(" (seen)")).alias("point_name"),
    )
    return upserts.upsert_dimension(existing, seen, "point_id", _created()).select(
        "point_id", "location_id", "point_name", "point_type", "created_at", "updated_at"
    )


@query
def run_log_upsert(t):
    runs = t.run_log
    cut = F.lit("1998-01-01").cast("timestamp")
    old, new = runs.where(F.col("started_at") < cut), runs.where(F.col("started_at") >= cut)
    return upserts.upsert_log(old, new, ["batch_id", "stage_name"], ["started_at", "run_key"]).select(
        "batch_id", "stage_name", "run_id", "status", "started_at"
    )


@query
def check_log_upsert(t):
    # Half of the log is stored, the other half arrives.
    checks = t.check_log
    stored = F.pmod(F.xxhash64("run_id", "check_name"), F.lit(2)) == 0
    newest = ["checked_at", "run_id", "bad_records_count", "status"]
    return upserts.upsert_log(checks.where(stored), checks.where(~stored), ["batch_id", "check_name"], newest).select(
        "batch_id", "check_name", "run_id", "status", "bad_records_count"
    )


@query
def alert_merge(t):
    facts = t.facts
    return alert_plans.refresh(t.alerts, serving.latest_batch_rows(facts), _created())


@query
def quarantine_backup(t):
    # Every third run is backed up already; the rest is stored as whole rows.
    reason = "MISSING_BATCH_OR_STAGE"
    runs = t.run_log.where(upserts.is_unassigned())
    before = upserts.backup_rows(runs.where("run_key % 3 = 0"), "run_id", reason)
    row = "run_key long, stage_name string, status string"
    return (
        upserts.backup_rows(runs, "run_id", reason, before)
        .select("original_id", "backup_reason", F.from_json("row_data", row).alias("row"))
        .select("original_id", "backup_reason", "row.*")
    )


@query
def collectable_points(t):
    return collectable(t.points)


@query
def backfill_batch_id(t):
    return upserts.backfill_batch_id(t.run_log, "legacy_without_batch").select("run_id", "batch_id")


@query
def purge_orphan_checks(t):
    return upserts.purge_orphan_checks(t.check_log, t.run_log).select(
        "run_id", "batch_id", "check_name", "status", "bad_records_count"
    )


# --- projections and filters --------------------------------------------------


@query
def clean_projection(t):
    return t.readings.select(*CLEAN_COLUMNS)


@query
def alerts_filtered(t):
    chosen = alert_plans.filtered(t.alerts, ["critical", "HIGH"], status="open")
    return chosen.select("point_id", "alert_time", "severity", "status", "aqi_value")


@query
def locations_above_threshold(t):
    return views.above_threshold(views.location_summary(_nearest(t)), 60.0).select(
        "location_id", "location_name", "average_us_aqi"
    )


@query
def time_range_filter(t):
    readings = t.readings
    return views.time_range(readings, marts.snapshot_hour(readings), 24).select(
        "reading_id", "point_id", "forecast_time"
    )


@query
def time_range_fallback(t):
    as_of = F.lit("2030-01-01 00:00:00").cast("timestamp")
    return views.time_range(t.readings, as_of, 24).select("reading_id", "point_id", "forecast_time")


@query
def history_date_range(t):
    daily = _daily(t).select("forecast_date", "point_id", "average_us_aqi", "available_hours")
    return views.history_days(daily, F.lit("2024-01-25").cast("date"))


@query
def daily_compat_view(t):
    return release.daily_compatible(_daily(t)).select(
        "forecast_date", "point_id", "forecast_time", "us_aqi", "pm2_5", "batch_id", "ingested_at"
    )


@query
def label_fallback(t):
    # Readings of an unknown location have no label in the summary.
    summary = views.location_summary(joins.enrich_locations(t.facts, t.locations))
    return views.labelled_locations(joins.enrich_locations(t.dirty_readings, t.locations), summary).select("reading_id", "location_id", "location_label")


@query
def translated_run_log(t):
    return views.translated_runs(t.run_log).select("run_id", "stage_label", "status_label")


@query
def translated_alerts(t):
    return views.translated_alerts(t.alerts).select("point_id", "alert_time", "severity_label", "status_label")


@query
def translated_points(t):
    return views.translated_points(t.points).select("point_id", "point_type_label")


@query
def readings_filtered(t):
    return views.technical_view(t.readings, HISTORY_LOCATION, ["P7", "P32", "P57"])


@query
def missing_points_except(t):
    return joins.difference(t.points, t.readings, ["point_id", "location_id"])


# --- joins --------------------------------------------------------------------


@query
def enrich_locations(t):
    return joins.enrich_locations(t.dirty_readings, t.locations).select(
        "reading_id", "location_id", "location_name", "region"
    )


@query
def missing_dimension_keys(t):
    return joins.missing_keys(t.dirty_readings, t.locations, "location_id")


@query
def orphan_points(t):
    return joins.orphan_points(t.points, t.locations).select("point_id", "location_id")


@query
def positional_join(t):
    requests, responses = t.requests
    return joins.zip_responses(requests, responses).select(
        "request_id",
        F.col("position").cast("int").alias("position"),
        F.col("point").alias("point_id"),
        F.col("response").alias("peak"),
    )


@query
def stage_chain(t):
    return runlog.stage_chain(t.stage_summaries)


# --- marts --------------------------------------------------------------------


@query
def mart_current(t):
    return marts.sort_current(_current(t))


@query
def mart_current_all(t):
    return marts.sort_current(_all_current(t))


@query
def mart_location_summary(t):
    return marts.sort_location_summary(marts.location_summary(_all_current(t), _created()))


@query
def mart_daily_summary(t):
    return marts.sort_daily_summary(marts.daily_summary(valid_history(t.readings), t.locations, _created()))


@query
def mart_daily_increment(t):
    readings = t.readings
    batch = marts.latest_batch(readings)
    return marts.daily_summary_increment(readings, batch, t.locations, _created()).select(
        "forecast_date", "point_id", "available_hours", "average_us_aqi", "maximum_us_aqi"
    )


@query
def mart_build_summary(t):
    readings = t.readings
    return marts.build_summary(readings, t.locations, marts.build(readings, t.locations, _created()))


@query
def worst_point_per_location(t):
    worst = ranking.smallest(["point_id", "us_aqi"], ranking.worst_first("us_aqi", "point_id"))
    return _all_current(t).groupBy("location_id").agg(worst.alias("w")).select("location_id", "w.point_id", "w.us_aqi")


@query
def worst_hour_per_day(t):
    day = F.date_format(local_date(F.col("forecast_time")), "yyyy-MM-dd")
    worst = ranking.smallest(["forecast_time", "us_aqi"], ranking.worst_first("us_aqi", "forecast_time"))
    return (
        ranking.latest_wins(t.readings)
        .groupBy(day.alias("forecast_date"), "point_id")
        .agg(worst.alias("w"))
        .select("forecast_date", "point_id", "w.forecast_time", "w.us_aqi")
    )


# --- serving --------------------------------------------------------------------


@query
def latest_air_quality(t):
    return serving.latest_readings(t.facts, t.points, t.locations)


@query
def readings_by_location(t):
    return serving.readings_by_location(t.facts, t.points, t.locations, f" {HISTORY_LOCATION.lower()} ")


@query
def readings_by_point(t):
    return serving.readings_by_point(t.facts, t.points, t.locations, HISTORY_POINT)


@query
def top_polluted(t):
    return serving.top_polluted(t.facts, t.points, t.locations)


@query
def point_history(t):
    return serving.point_history(t.facts, t.points, t.locations, HISTORY_POINT, hours=48)


@query
def history_all_points(t):
    return serving.history_all_points(t.facts, hours=24).select("point_id", "forecast_time", "source", "us_aqi")


@query
def active_locations(t):
    return serving.active_locations(t.locations)


@query
def active_monitoring_points(t):
    return serving.active_monitoring_points(t.points, t.locations)


@query
def latest_alerts(t):
    return serving.latest_alerts(t.alerts).select("point_id", "alert_time", "severity", "created_at")


def _stamped_runs(t: Tables) -> DataFrame:
    return t.run_log.withColumn("updated_at", F.col("started_at"))


@query
def run_health(t):
    return runlog.pipeline_health(_stamped_runs(t)).select(
        "run_id", "batch_id", "stage_name", "status", "stage_rank", "pipeline_status"
    )


@query
def quality_status(t):
    return runlog.quality_status(t.check_log.withColumn("updated_at", F.col("checked_at")))


@query
def latest_quality_checks(t):
    latest = runlog.latest_checks(t.check_log.withColumn("updated_at", F.col("checked_at")))
    return latest.select("run_id", "batch_id", "check_name", "status", "bad_records_count")


# --- quality rules --------------------------------------------------------------


@query
def dq_row_rules(t):
    prepared, row_rules = rules.check_readings(
        t.dirty_readings, t.points, t.locations, adapter.SOURCE, batch="load_id"
    )
    judged = prepared.select("reading_id", rules.broken(row_rules).alias("broken"))
    return judged.select("reading_id", rules.error_codes(F.col("broken"), row_rules).alias("dq_error_codes"))


@query
def dq_row_checks(t):
    return _grading(t).row_report.select("load_id", "check_name", "status", "bad_records_count")


@query
def dq_valid(t):
    return _grading(t).valid.select("reading_id", "point_id", "forecast_time", "us_aqi")


@query
def dq_bad_records(t):
    return _grading(t).bad.select("reading_id", "dq_status", "dq_error_codes", "dq_error_messages", "dq_checked_at")


@query
def dq_batch_checks(t):
    return _grading(t).batch_report


@query
def dq_freshness(t):
    facts = batch_checks.batch_facts(t.dirty_readings, t.points, "load_id", adapter.SOURCE)
    return facts.select("load_id", "delay_minutes", "fresh")


@query
def dq_cadence(t):
    return batch_checks.cadence_issues(t.dirty_readings, "load_id")


@query
def dq_hours_per_point(t):
    return batch_checks.hours_per_point(t.dirty_readings, t.points, "load_id")


@query
def dq_point_coverage(t):
    return joins.coverage_by_group(t.dirty_readings, batch_checks.expected_points(t.points), "load_id", "point_id")


@query
def dq_score(t):
    return _grading(t).summary.select("load_id", "valid_percentage", "quality_score")


@query
def dq_verdict(t):
    return _grading(t).summary.select("load_id", "quality_status", "pipeline_status")


@query
def dq_summary(t):
    return _grading(t).summary


@query
def dq_non_passed(t):
    graded = _grading(t)
    return quality.not_passed(graded.row_report, graded.batch_report)


@query
def dq_time_aware(t):
    return t.text_records.select("reading_id", clean.has_offset(F.col("forecast_time")).alias("is_aware"))


@query
def duplicate_keys(t):
    return duplicates.duplicate_keys(t.readings, ["point_id", "forecast_time"])


@query
def duplicate_flag(t):
    return duplicates.flag_duplicates(t.readings, ["point_id", "forecast_time"], "is_duplicate").select(
        "reading_id", "is_duplicate"
    )


# --- audits -----------------------------------------------------------------------


@query
def dim_location_audit(t):
    strayed = F.substring("location_id", 2, 10).cast("int") % 6 == 0
    locations = t.locations.withColumn("region", F.when(strayed, "ATLANTIS").otherwise(F.col("region")))
    return audits.location_audit(locations, adapter.REGIONS, ["City", "Province"])


@query
def dim_point_audit(t):
    strayed = F.substring("point_id", 2, 10).cast("int") % 29 == 0
    points = t.points.withColumn("location_id", F.when(strayed, "L99").otherwise(F.col("location_id")))
    return audits.point_audit(points, t.locations)


@query
def config_audit(t):
    return audits.config_audit(t.points, t.locations)


@query
def load_precheck(t):
    return audits.load_precheck(t.dirty_readings, "load_id")


@query
def contract_audit_clean(t):
    return audits.audit(t.dirty_readings.drop("reading_id", "load_id"), clean_contract(adapter.SOURCE))


@query
def contract_audit_mart(t):
    created = _created()
    current = _all_current(t)
    parts = [
        (audits.audit(current, current_contract(adapter.SOURCE)), "current"),
        (audits.audit(marts.location_summary(current, created), LOCATION_SUMMARY_CONTRACT), "location_summary"),
        (audits.audit(_daily(t), DAILY_SUMMARY_CONTRACT), "daily_summary"),
    ]
    named = [df.withColumn("dataset", F.lit(name)) for df, name in parts]
    return named[0].union(named[1]).union(named[2])


@query
def contract_audit_fact(t):
    return audits.audit(t.dirty_readings.withColumn("aqi_severity", bands.level_code(F.col("us_aqi"))), fact_contract(adapter.SOURCE))


@query
def contract_audit_alerts(t):
    return audits.audit(t.alerts, alert_contract("other_feed"))


@query
def mart_audit(t):
    current = _current(t)
    batch_rows = marts.latest_batch(t.readings).agg(F.countDistinct("point_id")).scalar()
    parts = [
        audits.dataset_audit(current, "current", ["point_id"], batch_rows, "source_batch_id"),
        audits.dataset_audit(_all_current(t), "current_all", ["point_id"], batch_rows, "source_batch_id"),
        audits.dataset_audit(_daily(t), "daily_summary", ["forecast_date", "point_id"], batch_rows),
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query
def integrity_audit(t):
    runs = audits.count_conditions(
        t.run_log,
        [("BLANK", c, clean.is_blank(F.col(c))) for c in ("run_id", "batch_id", "stage_name")],
    ).withColumn("relation", F.lit("run_log"))
    checks = audits.count_conditions(
        t.check_log,
        [("BLANK", c, clean.is_blank(F.col(c))) for c in ("run_id", "batch_id", "check_name")],
    ).withColumn("relation", F.lit("check_log"))
    facts = audits.count_conditions(
        t.dirty_readings,
        [("BLANK", "batch_id", clean.is_blank(F.col("batch_id"))), ("NULL", "ingested_at", F.col("ingested_at").isNull())],
    ).withColumn("relation", F.lit("facts"))
    repeated = audits.repeated_rows(t.run_log, ["batch_id", "stage_name"], "DUPLICATE_KEY").withColumn(
        "relation", F.lit("run_log")
    )
    return runs.union(checks).union(facts).union(repeated)


@query
def null_counts(t):
    return audits.null_counts(t.dirty_readings, CLEAN_COLUMNS)


@query
def batch_profile(t):
    return t.readings.groupBy("batch_id", "point_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("forecast_time").alias("first_time"),
        F.max("forecast_time").alias("last_time"),
        F.count_if(F.col("us_aqi").isNull()).alias("null_aqi"),
    )


# --- windows ------------------------------------------------------------------------


@query
def nearest_per_point(t):
    readings = t.readings
    return ranking.nearest_in_time(
        readings, marts.snapshot_hour(readings), tie="future", then=[F.col("ingested_at").desc()]
    ).select("point_id", "reading_id", "forecast_time")


@query
def nearest_per_point_past(t):
    return _nearest(t).select("point_id", "reading_id", "forecast_time")


@query
def latest_wins(t):
    return ranking.latest_wins(t.readings).select("reading_id", "point_id", "forecast_time", "batch_id")


@query
def nearest_hour_delta(t):
    readings = t.readings
    return views.nearest_hour_delta(readings, "us_aqi", marts.snapshot_hour(readings)).select(
        "forecast_time", views.round_even(F.col("average"), 4).alias("average"), views.round_even(F.col("delta"), 4).alias("delta")
    )


@query
def point_name_lookup(t):
    return views.point_names(t.readings)


# --- aggregates and views --------------------------------------------------------------


@query
def level_distribution(t):
    return views.level_distribution(views.location_summary(_nearest(t)))


@query
def nationwide_kpis(t):
    return views.nationwide_kpis(_nearest(t))


@query
def hourly_mean(t):
    return views.hourly_mean(t.readings)


@query
def hourly_mean_by_location(t):
    return views.hourly_mean(t.readings, "pm10", "location_id")


@query
def alert_counts(t):
    return alert_plans.counts(t.facts)


@query
def alert_kpis(t):
    return alert_plans.kpis(t.alerts)


@query
def alert_precheck(t):
    return alert_plans.precheck(t.dirty_readings, adapter.SOURCE)


@query
def run_log_kpis(t):
    return runlog.run_kpis(t.run_log)


@query
def dashboard_location_summary(t):
    nearest = joins.enrich_locations(_nearest(t), t.locations)
    return views.sort_locations(views.location_summary(nearest)).withColumn(
        "fill_color", F.array_join(F.col("fill_color").cast("array<string>"), ",")
    )


@query
def location_view(t):
    nearest = joins.enrich_locations(_nearest(t), t.locations)
    mart = marts.location_summary(_all_current(t), _created())
    return views.location_view(mart, nearest).withColumn(
        "fill_color", F.array_join(F.col("fill_color").cast("array<string>"), ",")
    )


@query
def location_view_fallback(t):
    nearest = joins.enrich_locations(_nearest(t), t.locations)
    return views.location_view(None, nearest).withColumn(
        "fill_color", F.array_join(F.col("fill_color").cast("array<string>"), ",")
    )


@query
def location_ranking(t):
    nearest = joins.enrich_locations(_nearest(t), t.locations)
    return views.ranking(views.location_summary(nearest))


@query
def history_kpis(t):
    return views.history_kpis(t.facts.withColumn("forecast_date", local_date(F.col("forecast_time"))))


@query
def history_daily(t):
    return views.history_daily(t.facts.withColumn("forecast_date", local_date(F.col("forecast_time"))))


@query
def batch_status(t):
    per_point = t.dirty_readings.groupBy("load_id", "location_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("pm10").isNull()).alias("lost")
    )
    return runlog.batch_status(per_point, "load_id", F.col("lost") == 0, F.col("n"))


@query
def data_updated_at(t):
    return views.data_updated_at(t.readings, t.run_log, t.alerts)


@query
def available_hours(t):
    return views.available_hours(t.readings)


@query
def view_counts(t):
    return views.view_counts(t.readings)


@query
def pollutants_long(t):
    return views.pollutants_long(t.dirty_readings, ["reading_id"], POLLUTANTS)


@query
def filter_values(t):
    alerts = t.alerts
    return views.filter_values(
        {
            "point": (t.readings, "point_id"),
            "severity": (alerts, "severity"),
            "status": (alerts, "status"),
            "location": (t.locations, "location_name"),
        }
    )


# --- releases ----------------------------------------------------------------------------


@query
def top_polluted_mart(t):
    return release.top_polluted(_all_current(t)).select("point_id", "location_id", "us_aqi")


@query
def release_points(t):
    return release.point_payloads(release.current_compatible(_all_current(t)), t.points).select(
        "point_id", "record_count", "forecast_time", "us_aqi", "batch_id"
    )


@query
def release_locations(t):
    return release.location_payloads(release.current_compatible(_all_current(t)), t.locations).select(
        "location_id", "record_count", "point_id", "us_aqi", "batch_id"
    )


@query
def release_history(t):
    return release.history_payloads(release.daily_compatible(_daily(t)), t.points).select(
        "point_id", "record_count", "forecast_date", "us_aqi", "batch_id"
    )


@query
def release_manifest(t):
    current = _all_current(t)
    batch = serving.latest_batch_id(t.facts)
    return release.manifest(
        batch,
        {
            "locations": serving.active_locations(t.locations),
            "monitoring_points": serving.active_monitoring_points(t.points, t.locations),
            "current_records": current,
            "daily_records": _daily(t),
            "top_polluted_records": release.top_polluted(current),
            "alert_records": t.alerts,
        },
        {"mart": F.lit("SUCCESS")},
        _created(),
    )


@query
def release_audit(t):
    current = release.current_compatible(_all_current(t))
    spoiled = current.withColumn("batch_id", F.when(F.col("us_aqi") > 150, " ").otherwise(F.col("batch_id")))
    payloads = release.location_payloads(spoiled, t.locations, limit=None)
    return release.payload_audit(payloads, "location_id", "point_id", "batch_id")


@query
def safe_identifiers(t):
    return release.safe_identifiers(t.dirty_readings.withColumn("point_id", F.concat("point_id", "location_id")), "point_id")


# --- scalar functions -----------------------------------------------------------------------


@query
def aqi_bands(t):
    index = F.col("us_aqi")
    return t.readings.select("reading_id", bands.level_name(index).alias("aqi_level"), bands.level_rank(index).alias("aqi_severity"))


@query
def aqi_classified(t):
    text = F.col("us_aqi")
    error = bands.classification_error(text)
    index = F.when(error.isNull(), text.try_cast("double")).cast("int")
    return t.text_records.select(
        "reading_id",
        error.alias("classification_error"),
        bands.local_level(index).alias("aqi_level"),
        bands.level_code(index).alias("aqi_severity"),
        bands.alert_severity(index).alias("alert_severity"),
    )


@query
def alert_messages(t):
    return alert_plans.derive(t.facts, F.col("ingested_at")).select("point_id", "alert_time", "severity", "message")


@query
def map_markers(t):
    index = F.col("pm2_5")
    return t.readings.select(
        "reading_id",
        F.array_join(bands.fill_color(index).cast("array<string>"), ",").alias("fill_color"),
        bands.marker_radius(index).alias("marker_radius"),
    )


@query
def health_advice(t):
    entry = bands.advice(F.col("us_aqi"))
    return t.readings.select("reading_id", entry["title"].alias("title"), entry["body"].alias("body"), entry["color"].alias("color"))


@query
def coerced_records(t):
    return t.text_records.select(
        "reading_id",
        F.coalesce(F.trim("point_id"), F.lit("")).alias("point_id"),
        clean.to_number(F.col("us_aqi")).alias("us_aqi"),
        clean.to_integer(F.col("us_aqi"), default=-1).alias("us_aqi_integer"),
        clean.to_timestamp(F.col("forecast_time")).alias("forecast_time"),
    )


@query
def local_time_(t):
    return t.readings.select("reading_id", local_time(F.col("forecast_time")).alias("local_time"))


@query
def local_day_hour(t):
    when = F.col("forecast_time")
    return t.readings.select(
        "reading_id",
        F.date_format(local_date(when), "yyyy-MM-dd").alias("local_date"),
        F.hour(local_time(when)).alias("local_hour"),
        F.date_trunc("hour", F.col("ingested_at")).alias("ingest_hour"),
    )


@query
def partition_strings(t):
    start = F.col("started_at")
    starts = t.readings.groupBy("batch_id").agg(F.min("ingested_at").alias("started_at"))
    return starts.select(
        "batch_id", partition_date(start).alias("partition_date"), partition_hour(start).alias("partition_hour")
    )


@query
def batch_id_valid(t):
    spoiled = F.when(F.col("reading_id") % 11 == 0, F.concat(F.lit("/"), "batch_id")).otherwise(F.col("batch_id"))
    return t.readings.select("reading_id", clean.is_batch_id(spoiled).alias("is_batch_id"))


@query
def data_age(t):
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp")
    when = F.col("ingested_at")
    return t.readings.select(
        "reading_id",
        age_minutes(when, as_of).alias("age_minutes"),
        age_text(when, as_of).alias("age_text"),
        stale_tier(when, as_of).alias("stale_tier"),
    )


@query
def parse_boolean(t):
    return t.text_records.select(
        "reading_id",
        clean.parse_boolean(F.col("is_active")).alias("strict_flag"),
        clean.is_active(F.col("is_active")).alias("is_active"),
    )


@query
def json_safe(t):
    odd = F.when(F.col("reading_id") % 5 == 0, F.lit(float("nan"))).when(
        F.col("reading_id") % 7 == 0, F.lit(float("inf"))
    )
    table = t.readings.withColumn("pm10", F.coalesce(odd, F.col("pm10")))
    return release.json_ready(table.select("reading_id", "pm10", "forecast_time"))


# --- raw documents ------------------------------------------------------------------------------


@query
def locate_hourly(t):
    return raw.open_responses(t.raw_documents).select("batch_id", "point.point_id", raw.hourly_path().alias("path"))


@query
def raw_record_counts(t):
    return raw.with_failure(t.raw_documents, adapter.SOURCE).select(
        "batch_id", "point_id", raw.record_count().cast("bigint").alias("record_count")
    )


@query
def point_metadata(t):
    return raw.open_responses(t.raw_documents).select("batch_id", *raw.point_metadata())


@query
def explode_hourly(t):
    return raw.explode_documents(raw.with_failure(t.raw_documents, adapter.SOURCE)).select(
        "batch_id", "point_id", "forecast_time", "pm10", "ozone", "us_aqi", "ingested_at"
    )


@query
def transform_failures(t):
    return ingest.transform(t.raw_documents, adapter.SOURCE).failures


@query
def transform_batch(t):
    return ingest.transform(t.raw_documents, adapter.SOURCE).summary


@query
def raw_audit(t):
    return raw.envelope_issues(t.raw_documents, adapter.SOURCE)


# --- run logs -----------------------------------------------------------------------------------


@query
def run_log_rows(t):
    return runlog.run_log_rows(t.stage_summaries, adapter.SOURCE)


@query
def check_log_rows(t):
    return runlog.check_log_rows(t.stage_summaries)
