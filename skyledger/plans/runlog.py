"""Stage summaries: choosing batches, run-log and check-log rows, health.

A summary row is (batch_id, stage, object_name, summary), the last being the
JSON document a stage wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.operators.ranking import keep_first

LOADABLE = ("SUCCESS", "PARTIAL_SUCCESS")
# Order of the stages, and per stage the alternative names of its
# input, output and failure counters.
STAGE_ORDER = ("extract", "transform", "data_quality", "load_timescaledb", "alerts", "mart")
COUNTERS = {
    "extract": (
        ("records_extracted", "total_records"),
        ("records_extracted", "total_records"),
        ("failed_points",),
    ),
    "transform": (("input_objects",), ("records_transformed",), ("failed_objects",)),
    "data_quality": (("input_records",), ("valid_records",), ("bad_records",)),
    "load_timescaledb": (("input_rows",), ("processed_rows",), ()),
    "alerts": (
        ("input_records", "processed_records", "total_records"),
        ("alert_records", "alerts_created", "alerts_generated", "total_alerts"),
        (),
    ),
    "mart": (
        ("input_records", "history_input_records", "latest_clean_records"),
        ("output_records", "current_aqi_rows"),
        ("failed_records", "skipped_source_object_count"),
    ),
}
CHECK_TYPE = (
    "array<struct<check_name: string, status: string, bad_records_count: string, message: string>>"
)


def fields(summaries: DataFrame) -> DataFrame:
    """Summaries with their top-level fields as a map of texts."""
    return summaries.withColumn("fields", F.from_json("summary", "map<string,string>"))


def _field(name: str) -> Column:
    return F.col("fields")[name]


def first_counter(names: Sequence[str]) -> Column:
    """The first counter that is there; there but unreadable counts as 0."""
    value = F.lit(0).cast("bigint")
    for name in reversed(names):
        value = F.when(F.map_contains_key("fields", name), clean.to_integer(_field(name))).otherwise(value)
    return value


def _stage_counter(position: int) -> Column:
    value = F.lit(0).cast("bigint")
    for stage, groups in COUNTERS.items():
        value = F.when(F.col("stage") == stage, first_counter(groups[position])).otherwise(value)
    return value


def run_log_rows(summaries: DataFrame, source: str) -> DataFrame:
    """One run-log row per batch and stage."""
    df = fields(summaries)
    first_failure = F.get_json_object("summary", "$.failures[0]")
    return df.select(
        F.concat_ws(":", "batch_id", "stage").alias("run_id"),
        "batch_id",
        clean.text_or(_field("pipeline_name"), F.lit("hourly_pipeline")).alias("pipeline_name"),
        clean.text_or(_field("source"), F.lit(source)).alias("source"),
        F.col("stage").alias("stage_name"),
        F.upper(clean.text_or(_field("status"), F.lit("UNKNOWN"))).alias("status"),
        clean.to_timestamp(_field("started_at")).alias("started_at"),
        clean.to_timestamp(_field("finished_at")).alias("finished_at"),
        clean.to_float(_field("duration_seconds")).alias("duration_seconds"),
        _stage_counter(0).alias("input_records"),
        _stage_counter(1).alias("output_records"),
        _stage_counter(2).alias("failed_records"),
        first_failure.alias("error_message"),
        F.col("object_name").alias("summary_object_name"),
    )


def check_log_rows(summaries: DataFrame) -> DataFrame:
    """One check-log row per named check of a quality summary."""
    quality = fields(summaries.where(F.col("stage") == "data_quality"))
    checks = quality.select(
        "batch_id",
        clean.to_timestamp(_field("finished_at")).alias("checked_at"),
        F.col("object_name").alias("summary_object_name"),
        F.inline(F.from_json(F.get_json_object("summary", "$.checks"), CHECK_TYPE)),
    )
    return checks.where(~clean.is_blank(F.col("check_name"))).select(
        F.concat_ws(":", "batch_id", F.lit("data_quality")).alias("run_id"),
        "batch_id",
        clean.strip("check_name").alias("check_name"),
        F.upper(clean.text_or(F.col("status"), F.lit("UNKNOWN"))).alias("status"),
        clean.to_integer(F.col("bad_records_count")).alias("bad_records_count"),
        F.coalesce(clean.strip("message"), F.lit("")).alias("message"),
        "checked_at",
        "summary_object_name",
    )


def loadable(summaries: DataFrame, stage: str, payload: str) -> DataFrame:
    """Summaries of a stage that a later stage may work on."""
    df = fields(summaries.where(F.col("stage") == stage))
    status = F.upper(clean.strip(_field("status")))
    return df.where(status.isin(*LOADABLE) & (clean.to_integer(_field(payload)) > 0))


def latest_loadable_batch(summaries: DataFrame, stage: str, payload: str) -> DataFrame:
    """The newest loadable summary: by end, else by start."""
    moment = F.coalesce(
        clean.to_timestamp(_field("finished_at")), clean.to_timestamp(_field("started_at"))
    )
    return (
        loadable(summaries, stage, payload)
        .select("batch_id", "object_name", F.upper(clean.strip(_field("status"))).alias("status"), moment.alias("moment"))
        .orderBy(F.col("moment").desc_nulls_last(), F.col("object_name").desc())
        .limit(1)
    )


def identity_check(summaries: DataFrame, readings: DataFrame, stage: str, payload: str) -> DataFrame:
    """Per batch: does the summary agree with its path and with the stored rows?"""
    actual = readings.groupBy("batch_id").agg(F.count(F.lit(1)).alias("actual_rows"))
    df = fields(summaries.where(F.col("stage") == stage)).join(actual, "batch_id", "left")
    announced = clean.to_integer(_field(payload))
    prefix = F.concat(F.lit("batch_id="), F.col("batch_id"), F.lit("/"))
    return df.select(
        "batch_id",
        _field("batch_id").eqNullSafe(F.col("batch_id")).alias("identity_ok"),
        F.coalesce(F.upper(_field("status")).isin(*LOADABLE), F.lit(False)).alias("status_ok"),
        (announced == F.coalesce("actual_rows", F.lit(0))).alias("rows_ok"),
        F.contains("object_name", prefix).alias("path_ok"),
    )


def latest_valid_mart(summaries: DataFrame) -> DataFrame:
    """The mart summary a reader trusts: last path first, first that is valid."""
    df = fields(summaries.where(F.col("stage") == "mart"))
    counts = ("current_aqi_rows", "location_summary_rows", "daily_summary_rows")
    valid = (F.upper(clean.strip(_field("status"))) == "SUCCESS") & ~clean.is_blank(_field("batch_id"))
    valid = valid & F.contains(F.col("object_name"), F.concat(F.lit("/batch_id="), _field("batch_id"), F.lit("/")))
    for name in counts:
        valid = valid & F.coalesce(_field(name).try_cast("bigint") >= 0, F.lit(False))
    return (
        df.where(valid)
        .select("batch_id", "object_name", *[_field(n).try_cast("bigint").alias(n) for n in counts])
        .orderBy(F.col("object_name").desc())
        .limit(1)
    )


# Which field of a stage's summary names the summary before it.
CHAIN = (
    ("load_timescaledb", "quality_summary_object_name", "data_quality"),
    ("data_quality", "transform_summary_object_name", "transform"),
    ("transform", "raw_summary_object_name", "extract"),
)


def stage_chain(summaries: DataFrame) -> DataFrame:
    """Per load summary: is the chain back to the raw summary whole and of one batch?

    Alerts may be absent, the mart may not.
    """
    df = fields(summaries)

    def stage(name: str) -> DataFrame:
        return df.where(F.col("stage") == name).select(
            F.col("object_name").alias(f"{name}_object"),
            clean.strip(_field("batch_id")).alias(f"{name}_batch"),
            "fields",
        )

    chain = stage("load_timescaledb")
    for child, reference, parent in CHAIN:
        linked = chain.withColumn("_reference", _field(reference)).drop("fields")
        before = stage(parent)
        chain = linked.join(before, linked["_reference"] == before[f"{parent}_object"], "left").drop(
            "_reference"
        )
    chain = chain.drop("fields")
    for side in ("alerts", "mart"):
        ids = df.where(F.col("stage") == side).select(
            F.col("batch_id").alias("load_timescaledb_batch"), clean.strip(_field("batch_id")).alias(f"{side}_batch")
        )
        chain = chain.join(ids, "load_timescaledb_batch", "left")
    batch = F.col("load_timescaledb_batch")
    required = ("data_quality", "transform", "extract", "mart")
    complete, agree = F.lit(True), F.lit(True)
    for name in required:
        complete = complete & F.col(f"{name}_batch").isNotNull()
        agree = agree & F.coalesce(F.col(f"{name}_batch") == batch, F.lit(False))
    agree = agree & F.coalesce(F.col("alerts_batch") == batch, F.lit(True))
    return chain.select(
        batch.alias("batch_id"),
        complete.alias("is_complete"),
        F.col("alerts_batch").isNotNull().alias("has_alerts"),
        (complete & agree).alias("is_valid"),
    )


def batch_status(outcomes: DataFrame, batch: str, ok: Column, records: Column) -> DataFrame:
    """Run status per batch from the outcome of each of its points."""
    counted = outcomes.groupBy(batch).agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(ok).alias("successful_points"),
        F.coalesce(F.sum(F.when(ok, records)), F.lit(0)).cast("bigint").alias("records"),
    )
    good = F.col("successful_points")
    return counted.withColumn(
        "status",
        F.when(good == F.col("points"), "SUCCESS").when(good > 0, "PARTIAL_SUCCESS").otherwise("FAILED"),
    )


def stage_rank(stage: Column) -> Column:
    rank = F.lit(10)
    for position, name in reversed(list(enumerate(STAGE_ORDER, 1))):
        rank = F.when(stage == name, position).otherwise(rank)
    return rank


def _latest(log: DataFrame, moment: str) -> DataFrame:
    named = log.where(~clean.is_blank(F.col("batch_id")))
    newest = named.agg(F.max_by("batch_id", F.struct(moment, "batch_id"))).scalar()
    return log.where(F.col("batch_id") == newest)


def pipeline_health(runs: DataFrame) -> DataFrame:
    """Stages of the newest batch in running order, with the overall status.

    A batch is a success only if every one of its stages is. Its few stages
    are one partition.
    """
    latest = _latest(runs, "updated_at")
    overall = latest.agg(
        F.when(F.count(F.lit(1)) == 0, "EMPTY")
        .when(F.bool_and(F.col("status") == "SUCCESS"), "SUCCESS")
        .otherwise("FAILED")
    ).scalar()
    return latest.withColumns(
        {"stage_rank": stage_rank(F.col("stage_name")), "pipeline_status": overall}
    ).orderBy("stage_rank")


def quality_status(checks: DataFrame) -> DataFrame:
    """Roll-up of the checks of the newest batch."""
    latest = _latest(checks, "updated_at")
    bad = ~F.col("status").isin("PASSED", "SUCCESS")
    return latest.agg(
        F.max("batch_id").alias("batch_id"),
        F.count(F.lit(1)).alias("check_count"),
        F.count_if(bad).alias("failed_check_count"),
        F.when(F.count_if(bad) == 0, "PASSED").otherwise("FAILED").alias("status"),
    )


def latest_checks(checks: DataFrame) -> DataFrame:
    return _latest(checks, "updated_at").orderBy("check_name")


def run_kpis(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count_if(F.upper("status") != "SUCCESS").alias("failed_stages"),
        F.sum("duration_seconds").alias("total_duration"),
    )


def keep_newest(log: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    return keep_first(log, keys, [F.col(c).desc_nulls_last() for c in newest])
