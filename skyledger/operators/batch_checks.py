"""Checks of whole batches, their score and verdict; all batches in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.functions.numbers import round_even
from skyledger.functions.time import hours_between
from skyledger.operators.counting import count_positions
from skyledger.operators.joins import missing_by_group, unique_dimension
from skyledger.operators.rules import BROKEN

# Fixed values of the score.
ROW_SHARE, BATCH_SHARE = 0.70, 0.30
ERROR_WEIGHT, WARNING_WEIGHT = 2.0, 1.0
FAIL_CEILING = 69.99


def expected_points(points: DataFrame) -> DataFrame:
    """Ids of the active points; a repeated one stops the job."""
    active = points.where(clean.is_active(F.col("is_active")))
    return unique_dimension(active.select(clean.strip("point_id").alias("point_id")), "point_id", [])


def point_hours(readings: DataFrame, batch: str) -> DataFrame:
    """Distinct (batch, point, time) with row counts; points keep their blank id."""
    return readings.groupBy(batch, clean.strip("point_id").alias("point_id"), "forecast_time").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def with_gaps(hours: DataFrame, batch: str) -> DataFrame:
    """Hours since the previous distinct time of the same point.

    The window runs over distinct hours, so its size is bounded by the calendar
    and not by the number of rows.
    """
    window = Window.partitionBy(batch, "point_id").orderBy("forecast_time")
    named = hours.where(F.col("point_id").isNotNull())
    return named.withColumn(
        "gap_hours", hours_between(F.col("forecast_time"), F.lag("forecast_time").over(window))
    )


def cadence_issues(readings: DataFrame, batch: str) -> DataFrame:
    """Every step between two hours of a point that is not exactly one hour."""
    return (
        with_gaps(point_hours(readings, batch), batch)
        .where("gap_hours <> 1.0")
        .select(batch, "point_id", "forecast_time", round_even(F.col("gap_hours"), 3).alias("gap_hours"))
    )


def hours_per_point(readings: DataFrame, points: DataFrame, batch: str) -> DataFrame:
    """Distinct hours of each expected point in each batch; 0 where a batch lacks the point."""
    hours = point_hours(readings, batch)
    counted = hours.groupBy(batch, "point_id").agg(F.count("forecast_time").alias("forecast_hours"))
    there = counted.join(expected_points(points), "point_id", "left_semi").select(batch, "point_id", "forecast_hours")
    lacking = missing_by_group(counted, expected_points(points), batch, "point_id")
    return there.unionByName(lacking.withColumn("forecast_hours", F.lit(0).cast("bigint")))


def _point_facts(readings: DataFrame, points: DataFrame, batch: str, hours: int) -> DataFrame:
    """Per batch: how many points are there, known, complete and off cadence."""
    gaps = with_gaps(point_hours(readings, batch), batch)
    per_point = gaps.groupBy(batch, "point_id").agg(
        F.count("forecast_time").alias("hours"),
        F.count_if(F.col("gap_hours") != 1.0).alias("bad_gaps"),
    )
    known = expected_points(points).withColumn("_known", F.lit(True))
    return (
        per_point.join(known, "point_id", "left")
        .groupBy(batch)
        .agg(
            F.count_if(F.col("point_id") != "").alias("present"),
            F.count_if((F.col("point_id") != "") & F.col("_known")).alias("known"),
            F.count_if(F.col("_known") & (F.col("hours") == hours)).alias("complete"),
            F.count_if(F.col("bad_gaps") > 0).alias("off_cadence"),
        )
    )


def _identity_facts(readings: DataFrame, batch: str, source: str) -> DataFrame:
    """Per batch: rows, time bounds, distinct batch ids and sources.

    Rows are first counted per (batch id, source), so the exact distinct counts
    run over those few combinations.
    """
    combos = readings.groupBy(
        batch,
        F.nullif(clean.strip("batch_id"), F.lit("")).alias("_id"),
        F.nullif(F.lower(clean.strip("source")), F.lit("")).alias("_source"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("forecast_time").alias("first_time"),
        F.max("ingested_at").alias("last_ingest"),
    )
    return combos.groupBy(batch).agg(
        F.sum("rows").alias("record_count"),
        F.min("first_time").alias("first_time"),
        F.max("last_ingest").alias("last_ingest"),
        F.countDistinct("_id").alias("batch_ids"),
        F.countDistinct("_source").alias("sources"),
        F.count_if(F.col("_source") == source).alias("own_source"),
    )


def batch_facts(
    readings: DataFrame,
    points: DataFrame,
    batch: str,
    source: str,
    hours: int = 24,
    freshness_minutes: int = 90,
) -> DataFrame:
    """One wide row per batch with everything the checks compare."""
    if hours <= 0 or freshness_minutes <= 0:
        raise ValueError("hours and freshness_minutes must be positive")
    expected = expected_points(points).agg(F.count(F.lit(1))).scalar()
    delay = F.abs(
        F.unix_micros("first_time") - F.unix_micros(F.date_trunc("hour", F.col("last_ingest")))
    ) / F.lit(60_000_000.0)
    return (
        _identity_facts(readings, batch, source)
        .join(_point_facts(readings, points, batch, hours), batch, "left")
        .fillna(0, ["present", "known", "complete", "off_cadence"])
        .withColumns({"expected": expected, "delay_minutes": round_even(delay, 2)})
        .withColumns(
            {
                "missing": F.col("expected") - F.col("known"),
                "unexpected": F.col("present") - F.col("known"),
                "expected_records": F.col("expected") * hours,
                "incomplete": F.col("expected") - F.col("complete"),
                "fresh": F.coalesce(F.col("delay_minutes") <= freshness_minutes, F.lit(False)),
            }
        )
    )


def _checks(hours: int, freshness_minutes: int) -> list[dict]:
    """Name, severity, pass condition, bad count, actual and expected text."""
    c = F.col
    surplus = lambda name: F.greatest(c(name) - 1, F.lit(0))
    text = lambda column: column.cast("string")
    return [
        dict(
            name="EXPECTED_ACTIVE_POINTS",
            passed=(c("missing") == 0) & (c("unexpected") == 0),
            bad=c("missing") + c("unexpected"),
            actual=text(c("present")),
            expected=text(c("expected")),
        ),
        dict(
            name="EXPECTED_RECORD_COUNT",
            passed=c("record_count") == c("expected_records"),
            bad=F.abs(c("record_count") - c("expected_records")),
            actual=text(c("record_count")),
            expected=text(c("expected_records")),
        ),
        dict(
            name="EXPECTED_FORECAST_HOURS_PER_POINT",
            passed=c("incomplete") == 0,
            bad=c("incomplete"),
            actual=text(c("complete")),
            expected=F.lit(str(hours)),
        ),
        dict(
            name="HOURLY_FORECAST_CADENCE",
            passed=c("off_cadence") == 0,
            bad=c("off_cadence"),
            actual=text(c("off_cadence")),
            expected=F.lit("1 hour"),
        ),
        dict(
            name="SINGLE_BATCH_ID",
            passed=c("batch_ids") == 1,
            bad=surplus("batch_ids"),
            actual=text(c("batch_ids")),
            expected=F.lit("1"),
        ),
        dict(
            name="SINGLE_SOURCE",
            passed=(c("sources") == 1) & (c("own_source") > 0),
            bad=surplus("sources"),
            actual=text(c("sources")),
            expected=F.lit("1"),
        ),
        dict(
            name="DATA_FRESHNESS",
            severity="WARNING",
            passed=c("fresh"),
            bad=F.when(c("fresh"), 0).otherwise(1),
            actual=text(c("delay_minutes").cast("decimal(20,2)")),
            expected=F.lit(f"<= {freshness_minutes} minutes"),
        ),
    ]


def _status(check: dict) -> Column:
    failed = "WARNED" if check.get("severity") == "WARNING" else "FAILED"
    return F.when(check["passed"], "PASSED").otherwise(failed)


def batch_report(
    facts: DataFrame, batch: str, hours: int = 24, freshness_minutes: int = 90
) -> DataFrame:
    """One row per batch and check."""
    entries = [
        F.struct(
            F.lit(check["name"]).alias("check_name"),
            F.lit("BATCH").alias("check_scope"),
            F.lit(check.get("severity", "ERROR")).alias("severity"),
            _status(check).alias("status"),
            check["bad"].cast("bigint").alias("bad_records_count"),
            check["actual"].alias("actual_value"),
            check["expected"].alias("expected_value"),
        )
        for check in _checks(hours, freshness_minutes)
    ]
    return facts.select(batch, F.inline(F.array(*entries)))


def row_facts(judged: DataFrame, batch: str) -> DataFrame:
    """Per batch of judged rows: valid rows, and how many rules found something."""
    counts = count_positions(judged, BROKEN, [batch])
    return counts.groupBy(batch).agg(
        F.coalesce(F.sum(F.when(F.col("position").isNull(), F.col("row_count"))), F.lit(0)).alias(
            "valid_records"
        ),
        F.count("position").alias("failed_row_checks"),
    )


def score(facts: DataFrame, rows: DataFrame, rules: int, batch: str) -> DataFrame:
    """Quality score, verdict and run status of every batch.

    70 % of the score is the share of valid rows, 30 % the weighted share of
    passed batch checks; a warning earns half its weight. A batch that fails a
    check of severity ERROR, or has no valid row, fails and is capped.
    """
    checks = _checks(24, 90)
    errors = [check for check in checks if check.get("severity") != "WARNING"]
    passed = reduce(lambda a, b: a + b, [check["passed"].cast("int") for check in errors])
    earned = passed * ERROR_WEIGHT + F.when(F.col("fresh"), WARNING_WEIGHT).otherwise(
        WARNING_WEIGHT / 2
    )
    weight = len(errors) * ERROR_WEIGHT + WARNING_WEIGHT
    valid_share = round_even(F.col("valid_records") / F.col("record_count") * 100, 2)
    bad_records = F.col("record_count") - F.col("valid_records")
    raw_score = round_even(valid_share * ROW_SHARE + earned / weight * 100 * BATCH_SHARE, 2)
    failed = (passed < len(errors)) | (F.col("valid_records") == 0)
    verdict = (
        F.when(failed, "FAIL")
        .when((bad_records > 0) | ~F.col("fresh"), "WARN")
        .otherwise("PASS")
    )
    failed_batch_checks = F.lit(len(errors)) - passed
    warned = F.when(F.col("fresh"), 0).otherwise(1)
    return facts.join(rows, batch).select(
        batch,
        F.col("record_count").alias("total_records"),
        "valid_records",
        bad_records.alias("bad_records"),
        valid_share.alias("valid_percentage"),
        F.when(failed, F.least(raw_score, F.lit(FAIL_CEILING)))
        .otherwise(raw_score)
        .alias("quality_score"),
        verdict.alias("quality_status"),
        F.when(failed, "FAILED")
        .when(verdict == "WARN", "PARTIAL_SUCCESS")
        .otherwise("SUCCESS")
        .alias("pipeline_status"),
        "expected_records",
        F.col("expected").alias("expected_active_points"),
        F.col("known").alias("actual_active_points"),
        (F.lit(rules + len(checks)) - F.col("failed_row_checks") - failed_batch_checks - warned)
        .cast("bigint")
        .alias("passed_check_count"),
        warned.cast("bigint").alias("warning_check_count"),
        (F.col("failed_row_checks") + failed_batch_checks).cast("bigint").alias("failed_check_count"),
    )
