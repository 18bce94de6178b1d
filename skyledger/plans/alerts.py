"""Alerts of a batch of facts, and their merge into the alert table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import bands, clean
from skyledger.operators.audits import count_conditions, repeated_rows
from skyledger.operators.upserts import merge_alerts
from skyledger.schema import LOGICAL_KEY

ALERT_FLOOR = 101


def derive(facts: DataFrame, as_of: Column) -> DataFrame:
    """One open alert per reading above the second band.

    The bare filter on the index reaches the scan.
    """
    index = F.col("us_aqi")
    return facts.where(index >= ALERT_FLOOR).select(
        clean.strip("point_id").alias("point_id"),
        clean.strip("location_id").alias("location_id"),
        F.col("forecast_time").alias("alert_time"),
        index.alias("aqi_value"),
        bands.local_level(index).alias("aqi_level"),
        bands.alert_severity(index).alias("severity"),
        bands.alert_message(clean.strip("point_id"), clean.strip("location_id"), index).alias("message"),
        F.lit("OPEN").alias("status"),
        clean.strip("source").alias("source"),
        as_of.alias("created_at"),
    )


def counts(facts: DataFrame) -> DataFrame:
    """Counters of an alert run."""
    severity = bands.alert_severity(F.col("us_aqi"))
    return facts.agg(
        F.count(F.lit(1)).alias("input_records"),
        F.count("us_aqi").alias("classified_records"),
        F.count_if(F.col("us_aqi").isNull()).alias("null_aqi_records"),
        F.count_if(severity.isNotNull()).alias("alerts_generated"),
        *[
            F.count_if(severity == name).alias(f"{name.lower()}_alerts")
            for name in ("MEDIUM", "HIGH", "CRITICAL")
        ],
    )


def precheck(facts: DataFrame, source: str) -> DataFrame:
    """What would stop an alert run: (code, field, invalid_count)."""
    checks = [("BLANK", c, clean.is_blank(F.col(c))) for c in ("point_id", "location_id", "source")]
    checks.append(("WRONG_SOURCE", "source", ~clean.strip("source").eqNullSafe(F.lit(source))))
    checks.append(("NOT_CLASSIFIABLE", "us_aqi", bands.classification_error(F.col("us_aqi")).isNotNull()))
    return count_conditions(facts, checks).union(repeated_rows(facts, LOGICAL_KEY, "DUPLICATE_KEY"))


def refresh(alerts: DataFrame, batch: DataFrame, as_of: Column) -> DataFrame:
    """Alert table after judging a batch of facts."""
    return merge_alerts(alerts, batch, derive(batch, as_of))


def kpis(alerts: DataFrame) -> DataFrame:
    severity, status = F.upper("severity"), F.upper("status")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(severity == "CRITICAL").alias("critical_alerts"),
        F.count_if(severity == "HIGH").alias("high_alerts"),
        F.count_if(status == "OPEN").alias("open_alerts"),
    )


def filtered(
    alerts: DataFrame, severities: list[str], status: str | None = None, location: str | None = None
) -> DataFrame:
    """Alerts of the chosen severities, status and location."""
    chosen = alerts.where(F.upper("severity").isin([s.upper() for s in severities]))
    if status is not None:
        chosen = chosen.where(F.upper("status") == status.upper())
    if location is not None:
        chosen = chosen.where(F.col("location_id") == location)
    return chosen
