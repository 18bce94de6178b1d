"""Serving queries over facts, dimensions, alerts and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.operators.joins import active_points, star
from skyledger.operators.ranking import keep_top
from skyledger.schema import AQI_COLUMNS, POLLUTANTS

# Largest limit a caller may ask for.
MAX_READINGS, MAX_TOP, MAX_HISTORY, MAX_ALERTS = 5000, 100, 2160, 1000

HOURS_A_DAY = 24

READING_COLUMNS = (
    "point_id",
    "location_id",
    "point_name",
    "point_type",
    "location_name",
    "region",
    "admin_type",
    "latitude",
    "longitude",
    "forecast_time",
    *POLLUTANTS,
    *AQI_COLUMNS,
    "aqi_level",
    "aqi_severity",
    "source",
    "batch_id",
    "schema_version",
    "ingested_at",
)


def bounded(limit: int, maximum: int) -> int:
    if not 1 <= limit <= maximum:
        raise ValueError(f"limit must be within 1..{maximum}, got {limit}")
    return limit


def limited(rows: DataFrame, limit: int | None, maximum: int) -> DataFrame:
    """The first rows if the caller names a limit, else all."""
    return rows if limit is None else rows.limit(bounded(limit, maximum))


def key_of(text: str) -> str:
    """Ids are looked up trimmed and in upper case; the column stays bare so
    that the filter reaches the scan."""
    return text.strip().upper()


def latest_batch_id(facts: DataFrame) -> Column:
    """Batch of the row ingested last, as a scalar subquery; also of a map of batches."""
    return facts.agg(F.max_by("batch_id", F.struct("ingested_at", "batch_id"))).scalar()


def latest_batch_rows(facts: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Facts of the batch that was ingested last.

    With the stored map of batches to days (``sinks.facts.read_batches``) the batch
    is looked up there, and only its day folders are read; without it the facts are
    scanned for it.
    """
    if batches is None:
        return facts.where(F.col("batch_id") == latest_batch_id(facts))
    batch = batches.select(F.max_by(F.struct("batch_id"), F.struct("ingested_at", "batch_id"))).first()[0]
    if batch is None:
        return facts.limit(0)
    own = F.lit(batch.batch_id)
    days = batches.where(F.col("batch_id").eqNullSafe(own)).select("forecast_date").distinct()
    # A batch's days are bounded by how far ahead it looks.
    days = [row.forecast_date for row in days.collect()]
    return facts.where(F.col("forecast_date").isin(days) & F.col("batch_id").eqNullSafe(own))


def first_hour(rows: DataFrame) -> DataFrame:
    """The rows at the first forecast time among ``rows``."""
    return rows.where(F.col("forecast_time") == rows.agg(F.min("forecast_time")).scalar())


def _readings(rows: DataFrame, points: DataFrame, locations: DataFrame) -> DataFrame:
    return star(rows, points, locations).select(*READING_COLUMNS)


def latest_readings(
    facts: DataFrame, points: DataFrame, locations: DataFrame, limit: int | None = None, batches: DataFrame | None = None
) -> DataFrame:
    rows = latest_batch_rows(facts, batches)
    ordered = _readings(rows, points, locations).orderBy("forecast_time", "point_id")
    return limited(ordered, limit, MAX_READINGS)


def readings_by_location(
    facts: DataFrame,
    points: DataFrame,
    locations: DataFrame,
    location_id: str,
    limit: int | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    rows = latest_batch_rows(facts, batches).where(F.col("location_id") == key_of(location_id))
    ordered = _readings(rows, points, locations).orderBy("forecast_time", "point_id")
    return limited(ordered, limit, MAX_READINGS)


def readings_by_point(
    facts: DataFrame,
    points: DataFrame,
    locations: DataFrame,
    point_id: str,
    limit: int | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    rows = latest_batch_rows(facts, batches).where(F.col("point_id") == key_of(point_id))
    return limited(_readings(rows, points, locations).orderBy("forecast_time"), limit, MAX_READINGS)


def top_polluted(
    facts: DataFrame, points: DataFrame, locations: DataFrame, limit: int = 10, batches: DataFrame | None = None
) -> DataFrame:
    """Worst points at the first forecast hour of the latest batch."""
    rows = first_hour(latest_batch_rows(facts, batches)).where(F.col("us_aqi").isNotNull())
    return (
        _readings(rows, points, locations)
        .orderBy(F.col("us_aqi").desc(), "location_name", "point_name")
        .limit(bounded(limit, MAX_TOP))
    )


def newest_days(facts: DataFrame, batches: DataFrame, point_id: str, hours: int) -> list:
    """The newest days of the map that hold the last ``hours`` rows of a point.

    It starts with the days that hold so many if none is missing, and takes twice as
    many as long as the point has fewer rows there. Only the folders of those days
    are read, and only to count.
    """
    known = sorted((row[0] for row in batches.select("forecast_date").distinct().collect()), reverse=True)
    known = [day for day in known if day is not None]
    own, take = F.col("point_id") == key_of(point_id), hours // HOURS_A_DAY + 2
    while take < len(known):
        if facts.where(F.col("forecast_date").isin(known[:take]) & own).limit(hours).count() >= hours:
            break
        take *= 2
    return known[:take]


def point_history(
    facts: DataFrame,
    points: DataFrame,
    locations: DataFrame,
    point_id: str,
    hours: int | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """All or the last hours of one point, oldest first; with the map of batches only the days they lie in are read."""
    own = facts.where(F.col("point_id") == key_of(point_id))
    if batches is not None and hours is not None:
        days = newest_days(facts, batches, point_id, bounded(hours, MAX_HISTORY))
        own = own.where(F.col("forecast_date").isin(days))
    recent = own.orderBy(F.col("forecast_time").desc())
    return _readings(limited(recent, hours, MAX_HISTORY), points, locations).orderBy("forecast_time")


def history_all_points(facts: DataFrame, hours: int) -> DataFrame:
    """Last hours of every point at once."""
    order = [F.col("forecast_time").desc(), F.col("source").asc()]
    return keep_top(facts, ["point_id"], order, bounded(hours, MAX_HISTORY))


def active_locations(locations: DataFrame) -> DataFrame:
    return locations.where(clean.is_active(F.col("is_active"))).orderBy("region", "location_name")


def active_monitoring_points(points: DataFrame, locations: DataFrame) -> DataFrame:
    return active_points(points, locations).orderBy("location_name", "point_name")


def latest_alerts(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    order = [F.col("created_at").desc(), "point_id", "alert_time", "severity"]
    return limited(alerts.orderBy(*order), limit, MAX_ALERTS)
