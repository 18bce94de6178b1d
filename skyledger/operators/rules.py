"""Row rules: every rule is one boolean expression, all run in one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import clean
from skyledger.operators.counting import count_positions, met, spread
from skyledger.operators.duplicates import flag_duplicates
from skyledger.operators.joins import unique_dimension
from skyledger.schema import AQI_COLUMNS, LOGICAL_KEY, POLLUTANTS, REQUIRED_TEXT

DUPLICATE_FLAG = "_key_repeated"


@dataclass(frozen=True)
class Rule:
    code: str
    message: str
    failed: Column
    severity: str = "ERROR"


def number_of(df: DataFrame, name: str) -> Column:
    """A column as double; text is parsed, unreadable text and NaN become null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return clean.to_number(F.col(name))
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _time_invalid(df: DataFrame, name: str) -> Column:
    # A typed timestamp is an instant already; only text can lack its offset.
    if isinstance(df.schema[name].dataType, T.StringType):
        return ~clean.has_offset(F.col(name))
    return F.col(name).isNull()


def _outside(value: Column, low: float, high: float) -> Column:
    return ~F.coalesce(value.between(low, high), F.lit(False))


def with_dimensions(df: DataFrame, points: DataFrame, locations: DataFrame) -> DataFrame:
    """Attach what the active dimensions say about the row's point and location.

    A repeated active id stops the job, as it would multiply readings.
    """
    point = points.where(clean.is_active(F.col("is_active"))).select(
        clean.strip("point_id").alias("_point_key"),
        clean.strip("location_id").alias("_home_location"),
        F.col("latitude").alias("_home_latitude"),
        F.col("longitude").alias("_home_longitude"),
    )
    location = locations.where(clean.is_active(F.col("is_active"))).select(
        clean.strip("location_id").alias("_location_key")
    )
    point = unique_dimension(point, "_point_key", DIMENSION_COLUMNS[1:4])
    location = unique_dimension(location, "_location_key", [])
    return df.join(point, clean.strip(df["point_id"]) == point["_point_key"], "left").join(
        location, clean.strip(df["location_id"]) == location["_location_key"], "left"
    )


DIMENSION_COLUMNS = (
    "_point_key",
    "_home_location",
    "_home_latitude",
    "_home_longitude",
    "_location_key",
)


def reading_rules(
    df: DataFrame,
    source: str,
    tolerance: float = 0.001,
    batch: str | None = None,
) -> list[Rule]:
    """The reading rules in reporting order.

    ``df`` must carry the columns of :func:`with_dimensions` and the duplicate
    flag. ``batch`` names the column that holds the batch a row was loaded
    with; then the row's own batch id must agree.
    """
    rules = [
        Rule(f"{c.upper()}_REQUIRED", f"{c} must not be blank", clean.is_blank(F.col(c)))
        for c in REQUIRED_TEXT
    ]
    for c in ("forecast_time", "ingested_at"):
        rules.append(
            Rule(f"{c.upper()}_AWARE", f"{c} must be a time with offset", _time_invalid(df, c))
        )
    for c in POLLUTANTS + AQI_COLUMNS:
        value = number_of(df, c)
        rules.append(
            Rule(f"{c.upper()}_REQUIRED_NUMERIC", f"{c} must be a number", value.isNull())
        )
        rules.append(
            Rule(
                f"{c.upper()}_NON_NEGATIVE",
                f"{c} must be at least 0",
                F.coalesce(value, F.lit(-1.0)) < 0,
            )
        )
    latitude, longitude = number_of(df, "latitude"), number_of(df, "longitude")
    location = clean.strip("location_id")
    home = F.col("_home_location")
    far = (F.abs(latitude - F.col("_home_latitude")) > tolerance) | (
        F.abs(longitude - F.col("_home_longitude")) > tolerance
    )
    rules += [
        Rule("LATITUDE_RANGE", "latitude must be within -90..90", _outside(latitude, -90, 90)),
        Rule("LONGITUDE_RANGE", "longitude must be within -180..180", _outside(longitude, -180, 180)),
        Rule(
            f"SOURCE_{source.upper()}",
            f"source must be {source}",
            ~F.lower(clean.strip("source")).eqNullSafe(F.lit(source)),
        ),
        Rule(
            "UNIQUE_LOGICAL_KEY",
            "point_id, forecast_time and source must be unique",
            F.col(DUPLICATE_FLAG),
        ),
        Rule("KNOWN_ACTIVE_POINT_ID", "point_id must be an active point", F.col("_point_key").isNull()),
        Rule(
            "KNOWN_ACTIVE_LOCATION_ID",
            "location_id must be an active location",
            F.col("_location_key").isNull(),
        ),
        Rule(
            "POINT_LOCATION_MATCH",
            "point_id must belong to location_id",
            home.isNotNull() & ~location.eqNullSafe(home),
        ),
        Rule(
            "POINT_COORDINATE_MATCH",
            "coordinates must match those of the point",
            F.coalesce(far, F.lit(False)),
        ),
    ]
    if batch is not None:
        rules.append(
            Rule(
                "BATCH_ID_MATCH",
                "batch_id must be the id of its batch",
                ~clean.strip("batch_id").eqNullSafe(clean.strip(F.col(batch))),
            )
        )
    return rules


def check_readings(
    df: DataFrame,
    points: DataFrame,
    locations: DataFrame,
    source: str,
    tolerance: float = 0.001,
    batch: str | None = None,
) -> tuple[DataFrame, list[Rule]]:
    """Readings with everything the rules look at, and the rules themselves.

    The key is unique within a batch, so several batches are checked at once.
    """
    key = (*LOGICAL_KEY, batch) if batch else LOGICAL_KEY
    flagged = flag_duplicates(df, key, DUPLICATE_FLAG)
    prepared = with_dimensions(flagged, points, locations)
    return prepared, reading_rules(prepared, source, tolerance, batch)


def broken(rules: Sequence[Rule]) -> Column:
    """Positions of the broken rules, in rule order."""
    return met([rule.failed for rule in rules])


def _named(positions: Column, names: Sequence[str], separator: str) -> Column:
    """Positions as joined texts; only the few broken rules are looked up."""
    texts = F.array(*[F.lit(name) for name in names])
    return F.array_join(F.transform(positions, lambda i: F.get(texts, i)), separator)


def error_codes(positions: Column, rules: Sequence[Rule]) -> Column:
    return _named(positions, [rule.code for rule in rules], "|")


def error_messages(positions: Column, rules: Sequence[Rule]) -> Column:
    return _named(positions, [rule.message for rule in rules], " | ")


#: Positions of the rules that a judged row breaks.
BROKEN = "_broken"


def judged(prepared: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Readings with the positions of their broken rules, without what the rules looked at.

    All results follow from these rows, so rules are evaluated once if they are written.
    """
    return prepared.withColumn(BROKEN, broken(rules)).drop(DUPLICATE_FLAG, *DIMENSION_COLUMNS)


def split(
    judged_rows: DataFrame, rules: Sequence[Rule], checked_at: Column
) -> tuple[DataFrame, DataFrame]:
    """Judged rows without issue, and the quarantined rest with codes and messages."""
    positions = F.col(BROKEN)
    good = judged_rows.where(F.size(positions) == 0).drop(BROKEN)
    bad = (
        judged_rows.where(F.size(positions) > 0)
        .withColumns(
            {
                "dq_status": F.lit("FAILED"),
                "dq_checked_at": checked_at,
                "dq_error_codes": error_codes(positions, rules),
                "dq_error_messages": error_messages(positions, rules),
            }
        )
        .drop(BROKEN)
    )
    return good, bad


def report(judged_rows: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """One row per rule (and group): bad rows and PASSED or FAILED. One pass."""
    counts = count_positions(judged_rows, BROKEN, by)
    entries = [
        (
            F.lit(rule.code).alias("check_name"),
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.message).alias("message"),
        )
        for rule in rules
    ]
    return spread(counts, entries, by).select(
        *by,
        "check_name",
        F.lit("ROW").alias("check_scope"),
        "severity",
        F.when(F.col("row_count") == 0, "PASSED").otherwise("FAILED").alias("status"),
        F.col("row_count").alias("bad_records_count"),
        "message",
    )
