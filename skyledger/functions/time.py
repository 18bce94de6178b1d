"""Instants, local time, partition strings and data age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.clean import OFFSET_PATTERN, to_timestamp
from skyledger.session import LOCAL_ZONE


def local_time(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone)


def local_date(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_time(instant, zone))


def local_hour_floor(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Start of the local hour, as an instant."""
    return F.to_utc_timestamp(F.date_trunc("hour", local_time(instant, zone)), zone)


def parse_instant(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """Text with an offset is an instant; without one it is local time."""
    parsed = to_timestamp(text)
    return F.when(text.rlike(OFFSET_PATTERN), parsed).otherwise(F.to_utc_timestamp(parsed, zone))


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)


def local_day(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local day as text, as days name folders and mart rows."""
    return F.date_format(local_time(instant, zone), "yyyy-MM-dd")


def partition_date(started_at: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_day(started_at, zone)


def partition_hour(started_at: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.date_format(local_time(started_at, zone), "HH")


def age_seconds(instant: Column, as_of: Column) -> Column:
    micros = F.unix_micros(as_of) - F.unix_micros(instant)
    seconds = F.floor(micros / F.lit(1_000_000.0)).cast("bigint")
    return F.when(instant.isNotNull(), F.greatest(F.lit(0).cast("bigint"), seconds))


def age_minutes(instant: Column, as_of: Column) -> Column:
    return F.floor(age_seconds(instant, as_of) / 60).cast("bigint")


def age_text(instant: Column, as_of: Column) -> Column:
    """Fixed display texts for the age of the data."""
    seconds = age_seconds(instant, as_of)
    minutes = F.floor(seconds / 60).cast("bigint")
    hours = F.floor(seconds / 3600).cast("bigint")
    days = F.floor(seconds / 86400).cast("bigint")
    return (
        F.when(instant.isNull(), F.lit("chưa xác định được độ mới"))
        .when(seconds < 60, F.lit("vừa cập nhật"))
        .when(minutes < 60, F.format_string("cách đây %d phút", minutes))
        .when(hours < 24, F.format_string("cách đây %d giờ", hours))
        .otherwise(F.format_string("cách đây %d ngày", days))
    )


def stale_tier(instant: Column, as_of: Column) -> Column:
    minutes = age_minutes(instant, as_of)
    return (
        F.when(minutes.isNull(), F.lit("UNKNOWN"))
        .when(minutes > 120, F.lit("STALE_2H"))
        .when(minutes > 60, F.lit("STALE_1H"))
        .otherwise(F.lit("FRESH"))
    )
