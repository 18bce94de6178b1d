"""Hour states: what the daily mart has to know of a point's local day, ready to be merged.

A state is one row per (day, point) with the newest version of each of its hours,
at most a calendar day's. Two states of a point and day merge hour by hour, the
newer version winning, in any order and as often as one likes, so a batch adds its
states to the stored ones and a corrected hour takes the place of its own. Days
are then summarised from their states alone, without the history behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.time import local_day
from skyledger.operators.ranking import latest_wins

DAY = "forecast_date"
KEYS = (DAY, "point_id")
MEASURED = ("pm2_5", "pm10", "ozone")
ATTRIBUTES = ("location_id", "point_name", "point_type", "latitude", "longitude")
#: The version comes first, so that versions of an hour are in order when hours are.
HOUR = ("forecast_time", "ingested_at", "batch_id", "us_aqi", *MEASURED, *ATTRIBUTES)


def days_of(rows: DataFrame) -> DataFrame:
    """Local days that rows lie in; bounded by the calendar, not by the rows."""
    return rows.select(local_day(F.col("forecast_time")).alias(DAY)).distinct()


def newest(states: DataFrame, hours: str) -> DataFrame:
    """``states`` with only the last version of each hour in their array ``hours``.

    The array is sorted in a step of its own, as a lambda would sort it for every hour.
    """
    ordered = states.withColumn("_ordered", F.array_sort(hours))

    def last(hour: Column, place: Column) -> Column:
        following = F.get("_ordered", place + 1)
        return following.isNull() | (following["forecast_time"] != hour["forecast_time"])

    return ordered.withColumn(hours, F.filter("_ordered", last)).drop("_ordered")


def of_rows(rows: DataFrame) -> DataFrame:
    """States of readings; versions are dropped before the shuffle, so a group holds one row an hour."""
    dated = latest_wins(rows).withColumn(DAY, local_day(F.col("forecast_time")))
    return dated.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(*HOUR))).alias("hours"))


def merged(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """One state for each (day, point) of either side."""
    both = stored.select(*KEYS, "hours").join(
        fresh.select(*KEYS, F.col("hours").alias("_fresh")), list(KEYS), "full_outer"
    )
    empty = F.array().cast(stored.schema["hours"].dataType)
    either = F.concat(F.coalesce("hours", empty), F.coalesce("_fresh", empty))
    return newest(both.select(*KEYS, either.alias("hours")), "hours")


def hours(states: DataFrame) -> DataFrame:
    """The hours of states as readings, one row each."""
    return states.select("point_id", F.inline("hours"))
