"""Live windows over the time of ingestion, and live values of the newest versions.

Forecast times lie in the future and would push the watermark past every
correction, so all jobs run on ``ingested_at``. ``hourly_means`` and
``alert_counts`` tell what arrived; ``corrections`` and ``current_hours`` tell what
holds, as a corrected reading takes the place of its older version there.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skyledger.functions.bands import alert_severity

#: Severities of alerts, as ``alert_severity`` gives them.
SEVERITIES = ("MEDIUM", "HIGH", "CRITICAL")
LATENESS, WINDOW = "2 hours", "1 hour"


def hourly_means(readings: DataFrame) -> DataFrame:
    """Mean index per location and hour of ingestion."""
    return (
        readings.withWatermark("ingested_at", LATENESS)
        .groupBy(F.window("ingested_at", WINDOW), "location_id")
        .agg(F.avg("us_aqi").alias("average_us_aqi"), F.count(F.lit(1)).alias("readings"))
        .select(F.col("window.start").alias("hour"), "location_id", "average_us_aqi", "readings")
    )


def alert_counts(readings: DataFrame) -> DataFrame:
    """Alerts per severity and hour of ingestion."""
    return (
        readings.withWatermark("ingested_at", LATENESS)
        .withColumn("severity", alert_severity(F.col("us_aqi")))
        .where(F.col("severity").isNotNull())
        .groupBy(F.window("ingested_at", WINDOW), "severity")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select(F.col("window.start").alias("hour"), "severity", "alerts")
    )


#: Hours that a reading may be corrected after its own hour is over.
CORRECTABLE = 2
HOUR_MS = 3_600_000

CHANGE = (
    "location_id string, forecast_time timestamp, readings bigint, measured bigint, total_us_aqi bigint, "
    "severity string, alerts bigint"
)
VERSION = "ingested_at timestamp, batch_id string, location_id string, us_aqi bigint, severity string"


def corrections(readings: DataFrame) -> DataFrame:
    """A stream of changes to what each location shows for each hour, from the newest version of every reading.

    The state of a point and hour is its newest version, by ``ingested_at`` and then
    ``batch_id``. A newer one takes the old values back, at the location where they
    counted, and adds its own; an older or repeated one changes nothing. When
    ``ingested_at`` has passed the hour by ``CORRECTABLE`` hours beyond its lateness,
    a timer drops the state, and later versions of the hour are left out, as they
    could no longer be told from first ones.
    """
    versions = readings.withWatermark("ingested_at", LATENESS).select(
        "point_id",
        "forecast_time",
        "ingested_at",
        "batch_id",
        "location_id",
        F.col("us_aqi").cast("bigint").alias("us_aqi"),
        alert_severity(F.col("us_aqi")).alias("severity"),
    )
    keyed = versions.groupBy("point_id", "forecast_time")
    return keyed.applyInPandasWithState(newest_version, CHANGE, VERSION, "append", GroupStateTimeout.EventTimeTimeout)


def change(hour: datetime, version: tuple, sign: int) -> tuple:
    _, _, location, index, severity = version
    known = index is not None
    return location, hour, sign, sign * known, sign * (index or 0), severity, sign * (severity is not None)


def plain(row: tuple) -> tuple:
    """A version as Python values, absent ones as None."""
    ingested_at, batch, location, index, severity = (None if pd.isna(value) else value for value in row)
    at = None if ingested_at is None else pd.Timestamp(ingested_at).to_pydatetime()
    return at, batch, location, None if index is None else int(index), severity


def newer(one: tuple, other: tuple | None) -> bool:
    rank = lambda v: (v[0] is not None, v[0] or datetime.min, v[1] is not None, v[1] or "")
    return other is None or rank(one) > rank(other)


def newest_version(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes that the new versions of one point and hour make."""
    if state.hasTimedOut:
        state.remove()
        return
    hour = pd.Timestamp(key[1])
    closes = int(hour.tz_localize("UTC").timestamp() * 1000) + (1 + CORRECTABLE) * HOUR_MS
    if state.getCurrentWatermarkMs() >= closes:
        return
    held = plain(state.get) if state.exists else None
    best = held
    for frame in frames:
        for row in frame[["ingested_at", "batch_id", "location_id", "us_aqi", "severity"]].itertuples(index=False, name=None):
            version = plain(row)
            best = version if newer(version, best) else best
    if best == held:
        return
    state.update(best)
    state.setTimeoutTimestamp(closes)
    changes = [change(hour, best, 1)] + ([change(hour, held, -1)] if held is not None else [])
    names = [field.strip().split()[0] for field in CHANGE.split(",")]
    yield pd.DataFrame(changes, columns=names)


def maintain(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add up the available changes below ``path``, one folder for each micro-batch, then stop.

    A micro-batch holds a row for each location, hour and severity that it changes. A
    replayed one writes its folder again, so the sums stay the same.
    """

    def store(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("location_id", "forecast_time", "severity").agg(
            *[F.sum(c).alias(c) for c in ("readings", "measured", "total_us_aqi", "alerts")]
        )
        sums.write.mode("overwrite").parquet(f"{path}/micro_batch={number}")

    stream = changes.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return stream.foreachBatch(store).start()


def current_hours(spark: SparkSession, path: str) -> DataFrame:
    """Mean index, readings and alerts by severity per location and hour, of the newest versions alone."""
    sums = spark.read.parquet(path).groupBy("location_id", "forecast_time")
    alerts = [F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("alerts"))), F.lit(0)).alias(f"{s.lower()}_alerts") for s in SEVERITIES]
    found = sums.agg(F.sum("readings").alias("readings"), F.sum("measured").alias("measured"), F.sum("total_us_aqi").alias("total"), *alerts)
    mean = F.when(F.col("measured") > 0, F.col("total") / F.col("measured"))
    return found.where("readings > 0").select(
        "location_id", "forecast_time", mean.alias("average_us_aqi"), "readings", *[f"{s.lower()}_alerts" for s in SEVERITIES]
    )
