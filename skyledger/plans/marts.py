"""The three marts: current per point, summary per location, summary per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.bands import LEVEL_NAMES, level_name, level_rank
from skyledger.functions.numbers import mean, round_even
from skyledger.functions.time import local_day, local_hour_floor
from skyledger.operators.joins import enrich_locations
from skyledger.operators.ranking import latest_wins, nearest_in_time, smallest, worst_first
from skyledger.operators.audits import batch_validity
from skyledger.plans import states
from skyledger.schema import BAND_HOUR_COLUMNS, POLLUTANTS
from skyledger.sources.tables import valid_history

FULL_DAY_HOURS = 24
MEASURED = states.MEASURED


def with_level(df: DataFrame, index: str) -> DataFrame:
    return df.withColumns({"aqi_level": level_name(F.col(index)), "aqi_severity": level_rank(F.col(index))})


def snapshot_hour(readings: DataFrame) -> Column:
    """Local hour in which the newest reading was ingested."""
    return readings.agg(local_hour_floor(F.max("ingested_at"))).scalar()


def current(
    batch: DataFrame, locations: DataFrame, created_at: Column, as_of: Column | None = None
) -> DataFrame:
    """Per point the forecast nearest to the snapshot hour; the future wins ties."""
    reference = snapshot_hour(batch) if as_of is None else as_of
    nearest = nearest_in_time(
        batch, reference, tie="future", then=[F.col("ingested_at").desc_nulls_last()]
    )
    named = with_level(enrich_locations(nearest, locations), "us_aqi")
    return named.select(
        "point_id",
        "location_id",
        "location_name",
        "region",
        "point_name",
        "point_type",
        "latitude",
        "longitude",
        "forecast_time",
        "us_aqi",
        "aqi_level",
        "aqi_severity",
        *POLLUTANTS,
        "source",
        F.col("batch_id").alias("source_batch_id"),
        "schema_version",
        F.col("ingested_at").alias("source_ingested_at"),
        created_at.alias("mart_created_at"),
    )


def sort_current(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("aqi_severity").desc_nulls_last(),
        F.col("us_aqi").desc_nulls_last(),
        F.col("location_id").asc_nulls_last(),
        F.col("point_id").asc_nulls_last(),
    )


def _measures() -> list[Column]:
    aggregates = []
    for c in MEASURED:
        aggregates.append(round_even(mean(F.col(c)), 2).alias(f"average_{c}"))
        aggregates.append(round_even(F.max(c), 2).alias(f"maximum_{c}"))
    return aggregates


def location_summary(current_rows: DataFrame, created_at: Column) -> DataFrame:
    """Per location: averages, extremes and the worst point, in one aggregate."""
    keys = ["location_id", "location_name", "region"]
    summary = current_rows.groupBy(*keys).agg(
        F.countDistinct("point_id").alias("monitoring_point_count"),
        F.max("forecast_time").alias("forecast_time"),
        round_even(F.avg("us_aqi"), 2).alias("average_us_aqi"),
        F.min("us_aqi").alias("minimum_us_aqi"),
        F.max("us_aqi").alias("maximum_us_aqi"),
        *_measures(),
        round_even(mean(F.col("latitude")), 2).alias("latitude"),
        round_even(mean(F.col("longitude")), 2).alias("longitude"),
        F.countDistinct("source_batch_id").alias("source_batch_count"),
        smallest(["point_id", "point_name", "us_aqi"], worst_first("us_aqi", "point_id")).alias("_worst"),
    )
    named = summary.withColumns(
        {
            "worst_point_id": F.col("_worst.point_id"),
            "worst_point_name": F.col("_worst.point_name"),
            "worst_point_us_aqi": F.col("_worst.us_aqi"),
        }
    ).drop("_worst")
    return with_level(named, "maximum_us_aqi").withColumn("mart_created_at", created_at)


def sort_location_summary(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("aqi_severity").desc_nulls_last(),
        F.col("maximum_us_aqi").desc_nulls_last(),
        F.col("location_id").asc_nulls_last(),
    )


POINT_ATTRIBUTES = (
    "location_id",
    "location_name",
    "region",
    "point_name",
    "point_type",
    "latitude",
    "longitude",
)


def daily_summary(
    history: DataFrame, locations: DataFrame, created_at: Column, split_on_drift: bool = False
) -> DataFrame:
    """Per point and local day over the newest version of each hour.

    Hours of a point are unique after the newest-version step, so hours are
    counted and not counted distinct, and the batches of a day fit in a set of
    at most a day's hours. A point whose attributes change within a day keeps
    the latest ones; ``split_on_drift`` gives one row per attribute set instead.
    """
    return days_of_hours(latest_wins(history), locations, created_at, split_on_drift)


def days_of_hours(
    newest: DataFrame, locations: DataFrame, created_at: Column, split_on_drift: bool = False
) -> DataFrame:
    """The daily summary of rows that are the newest of their point and hour already."""
    hours = with_level(newest, "us_aqi").withColumn("forecast_date", local_day(F.col("forecast_time")))
    named = enrich_locations(hours, locations)
    keys = ["forecast_date", "point_id", *(POINT_ATTRIBUTES if split_on_drift else ())]
    attributes = F.max_by(F.struct(*POINT_ATTRIBUTES), F.struct("ingested_at", "forecast_time"))
    summary = named.groupBy(*keys).agg(
        *([] if split_on_drift else [attributes.alias("_point")]),
        F.min("forecast_time").alias("first_forecast_time"),
        F.max("forecast_time").alias("last_forecast_time"),
        F.count("forecast_time").alias("available_hours"),
        round_even(F.avg("us_aqi"), 2).alias("average_us_aqi"),
        F.min("us_aqi").alias("minimum_us_aqi"),
        F.max("us_aqi").alias("maximum_us_aqi"),
        *_measures(),
        *[
            F.count_if(F.col("aqi_level") == level).alias(column)
            for level, column in zip(LEVEL_NAMES, BAND_HOUR_COLUMNS)
        ],
        F.size(F.collect_set("batch_id")).cast("bigint").alias("source_batch_count"),
        F.max("ingested_at").alias("latest_source_ingested_at"),
        smallest(["forecast_time", "batch_id"], worst_first("us_aqi", "forecast_time")).alias("_worst"),
    )
    if not split_on_drift:
        summary = summary.withColumns({c: F.col(f"_point.{c}") for c in POINT_ATTRIBUTES}).drop("_point")
    finished = summary.withColumns(
        {
            "worst_forecast_time": F.col("_worst.forecast_time"),
            "worst_hour_source_batch_id": F.col("_worst.batch_id"),
            "coverage_status": F.when(F.col("available_hours") >= FULL_DAY_HOURS, "COMPLETE").otherwise(
                "PARTIAL"
            ),
            "mart_created_at": created_at,
        }
    ).drop("_worst")
    return with_level(finished, "maximum_us_aqi")


def sort_daily_summary(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("forecast_date").desc_nulls_last(),
        F.col("maximum_us_aqi").desc_nulls_last(),
        F.col("location_id").asc_nulls_last(),
        F.col("point_id").asc_nulls_last(),
    )


def daily_summary_increment(
    history: DataFrame, batch: DataFrame, locations: DataFrame, created_at: Column
) -> DataFrame:
    """Daily rows of only those days that the new batch touches, from valid batches as in ``build``.

    The hour states of the batch are merged into those of the batches before it,
    as ``sinks.daily`` does with stored states; see ``plans.states``.
    """
    days = states.days_of(batch)
    known = valid_history(history).where(F.col("batch_id") != batch.agg(F.max("batch_id")).scalar())
    before = states.of_rows(known.join(days, local_day(F.col("forecast_time")) == F.col(states.DAY), "left_semi"))
    merged = states.merged(before, states.of_rows(valid_history(batch)))
    return days_of_hours(states.hours(merged), locations, created_at)


def latest_batch_id(readings: DataFrame) -> Column:
    return readings.agg(F.max_by("batch_id", F.struct("ingested_at", "batch_id"))).scalar()


def latest_batch(readings: DataFrame) -> DataFrame:
    """Rows of the batch that was ingested last."""
    return readings.where(F.col("batch_id") == latest_batch_id(readings))


def build(history: DataFrame, locations: DataFrame, created_at: Column) -> dict[str, DataFrame]:
    """All three marts: the newest batch for the current one, valid batches for the days."""
    current_rows = current(latest_batch(history), locations, created_at)
    return {
        "current": current_rows,
        "location_summary": location_summary(current_rows, created_at),
        "daily_summary": daily_summary(valid_history(history), locations, created_at),
    }


def build_summary(
    history: DataFrame, locations: DataFrame, built: dict[str, DataFrame]
) -> DataFrame:
    """One row of counts that goes into the build log, written after the marts.

    ``built`` holds the marts, best as read back from where they were written,
    so that counting them does not build them again.
    """

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    counts = batch_validity(history).agg(
        F.count_if("is_valid").alias("valid_batch_count"),
        F.count_if(~F.col("is_valid")).alias("skipped_batch_count"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("record_count"))), F.lit(0)).alias(
            "history_input_records"
        ),
        F.sum(F.when(F.col("batch_id") == latest_batch_id(history), F.col("record_count"))).alias(
            "latest_batch_records"
        ),
    )
    return counts.select(
        F.lit("SUCCESS").alias("status"),
        latest_batch_id(history).alias("batch_id"),
        "valid_batch_count",
        "skipped_batch_count",
        "history_input_records",
        "latest_batch_records",
        rows(locations).alias("location_dimension_rows"),
        *[rows(df).alias(f"{name}_rows") for name, df in built.items()],
    ).withColumn("output_records", sum(F.col(f"{name}_rows") for name in built))
