"""Analytical views: rankings, distributions, series, filters and indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import bands, clean
from skyledger.functions.numbers import mean, round_even
from skyledger.functions.time import hours_between, local_time
from skyledger.operators.ranking import keep_first, smallest, worst_first

UNKNOWN_LOCATION = "Không rõ"
UNKNOWN_LABEL = "Chưa xác định"
# Display texts of the codes.
POINT_TYPE_LABELS = {"urban_center": "Trung tâm đô thị", "regional_center": "Trung tâm khu vực"}
UNKNOWN_POINT_TYPE = "Chưa phân loại"
STAGE_LABELS = {
    "extract": "Thu thập dữ liệu",
    "transform": "Làm sạch dữ liệu",
    "data_quality": "Kiểm tra chất lượng",
    "load_timescaledb": "Lưu vào cơ sở dữ liệu",
    "alerts": "Xử lý cảnh báo",
    "mart": "Tạo dữ liệu tổng hợp",
    "snapshot_publish": "Xuất bản dữ liệu công khai",
}
STATUS_LABELS = {
    "SUCCESS": "Thành công",
    "HEALTHY": "Ổn định",
    "FAILED": "Thất bại",
    "FAIL": "Thất bại",
    "WARNING": "Cần chú ý",
    "RUNNING": "Đang chạy",
    "EMPTY": "Chưa có dữ liệu",
    "OPEN": "Đang mở",
    "ACKNOWLEDGED": "Đã xác nhận",
    "RESOLVED": "Đã xử lý",
    "PASS": "Đạt",
    "PASSED": "Đạt",
    "UNKNOWN": "Chưa xác định",
}
SEVERITY_LABELS = {"MEDIUM": "Trung bình", "HIGH": "Cao", "CRITICAL": "Nghiêm trọng"}

TECHNICAL_COLUMNS = (
    "forecast_time",
    "location_id",
    "location_name",
    "point_id",
    "point_name",
    "point_type",
    "latitude",
    "longitude",
    "pm2_5",
    "pm10",
    "ozone",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "carbon_monoxide",
    "us_aqi",
    "source",
    "batch_id",
    "schema_version",
    "ingested_at",
)


def with_columns_present(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Add missing columns as typed nulls."""
    absent = {c: F.lit(None).cast(t) for c, t in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def location_summary(nearest: DataFrame) -> DataFrame:
    """Per location from its nearest rows; unlike the mart, the level follows the average."""
    named = with_columns_present(nearest, {"location_name": "string", "nitrogen_dioxide": "double"})
    rows = named.where(~clean.is_blank(F.col("location_id")))
    name = F.nullif(clean.strip("location_name"), F.lit(""))
    summary = rows.groupBy(clean.strip("location_id").alias("location_id")).agg(
        F.min_by(name, F.when(name.isNotNull(), F.col("point_id"))).alias("location_name"),
        mean(F.col("latitude")).alias("latitude"),
        mean(F.col("longitude")).alias("longitude"),
        F.countDistinct("point_id").alias("monitoring_point_count"),
        F.avg("us_aqi").alias("average_us_aqi"),
        F.max("us_aqi").alias("maximum_us_aqi"),
        *[
            mean(F.col(c)).alias(f"average_{c}")
            for c in ("pm2_5", "pm10", "ozone", "nitrogen_dioxide")
        ],
        F.max("forecast_time").alias("forecast_time"),
        smallest(["point_id", "point_name", "us_aqi"], worst_first("us_aqi", "point_id")).alias("_worst"),
    )
    summary = summary.withColumns(
        {
            "worst_point_id": F.col("_worst.point_id"),
            "worst_point_name": F.col("_worst.point_name"),
            "worst_point_us_aqi": F.col("_worst.us_aqi"),
        }
    ).drop("_worst")
    return with_display(summary.withColumn("aqi_level", bands.display_level(F.col("average_us_aqi"))))


def with_display(summary: DataFrame) -> DataFrame:
    """Label, colour and marker of a location, and rounded numbers."""
    rounded = [c for c in summary.columns if c.startswith("average_")]
    rounded += ["latitude", "longitude"]
    average = F.col("average_us_aqi")
    return summary.withColumns(
        {
            "location_label": clean.text_or(
                F.col("location_name"), F.col("location_id"), F.lit(UNKNOWN_LOCATION)
            ),
            "fill_color": bands.fill_color(average),
            "marker_radius": bands.marker_radius(average),
        }
    ).withColumns({c: round_even(F.col(c), 2) for c in rounded})


def sort_locations(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("average_us_aqi").desc_nulls_last(),
        F.col("maximum_us_aqi").desc_nulls_last(),
        "location_id",
    )


LOCATION_VIEW_TYPES = {
    "location_id": "string",
    "location_name": "string",
    "latitude": "double",
    "longitude": "double",
    "monitoring_point_count": "bigint",
    "average_us_aqi": "double",
    "maximum_us_aqi": "double",
    "average_pm2_5": "double",
    "average_pm10": "double",
    "average_ozone": "double",
    "average_nitrogen_dioxide": "double",
    "worst_point_id": "string",
    "worst_point_name": "string",
    "worst_point_us_aqi": "double",
    "forecast_time": "timestamp",
    "aqi_level": "string",
}


def location_view(mart: DataFrame | None, nearest: DataFrame) -> DataFrame:
    """Mart rows for display; computed from the nearest rows if the mart is empty or not there."""
    if mart is None:
        mart = nearest.sparkSession.createDataFrame([], "location_id string")
    stored = with_columns_present(mart, LOCATION_VIEW_TYPES)
    stored = stored.select(*[F.col(c).try_cast(t).alias(c) for c, t in LOCATION_VIEW_TYPES.items()])
    stored = with_display(stored.where(~clean.is_blank(F.col("location_id"))))
    computed = location_summary(nearest)
    computed = computed.select(
        *[
            F.col(c).cast(LOCATION_VIEW_TYPES[c]).alias(c) if c in LOCATION_VIEW_TYPES else F.col(c)
            for c in stored.columns
        ]
    )
    stored_rows = stored.agg(F.count(F.lit(1))).scalar()
    return sort_locations(stored.unionByName(computed.where(stored_rows == 0)))


def ranking(summary: DataFrame, n: int = 15) -> DataFrame:
    return (
        summary.where(F.col("average_us_aqi").isNotNull())
        .orderBy(F.col("average_us_aqi").desc(), F.col("maximum_us_aqi").desc(), "location_id")
        .limit(n)
        .select("location_id", "location_label", "average_us_aqi")
    )


def level_distribution(summary: DataFrame) -> DataFrame:
    """Locations per level in band order; levels without a location do not show."""
    position = F.array_position(F.array(*[F.lit(level) for level in bands.DISPLAY_LEVELS]), F.col("aqi_level"))
    return (
        summary.groupBy("aqi_level")
        .agg(F.count(F.lit(1)).alias("locations"))
        .withColumn("band", position.cast("int"))
        .where("band > 0")
        .orderBy("band")
    )


def above_threshold(summary: DataFrame, threshold: float) -> DataFrame:
    located = summary.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return located.where(F.coalesce("average_us_aqi", F.lit(-1.0)) > threshold)


def nationwide_kpis(nearest: DataFrame) -> DataFrame:
    return nearest.agg(
        F.avg("us_aqi").alias("average_us_aqi"),
        F.max("us_aqi").alias("maximum_us_aqi"),
        F.max("forecast_time").alias("latest_forecast_time"),
        F.count(F.lit(1)).alias("points"),
    )


def hourly_mean(readings: DataFrame, value: str = "us_aqi", series: str | None = None) -> DataFrame:
    """Mean per hour (and series), shown in local time."""
    rows = readings.where(F.col("forecast_time").isNotNull() & F.col(value).isNotNull())
    keys = ["forecast_time", *([series] if series else [])]
    return rows.groupBy(*keys).agg(mean(F.col(value)).alias("average"), F.count(F.lit(1)).alias("readings")).withColumn(
        "local_time", local_time(F.col("forecast_time"))
    )


def nearest_hour_delta(readings: DataFrame, value: str, as_of: Column) -> DataFrame:
    """Change of the hourly mean at the hour nearest to ``as_of`` against the hour before."""
    series = hourly_mean(readings, value)
    distance = F.abs(F.unix_micros("forecast_time") - F.unix_micros(as_of))
    hour = F.struct("forecast_time", "average")
    nearest = series.agg(F.min_by(hour, F.struct(distance.alias("distance"), "forecast_time")).alias("at"))
    at = nearest.select("at.forecast_time").scalar()
    before = series.where(F.col("forecast_time") < at).agg(F.max_by("average", "forecast_time")).scalar()
    return nearest.where("at IS NOT NULL").select("at.*", (F.col("at.average") - before).alias("delta"))


def available_hours(readings: DataFrame, time: str = "forecast_time", default: int = 24) -> DataFrame:
    """Hours between first and last reading, both included."""
    span = readings.agg(F.min(time).alias("low"), F.max(time).alias("high"))
    hours = F.rint(hours_between(F.col("high"), F.col("low"))).cast("bigint") + 1
    return span.select(
        F.when(F.col("low").isNull(), F.lit(default).cast("bigint"))
        .otherwise(F.greatest(hours, F.lit(1).cast("bigint")))
        .alias("available_hours")
    )


def time_range(readings: DataFrame, as_of: Column, hours: int, time: str = "forecast_time") -> DataFrame:
    """From one hour before ``as_of`` on; if nothing is there, the last hours of the data.

    Both bounds come from one scalar subquery over the table, so no job has to
    look first whether the range is empty.
    """
    start = as_of - F.make_dt_interval(hours=F.lit(1))
    end = as_of + F.make_dt_interval(hours=F.lit(hours))
    fallback = F.col("latest") - F.make_dt_interval(hours=F.lit(max(hours - 1, 0)))
    bounds = readings.agg(
        F.count_if(F.col(time).between(start, end)).alias("n"), F.max(time).alias("latest")
    ).select(
        F.when(F.col("n") > 0, F.struct(start.alias("low"), end.alias("high")))
        .otherwise(F.struct(fallback.alias("low"), F.col("latest").alias("high")))
        .alias("bounds")
    )
    found = bounds.scalar()
    return readings.where((F.col(time) >= found["low"]) & (F.col(time) <= found["high"]))


def history_days(
    daily: DataFrame, today: Column, include_open: bool = False, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Daily rows in a date range; by default the last seven finished days."""
    day = F.to_date("forecast_date")
    rows = daily if include_open else daily.where(day < today)
    last = rows.agg(F.max(day)).scalar()
    high = last if end is None else end
    low = F.date_sub(last, 6) if start is None else start
    return rows.where(day.between(low, high))


def history_kpis(history: DataFrame, day: str = "forecast_date") -> DataFrame:
    """Days, mean, extremes and the first time of the worst value."""
    per_day = history.groupBy(day).agg(
        F.count("us_aqi").alias("n"),
        F.sum(F.col("us_aqi").cast("decimal(18,6)")).alias("total"),
        F.min("us_aqi").alias("low"),
        F.max("us_aqi").alias("high"),
        smallest(["forecast_time"], worst_first("us_aqi", "forecast_time")).alias("worst"),
    )
    return per_day.agg(
        F.count(F.lit(1)).alias("days"),
        F.try_divide(F.sum("total").cast("double"), F.sum("n").cast("double")).alias("average_us_aqi"),
        F.min("low").alias("minimum_us_aqi"),
        F.max("high").alias("maximum_us_aqi"),
        F.min_by(
            "worst.forecast_time",
            F.struct(F.col("high").isNull(), -F.col("high"), F.col("worst.forecast_time")),
        ).alias("worst_time"),
    )


def history_daily(history: DataFrame, day: str = "forecast_date") -> DataFrame:
    """Per day ten aggregates, rounded to one digit."""
    measures = []
    for c in ("pm2_5", "pm10", "ozone"):
        measures.append(round_even(mean(F.col(c)), 1).alias(f"average_{c}"))
        measures.append(round_even(F.max(c), 1).alias(f"maximum_{c}"))
    return history.groupBy(day).agg(
        round_even(F.avg("us_aqi"), 1).alias("average_us_aqi"),
        F.min("us_aqi").alias("minimum_us_aqi"),
        F.max("us_aqi").alias("maximum_us_aqi"),
        F.countDistinct("forecast_time").alias("available_hours"),
        *measures,
    )


def point_names(readings: DataFrame) -> DataFrame:
    """One name per point: that of its earliest reading."""
    rows = readings.where(F.col("point_id").isNotNull())
    first = keep_first(rows, ["point_id"], [F.col("forecast_time").asc_nulls_last(), F.col("ingested_at").asc_nulls_last()])
    return first.select("point_id", clean.text_or(F.col("point_name"), F.col("point_id")).alias("point_name"))


def pollutants_long(readings: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per reading and pollutant that has a value."""
    return (
        readings.select(*ids, *values)
        .unpivot(list(ids), list(values), "pollutant", "concentration")
        .where(F.col("concentration").isNotNull())
    )


def labelled_locations(readings: DataFrame, summary: DataFrame) -> DataFrame:
    """Readings with the label of their location: label, else name, else id."""
    labels = summary.select("location_id", "location_label")
    return readings.join(labels, "location_id", "left").withColumn(
        "location_label",
        clean.text_or(F.col("location_label"), F.col("location_name"), F.col("location_id"), F.lit(UNKNOWN_LOCATION)),
    )


def translated_runs(runs: DataFrame) -> DataFrame:
    return runs.withColumns(
        {
            "stage_label": clean.translate(F.col("stage_name"), STAGE_LABELS, UNKNOWN_LABEL, upper=False),
            "status_label": clean.translate(F.col("status"), STATUS_LABELS, UNKNOWN_LABEL),
        }
    )


def translated_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns(
        {
            "severity_label": clean.translate(F.col("severity"), SEVERITY_LABELS, UNKNOWN_LABEL),
            "status_label": clean.translate(F.col("status"), STATUS_LABELS, UNKNOWN_LABEL),
        }
    )


def translated_points(points: DataFrame) -> DataFrame:
    label = clean.translate(F.col("point_type"), POINT_TYPE_LABELS, UNKNOWN_POINT_TYPE, upper=False)
    return points.withColumn("point_type_label", label)


def filter_values(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct upper-case values per filter, sorted."""
    parts = [
        df.where(F.col(column).isNotNull())
        .select(F.lit(name).alias("filter"), F.upper(column).alias("value"))
        .distinct()
        for name, (df, column) in tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    return union.orderBy("filter", "value")


def technical_view(
    readings: DataFrame, location: str | None = None, points: Sequence[str] = ()
) -> DataFrame:
    """Chosen readings with the technical columns that exist, by time."""
    rows = readings
    if location is not None:
        rows = rows.where(F.col("location_id") == location)
    if points:
        rows = rows.where(F.col("point_id").isin(*points))
    return rows.select(*[c for c in TECHNICAL_COLUMNS if c in readings.columns]).orderBy(
        "forecast_time", "point_id", "ingested_at"
    )


def view_counts(readings: DataFrame) -> DataFrame:
    """Rows, locations and times of a view.

    Rows are first counted per (location, time); the two distinct counts then
    run over those combinations.
    """
    cells = readings.groupBy("location_id", "forecast_time").agg(F.count(F.lit(1)).alias("n"))
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
        F.countDistinct("location_id").alias("locations"),
        F.countDistinct("forecast_time").alias("times"),
    )


def data_updated_at(readings: DataFrame, runs: DataFrame, alerts: DataFrame) -> DataFrame:
    """Newest of all time stamps that tell how fresh the data is."""
    ingest = readings.agg(F.max("ingested_at")).scalar()
    finished = runs.agg(F.max("finished_at")).scalar()
    created = alerts.agg(F.max("created_at")).scalar()
    one = readings.agg(F.count(F.lit(1)).alias("record_count"))
    return one.withColumn("updated_at", F.greatest(ingest, finished, created))
