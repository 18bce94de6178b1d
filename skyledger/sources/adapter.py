"""The readings model as a fixed projection of generic event tables.

``events`` become hourly readings, ``nation`` and ``region`` the locations,
``customer`` the monitoring points, ``orders`` the run log and ``lineitem`` the
check log. Every defect is decided by a row's own id, so the same rows are dirty
in any engine that reads the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.bands import level_code, local_level
from skyledger.operators.ranking import latest_wins
from skyledger.plans.alerts import derive
from skyledger.schema import AQI_COLUMNS, LOGICAL_KEY, POINT_COLUMNS, POLLUTANTS, SCHEMA_VERSION

SOURCE = "sensor_feed"
# Measure as a multiple of the event value.
POLLUTANT_FACTORS = dict(zip(POLLUTANTS, (1.0, 1.5, 10.0, 0.25, 0.125, 0.5)))
AQI_FACTORS = dict(zip(AQI_COLUMNS, (1.0, 1.0, 0.75, 0.25, 0.125, 0.5, 0.0625)))
STAGES = ("extract", "transform", "data_quality", "load_timescaledb", "alerts", "mart")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _point_columns(key: Column) -> list[Column]:
    return [
        F.concat(F.lit("P"), key.cast("string")).alias("point_id"),
        F.concat(F.lit("L"), (key % 25).cast("string")).alias("location_id"),
        F.concat(F.lit("Point "), key.cast("string")).alias("point_name"),
        F.when(key % 3 == 0, "urban_center").otherwise("regional_center").alias("point_type"),
        (F.lit(8.0) + (key % 100).cast("double") / 10).alias("latitude"),
        (F.lit(102.0) + (key % 70).cast("double") / 10).alias("longitude"),
    ]


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Clean hourly readings; every 41st has no index and no PM2.5."""
    events = table(spark, folder, "events")
    instant = F.col("ts").cast("timestamp")
    gap = F.col("event_id") % 41 == 0
    return events.select(
        F.col("event_id").alias("reading_id"),
        *_point_columns(F.col("user_id")),
        (
            F.date_trunc("hour", instant)
            + F.make_dt_interval(hours=(F.col("event_id") % 24).cast("int"))
        ).alias("forecast_time"),
        *[
            (F.when(~gap, F.col("value")) if c == "pm2_5" else F.col("value") * factor).alias(c)
            for c, factor in POLLUTANT_FACTORS.items()
        ],
        *[
            (
                F.when(~gap, F.floor("value")) if c == "us_aqi" else F.floor(F.col("value") * factor)
            )
            .cast("int")
            .alias(c)
            for c, factor in AQI_FACTORS.items()
        ],
        F.lit(SOURCE).alias("source"),
        F.concat_ws("_", F.date_format(instant, "yyyyMMdd"), "event_type").alias("batch_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        instant.alias("ingested_at"),
    )


def dirty_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with defects for the row rules; ``load_id`` is the true batch."""
    row = F.col("reading_id")
    df = readings(spark, folder).withColumn("load_id", F.col("batch_id"))

    def spoil(name: str, every: int, value: Column) -> Column:
        return F.when(row % every == 0, value).otherwise(F.col(name))

    return df.withColumns(
        {
            "point_id": spoil("point_id", 83, F.lit(" ")),
            "location_id": spoil("location_id", 79, F.lit("L99")),
            "latitude": F.when(row % 61 == 0, F.col("latitude") + 1)
            .when(row % 59 == 0, F.lit(95.0))
            .otherwise(F.col("latitude")),
            "pm2_5": spoil("pm2_5", 97, -F.col("pm2_5")),
            "pm10": spoil("pm10", 67, F.lit(None)).cast("double"),
            "us_aqi": spoil("us_aqi", 89, F.lit(None)).cast("int"),
            "source": F.when(row % 53 == 0, F.lit("other"))
            .when(row % 47 == 0, F.lit(" Sensor_Feed "))
            .otherwise(F.col("source")),
            "batch_id": spoil("batch_id", 43, F.lit("foreign")),
        }
    )


def text_records(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as loosely typed text, as a JSON payload would deliver them."""
    row = F.col("reading_id")
    stamp = F.date_format("forecast_time", "yyyy-MM-dd'T'HH:mm:ss")
    return readings(spark, folder).select(
        "reading_id",
        F.when(row % 19 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), "point_id")).alias("point_id"),
        F.when(row % 17 == 0, F.lit("n/a"))
        .when(row % 13 == 0, F.concat(F.col("us_aqi").cast("string"), F.lit(".5")))
        .when(row % 31 == 0, F.lit("-7"))
        .otherwise(F.col("us_aqi").cast("string"))
        .alias("us_aqi"),
        F.when(row % 73 == 0, F.lit("someday"))
        .when(row % 71 == 0, stamp)
        .when(row % 3 == 0, F.concat(stamp, F.lit("Z")))
        .otherwise(F.concat(stamp, F.lit("+07:00")))
        .alias("forecast_time"),
        F.element_at(
            F.array(*[F.lit(t) for t in ("True", " YES ", "1", "no", "0", "F", "maybe")]),
            (row % 7 + 1).cast("int"),
        ).alias("is_active"),
    )


def locations(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    key = F.col("n_nationkey")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.concat(F.lit("L"), key.cast("string")).alias("location_id"),
        F.col("n_name").alias("location_name"),
        F.col("r_name").alias("region"),
        F.when(key % 5 == 0, "City").otherwise("Province").alias("admin_type"),
        F.when(key % 12 == 11, "no").otherwise("Yes").alias("is_active"),
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.select(
        *_point_columns(F.col("c_custkey")),
        F.when(F.col("c_acctbal") < -500, "0").otherwise("1").alias("is_active"),
    )


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table: newest version of each reading, with its labels."""
    newest = latest_wins(readings(spark, folder), LOGICAL_KEY)
    index = F.col("us_aqi")
    return newest.withColumns(
        {"aqi_level": local_level(index), "aqi_severity": level_code(index)}
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Stage runs; some lack a batch id, some have no duration."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp")
    batch = (
        F.when(key % 101 == 0, F.lit(" "))
        .when(key % 103 == 0, F.lit(None))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    stage = F.element_at(F.array(*[F.lit(s) for s in STAGES]), (key % 6 + 1).cast("int"))
    return table(spark, folder, "orders").select(
        key.alias("run_key"),
        key.cast("string").alias("run_id"),
        batch.alias("batch_id"),
        stage.alias("stage_name"),
        F.when(F.col("o_orderstatus") == "F", "FAILED")
        .when(F.col("o_orderstatus") == "P", "PARTIAL_SUCCESS")
        .otherwise("SUCCESS")
        .alias("status"),
        (day + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("started_at"),
        F.when(key % 7 != 0, day + F.make_dt_interval(secs=(key % 86400 + key % 600).cast("decimal(18,6)"))).alias(
            "finished_at"
        ),
        F.when(key % 7 != 0, (key % 600).cast("double")).alias("duration_seconds"),
        (key % 5000).alias("input_records"),
        (key % 4000).alias("output_records"),
        (key % 9).alias("failed_records"),
    )


def check_log(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of the runs; several versions per (batch, check)."""
    key = F.col("l_orderkey")
    day = F.col("l_shipdate").cast("timestamp")
    return table(spark, folder, "lineitem").select(
        key.cast("string").alias("run_id"),
        F.date_format(day, "yyyyMMdd").alias("batch_id"),
        F.concat(F.lit("CHECK_"), F.col("l_linenumber").cast("string")).alias("check_name"),
        F.when(F.col("l_returnflag") == "A", "PASSED")
        .when(F.col("l_returnflag") == "N", "WARNED")
        .otherwise("FAILED")
        .alias("status"),
        F.col("l_quantity").cast("bigint").alias("bad_records_count"),
        (day + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("checked_at"),
    )


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of an earlier run, when the index read a little higher."""
    row = F.col("reading_id")
    earlier = facts(spark, folder).withColumn("us_aqi", F.col("us_aqi") + (row % 40).cast("int"))
    found = derive(
        earlier.withColumn("source", F.concat_ws("|", "source", row.cast("string"))), F.col("ingested_at")
    )
    key = F.split("source", r"\|")[1].cast("bigint")
    status = F.when(key % 3 == 0, "OPEN").when(key % 3 == 1, "ACKNOWLEDGED").otherwise("RESOLVED")
    return found.withColumn("status", status).withColumn("source", F.split("source", r"\|")[0])


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Raw documents, one per point and batch, with defects by point.

    Hours of a document are made unique first, so an array never holds more
    than the hours of two days.
    """
    key = F.substring("point_id", 2, 20).cast("bigint")
    hours = latest_wins(
        readings(spark, folder), ("batch_id", "point_id", "forecast_time"), ("ingested_at",)
    ).withColumn("key", key)
    k = F.col("key")
    local = F.date_format(F.from_utc_timestamp("forecast_time", "Asia/Ho_Chi_Minh"), "yyyy-MM-dd'T'HH:mm")
    utc = F.date_format("forecast_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    measures = POLLUTANTS + AQI_COLUMNS
    entry = F.struct(
        "forecast_time",
        F.when(k % 5 == 1, utc).otherwise(local).alias("time"),
        *[F.col(c).cast("double").alias(c) for c in measures],
    )
    grouped = hours.groupBy("batch_id", "key", *POINT_COLUMNS).agg(
        F.sort_array(F.collect_list(entry)).alias("h"), F.max("ingested_at").alias("extracted")
    )

    def array(name: str) -> Column:
        values = F.col(f"h.{name}")
        if name == "time":
            values = F.when(
                k % 23 == 7, F.transform(values, lambda t, i: F.when(i == 0, F.lit("soon")).otherwise(t))
            ).otherwise(values)
        if name == "us_aqi":
            values = F.when(k % 19 == 5, F.transform(values, lambda v: v + 0.5)).otherwise(values)
        if name == "ozone":
            values = (
                F.when(k % 7 == 0, F.lit(None))
                .when(k % 17 == 3, F.slice(values, F.lit(1), F.size(values) - 1))
                .otherwise(values)
            )
        return values.alias(name)

    def within(inner: Column, *names: str) -> Column:
        inner = F.struct(inner.alias("hourly"))
        for name in names:
            inner = F.struct(inner.alias(name))
        return inner

    hourly = F.struct(*[array(c) for c in ("time", *measures)])
    nested, deeper = k % 13 == 4, (k % 11 == 2) & (k % 13 != 4)
    far = (k % 19 == 8) & ~nested & ~deeper
    absent = k % 29 == 11
    plain = ~nested & ~deeper & ~far & ~absent
    nowhere = F.lit(None)
    return grouped.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "batch_id",
        F.lit(SOURCE).alias("source"),
        F.date_format("extracted", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("extracted_at"),
        F.struct(
            "point_id",
            F.when(k % 41 != 8, F.col("location_id")).alias("location_id"),
            F.when(k % 37 != 6, F.col("point_name")).alias("point_name"),
            F.when(k % 37 != 6, F.col("point_type")).alias("point_type"),
            F.when(k % 31 != 9, F.col("latitude")).alias("latitude"),
            "longitude",
        ).alias("point"),
        F.to_json(F.struct(
            F.when(plain, hourly).alias("hourly"),
            F.when(nested & ~absent, F.struct(hourly.alias("hourly"))).alias("response"),
            F.when(deeper & ~absent, F.struct(hourly.alias("hourly"))).alias("data"),
            F.when(far & ~absent, within(hourly, "model", "series", "result")).alias("body"),
            nowhere.cast("string").alias("point_id"),
            F.when(k % 41 == 8, F.col("location_id")).alias("location_id"),
            nowhere.cast("string").alias("point_name"),
            nowhere.cast("string").alias("point_type"),
            F.when(k % 31 == 9, F.lit(123.0)).alias("latitude"),
            nowhere.cast("double").alias("longitude"),
        )).alias("api_response"),
    )




def stage_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON summary every stage wrote for every batch; defects by batch size."""
    batches = (
        readings(spark, folder)
        .groupBy("batch_id", "point_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("ingested_at").alias("t0"),
            F.max("ingested_at").alias("t1"),
        )
        .groupBy("batch_id")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("p"),
            F.min("t0").alias("t0"),
            F.max("t1").alias("t1"),
        )
    )
    n, p = F.col("n"), F.col("p")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    path = lambda stage: F.concat(F.lit(f"{stage}/batch_id="), F.col("batch_id"), F.lit("/summary.json"))

    def common(status: Column, batch: Column = F.col("batch_id")) -> list[Column]:
        return [
            batch.alias("batch_id"),
            status.alias("status"),
            F.date_format("t0", iso).alias("started_at"),
            F.when(n % 6 != 0, F.date_format("t1", iso)).alias("finished_at"),
            (n / 8).cast("double").alias("duration_seconds"),
        ]

    ok = F.lit("SUCCESS")
    check = lambda name, status, bad: F.struct(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        bad.cast("string").alias("bad_records_count"),
        F.lit(" seen ").alias("message"),
    )
    checks = F.array(
        check("RECORD_COUNT", F.when(n % 2 == 0, "passed").otherwise("FAILED"), n % 2),
        check("FRESHNESS", F.when(n % 4 == 0, F.lit(None)).otherwise("WARNED"), F.lit("none")),
        check(" ", F.lit("PASSED"), F.lit(0)),
    )
    failures = F.when(n % 3 > 0, F.array(F.struct(F.lit("P0").alias("point_id"), n.alias("position"))))
    stages = {
        "extract": [
            *common(F.when(n % 5 == 0, "PARTIAL_SUCCESS").otherwise("SUCCESS")),
            F.when(n % 2 == 0, n + 1).alias("records_extracted"),
            n.alias("total_records"),
            (n % 3).alias("failed_points"),
            failures.alias("failures"),
        ],
        "transform": [
            *common(ok, F.when(n % 11 == 0, F.lit("another")).otherwise(F.col("batch_id"))),
            p.alias("input_objects"),
            n.alias("records_transformed"),
            F.lit("many").alias("failed_objects"),
            path("extract").alias("raw_summary_object_name"),
        ],
        "data_quality": [
            *common(F.when(n % 4 == 0, "failed").otherwise("partial_success")),
            n.alias("input_records"),
            (n - n % 7).alias("valid_records"),
            (n % 7).alias("bad_records"),
            checks.alias("checks"),
            path("transform").alias("transform_summary_object_name"),
        ],
        "load_timescaledb": [
            *common(ok),
            n.alias("input_rows"),
            n.alias("processed_rows"),
            F.when(n % 7 == 0, F.lit("lost.json")).otherwise(path("data_quality")).alias(
                "quality_summary_object_name"
            ),
        ],
        "alerts": [*common(ok), n.alias("processed_records"), (n % 13).alias("alerts_generated")],
        "mart": [
            *common(F.when(n % 9 == 0, "FAILED").otherwise("SUCCESS")),
            n.alias("latest_clean_records"),
            p.alias("current_aqi_rows"),
            F.when(n % 8 != 0, p % 25).alias("location_summary_rows"),
            n.alias("daily_summary_rows"),
        ],
    }
    entries = F.array(
        *[
            F.struct(
                F.lit(stage).alias("stage"),
                path(stage).alias("object_name"),
                F.to_json(F.struct(*columns)).alias("summary"),
            )
            for stage, columns in stages.items()
        ]
    )
    rows = batches.select("batch_id", "n", F.inline(entries))
    return rows.where((F.col("stage") != "alerts") | (n % 10 != 0)).drop("n")


def requests(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Requests of at most ten points each, and the responses in the same order."""
    key = F.substring("point_id", 2, 20).cast("bigint")
    chunk = F.floor(key / 10).cast("bigint")
    per_point = (
        readings(spark, folder)
        .groupBy("batch_id", "point_id")
        .agg(F.max("pm10").alias("peak"))
        .withColumns({"key": key, "chunk": chunk})
    )
    grouped = per_point.groupBy("batch_id", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("key", "point_id", "peak"))).alias("entries")
    )
    named = grouped.withColumn("request_id", F.concat_ws("/", "batch_id", F.col("chunk").cast("string")))
    lost = F.when(F.col("chunk") % 7 == 3, F.size("entries") - 1).otherwise(F.size("entries"))
    return (
        named.select("request_id", F.col("entries.point_id").alias("points")),
        named.select("request_id", F.slice(F.col("entries.peak"), F.lit(1), lost).alias("responses")),
    )
