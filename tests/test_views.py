from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from data import START, frame, locations, points, reading
from skyledger.plans import marts, runlog, serving, views


def at(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def test_time_range_and_fallback(spark):
    df = frame(spark, [reading(hour=h) for h in range(6)])
    inside = views.time_range(df, at(START + timedelta(hours=2)), 2).collect()
    assert sorted(r.forecast_time.hour for r in inside) == [13, 14, 15, 16]
    late = views.time_range(df, at(datetime(2030, 1, 1)), 2).collect()
    assert sorted(r.forecast_time.hour for r in late) == [16, 17]


def test_delta_against_the_hour_before(spark):
    df = frame(spark, [reading("P1", hour=0, us_aqi=10), reading("P2", hour=0, us_aqi=30), reading(hour=2, us_aqi=50)])
    assert views.nearest_hour_delta(df, "us_aqi", at(START + timedelta(hours=3))).first().delta == 30
    assert views.nearest_hour_delta(df, "us_aqi", at(START)).first().delta is None


def test_available_hours(spark):
    df = frame(spark, [reading(hour=h) for h in (0, 5)])
    assert views.available_hours(df).first()[0] == 6
    assert views.available_hours(df.limit(1)).first()[0] == 1
    assert views.available_hours(df.limit(0)).first()[0] == 24


def test_location_level_follows_the_average(spark):
    df = frame(spark, [reading("P1", us_aqi=40), reading("P2", us_aqi=120)]).withColumn("location_name", F.lit(" "))
    row = views.location_summary(df).first()
    assert (row.average_us_aqi, row.maximum_us_aqi, row.aqi_level) == (80.0, 120, "Trung bình")
    assert (row.location_label, row.worst_point_id) == ("L1", "P2")


def test_location_view_prefers_the_mart(spark):
    made = at(START)
    nearest = frame(spark, [reading(us_aqi=40)])
    mart = marts.location_summary(marts.current(nearest, locations(spark), made), made)
    assert views.location_view(mart, nearest).first().aqi_level == "Good"
    assert views.location_view(mart.limit(0), nearest).first().aqi_level == "Tốt"


def test_history_defaults_to_the_last_seven_finished_days(spark):
    days = [(f"2026-07-{d:02d}",) for d in range(1, 21)]
    daily = spark.createDataFrame(days, "forecast_date string")
    today = F.lit("2026-07-15").cast("date")
    found = sorted(r[0] for r in views.history_days(daily, today).collect())
    assert (found[0], found[-1], len(found)) == ("2026-07-08", "2026-07-14", 7)
    assert views.history_days(daily, today, include_open=True).count() == 7


def test_unpivot_drops_missing(spark):
    df = frame(spark, [reading(pm10=None)])
    assert views.pollutants_long(df, ["point_id"], ["pm2_5", "pm10"]).count() == 1


def test_missing_columns_do_not_stop_the_view(spark):
    assert views.technical_view(frame(spark, [reading()]).drop("ozone")).columns.count("ozone") == 0


def facts(spark):
    rows = [reading(p, "L1" if p == "P1" else "L2", h, us_aqi=50 + h, batch_id="B2") for p in ("P1", "P2") for h in range(3)]
    rows.append(reading(hour=9, us_aqi=500, ingested_at=datetime(2020, 1, 1)))
    df = frame(spark, rows)
    return df.withColumns({"aqi_level": F.lit("x"), "aqi_severity": F.lit("y")})


def test_serving(spark):
    p, l = points(spark), locations(spark)
    assert serving.latest_readings(facts(spark), p, l).count() == 6
    assert serving.readings_by_location(facts(spark), p, l, " l1 ").count() == 3
    top = serving.top_polluted(facts(spark), p, l).collect()
    assert [(r.point_id, r.us_aqi) for r in top] == [("P1", 50), ("P2", 50)]
    history = serving.point_history(facts(spark), p, l, "p1", hours=2).collect()
    assert [r.us_aqi for r in history] == [52, 500]
    assert {r.point_id for r in serving.history_all_points(facts(spark), hours=1).collect()} == {"P1", "P2"}
    with pytest.raises(ValueError):
        serving.top_polluted(facts(spark), p, l, limit=101)


def test_filters_reach_the_scan(spark, tmp_path):
    facts(spark).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    df = serving.point_history(stored, points(spark), locations(spark), "P1").select("point_id", "us_aqi")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(point_id,P1)" in plan
    schema = plan[plan.index("ReadSchema") :]
    assert "ozone" not in schema.split("\n")[0]


def log(spark, rows):
    return spark.createDataFrame(rows, "run_id string, batch_id string, stage_name string, status string, updated_at int, duration_seconds double")


def test_pipeline_health(spark):
    runs = log(spark, [("1", "A", "mart", "FAILED", 1, None), ("2", "B", "mart", "SUCCESS", 2, None), ("3", "B", "extract", "PARTIAL_SUCCESS", 1, None), ("4", " ", "mart", "FAILED", 9, None)])
    rows = runlog.pipeline_health(runs).collect()
    assert [(r.stage_name, r.pipeline_status) for r in rows] == [("extract", "FAILED"), ("mart", "FAILED")]
    good = runlog.pipeline_health(runs.where("status = 'SUCCESS'")).collect()
    assert [r.pipeline_status for r in good] == ["SUCCESS"]
    assert runlog.pipeline_health(runs.limit(0)).count() == 0
    assert tuple(runlog.run_kpis(runs).first()) == (3, None)


def test_run_log_from_summaries(spark):
    summary = '{"status": " success ", "records_extracted": "bad", "total_records": 7, "failures": [{"e": 1}], "duration_seconds": "x"}'
    df = spark.createDataFrame([("B1", "extract", "o", summary)], "batch_id string, stage string, object_name string, summary string")
    row = runlog.run_log_rows(df, "feed").first()
    assert (row.run_id, row.status, row.source, row.input_records, row.duration_seconds) == ("B1:extract", "SUCCESS", "feed", 0, 0.0)
    assert row.error_message == '{"e":1}' and row.started_at is None
