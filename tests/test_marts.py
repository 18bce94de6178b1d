from datetime import datetime

from pyspark.sql import functions as F

from data import frame, locations, reading
from skyledger.plans import marts


def made():
    return F.lit("2026-07-21 00:00:00").cast("timestamp")


INGEST = datetime(2026, 7, 20, 2, 15)


def test_current_prefers_the_future_hour(spark):
    rows = [
        reading(forecast_time=datetime(2026, 7, 20, 1), us_aqi=40, ingested_at=INGEST),
        reading(forecast_time=datetime(2026, 7, 20, 3), us_aqi=80, ingested_at=INGEST),
    ]
    found = marts.current(frame(spark, rows), locations(spark), made()).collect()
    assert [(r.us_aqi, r.aqi_level, r.aqi_severity, r.location_name) for r in found] == [(80, "Moderate", 2, "North")]


def three_points(spark):
    rows = [
        reading(f"HN_{i}", "L1", us_aqi=index, pm2_5=amount)
        for i, index, amount in ((1, 40, 10.0), (2, 70, 20.0), (3, 120, 30.0))
    ]
    return marts.current(frame(spark, rows), locations(spark), made())


def test_location_summary(spark):
    row = marts.location_summary(three_points(spark), made()).first()
    assert (row.monitoring_point_count, row.average_us_aqi, row.maximum_us_aqi) == (3, 76.67, 120)
    assert (row.worst_point_id, row.aqi_level) == ("HN_3", "Unhealthy for Sensitive Groups")
    assert (row.average_pm2_5, row.maximum_pm2_5) == (20.0, 30.0)


def test_unknown_location_is_kept(spark):
    rows = [reading("X", "L77"), reading("Y", "NA")]
    found = marts.location_summary(marts.current(frame(spark, rows), locations(spark), made()), made()).collect()
    assert {r.location_id: r.location_name for r in found} == {"L77": None, "NA": "Coast"}


def test_newest_version_of_an_hour_counts(spark):
    rows = [
        reading(batch_id="OLD", us_aqi=40, ingested_at=datetime(2026, 7, 20, 1)),
        reading(batch_id="NEW", us_aqi=80, ingested_at=datetime(2026, 7, 20, 2)),
    ]
    row = marts.daily_summary(frame(spark, rows), locations(spark), made()).first()
    assert (row.available_hours, row.average_us_aqi, row.worst_hour_source_batch_id) == (1, 80.0, "NEW")
    assert (row.moderate_hours, row.good_hours, row.coverage_status) == (1, 0, "PARTIAL")


def test_a_day_is_local(spark):
    rows = [reading(forecast_time=datetime(2026, 7, 20, h)) for h in (16, 17)]
    found = marts.daily_summary(frame(spark, rows), locations(spark), made()).collect()
    assert sorted(r.forecast_date for r in found) == ["2026-07-20", "2026-07-21"]


def test_full_day_is_complete(spark):
    rows = [reading(forecast_time=datetime(2026, 7, 19, 17) if h == 0 else datetime(2026, 7, 19 + (17 + h) // 24, (17 + h) % 24)) for h in range(24)]
    row = marts.daily_summary(frame(spark, rows), locations(spark), made()).first()
    assert (row.available_hours, row.coverage_status) == (24, "COMPLETE")


def test_attribute_drift(spark):
    rows = [
        reading(hour=0, point_name="old", ingested_at=datetime(2026, 7, 20, 1)),
        reading(hour=1, point_name="new", ingested_at=datetime(2026, 7, 20, 2)),
    ]
    history = frame(spark, rows)
    assert [r.point_name for r in marts.daily_summary(history, locations(spark), made()).collect()] == ["new"]
    split = marts.daily_summary(history, locations(spark), made(), split_on_drift=True)
    assert sorted(r.point_name for r in split.collect()) == ["new", "old"]


def test_increment_equals_full_rebuild(spark):
    old = [reading(p, "L1", h, batch_id="OLD") for p in ("P1", "P2") for h in range(0, 60)]
    new = [reading("P1", "L1", h, batch_id="NEW", us_aqi=90, ingested_at=datetime(2026, 7, 21)) for h in range(10, 20)]
    history, batch = frame(spark, old + new), frame(spark, new)
    full = marts.daily_summary(history, locations(spark), made())
    part = marts.daily_summary_increment(history, batch, locations(spark), made())
    days = {r.forecast_date for r in part.collect()}
    assert days == {"2026-07-21"}
    expected = full.where(F.col("forecast_date").isin(*days))
    assert part.exceptAll(expected).count() == expected.exceptAll(part).count() == 0


def test_build_skips_batches_with_repeated_rows(spark):
    rows = [reading(batch_id="BAD"), reading(batch_id="BAD"), reading(batch_id="GOOD", ingested_at=datetime(2026, 7, 22))]
    history = frame(spark, rows)
    built = marts.build(history, locations(spark), made())
    row = marts.build_summary(history, locations(spark), built).first()
    assert (row.batch_id, row.valid_batch_count, row.skipped_batch_count) == ("GOOD", 1, 1)
    assert (row.current_rows, row.location_summary_rows, row.daily_summary_rows, row.output_records) == (1, 1, 1, 3)
