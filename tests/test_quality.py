from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import SOURCE, START, batch, frame, locations, points, reading
from skyledger.operators import rules
from skyledger.plans import quality


def grade(spark, rows, **options):
    df = frame(spark, rows).withColumn("load_id", F.lit("B1"))
    return quality.grade(
        df, points(spark), locations(spark), SOURCE, F.lit(START).cast("timestamp"), hours=3, **options
    )


def summary(graded):
    return graded.summary.first().asDict()


def statuses(graded):
    return {r.check_name: r.status for r in graded.batch_report.collect()}


def test_clean_batch_passes(spark):
    graded = grade(spark, batch())
    result = summary(graded)
    assert (result["quality_status"], result["pipeline_status"], result["quality_score"]) == ("PASS", "SUCCESS", 100.0)
    assert (result["valid_records"], result["bad_records"]) == (6, 0)
    assert result["passed_check_count"] == 44 + 7
    assert graded.valid.count() == 6 and graded.bad.count() == 0


def test_negative_value_warns(spark):
    rows = batch()
    rows[0]["pm2_5"] = -1.0
    graded = grade(spark, rows)
    result = summary(graded)
    assert (result["quality_status"], result["pipeline_status"]) == ("WARN", "PARTIAL_SUCCESS")
    assert (result["valid_records"], result["bad_records"]) == (5, 1)
    assert graded.bad.first().dq_error_codes == "PM2_5_NON_NEGATIVE"


def test_missing_value_breaks_two_rules(spark):
    rows = batch()
    rows[0]["ozone"] = None
    bad = grade(spark, rows).bad.first()
    assert bad.dq_error_codes == "OZONE_REQUIRED_NUMERIC|OZONE_NON_NEGATIVE"
    assert bad.dq_error_messages == "ozone must be a number | ozone must be at least 0"


def test_missing_hour_fails(spark):
    graded = grade(spark, batch()[:-1])
    result = summary(graded)
    assert result["quality_status"] == "FAIL" and result["quality_score"] <= 69.99
    found = statuses(graded)
    assert found["EXPECTED_RECORD_COUNT"] == found["EXPECTED_FORECAST_HOURS_PER_POINT"] == "FAILED"
    assert found["HOURLY_FORECAST_CADENCE"] == "PASSED"


def test_repeated_row_makes_both_bad(spark):
    rows = batch()
    graded = grade(spark, [*rows, rows[0]])
    report = {r.check_name: r.bad_records_count for r in graded.row_report.collect()}
    assert report["UNIQUE_LOGICAL_KEY"] == 2
    assert summary(graded)["quality_status"] == "FAIL"
    assert graded.bad.count() == 2


def test_old_forecast_only_warns(spark):
    rows = [{**r, "ingested_at": START + timedelta(hours=5)} for r in batch()]
    graded = grade(spark, rows)
    result = summary(graded)
    assert statuses(graded)["DATA_FRESHNESS"] == "WARNED"
    assert result["bad_records"] == 0 and result["quality_status"] == "WARN" and result["quality_score"] < 100


def test_gap_in_cadence(spark):
    rows = [reading("P1", "L1", h) for h in (0, 1, 4)] + [reading("P2", "L2", h) for h in range(3)]
    graded = grade(spark, rows)
    assert statuses(graded)["HOURLY_FORECAST_CADENCE"] == "FAILED"


def test_wrong_home_and_coordinates(spark):
    rows = batch()
    rows[0]["location_id"] = "L2"
    rows[1]["latitude"] = 21.5
    rows[2]["point_id"] = "P9"
    codes = sorted(r.dq_error_codes for r in grade(spark, rows).bad.collect())
    assert codes == ["KNOWN_ACTIVE_POINT_ID", "POINT_COORDINATE_MATCH", "POINT_LOCATION_MATCH"]


def test_nan_is_missing_and_no_coordinate_mismatch(spark):
    rows = batch()
    rows[0]["latitude"] = float("nan")
    assert grade(spark, rows).bad.first().dq_error_codes == "LATITUDE_RANGE"


def test_missing_column(spark):
    df = frame(spark, batch()).withColumn("load_id", F.lit("B1")).drop("pm2_5")
    with pytest.raises(ValueError, match="pm2_5"):
        quality.grade(df, points(spark), locations(spark), SOURCE, F.lit(START))


def test_two_batches_are_graded_like_each_alone(spark):
    second = [{**r, "batch_id": "B2", "pm10": -1.0} for r in batch()]
    df = frame(spark, [*batch(), *second]).withColumn("load_id", F.col("batch_id"))
    graded = quality.grade(df, points(spark), locations(spark), SOURCE, F.lit(START).cast("timestamp"), hours=3)
    found = {r.load_id: r.quality_status for r in graded.summary.collect()}
    assert found == {"B1": "PASS", "B2": "FAIL"}


def test_rule_order(spark):
    prepared, found = rules.check_readings(frame(spark, batch()), points(spark), locations(spark), SOURCE)
    assert len(found) == 43 and found[0].code == "POINT_ID_REQUIRED" and found[-1].code == "POINT_COORDINATE_MATCH"
