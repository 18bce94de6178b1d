import pytest
from pyspark.sql import functions as F

from data import SOURCE, batch, frame, locations, points, reading
from skyledger import schema
from skyledger.operators import audits, batch_checks, joins, rules


def issues(df, contract):
    return {(r.code, r.field): r.invalid_count for r in audits.audit(df, contract).collect()}


def test_clean_rows_meet_the_contract(spark):
    assert issues(frame(spark, batch()), schema.clean_contract(SOURCE)) == {}


def test_broken_terms(spark):
    rows = [reading(us_aqi=-1, point_type="roof"), reading(us_aqi=-1, point_type="roof"), reading("P2", point_name=" ", ozone=None)]
    assert issues(frame(spark, rows), schema.clean_contract(SOURCE)) == {
        ("BELOW_MINIMUM", "us_aqi"): 2,
        ("VALUE_NOT_ALLOWED", "point_type"): 2,
        ("NULL_NOT_ALLOWED", "point_name"): 1,
        ("NULL_NOT_ALLOWED", "ozone"): 1,
        ("DUPLICATE_KEY", "point_id,forecast_time,source"): 2,
    }


def test_columns(spark):
    df = frame(spark, batch())
    assert issues(df.withColumn("x", F.lit(1)), schema.clean_contract(SOURCE)) == {("EXTRA_COLUMNS", "x"): 1}
    assert issues(df.drop("ozone"), schema.clean_contract(SOURCE)) == {("MISSING_COLUMNS", "ozone"): 1}
    assert issues(df.drop("us_aqi_ozone"), schema.mart_source_contract(SOURCE)) == {}


def test_text_types(spark):
    df = frame(spark, batch()).withColumns(
        {"forecast_time": F.lit("2026-07-20T12:00"), "us_aqi": F.lit("7.5"), "batch_id": F.lit(7)}
    )
    found = issues(df, schema.clean_contract(SOURCE))
    assert found[("TIMEZONE_REQUIRED", "forecast_time")] == 6
    assert found[("INVALID_INTEGER", "us_aqi")] == 6
    assert found[("INVALID_STRING", "batch_id")] == 6


def test_null_is_allowed_in_facts(spark):
    df = frame(spark, [reading(pm10=None)]).withColumn("aqi_severity", F.lit(None).cast("string"))
    assert issues(df, schema.fact_contract(SOURCE)) == {}


def test_catalog_lists_every_layer():
    catalog = schema.contract_catalog(SOURCE)
    assert len(catalog) == 8 and len(catalog["clean_hourly"]["columns"]) == 24


def test_dimension_audit(spark):
    bad = spark.createDataFrame(
        [("l1", "North", "R1", "City", "perhaps"), ("L1", "North", "R9", " ", "no")],
        "location_id string, location_name string, region string, admin_type string, is_active string",
    )
    found = {(r.code, r.field): r.invalid_count for r in audits.location_audit(bad, ["R1"], ["City"]).collect()}
    assert found[("DUPLICATE_KEY", "location_id")] == found[("DUPLICATE_KEY", "location_name")] == 1
    assert found[("VALUE_NOT_ALLOWED", "region")] == found[("INVALID_BOOLEAN", "is_active")] == 1
    assert found[("BLANK", "admin_type")] == 1


def test_point_audit(spark):
    rows = points(spark).union(points(spark).limit(1).withColumns({"latitude": F.lit(95.0), "location_id": F.lit("L9")}))
    found = {(r.code, r.field): r.invalid_count for r in audits.point_audit(rows, locations(spark)).collect()}
    assert found[("OUT_OF_RANGE", "latitude")] == found[("UNKNOWN_LOCATION", "location_id")] == 1
    assert found[("DUPLICATE_KEY", "point_id")] == 1


def test_orphans_and_coverage(spark):
    home = locations(spark).where("location_id <> 'L2'")
    assert [r.point_id for r in joins.orphan_points(points(spark), home).collect()] == ["P2"]
    seen = spark.createDataFrame([("P1",), ("P7",), (" ",), (None,)], "point_id string")
    rows = joins.coverage(seen, points(spark).select("point_id"), "point_id").collect()
    assert {r.point_id: r.coverage for r in rows} == {"P1": "PRESENT", "P2": "MISSING", "P7": "UNEXPECTED"}


def test_coverage_of_each_batch(spark):
    rows = [("B1", "P1"), ("B1", " "), ("B2", "P2"), ("B2", "P7"), ("B3", None)]
    seen = spark.createDataFrame(rows, "batch_id string, point_id string")
    found = joins.coverage_by_group(seen, points(spark).select("point_id"), "batch_id", "point_id").collect()
    assert sorted((r.batch_id, r.point_id, r.coverage) for r in found) == [
        ("B1", "P1", "PRESENT"), ("B1", "P2", "MISSING"), ("B2", "P1", "MISSING"), ("B2", "P2", "PRESENT"),
        ("B2", "P7", "UNEXPECTED"), ("B3", "P1", "MISSING"), ("B3", "P2", "MISSING"),
    ]


def pairs_are_made_last(df):
    """Whether (batch, id) pairs that are missing are made of two lists, and enter no join or exchange."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "LeftAnti" not in plan and "Generate explode(CASE WHEN" in plan


def test_missing_points_are_unrolled_from_short_lists(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK", 2)
    batches = [None, *[f"B{i}" for i in range(9)]]
    seen = [(b, f"P{i}") for i, b in enumerate(batches)] + [(b, "P1") for b in batches] + [(b, "P2") for b in batches[1:]]
    present = spark.createDataFrame([*seen, *seen, ("B1", None), ("B99", " ")], "batch_id string, point_id string")
    ids = [*[f"P{i}" for i in range(8)], "", None]
    expected = spark.createDataFrame([(i,) for i in ids], "point_id string")
    lacking = joins.missing_by_group(present, expected, "batch_id", "point_id")
    found = [tuple(r) for r in lacking.collect()]
    want = {(b, i) for b in [*batches, "B99"] for i in ids} - set(seen)
    assert len(found) == len(want) and set(found) == want
    assert pairs_are_made_last(lacking)


def test_point_without_readings_has_no_hours(spark):
    rows = frame(spark, [r for r in batch() if r["point_id"] != "P2"])
    found = {r.point_id: r.forecast_hours for r in batch_checks.hours_per_point(rows, points(spark), "batch_id").collect()}
    assert found["P2"] == 0 and found["P1"] > 0


def test_hours_of_each_point_and_batch(spark):
    rows = [
        *[reading("P1", hour=h, batch_id=b) for b in ("B1", None) for h in (0, 0, 1)],
        *[reading(p, batch_id="B2") for p in (" P2 ", " ", "P7", None)],
    ]
    hours = batch_checks.hours_per_point(frame(spark, rows), points(spark), "batch_id")
    assert sorted(map(tuple, hours.collect()), key=str) == [
        ("B1", "P1", 2), ("B1", "P2", 0), ("B2", "P1", 0), ("B2", "P2", 1), (None, "P1", 2), (None, "P2", 0),
    ]
    assert pairs_are_made_last(hours)


@pytest.mark.parametrize("table", ["point", "location"])
def test_repeated_dimension_row_stops_grading_and_serving(spark, table):
    p, l = points(spark), locations(spark)
    p, l = (p.union(p.limit(1)), l) if table == "point" else (p, l.union(l.limit(1)))
    readings = frame(spark, batch())
    with pytest.raises(Exception, match="not unique"):
        rules.with_dimensions(readings, p, l).collect()
    with pytest.raises(Exception, match="not unique"):
        joins.star(readings, p, l).collect()


@pytest.mark.parametrize("rows, valid", [(2, True), (3, False)])
def test_dataset_audit(spark, rows, valid):
    df = spark.createDataFrame([("P1", "B"), ("P2", "B")], "point_id string, batch string")
    row = audits.dataset_audit(df, "current", ["point_id"], F.lit(rows).cast("bigint"), "batch").first()
    assert row.is_valid is valid


def test_dataset_audit_of_mixed_batches_and_empty_table(spark):
    df = spark.createDataFrame([("P1", "B"), ("P2", "C")], "point_id string, batch string")
    two = F.lit(2).cast("bigint")
    assert audits.dataset_audit(df, "current", ["point_id"], two, "batch").first().is_valid is False
    assert audits.dataset_audit(df.limit(0), "current", ["point_id"], F.lit(0).cast("bigint"), "batch").first().is_valid is False


def test_repeated_location_stops_the_enrichment(spark):
    twice = locations(spark).union(locations(spark).limit(1))
    with pytest.raises(Exception, match="not unique: L1"):
        joins.enrich_locations(frame(spark, batch()), twice).collect()
    ordered = twice.withColumn("line", F.monotonically_increasing_id())
    assert joins.enrich_locations(frame(spark, batch()), ordered, "line").count() == 6
