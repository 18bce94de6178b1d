import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from data import SOURCE
from skyledger.plans import ingest
from skyledger.schema import AQI_COLUMNS, POLLUTANTS
from skyledger.sources import raw


def document(point="P1", nest=("data",), **hourly):
    arrays = {
        "time": ["2026-07-13T21:00", "2026-07-13T22:00"],
        **{c: [1.0, 2.0] for c in POLLUTANTS},
        **{c: [75, 80] for c in AQI_COLUMNS[:3]},
        **hourly,
    }
    response = {"hourly": {k: v for k, v in arrays.items() if v is not None}}
    for name in reversed(nest):
        response = {name: response}
    return {
        "schema_version": "1.0",
        "batch_id": "B1",
        "source": SOURCE,
        "extracted_at": "2026-07-13T14:05:00+00:00",
        "point": {
            "point_id": point,
            "location_id": "L1",
            "point_name": "Center",
            "point_type": "urban_center",
            "latitude": 21.0,
            "longitude": 105.0,
        },
        "api_response": response,
    }


def load(spark, folder, documents):
    for i, doc in enumerate(documents):
        path = folder / "date=2026-07-13" / "hour=21" / f"batch_id={doc['batch_id']}"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{i}.json").write_text(json.dumps(doc, indent=2))
    return raw.read_raw(spark, str(folder))


def test_hours_before_ten_are_found(spark, tmp_path):
    path = tmp_path / "date=2026-07-13" / "hour=05" / "batch_id=20260713"
    path.mkdir(parents=True)
    (path / "0.json").write_text(json.dumps(document()))
    found = raw.read_raw(spark, str(tmp_path), date="2026-07-13", hour="05", batch="20260713")
    assert found.count() == 1 and found.first().hour == "05"
    assert "PartitionFilters: [isnotnull(" in found._jdf.queryExecution().executedPlan().toString()
    assert raw.read_raw(spark, str(tmp_path), hour="06").count() == 0


def failure_of(spark, folder, doc):
    return raw.with_failure(load(spark, folder, [doc]), SOURCE).first().failure


@pytest.mark.parametrize("nest", [(), ("response",), ("data",), ("a", "b", "c", "d", "e")])
def test_two_hours(spark, tmp_path, nest):
    result = ingest.transform(load(spark, tmp_path, [document(nest=nest)]), SOURCE)
    rows = sorted(result.rows.collect(), key=lambda r: r.forecast_time)
    assert [r.us_aqi for r in rows] == [75, 80]
    assert rows[0].forecast_time == datetime(2026, 7, 13, 14) and rows[0].us_aqi_ozone is None
    assert rows[0].ingested_at == datetime(2026, 7, 13, 14, 5)
    assert result.summary.first().status == "SUCCESS"


@pytest.mark.parametrize(
    "change, failure",
    [
        ({"pm10": [1.0]}, "LENGTH_MISMATCH"),
        ({"us_aqi": [75.5, 80]}, "FRACTIONAL_AQI"),
        ({"time": ["2026-07-13T21:00", "soon"]}, "BAD_TIME"),
        ({"time": []}, "EMPTY_HOURLY"),
        ({"time": None}, "NO_HOURLY"),
        ({"ozone": None}, None),
    ],
)
def test_failures(spark, tmp_path, change, failure):
    assert failure_of(spark, tmp_path, document(**change)) == failure


@pytest.mark.parametrize(
    "field, value, failure",
    [
        ("source", "other", "WRONG_SOURCE"),
        ("extracted_at", "2026-07-13T14:05:00", "BAD_EXTRACTED_AT"),
    ],
)
def test_envelope_failures(spark, tmp_path, field, value, failure):
    assert failure_of(spark, tmp_path, {**document(), field: value}) == failure


def test_one_bad_document_does_not_stop_the_rest(spark, tmp_path):
    result = ingest.transform(load(spark, tmp_path, [document("P1"), document("P2", pm10=[1.0])]), SOURCE)
    row = result.summary.first()
    assert (row.status, row.successful_objects, row.failed_objects, row.records_transformed) == ("PARTIAL_SUCCESS", 1, 1, 2)
    assert [tuple(r) for r in result.failures.collect()] == [("B1", "P2", "LENGTH_MISMATCH")]


def test_repeated_document_fails_the_batch(spark, tmp_path):
    result = ingest.transform(load(spark, tmp_path, [document("P1"), document("P1")]), SOURCE)
    assert result.summary.first().status == "FAILED"
    assert ingest.clean_batches(result).count() == 0


@pytest.mark.parametrize(
    ("times", "repeated"),
    [
        (["2026-07-13T21:00", "2026-07-13T22:00"], 0),
        (["2026-07-13T21:00", "2026-07-13T21:00"], 2),
        (["2026-07-13T21:00", "2026-07-13T14:00:00Z"], 2),
        (["2026-07-13T21:00", "2026-07-13 21:00"], 2),
        (["2026-07-13T14:00:00Z", "2026-07-13T15:00:00Z"], 0),
        (["2026-07-13T21:00+07:00", "2026-07-13T15:00:00Z"], 0),
    ],
)
def test_repeated_hours_of_one_document(spark, tmp_path, times, repeated):
    result = ingest.transform(load(spark, tmp_path, [document("P1", time=times), document("P2")]), SOURCE).summary
    row = result.first()
    assert (row.duplicate_rows, row.status, row.records_transformed) == (repeated, "FAILED" if repeated else "SUCCESS", 4)
    assert result._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_point_metadata_defaults(spark, tmp_path):
    doc = document()
    doc["point"] = {"point_id": "P1", "location_id": "NA", "latitude": 1.0, "longitude": 2.0}
    row = raw.open_responses(load(spark, tmp_path, [doc])).select(*raw.point_metadata()).first()
    assert (row.point_name, row.point_type, row.location_id) == ("P1", "unknown", "NA")


@pytest.mark.parametrize(
    "response, path, first",
    [
        ({"z": {"y": {"hourly": {"time": ["z"]}}}, "a": {"hourly": {"time": ["a"]}}}, "z.y.hourly", "z"),
        ({"a": {"b": {"hourly": {"time": ["b"]}}, "hourly": {"time": ["a"]}}}, "a.hourly", "a"),
        ({"a": {"hourly": {"pm10": [1]}}, "hourly": {"inner": {"hourly": {"time": ["in"]}}}}, "hourly.inner.hourly", "in"),
        ({"hourly": {"time": "2026"}, "d": {"hourly": {"time": []}}}, "d.hourly", None),
        ({"list": [{"hourly": {"time": ["x"]}}], "text": '{"hourly": {"time": ["x"]}}'}, None, None),
        ({"a": None, "b": 3, "c": {}, "d": "{"}, None, None),
        ({}, None, None),
        (None, None, None),
        ([{"hourly": {"time": ["x"]}}], None, None),
    ],
)
def test_arrays_are_found_at_any_depth(spark, tmp_path, response, path, first):
    doc = {**document(), "api_response": response}
    found = raw.open_responses(load(spark, tmp_path, [doc])).select(
        raw.hourly_path().alias("path"), raw.locate_hourly()["time"].alias("time")
    ).first()
    assert found.path == path and (found.time or [None])[0] == first


def test_arrays_two_hundred_levels_down(spark, tmp_path):
    doc = document(nest=[f"n{i}" for i in range(200)])
    found = raw.open_responses(load(spark, tmp_path, [doc])).select(raw.hourly_path().alias("path")).first().path
    assert found.startswith("n0.n1.") and found.endswith("n199.hourly")


def test_objects_behind_the_first_arrays_are_not_opened(spark, tmp_path):
    arrays = {"hourly": {"time": ["x"], "more": {"hourly": {"time": ["inner"]}}}}
    responses = [
        ({"c": {"d": {"e": arrays}}, "b": {"d": arrays}, "a": arrays}, "c.d.e.hourly"),
        ({"c": {"d": {"e": {}}}, "b": {"d": arrays}, "a": arrays}, "b.d.hourly"),
        ({"c": {"d": arrays, "hourly": {"time": []}}, "a": arrays}, "c.hourly"),
        ({"c": [arrays], "hourly": {"time": None, "d": arrays}, "a": arrays}, "hourly.d.hourly"),
    ]
    documents = [{**document(f"P{i}"), "api_response": response} for i, (response, _) in enumerate(responses)]
    found = raw.open_responses(load(spark, tmp_path, documents)).select("point.point_id", raw.hourly_path().alias("path"))
    assert {r.point_id: r.path for r in found.collect()} == {f"P{i}": path for i, (_, path) in enumerate(responses)}
    # An object is read once as texts and once as values.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(MapType") == 2


def test_envelope_issues(spark, tmp_path):
    doc = document(nest=(), pm10=[1.0])
    doc["schema_version"] = "2.0"
    doc["point"]["latitude"] = 99.0
    found = raw.envelope_issues(load(spark, tmp_path, [doc]), SOURCE).collect()
    codes = {(r.code, r.field) for r in found}
    assert ("RAW_SCHEMA_VERSION", "schema_version") in codes
    assert ("RAW_COORDINATE_RANGE", "point.latitude") in codes
    assert ("RAW_HOURLY_LENGTH", "hourly.pm10") in codes
    assert ("RAW_HOURLY_FIELD", "hourly.us_aqi_ozone") in codes
    assert len(codes) == 7


def test_pruned_read(spark, tmp_path):
    load(spark, tmp_path, [document(), {**document("P2"), "batch_id": "B2"}])
    assert raw.read_raw(spark, str(tmp_path), batch="B2").select("point.point_id").first()[0] == "P2"
    assert raw.read_raw(spark, str(tmp_path), date="2000-01-01").count() == 0


def test_positional_join(spark):
    from skyledger.operators.joins import zip_responses

    requests = spark.createDataFrame([("r1", ["a", "b"]), ("r2", ["c", "d"])], "request_id string, points array<string>")
    responses = spark.createDataFrame([("r1", [1, 2]), ("r2", [3])], "request_id string, responses array<int>")
    rows = zip_responses(requests, responses).orderBy(F.col("position")).collect()
    assert [(r.request_id, r.position, r.point, r.response) for r in rows] == [("r1", 0, "a", 1), ("r1", 1, "b", 2)]
