import json
import os

import pytest
from pyspark.sql import functions as F

from data import SOURCE, batch, frame, locations, points, reading
from skyledger.operators import joins
from skyledger.plans import alerts, marts, quality, release
from skyledger.sinks import batches, facts, marts as mart_sink, release as release_sink
from skyledger.sources import tables


def graded(spark, rows):
    started = F.lit("2026-07-20 18:30:00").cast("timestamp")
    df = batches.with_partitions(frame(spark, rows), started).withColumn("load_id", F.col("batch_id"))
    result = quality.grade(df, points(spark), locations(spark), SOURCE, started, hours=3)
    return df, result


#: How a plan shows that rows are judged by the rules.
EVALUATION = "array_remove"


def test_rerun_replaces_a_batch_and_drops_stale_quarantine(spark, tmp_path):
    clean, bad = str(tmp_path / "clean"), str(tmp_path / "bad")
    rows = batch()
    rows[0]["pm2_5"] = -1.0
    df, result = graded(spark, rows)
    logs = {}

    def log(stored):
        logs.update(summary=stored.summary.collect(), checks=stored.row_report.where("status <> 'PASSED'").collect())
        for frame_ in (stored.valid, stored.bad, stored.row_report, stored.batch_report, stored.summary):
            plan = frame_._jdf.queryExecution().optimizedPlan().toString()
            assert EVALUATION not in plan and "_point_key" not in plan
        assert EVALUATION in result.valid._jdf.queryExecution().optimizedPlan().toString()

    batches.write_grading(result, clean, bad, log)
    assert logs["summary"] == result.summary.collect() and [r.check_name for r in logs["checks"]] == ["PM2_5_NON_NEGATIVE"]
    assert sorted(os.listdir(tmp_path)) == ["bad", "clean"]
    assert tables.read_history(spark, clean).count() == 5
    folder = os.path.join(bad, "date=2026-07-21", "hour=01", "batch_id=B1")
    assert os.path.isdir(folder)

    df, result = graded(spark, batch())
    batches.write_grading(result, clean, bad)
    history = tables.read_history(spark, clean, date="2026-07-21", hour="01", batch="B1")
    assert history.count() == 6 and not os.path.exists(folder)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert history.select("hour").first()[0] == "01"


def test_partition_parts(spark):
    paths = [
        ("x/date=2026-07-20/hour=05/batch_id=B_1/data.parquet",),
        ("x/date=2026-07-20/hour=5/batch_id=B_1/data.parquet",),
    ]
    rows = spark.createDataFrame(paths, "p string").select(*tables.partition_parts(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("2026-07-20", "05", "B_1"), (None, None, None)]


def fact_rows(spark, path):
    return sorted((r.point_id, r.forecast_time, r.us_aqi, r.batch_id) for r in spark.read.parquet(path).collect())


def test_fact_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "facts")
    facts.upsert_facts(spark, path, frame(spark, [reading(hour=h) for h in (0, 1, 30)]))
    other_day = os.path.join(path, "forecast_date=2026-07-21")
    before = sorted(os.listdir(other_day))
    incoming = frame(spark, [reading(hour=h, us_aqi=90, batch_id="B2") for h in (1, 2)])
    facts.upsert_facts(spark, path, incoming)
    first = fact_rows(spark, path)
    assert [(t.hour, index, b) for _, t, index, b in first] == [(12, 40, "B1"), (13, 90, "B2"), (14, 90, "B2"), (18, 40, "B1")]
    assert sorted(os.listdir(other_day)) == before
    facts.upsert_facts(spark, path, incoming)
    assert fact_rows(spark, path) == first


def test_one_batch_equals_two_halves(spark, tmp_path):
    rows = [reading(p, "L1", h) for p in ("P1", "P2") for h in range(4)]
    whole, halves = str(tmp_path / "whole"), str(tmp_path / "halves")
    facts.upsert_facts(spark, whole, frame(spark, rows))
    facts.upsert_facts(spark, halves, frame(spark, rows[::2]))
    facts.upsert_facts(spark, halves, frame(spark, rows[1::2]))
    assert fact_rows(spark, whole) == fact_rows(spark, halves)


def test_alert_table(spark, tmp_path):
    path = str(tmp_path / "alerts")
    made = F.lit("2026-07-20 12:00:00").cast("timestamp")

    def run(*rows):
        judged = frame(spark, list(rows))
        facts.upsert_alerts(spark, path, judged, alerts.derive(judged, made))
        return sorted((r.point_id, r.severity) for r in spark.read.parquet(path).collect())

    assert run(reading("P1", us_aqi=160), reading("P2", us_aqi=210)) == [("P1", "HIGH"), ("P2", "CRITICAL")]
    assert run(reading("P1", us_aqi=120)) == [("P1", "MEDIUM"), ("P2", "CRITICAL")]
    assert run(reading("P2", us_aqi=None)) == [("P1", "MEDIUM")]


def test_mart_build_is_seen_only_through_its_log(spark, tmp_path):
    root = str(tmp_path)
    made = F.lit("2026-07-21 00:00:00").cast("timestamp")
    history = frame(spark, batch())
    mart_sink.build_marts(history, locations(spark), made, root, "batch_id=B1")
    marts.build(history.limit(1), locations(spark), made)["current"].write.parquet(f"{root}/current/batch_id=B2")
    assert mart_sink.read_latest(spark, root, "current").count() == 2


def test_release_tree(spark, tmp_path):
    made = F.lit("2026-07-21 00:00:00").cast("timestamp")
    current = marts.current(frame(spark, batch()), locations(spark), made)
    rows = release.point_payloads(release.current_compatible(current), points(spark))
    path = str(tmp_path / "points")
    release_sink.write_payloads(rows, "point_id", path)
    folder = os.path.join(path, "point_id=P1")
    lines = [json.loads(line) for f in os.listdir(folder) if f.endswith(".json") for line in open(os.path.join(folder, f))]
    assert len(lines) == 1 and lines[0]["record_count"] == 1 and lines[0]["batch_id"] == "B1"
    assert lines[0]["forecast_time"].endswith("+00:00")


def test_payload_audit(spark):
    rows = spark.createDataFrame([("L1", 2, "P1", "B"), ("L1", 2, "P2", " "), ("L2", 1, None, None)], "l string, record_count bigint, p string, b string")
    found = {r.l: (r.actual, r.without_batch, r.is_valid) for r in release.payload_audit(rows, "l", "p", "b").collect()}
    assert found == {"L1": (2, 1, False), "L2": (0, 0, False)}


def test_csv_export(spark, tmp_path):
    release_sink.write_csv(points(spark), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_csv_dimensions_keep_the_literal_na(spark, tmp_path):
    path = tmp_path / "locations.csv"
    path.write_text("﻿location_id,location_name,region,admin_type,is_active\nNA,Coast,R,City,True\n", encoding="utf-8")
    assert tables.read_locations(spark, str(path)).first().location_id == "NA"
    path.write_text("location_id,location_name\nNA,Coast\n")
    with pytest.raises(ValueError, match="region"):
        tables.read_locations(spark, str(path))


HEADER = "point_id,location_id,point_name,point_type,latitude,longitude,is_active\n"


def test_collectable_points(spark, tmp_path):
    path = tmp_path / "points.csv"
    path.write_text(HEADER + "A,L1,a,t,1,2,true\nC,L1,c,t,1,2,no\n")
    assert [r.point_id for r in tables.collectable_points(tables.read_points(spark, str(path))).collect()] == ["A"]


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ("B,L1,b,t,x,2,true", "latitude is not within -90..90"),
        ("B,L1,b,t,1,180.5,no", "longitude is not within -180..180"),
        ("E,L1, ,t,1,2,1", "point_name is blank"),
        (",L1,e,t,1,2,1", "point_id is blank"),
        ("E,L1,e,t,1,2,maybe", "is_active is neither yes nor no"),
        ("E,L1,e,t,1,2,", "is_active is blank"),
        (" A ,L2,a,t,1,2,no", "point_id is not unique: A"),
    ],
)
def test_an_unusable_point_stops_the_job(spark, tmp_path, line, reason):
    path = tmp_path / "points.csv"
    path.write_text(HEADER + "A,L1,a,t,1,2,true\n" + line + "\n")
    points_read = tables.read_points(spark, str(path))
    found = tables.point_defects(points_read).collect()
    assert {r for row in found for r in row.reasons} == {reason} and len(found) == (2 if "unique" in reason else 1)
    with pytest.raises(Exception, match=reason.replace(".", "[.]")):
        tables.collectable_points(points_read).collect()


def test_a_file_without_active_points_stops_the_job(spark, tmp_path):
    path = tmp_path / "points.csv"
    path.write_text(HEADER + "A,L1,a,t,1,2,no\n")
    with pytest.raises(Exception, match="no active point"):
        tables.collectable_points(tables.read_points(spark, str(path))).collect()


def test_last_row_of_a_file_wins(spark, tmp_path):
    path = tmp_path / "locations.csv"
    path.write_text("location_id,location_name,region,admin_type,is_active\nL1,Old,R,City,1\nL1,New,R,City,1\n")
    named = joins.enrich_locations(frame(spark, batch()), tables.read_locations(spark, str(path)), tables.LOAD_ORDER)
    assert {r.location_name for r in named.where("location_id = 'L1'").collect()} == {"New"}


def test_alert_day_that_empties_is_deleted(spark, tmp_path):
    path = str(tmp_path / "alerts")
    made = F.lit("2026-07-20 12:00:00").cast("timestamp")
    for index in (160, 40):
        judged = frame(spark, [reading("P1", us_aqi=index)])
        facts.upsert_alerts(spark, path, judged, alerts.derive(judged, made))
    assert spark.read.schema("point_id string").parquet(path).count() == 0
    assert os.listdir(tmp_path) == ["alerts"]


def history_folder(spark, root, many=1, **lacking):
    """Batches B0.. of two files each; returns the files of each batch."""
    rows = [dict(r, batch_id=f"B{i}") for i in range(many) for r in batch()]
    df = frame(spark, rows).withColumns({"date": F.lit("2026-07-20"), "hour": F.lit("05")})
    df = df.repartition(2 * many, "batch_id", "forecast_time")
    df.write.partitionBy("date", "hour", "batch_id").parquet(root)
    return {
        f"B{i}": sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and d.endswith(f"batch_id=B{i}"))
        for i in range(many)
    }


def test_destroyed_files_make_their_batch_invalid(spark, tmp_path):
    root = str(tmp_path / "clean")
    files = history_folder(spark, root, many=4)
    for name in [files["B1"][0], *files["B2"]]:
        with open(name, "wb") as broken:
            broken.write(b"no parquet")
    rows, report = tables.read_history_isolated(spark, root)
    found = {r.batch_id: r.is_valid for r in report.collect()}
    assert found == {"B0": True, "B1": False, "B2": False, "B3": True}
    assert {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {"B0", "B3"}
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.read_history(spark, root).collect()


def test_announced_counts_and_missing_batches(spark, tmp_path):
    root = str(tmp_path / "clean")
    history_folder(spark, root, many=2)
    announced = spark.createDataFrame([("B0", 6), ("B1", 7), ("B9", 1)], "batch_id string, announced_count long")
    report = {r.batch_id: (r.is_valid, r.files) for r in tables.history_report(spark, root, announced).collect()}
    assert report["B0"][0] and not report["B1"][0] and report["B9"] == (False, 0)


def test_batch_without_a_column_is_invalid(spark, tmp_path):
    root = str(tmp_path / "clean")
    history_folder(spark, root)
    lacking = frame(spark, batch()).drop("source").withColumns({"date": F.lit("2026-07-20"), "hour": F.lit("05"), "batch_id": F.lit("B8")})
    lacking.write.mode("append").partitionBy("date", "hour", "batch_id").parquet(root)
    report = {r.batch_id: r for r in tables.history_report(spark, root).collect()}
    assert report["B0"].is_valid and not report["B8"].is_valid and report["B8"].empty_columns == ["source"]


def test_every_skipped_batch_is_listed(spark):
    rows = [dict(r, batch_id=f"B{i}") for i in range(25) for r in [*batch(), batch()[0]]]
    assert tables.skipped_batches(frame(spark, rows)).count() == 25


def test_damaged_build_is_passed_over(spark, tmp_path):
    root = str(tmp_path)
    made = F.lit("2026-07-21 00:00:00").cast("timestamp")
    history = frame(spark, batch())
    for name in ("batch_id=B1", "batch_id=B2"):
        mart_sink.build_marts(history, locations(spark), made, root, name)
    marts.build(history, locations(spark), made)["current"].limit(1).write.mode("overwrite").parquet(f"{root}/current/batch_id=B2")
    found = mart_sink.read_latest(spark, root, "current")
    assert found.count() == 2 and "batch_id=B1" in found.inputFiles()[0]

