import json
import os
import shutil
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import SOURCE, START, frame, locations, points, reading
from skyledger.functions.bands import alert_severity
from skyledger.operators import ranking
from skyledger.schema import AQI_COLUMNS, CLEAN_SCHEMA
from skyledger.streaming import ingest, live
from skyledger.streaming.ingest import ingest_available
from test_raw import document


def run(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("raw", "facts", "checkpoint")]
    query = ingest_available(spark, *paths, SOURCE, points(spark), locations(spark), str(tmp_path / "bad"))
    query.awaitTermination(120)
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(paths[1])


def valid(point, **changes):
    return document(point, **{**{c: [75, 80] for c in AQI_COLUMNS}, **changes})


def put(tmp_path, name, doc):
    (tmp_path / "raw").mkdir(exist_ok=True)
    (tmp_path / "raw" / name).write_text(json.dumps(doc, indent=2))


def test_new_documents_reach_the_facts_once(spark, tmp_path):
    put(tmp_path, "1.json", valid("P1"))
    put(tmp_path, "2.json", document("P2", pm10=[1.0]))
    assert run(spark, tmp_path).count() == 2
    put(tmp_path, "3.json", {**valid("P1", us_aqi=[160, 170]), "batch_id": "B2"})
    rows = run(spark, tmp_path).collect()
    assert sorted((r.point_id, r.us_aqi, r.batch_id, r.aqi_severity) for r in rows) == [
        ("P1", 160, "B2", "UNHEALTHY"),
        ("P1", 170, "B2", "UNHEALTHY"),
    ]
    assert run(spark, tmp_path).count() == 2


def test_rows_that_break_a_rule_go_to_quarantine(spark, tmp_path):
    put(tmp_path, "1.json", valid("P1", pm10=[-1.0, 2.0]))
    assert [r.pm10 for r in run(spark, tmp_path).collect()] == [2.0]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [(r.pm10, r.dq_status) for r in bad] == [(-1.0, "FAILED")]
    done = spark.read.parquet(ingest.ledger_path(str(tmp_path / "facts"))).collect()
    assert [(r.micro_batch, r.valid_rows, r.bad_rows) for r in done] == [(0, 1, 1)]


def test_a_replay_after_a_crash_between_quarantine_and_facts(spark, tmp_path, monkeypatch):
    put(tmp_path, "1.json", valid("P1", pm10=[-1.0, 2.0]))
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "upsert_facts", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            run(spark, tmp_path)
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1 and not (tmp_path / "facts").exists()
    assert run(spark, tmp_path).count() == 1
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    # The last commit of the checkpoint is lost: the micro-batch comes again and is passed over.
    for name in ("0", ".0.crc"):
        os.remove(tmp_path / "checkpoint" / "commits" / name)
    before = sorted(os.listdir(tmp_path / "facts" / "forecast_date=2026-07-13"))
    assert run(spark, tmp_path).count() == 1
    assert sorted(os.listdir(tmp_path / "facts" / "forecast_date=2026-07-13")) == before
    # A new checkpoint is another stream: it takes the same files and leaves the same rows.
    shutil.rmtree(tmp_path / "checkpoint")
    assert run(spark, tmp_path).count() == 1
    assert spark.read.parquet(ingest.ledger_path(str(tmp_path / "facts"))).count() == 2


def drain(spark, df, name):
    query = df.writeStream.outputMode("complete").format("memory").queryName(name).start()
    query.processAllAvailable()
    query.stop()
    return spark.table(name).collect()


def test_live_windows(spark, tmp_path):
    rows = [reading("P1", "L1", us_aqi=110), reading("P2", "L1", us_aqi=210), reading("P3", "L2", us_aqi=20)]
    frame(spark, rows).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(CLEAN_SCHEMA).parquet(str(tmp_path / "in"))
    means = drain(spark, live.hourly_means(source), "means")
    assert sorted((r.location_id, r.average_us_aqi, r.readings) for r in means) == [("L1", 160.0, 2), ("L2", 20.0, 1)]
    counts = drain(spark, live.alert_counts(source), "counts")
    assert sorted((r.severity, r.alerts) for r in counts) == [("CRITICAL", 1), ("MEDIUM", 1)]


def test_live_values_follow_the_newest_version(spark, tmp_path):
    """Corrections, a late row, a repeated file and a closed hour, against one batch over the same rows."""
    first, second, third = (START + timedelta(minutes=m) for m in (5, 40, 70))
    feeds = [
        [reading(p, l, h, us_aqi=a, ingested_at=first) for p, l, h, a in (("P1", "L1", 3, 110), ("P2", "L1", 3, 210), ("P3", "L2", 3, 20), ("P3", "L2", 4, None))],
        # P1 is corrected, P2 moves to L2, P3 gets a value.
        [reading("P1", "L1", 3, us_aqi=50, batch_id="B2", ingested_at=third), reading("P2", "L2", 3, us_aqi=160, batch_id="B2", ingested_at=third), reading("P3", "L2", 4, us_aqi=310, batch_id="B2", ingested_at=third)],
        # Late: older than what P1 has now, but newer than its first version; and the same rows again.
        [reading("P1", "L1", 3, us_aqi=500, batch_id="B9", ingested_at=second), reading("P2", "L2", 3, us_aqi=160, batch_id="B2", ingested_at=third)],
    ]

    def run(rows, name):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(CLEAN_SCHEMA).parquet(str(tmp_path / "in"))
        live.maintain(live.corrections(source), str(tmp_path / "live"), str(tmp_path / "check")).awaitTermination(120)
        return sorted(map(tuple, live.current_hours(spark, str(tmp_path / "live")).collect()))

    def batch_result(rows):
        newest = ranking.latest_wins(frame(spark, rows)).withColumn("severity", alert_severity(F.col("us_aqi")))
        counts = [F.count_if(F.col("severity") == s) for s in live.SEVERITIES]
        return sorted(map(tuple, newest.groupBy("location_id", "forecast_time").agg(F.avg("us_aqi"), F.count("*"), *counts).collect()))

    seen = []
    for number, rows in enumerate(feeds):
        seen += rows
        assert run(rows, number) == batch_result(seen)
    # Time passes the hours: a closed one is no longer corrected, an open one is.
    later = START + timedelta(hours=20)
    run([reading("P4", "L3", 40, us_aqi=10, ingested_at=later)], 3)
    run([reading("P5", "L3", 41, us_aqi=10, ingested_at=later)], 4)
    before = live.current_hours(spark, str(tmp_path / "live")).where("location_id = 'L1'").collect()
    found = run([reading("P1", "L1", 3, us_aqi=400, batch_id="B5", ingested_at=later), reading("P4", "L3", 40, us_aqi=30, batch_id="B5", ingested_at=later)], 5)
    assert live.current_hours(spark, str(tmp_path / "live")).where("location_id = 'L1'").collect() == before
    assert [(r[0], r[2], r[3]) for r in found if r[0] == "L3"] == [("L3", 30.0, 1), ("L3", 10.0, 1)]
