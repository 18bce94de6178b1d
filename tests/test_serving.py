from datetime import datetime, timedelta

import pytest

from data import frame, locations, points, reading
from skyledger.plans import serving
from skyledger.sinks import facts as fact_sink
from skyledger.streaming.ingest import labelled

OLD, NEW = datetime(2026, 7, 20, 1), datetime(2026, 7, 20, 2)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Ten days of batch A, two of them reached by the newer B, and an old C that came last."""
    path = str(tmp_path_factory.mktemp("facts") / "facts")
    every = [reading(p, l, h, batch_id="A", ingested_at=OLD, us_aqi=h % 50) for p, l in (("P1", "L1"), ("P2", "L2")) for h in range(240) if p == "P1" or h % 3 == 0]
    newer = [reading(p, l, h, batch_id="B", ingested_at=NEW, us_aqi=100 + h) for p, l in (("P1", "L1"), ("P2", "L2")) for h in range(20, 44)]
    late = [reading("P2", "L2", 200, batch_id="C", ingested_at=OLD - timedelta(days=1))]
    for rows in (every, newer, late):
        fact_sink.upsert_facts(spark, path, labelled(frame(spark, rows)))
    return spark.read.parquet(path), fact_sink.read_batches(spark, path)


def folders_read(df):
    """What the scan of the facts filters its folders by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.split("\n") if "forecast_date#" in line and "PartitionFilters" in line and "point_id" in line]
    assert lines, plan
    return [line.split("PartitionFilters: ")[1].split("]")[0] for line in lines]


def queries(spark, facts, batches=None):
    tables = (points(spark), locations(spark))
    return {
        "latest": serving.latest_readings(facts, *tables, batches=batches),
        "location": serving.readings_by_location(facts, *tables, "l1", batches=batches),
        "point": serving.readings_by_point(facts, *tables, " p2 ", batches=batches),
        "top": serving.top_polluted(facts, *tables, 5, batches=batches),
        "history": serving.point_history(facts, *tables, "P1", 30, batches=batches),
        "sparse history": serving.point_history(facts, *tables, "P2", 40, batches=batches),
        "unknown": serving.point_history(facts, *tables, "P9", 40, batches=batches),
    }


def test_the_map_changes_no_result(spark, stored):
    facts, batches = stored
    plain = queries(spark, facts)
    for name, df in queries(spark, facts, batches).items():
        rows = df.collect()
        assert rows == plain[name].collect(), name
        assert bool(rows) == (name != "unknown")


def test_every_serving_query_reads_few_folders(spark, stored):
    facts, batches = stored
    for name, df in queries(spark, facts, batches).items():
        for filters in folders_read(df):
            if name != "unknown":
                assert "forecast_date#" in filters and (" IN (" in filters or "INSET" in filters or " = " in filters), (name, filters)
    latest = serving.latest_batch_rows(facts, batches)
    assert {r.batch_id for r in latest.collect()} == {"B"} and latest.count() == 48


def test_history_goes_further_back_where_hours_are_missing(spark, stored):
    facts, batches = stored
    assert len(serving.newest_days(facts, batches, "P1", 30)) == 3
    assert len(serving.newest_days(facts, batches, "P2", 40)) == 6
    assert len(serving.newest_days(facts, batches, "P2", 2000)) == 11


def test_an_upsert_says_which_days_a_batch_brought(spark, stored):
    _, batches = stored
    found = {(r.batch_id, str(r.forecast_date)): r.row_count for r in batches.collect()}
    assert {d: n for (b, d), n in found.items() if b == "B"} == {"2026-07-21": 32, "2026-07-22": 16}
    assert found["C", "2026-07-28"] == 1 and len(found) == 11 + 2 + 1


def test_no_facts(spark, stored):
    facts, batches = stored
    assert serving.latest_batch_rows(facts.limit(0), batches.limit(0)).count() == 0
