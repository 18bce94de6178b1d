import os
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from data import batch, frame, locations, reading
from skyledger.functions.time import local_day
from skyledger.plans import marts, states
from skyledger.sinks import batches, daily
from skyledger.sources import ledger, tables

MADE = "2026-07-21 00:00:00"
OLD, NEW, LATE = datetime(2026, 7, 20, 1), datetime(2026, 7, 20, 2), datetime(2026, 7, 20, 3)


def made():
    return F.lit(MADE).cast("timestamp")


def store(spark, root, rows, started=MADE):
    df = batches.with_partitions(frame(spark, rows), F.lit(started).cast("timestamp"))
    batches.write_batches(df, root)


def rows(name, hours, ingested_at, points=("P1", "P2"), **changes):
    return [reading(p, "L1", h, batch_id=name, ingested_at=ingested_at, **changes) for p in points for h in hours]


def update(spark, tmp_path, **options):
    return daily.update(spark, str(tmp_path / "clean"), locations(spark), made(), str(tmp_path / "mart"), **options)


def same_as_rebuilt(spark, tmp_path):
    """The stored days against a summary of the whole valid history."""
    history = tables.valid_history(tables.read_history(spark, str(tmp_path / "clean")))
    full = marts.daily_summary(history, locations(spark), made())
    kept = daily.read(spark, str(tmp_path / "mart")).select(*full.columns)
    assert kept.exceptAll(full).count() == full.exceptAll(kept).count() == 0
    return kept


def folders(tmp_path, table="daily_summary"):
    root = tmp_path / "mart" / table
    return {day: sorted(os.listdir(root / day)) for day in os.listdir(root) if day.startswith("forecast_date")}


def test_a_batch_writes_its_days_only(spark, tmp_path):
    clean = str(tmp_path / "clean")
    store(spark, clean, rows("A", range(0, 60), OLD))
    assert update(spark, tmp_path) == ["2026-07-20", "2026-07-21", "2026-07-22", "2026-07-23"]
    before = folders(tmp_path)
    store(spark, clean, rows("B", range(10, 20), NEW, us_aqi=90, pm2_5=33.25))
    assert update(spark, tmp_path) == ["2026-07-21"]
    after = folders(tmp_path)
    assert {day for day in after if after[day] != before[day]} == {"forecast_date=2026-07-21"}
    assert same_as_rebuilt(spark, tmp_path).where("maximum_us_aqi = 90").count() == 2
    assert update(spark, tmp_path) == [] and folders(tmp_path) == after


def test_older_and_repeated_batches_change_nothing_newer(spark, tmp_path):
    clean = str(tmp_path / "clean")
    store(spark, clean, rows("B", range(0, 12), NEW, us_aqi=90))
    update(spark, tmp_path)
    store(spark, clean, rows("A", range(6, 30), OLD, us_aqi=20))
    update(spark, tmp_path)
    kept = same_as_rebuilt(spark, tmp_path)
    assert {r.source_batch_count for r in kept.collect()} == {1, 2}


def test_unusable_batches_are_left_out_and_taken_out(spark, tmp_path):
    clean = str(tmp_path / "clean")
    store(spark, clean, rows("A", range(0, 30), OLD))
    store(spark, clean, [*rows("BAD", range(0, 5), NEW, us_aqi=300), reading("P1", "L1", 0, batch_id="BAD", ingested_at=NEW)])
    update(spark, tmp_path)
    assert same_as_rebuilt(spark, tmp_path).agg(F.max("maximum_us_aqi")).first()[0] == 40
    # The bad batch is mended and reaches another day, then the good one goes bad.
    store(spark, clean, rows("BAD", range(40, 44), LATE, us_aqi=300))
    assert update(spark, tmp_path) == ["2026-07-22"]
    same_as_rebuilt(spark, tmp_path)
    store(spark, clean, [*rows("A", range(0, 3), OLD), *rows("A", [0], OLD)])
    assert update(spark, tmp_path) == ["2026-07-20", "2026-07-21", "2026-07-22"]
    assert {r.forecast_date for r in same_as_rebuilt(spark, tmp_path).collect()} == {"2026-07-22"}
    assert set(folders(tmp_path)) == {"forecast_date=2026-07-22"}


def test_a_rewritten_batch_brings_back_the_hours_below_it(spark, tmp_path):
    clean = str(tmp_path / "clean")
    store(spark, clean, rows("A", range(0, 10), OLD, us_aqi=40))
    store(spark, clean, rows("B", range(0, 10), NEW, us_aqi=200))
    update(spark, tmp_path)
    store(spark, clean, rows("B", range(8, 10), NEW, us_aqi=120))
    update(spark, tmp_path)
    kept = same_as_rebuilt(spark, tmp_path)
    assert kept.agg(F.max("maximum_us_aqi")).first()[0] == 120
    shutil.rmtree(tmp_path / "clean" / "date=2026-07-21" / "hour=07" / "batch_id=B")
    update(spark, tmp_path)
    assert same_as_rebuilt(spark, tmp_path).agg(F.max("maximum_us_aqi")).first()[0] == 40


def test_a_run_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    clean = str(tmp_path / "clean")
    store(spark, clean, rows("A", range(0, 30), OLD))
    update(spark, tmp_path)
    store(spark, clean, rows("B", range(5, 20), NEW, us_aqi=90))
    for step in (lambda *a: 1 / 0, None):
        with monkeypatch.context() as patch:
            patch.setattr(daily, "summarise", step) if step else patch.setattr(ledger.Changes, "commit", lambda self: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                update(spark, tmp_path)
    assert update(spark, tmp_path) == ["2026-07-21"]
    same_as_rebuilt(spark, tmp_path)


def test_a_refresh_reads_changed_batches_only(spark, tmp_path, monkeypatch):
    clean = str(tmp_path / "clean")
    for i in range(4):
        store(spark, clean, rows(f"B{i}", range(3 * i, 3 * i + 3), NEW))
    update(spark, tmp_path)
    store(spark, clean, rows("B4", range(2), NEW))
    path = str(tmp_path / "mart" / "batch_ledger")
    found = ledger.changes(spark, clean, path)
    plan = found.entries._jdf.queryExecution().optimizedPlan().toString()
    assert found.count == 1
    row = found.entries.first()
    assert (row.batch_id, row.is_valid, row.was_valid, row.days, row.generation) == ("B4", True, False, ["2026-07-20"], 2)
    assert "B0" not in plan
    history = tables.read_history(spark, clean)
    pruned = ledger.only(history, ["B4"], history)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in pruned and "= B4" in pruned
    found.commit()
    assert ledger.changes(spark, clean, path).count == 0
    # The same content in another file, or another size, is found.
    store(spark, clean, rows("B2", range(6, 9), NEW, us_aqi=41))
    assert [r.batch_id for r in ledger.changes(spark, clean, path).entries.collect()] == ["B2"]


def test_counts_that_were_announced(spark, tmp_path):
    store(spark, str(tmp_path / "clean"), [*rows("A", range(3), OLD), *rows("B", range(3), NEW, us_aqi=90)])
    announced = spark.createDataFrame([("A", 6), ("B", 7)], "batch_id string, announced_count long")
    update(spark, tmp_path, announced=announced)
    kept = daily.read(spark, str(tmp_path / "mart"))
    assert {r.maximum_us_aqi for r in kept.collect()} == {40}


def test_states_merge_in_any_order(spark):
    parts = [frame(spark, rows(n, hours, at, us_aqi=i)) for n, hours, at, i in (("A", range(0, 30), OLD, 10), ("B", range(20, 40), NEW, 20), ("C", range(5, 25, 2), LATE, 30))]
    a, b, c = map(states.of_rows, parts)
    whole = states.of_rows(parts[0].union(parts[1]).union(parts[2]))
    for merged in (states.merged(states.merged(a, b), c), states.merged(c, states.merged(b, a)), states.merged(whole, b)):
        merged = merged.select(*whole.columns)
        assert merged.exceptAll(whole).count() == whole.exceptAll(merged).count() == 0
    hours = whole.select(F.size("hours").alias("n"), F.explode("hours").alias("h"))
    assert hours.agg(F.max("n")).first()[0] <= 24
    assert hours.where(local_day(F.col("h.forecast_time")).isNull()).count() == 0


def test_reading_a_range_prunes_folders(spark, tmp_path):
    store(spark, str(tmp_path / "clean"), rows("A", range(0, 100), OLD))
    update(spark, tmp_path)
    part = daily.read(spark, str(tmp_path / "mart"), "2026-07-21", "2026-07-22")
    assert {r.forecast_date for r in part.collect()} == {"2026-07-21", "2026-07-22"}
    assert "PartitionFilters: [isnotnull(forecast_date" in part._jdf.queryExecution().executedPlan().toString()
