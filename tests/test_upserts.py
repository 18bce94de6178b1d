from pyspark.sql import functions as F

from skyledger.operators import upserts

OLD = "k int, a string, b string, kept string"


def test_upsert_replaces_mapped_columns_only(spark):
    old = spark.createDataFrame([(1, "x", "y", "z"), (2, "x", "y", "z")], OLD)
    new = spark.createDataFrame([(2, None, "n"), (3, "q", "n")], "k int, a string, kept string")
    rows = sorted(tuple(r) for r in upserts.upsert(old, new, ["k"], keep=["kept"]).collect())
    assert rows == [(1, "x", "y", "z"), (2, None, "y", "z"), (3, "q", None, "n")]


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, "x", "y", "z")], OLD)
    new = spark.createDataFrame([(1, "n", "n", "n"), (2, "n", "n", "n")], OLD)
    once = upserts.upsert(old, new, ["k"])
    twice = upserts.upsert(once, new, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dimension_keeps_creation_time(spark):
    old = spark.createDataFrame([("P1", "old", 1, 1), ("P2", "old", 1, 1)], "id string, name string, created_at int, updated_at int")
    new = spark.createDataFrame([("P1", "new"), ("P3", "new")], "id string, name string")
    rows = sorted(tuple(r) for r in upserts.upsert_dimension(old, new, "id", F.lit(9)).collect())
    assert rows == [("P1", "new", 1, 9), ("P2", "old", 1, 1), ("P3", "new", 9, 9)]


def test_counts(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "k int, t int")
    new = spark.createDataFrame([(2, 20), (3, 30), (4, 15)], "k int, t int")
    assert tuple(upserts.upsert_counts(old, new, ["k", "t"], "t").first()) == (3, 2, 1)


ALERT = "point_id string, alert_time int, severity string, source string, message string, status string, created_at int"


def test_alert_merge(spark):
    old = spark.createDataFrame(
        [
            ("P1", 1, "HIGH", "s", "old", "ACKNOWLEDGED", 1),
            ("P1", 2, "MEDIUM", "s", "old", "OPEN", 1),
            ("P1", 3, "HIGH", "s", "old", "OPEN", 1),
            ("P9", 1, "HIGH", "s", "old", "OPEN", 1),
        ],
        ALERT,
    )
    batch = spark.createDataFrame([("P1", t, "s") for t in (1, 2, 3)], "point_id string, forecast_time int, source string")
    fresh = spark.createDataFrame(
        [("P1", 1, "HIGH", "s", "new", "OPEN", 5), ("P1", 2, "HIGH", "s", "new", "OPEN", 5)], ALERT
    )
    rows = sorted(tuple(r) for r in upserts.merge_alerts(old, batch, fresh).collect())
    assert rows == [
        ("P1", 1, "HIGH", "s", "new", "ACKNOWLEDGED", 1),
        ("P1", 2, "HIGH", "s", "new", "OPEN", 5),
        ("P9", 1, "HIGH", "s", "old", "OPEN", 1),
    ]


def test_backup_once_per_id_and_reason(spark):
    rows = spark.createDataFrame([("r1", " "), ("r1", " "), ("r2", " ")], "run_id string, batch_id string")
    first = upserts.backup_rows(rows.limit(2), "run_id", "WHY")
    assert [tuple(r) for r in first.collect()] == [("r1", "WHY", '{"run_id":"r1","batch_id":" "}')]
    assert [r.original_id for r in upserts.backup_rows(rows, "run_id", "WHY", first).collect()] == ["r2"]


def test_purge_and_backfill(spark):
    runs = spark.createDataFrame([("r1", "B", "s"), ("r2", " ", "s"), ("r3", "B", None)], "run_id string, batch_id string, stage_name string")
    checks = spark.createDataFrame([("r1",), ("r2",), ("r3",), ("r4",)], "run_id string")
    assert sorted(r.run_id for r in upserts.purge_orphan_checks(checks, runs).collect()) == ["r1", "r4"]
    assert [r.batch_id for r in upserts.backfill_batch_id(runs, "old").orderBy("run_id").collect()] == ["B", "old", "B"]
