from datetime import datetime

from pyspark.sql import functions as F

from skyledger.functions import clean, numbers, time


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_rounding_matches_binary_half_even(spark):
    found = values(spark, [(0.125,), (2.675,), (76.66666666666667,)], "x double", numbers.round_even(F.col("x"), 2))
    assert found == [(0.12,), (2.68,), (76.67,)]


def test_mean_does_not_depend_on_order(spark):
    numbers_in = [0.1 * i for i in range(1, 2000)]
    one = values(spark, [(v,) for v in numbers_in], "x double", numbers.mean(F.col("x")))
    other = values(spark, [(v,) for v in reversed(numbers_in)], "x double", numbers.mean(F.col("x")))
    assert one == other
    assert values(spark, [(None,)], "x double", numbers.mean(F.col("x"))) == [(None,)]


def test_offsets_and_instants(spark):
    rows = [("2026-07-13T21:00",), ("2026-07-13T21:00Z",), ("2026-07-13T21:00+07:00",), ("someday",), (None,)]
    found = values(
        spark, rows, "t string", clean.has_offset(F.col("t")), time.parse_instant(F.col("t")).cast("string")
    )
    assert found == [
        (False, "2026-07-13 14:00:00"),
        (True, "2026-07-13 21:00:00"),
        (True, "2026-07-13 14:00:00"),
        (False, None),
        (False, None),
    ]


def test_booleans(spark):
    rows = [(" YES ",), ("0",), ("maybe",), (None,)]
    found = values(spark, rows, "t string", clean.parse_boolean(F.col("t")), clean.is_active(F.col("t")))
    assert found == [(True, True), (False, False), (None, False), (None, False)]


def test_identifiers(spark):
    rows = [("20260720T120000Z_ab.c",), ("/x",), ("a b",), (None,)]
    found = values(spark, rows, "t string", clean.is_batch_id(F.col("t")), clean.is_safe_identifier(F.col("t")))
    assert found == [(True, False), (False, False), (False, False), (False, False)]


def test_partition_strings_follow_local_time(spark):
    rows = [(datetime(2026, 7, 20, 18, 30),)]
    found = values(spark, rows, "t timestamp", time.partition_date(F.col("t")), time.partition_hour(F.col("t")))
    assert found == [("2026-07-21", "01")]


def test_age(spark):
    rows = [(datetime(2026, 7, 20, 10, 59, 30),), (datetime(2026, 7, 20, 9),), (datetime(2026, 7, 21),), (None,)]
    as_of = F.lit("2026-07-20 11:00:00").cast("timestamp")
    found = values(spark, rows, "t timestamp", time.age_minutes(F.col("t"), as_of), time.stale_tier(F.col("t"), as_of))
    assert found == [(0, "FRESH"), (120, "STALE_1H"), (0, "FRESH"), (None, "UNKNOWN")]
