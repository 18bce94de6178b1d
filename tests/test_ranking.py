from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.operators import ranking

AT = datetime(2026, 7, 20, 9)
SCHEMA = "point_id string, forecast_time timestamp, ingested_at timestamp, batch_id string, us_aqi int"


def rows(spark):
    early, late = datetime(2026, 7, 20, 1), datetime(2026, 7, 20, 2)
    return spark.createDataFrame(
        [
            ("A", datetime(2026, 7, 20, 8), early, "OLD", 40),
            ("A", datetime(2026, 7, 20, 10), early, "OLD", 80),
            ("A", datetime(2026, 7, 20, 8), late, "NEW", 60),
            ("B", None, late, "NEW", 10),
            ("B", datetime(2026, 7, 22, 8), late, "NEW", 20),
        ],
        SCHEMA,
    )


@pytest.mark.parametrize("tie, index", [("future", 80), ("past", 60)])
def test_tie_between_two_hours(spark, tie, index):
    reference = F.lit(AT).cast("timestamp")
    found = ranking.nearest_in_time(rows(spark), reference, tie=tie, then=[F.col("ingested_at").desc()])
    assert {r.point_id: r.us_aqi for r in found.collect()} == {"A": index, "B": 20}


def test_unknown_tie(spark):
    with pytest.raises(ValueError):
        ranking.nearest_in_time(rows(spark), F.lit(AT), tie="both")


def test_latest_wins(spark):
    found = ranking.latest_wins(rows(spark).where("point_id = 'A'")).collect()
    assert sorted((r.forecast_time.hour, r.batch_id, r.us_aqi) for r in found) == [(8, "NEW", 60), (10, "OLD", 80)]


def test_order_of_rows_does_not_matter(spark):
    shuffled = rows(spark).repartition(7, F.rand(1))
    assert sorted(map(tuple, ranking.latest_wins(shuffled).collect()), key=str) == sorted(
        map(tuple, ranking.latest_wins(rows(spark)).collect()), key=str
    )


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    top = ranking.keep_top(df.repartition(6), ["k"], [F.col("id").desc()], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")
    assert sorted(r.id for r in top.where("k = 'HOT'").collect()) == [29994, 29997]


def test_worst_member(spark):
    df = spark.createDataFrame([("L", "b", 9), ("L", "a", 9), ("L", "c", None), ("M", "z", None)], "l string, p string, x int")
    worst = ranking.smallest(["p", "x"], ranking.worst_first("x", "p"))
    found = {r.l: (r.w.p, r.w.x) for r in df.groupBy("l").agg(worst.alias("w")).collect()}
    assert found == {"L": ("a", 9), "M": ("z", None)}
