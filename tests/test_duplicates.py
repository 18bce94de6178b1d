from pyspark.sql import functions as F

from skyledger.operators import duplicates


def brute(rows):
    seen = {}
    for _, a, b in rows:
        seen[(a, b)] = seen.get((a, b), 0) + 1
    return {i: seen[(a, b)] > 1 for i, a, b in rows}


def test_flags_match_brute_force_with_hot_and_missing_keys(spark):
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append((i, "HOT", 1))
        elif i % 50 == 1:
            rows.append((i, None, i % 2))
        elif i % 7 == 2:
            rows.append((i, f"k{i % 20}", None))
        else:
            rows.append((i, f"k{i}", i))
    df = spark.createDataFrame(rows, "id int, a string, b int").repartition(6)
    flagged = duplicates.flag_duplicates(df, ["a", "b"], "twice")
    found = [(r.id, r.twice) for r in flagged.collect()]
    assert len(found) == len(rows)
    assert dict(found) == brute(rows)
    assert flagged.columns == ["id", "a", "b", "twice"]


def test_only_the_bounded_list_of_hot_keys_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(F.col("id"), (F.col("id") % 10).alias("k"))
        plan = duplicates.flag_duplicates(df, ["k"], "twice")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1
    assert "SortMergeJoin" in plan and "Window" not in plan


def test_hot_rows_are_spread(spark):
    """The slice makes rows of one hot key hash to different partitions."""
    df = spark.range(0, 8000, 1, 8).select("id", F.lit("HOT").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = duplicates.flag_duplicates(df, ["k"], "twice")
        used = flagged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(used) > 1 and sum(r["count"] for r in used) == 8000


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert sorted((r.k is None, r.row_count) for r in duplicates.duplicate_keys(df, ["k"]).collect()) == [
        (False, 2),
        (True, 2),
    ]
