"""Dimension joins, anti and semi joins, set differences, positional joins.

No join here forces a broadcast of a table that can grow. Spark broadcasts a
side when its size is below ``spark.sql.autoBroadcastJoinThreshold`` and else
sorts and merges, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.functions.clean import is_active
from skyledger.operators.ranking import keep_first


def distinct_dimension(dimension: DataFrame, key: str, load_order: str | None) -> DataFrame:
    """One row per id: the last one in load order."""
    if load_order is None:
        return dimension
    return keep_first(dimension, [key], [F.col(load_order).desc_nulls_last()])


def unique_dimension(dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The dimension for a many-to-one join; a repeated id stops the job."""
    counted = dimension.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.min(c).alias(c) for c in columns]
    )
    repeated = F.concat(F.lit(f"{key} is not unique: "), F.col(key))
    # The key is checked too, as a join that needs no other column would drop their checks.
    return counted.select(
        *[F.when(F.col("_rows") > 1, F.raise_error(repeated)).otherwise(F.col(c)).alias(c) for c in (key, *columns)]
    )


def enrich_locations(
    readings: DataFrame, locations: DataFrame, load_order: str | None = None
) -> DataFrame:
    """Add location name and region; readings of unknown locations stay.

    Ids must be unique, unless ``load_order`` says which row is the last.
    """
    last = distinct_dimension(locations, "location_id", load_order)
    names = unique_dimension(last, "location_id", ["location_name", "region"])
    return readings.drop("location_name", "region").join(names, "location_id", "left")


def star(facts: DataFrame, points: DataFrame, locations: DataFrame) -> DataFrame:
    """Facts with the attributes of their point and location; a repeated id stops the job."""
    point = unique_dimension(points, "point_id", ["point_name", "point_type", "latitude", "longitude"])
    location = unique_dimension(locations, "location_id", ["location_name", "region", "admin_type"])
    bare = facts.drop("point_name", "point_type", "latitude", "longitude")
    return bare.join(point, "point_id").join(location, "location_id")


def active_points(points: DataFrame, locations: DataFrame) -> DataFrame:
    """Active points of active locations."""
    location = locations.where(is_active(F.col("is_active"))).select(
        "location_id", "location_name", "region", "admin_type"
    )
    return points.where(is_active(F.col("is_active"))).join(location, "location_id")


def missing_keys(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Ids used by the rows that the dimension does not hold.

    The ids are made distinct first, so a hot id is one row in the join.
    """
    used = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return used.join(dimension.select(key), key, "left_anti")


def orphan_points(points: DataFrame, locations: DataFrame) -> DataFrame:
    """Active points whose location is not active or not there."""
    active = locations.where(is_active(F.col("is_active")))
    home = active.select(clean.strip("location_id").alias("_location_id"))
    return (
        points.where(is_active(F.col("is_active")))
        .withColumn("_location_id", clean.strip("location_id"))
        .join(home, "_location_id", "left_anti")
        .drop("_location_id")
    )


def difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not have."""
    return left.select(*columns).distinct().subtract(right.select(*columns))


#: Groups of a block, about.
BLOCK = 1024


def _listed(column: str) -> Column:
    """Aggregate: all values as a list, nulls too."""
    empty = F.count_if(F.col(column).isNull()).cast("int")
    return F.concat(F.collect_list(column), F.array_repeat(F.lit(None), empty))


def missing_by_group(present: DataFrame, expected: DataFrame, group: str, key: str) -> DataFrame:
    """(group, key) for every expected id that a group lacks.

    Groups are dealt into blocks by hash. Each id gets the groups of a block that hold
    it as one short list, and what the block's own list has beyond that is unrolled. So
    only the rows and the ids are exchanged, never a pair that is missing, and no list is
    longer than a block.
    """
    ids = expected.select(key).distinct()
    named = present.select(F.col(group).alias("_group"), F.nullif(clean.strip(F.col(key)), F.lit("")).alias(key)).distinct()
    groups = named.select("_group").distinct()
    blocks = F.greatest(F.ceil(groups.agg(F.count(F.lit(1))).scalar() / BLOCK).cast("int"), F.lit(1))
    block = F.pmod(F.xxhash64("_group"), blocks).cast("int").alias("_block")
    every = groups.groupBy(block).agg(_listed("_group").alias("_every"))
    there = named.where(F.col(key).isNotNull()).groupBy(key, block).agg(_listed("_group").alias("_there"))
    places = ids.select(key, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"))
    lists = places.join(there, [key, "_block"], "left").join(every, "_block")
    lacking = F.when(F.col("_there").isNull(), F.col("_every")).otherwise(F.array_except("_every", "_there"))
    return lists.select(F.explode(lacking).alias(group), key)


def coverage_by_group(present: DataFrame, expected: DataFrame, group: str, key: str) -> DataFrame:
    """Per group (such as a batch): every id as MISSING, UNEXPECTED or PRESENT."""
    named = present.select(group, clean.strip(F.col(key)).alias(key)).where(F.col(key) != "").distinct()
    want = unique_dimension(expected.select(key), key, []).withColumn("_want", F.lit(1))
    state = F.when(F.col("_want").isNull(), "UNEXPECTED").otherwise("PRESENT")
    there = named.join(want, key, "left").select(group, key, state.alias("coverage"))
    return there.unionByName(missing_by_group(present, expected, group, key).withColumn("coverage", F.lit("MISSING")))


def coverage(present: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Full comparison of two id sets: MISSING, UNEXPECTED or PRESENT."""
    have = present.select(key).where(clean.strip(F.col(key)) != "").distinct().withColumn("_have", F.lit(1))
    want = expected.select(key).distinct().withColumn("_want", F.lit(1))
    state = (
        F.when(F.col("_have").isNull(), "MISSING")
        .when(F.col("_want").isNull(), "UNEXPECTED")
        .otherwise("PRESENT")
    )
    return have.join(want, key, "full_outer").select(key, state.alias("coverage"))


def zip_responses(requests: DataFrame, responses: DataFrame, key: str = "request_id") -> DataFrame:
    """Pair the i-th requested point with the i-th response of the same request.

    ``requests`` has (key, points: array), ``responses`` (key, responses:
    array). A request whose two lists differ in length pairs nothing.
    """
    both = requests.join(responses, key).where(F.size("points") == F.size("responses"))
    return both.select(
        key, F.posexplode(F.arrays_zip("points", "responses")).alias("position", "pair")
    ).select(key, "position", F.col("pair.points").alias("point"), F.col("pair.responses").alias("response"))
