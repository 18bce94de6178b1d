"""Mart tables and their build log."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.audits import dataset_audit
from skyledger.plans import marts
from skyledger.sinks.files import exists

BUILD_LOG = "build_log"


def build_marts(
    history: DataFrame, locations: DataFrame, created_at: Column, root: str, partition: str
) -> None:
    """Write the marts of one build, then append its log row.

    The summaries are taken from the stored current mart. Readers find their
    partition in the log, so a build that dies half way is never seen.
    """
    spark = history.sparkSession

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}/{partition}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    planned = marts.build(history, locations, created_at)
    current = store("current", planned["current"])
    built = {
        "current": current,
        "location_summary": store("location_summary", marts.location_summary(current, created_at)),
        "daily_summary": store("daily_summary", planned["daily_summary"]),
    }
    summary = marts.build_summary(history, locations, built)
    summary.withColumn("partition", F.lit(partition)).write.mode("append").parquet(f"{root}/{BUILD_LOG}")


#: Key columns of each mart.
MART_KEYS = {
    "current": ["point_id"],
    "location_summary": ["location_id"],
    "daily_summary": ["forecast_date", "point_id"],
}


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart of the newest successful build whose stored rows match its log row.

    Builds are tried from the newest on; a damaged one is passed over.
    """
    log = spark.read.parquet(f"{root}/{BUILD_LOG}").where(F.upper("status") == "SUCCESS")
    builds = log.groupBy("partition").agg(F.max(f"{name}_rows").alias("rows")).orderBy(F.desc("partition"))
    for build in builds.toLocalIterator():
        path = f"{root}/{name}/{build.partition}"
        if not exists(spark, path):
            continue
        mart = spark.read.parquet(path)
        audit = dataset_audit(mart, name, MART_KEYS[name], F.lit(build.rows).cast("bigint"))
        try:
            if audit.first().is_valid:
                return mart
        except PySparkException:
            # Files that cannot be read make a build as unusable as missing rows.
            continue
    raise ValueError(f"no valid build of {name} in {root}")
