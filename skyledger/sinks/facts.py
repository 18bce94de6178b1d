"""Upsert into a Parquet table by rewriting only the days it touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.upserts import merge_alerts, upsert
from skyledger.schema import LOGICAL_KEY
from skyledger.sinks.files import beside, delete_folder, exists

FACT_DAY, ALERT_DAY = "forecast_date", "alert_date"


def write_days(df: DataFrame, path: str, day: str) -> None:
    """Write a table in one folder per day; the folders of the days written are replaced."""
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def distinct_days(df: DataFrame, day: str) -> list:
    """The days a table has rows of; as many as the calendar has."""
    return sorted(row[0] for row in df.select(day).distinct().collect() if row[0] is not None)


def rewrite_days(
    spark: SparkSession, path: str, days: Sequence, day: str, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """Replace ``days`` by ``merge(stored rows of those days)``.

    The days are named in the filter, so only their folders are read. The merged
    rows go through a table beside this one, as a path must not be overwritten while
    it is read; a job that dies before the last write leaves the table as it was. A
    day without merged rows loses its folder, which a dynamic overwrite would keep.
    """
    stored = spark.read.parquet(path).where(F.col(day).isin(list(days)))
    with beside(spark, path) as staging:
        merge(stored).write.parquet(staging)
        merged = spark.read.parquet(staging)
        filled = {str(value) for value in distinct_days(merged, day)}
        write_days(merged, path, day)
        for value in days:
            if str(value) not in filled:
                delete_folder(spark, f"{path.rstrip('/')}/{day}={value}")


def batches_path(path: str) -> str:
    return f"{path.rstrip('/')}.batches"


def batch_days(facts: DataFrame) -> DataFrame:
    """The days of each batch among facts: batch_id, forecast_date, ingested_at, first_time and row_count."""
    return facts.groupBy("batch_id", FACT_DAY).agg(
        F.max("ingested_at").alias("ingested_at"),
        F.min("forecast_time").alias("first_time"),
        F.count(F.lit(1)).alias("row_count"),
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The stored map of batches to the days they brought, which serving prunes with."""
    return spark.read.parquet(batches_path(path))


def upsert_facts(
    spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str] = LOGICAL_KEY
) -> None:
    """Insert or replace facts by their key, then add the batches' days to the map beside the table.

    Incoming rows are computed once. The map comes after the rows it speaks of; a
    run that dies in between is to be done again, which adds the same entries.
    """
    with beside(spark, f"{path.rstrip('/')}.incoming") as staging:
        incoming.withColumn(FACT_DAY, F.to_date("forecast_time")).write.parquet(staging)
        dated = spark.read.parquet(staging)
        if not exists(spark, path):
            write_days(dated, path, FACT_DAY)
        else:
            days = distinct_days(dated, FACT_DAY)
            rewrite_days(spark, path, days, FACT_DAY, lambda stored: upsert(stored, dated, keys))
        batch_days(dated).coalesce(1).write.mode("append").parquet(batches_path(path))


def upsert_alerts(spark: SparkSession, path: str, batch: DataFrame, fresh: DataFrame) -> None:
    """Merge the alerts of a judged batch; see :func:`merge_alerts`."""
    dated = fresh.withColumn(ALERT_DAY, F.to_date("alert_time"))
    if not exists(spark, path):
        write_days(dated, path, ALERT_DAY)
        return
    judged = distinct_days(batch.select(F.to_date("forecast_time").alias(ALERT_DAY)), ALERT_DAY)

    def merge(stored: DataFrame) -> DataFrame:
        return merge_alerts(stored, batch, dated)

    rewrite_days(spark, path, judged, ALERT_DAY, merge)
