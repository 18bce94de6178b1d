"""From raw documents to one clean batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.time import parse_instant
from skyledger.sources.raw import explode_documents, failures, record_count, with_failure


@dataclass(frozen=True)
class Transformed:
    rows: DataFrame
    failures: DataFrame
    summary: DataFrame


def transform(raw: DataFrame, source: str) -> Transformed:
    """Clean rows, rejected documents and one summary row per batch.

    A repeated key fails its whole batch, so the summary counts repeated keys
    and only batches without any are loadable.
    """
    documents = with_failure(raw, source)
    return Transformed(
        rows=explode_documents(documents),
        failures=failures(documents),
        summary=summary(documents),
    )


#: What tells the rows of a batch apart besides their time.
SERIES = ("batch_id", "point_id", "source")


def summary(documents: DataFrame) -> DataFrame:
    """Counts and status of every batch, from one pass over the documents.

    A document is unrolled to its times alone, without its measures, and counts with
    the first of them; a rejected one gives a row without a time. Rows are counted
    by key and then summed by batch, so repeated hours are found within a document
    and between documents of one point alike.
    """
    ok = F.col("failure").isNull()
    unrolled = documents.select(
        *SERIES, ok.alias("ok"), record_count().alias("records"), F.posexplode_outer(F.when(ok, F.col("hourly.time"))).alias("place", "text")
    )
    first = F.coalesce("place", F.lit(0)) == 0
    cells = unrolled.groupBy(*SERIES, parse_instant(F.col("text")).alias("time")).agg(
        F.count("text").alias("n"),
        F.count_if(first).alias("objects"),
        F.count_if(first & F.col("ok")).alias("good"),
        F.sum(F.when(first & F.col("ok"), F.col("records"))).alias("records"),
    )
    return (
        cells.groupBy("batch_id")
        .agg(
            F.sum("objects").alias("input_objects"),
            F.sum("good").alias("successful_objects"),
            F.sum(F.col("objects") - F.col("good")).alias("failed_objects"),
            F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records_transformed"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        )
        .withColumn("status", _status())
    )


def _status() -> Column:
    return (
        F.when((F.col("records_transformed") == 0) | (F.col("duplicate_rows") > 0), "FAILED")
        .when(F.col("failed_objects") > 0, "PARTIAL_SUCCESS")
        .otherwise("SUCCESS")
    )


def clean_batches(result: Transformed) -> DataFrame:
    """Rows of the batches that did not fail."""
    usable = result.summary.where(F.col("status") != "FAILED").select("batch_id")
    return result.rows.join(usable, "batch_id", "left_semi")
