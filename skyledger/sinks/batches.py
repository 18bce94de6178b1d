"""Batch tables: one folder per date, hour and batch, rewritten as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from skyledger.functions.time import partition_date, partition_hour
from skyledger.plans.quality import Grading
from skyledger.sinks.files import beside, delete_folder, exists

PARTITIONS = ("date", "hour", "batch_id")


def with_partitions(rows: DataFrame, started_at: Column) -> DataFrame:
    """Add the local date and hour in which the batch started."""
    return rows.withColumns({"date": partition_date(started_at), "hour": partition_hour(started_at)})


def write_batches(rows: DataFrame, root: str) -> None:
    """Write batches; folders of the same batch are replaced, others stay.

    Rebalancing gives each folder few files, yet splits a batch that is far
    larger than the others over several tasks.
    """
    (
        rows.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITIONS)
        .parquet(root)
    )


def drop_stale(graded: DataFrame, written: DataFrame, root: str) -> list[str]:
    """Delete folders of graded batches that now have no rows to write.

    A dynamic overwrite leaves such folders alone, so an earlier run's rows
    would stay. The list is as long as the number of batches of this run.
    """
    spark = graded.sparkSession
    keys = graded.select(*PARTITIONS).distinct()
    stale = keys.join(written.select(*PARTITIONS).distinct(), list(PARTITIONS), "left_anti")
    deleted = []
    for row in stale.toLocalIterator():
        folder = "/".join([root, *[f"{name}={row[name]}" for name in PARTITIONS]])
        if exists(spark, folder):
            delete_folder(spark, folder)
            deleted.append(folder)
    return deleted


def write_grading(
    grading: Grading, clean_root: str, bad_root: str, then: Callable[[Grading], None] | None = None
) -> None:
    """Valid rows and the quarantine of the same batches, safe to run again.

    Rules are evaluated once: the judged rows are written beside the clean table,
    and everything else reads them from there, also ``then``, which gets the stored
    grading for reports and logs. The readings carry the columns of ``PARTITIONS``.
    """
    spark = grading.judged.sparkSession
    with beside(spark, f"{clean_root.rstrip('/')}.judged") as staging:
        stored = grading.stored(staging)
        for rows, root in ((stored.valid, clean_root), (stored.bad, bad_root)):
            rows = rows.drop(grading.batch) if grading.batch not in PARTITIONS else rows
            write_batches(rows, root)
            drop_stale(stored.judged, rows, root)
        if then is not None:
            then(stored)
