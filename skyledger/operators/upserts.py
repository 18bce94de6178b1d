"""Upserts, merges, purges and backups as plain set operations on tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.operators.ranking import latest_wins


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``existing`` with those of ``incoming`` inserted or replaced.

    Columns the incoming table lacks, and those in ``keep``, stay as they were
    on a replaced row. Keys must be unique on both sides.
    """
    old = existing.select(*[F.col(c).alias(f"_old_{c}") if c not in keys else F.col(c) for c in existing.columns])
    old = old.withColumn("_is_old", F.lit(True))
    new = incoming.withColumn("_is_new", F.lit(True))
    joined = old.join(new, list(keys), "full_outer")

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in incoming.columns:
            return F.col(f"_old_{name}").alias(name)
        if name in keep:
            return (
                F.when(F.col("_is_old"), F.col(f"_old_{name}")).otherwise(F.col(name)).alias(name)
            )
        return F.when(F.col("_is_new"), F.col(name)).otherwise(F.col(f"_old_{name}")).alias(name)

    return joined.select(*[pick(c) for c in existing.columns])


def upsert_counts(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], time: str
) -> DataFrame:
    """How many incoming rows insert and how many update.

    Only existing rows within the incoming time range are read.
    """
    low = incoming.agg(F.min(time)).scalar()
    high = incoming.agg(F.max(time)).scalar()
    known = (
        existing.where((F.col(time) >= low) & (F.col(time) <= high))
        .select(*keys)
        .withColumn("_known", F.lit(True))
    )
    joined = incoming.select(*keys).join(known, list(keys), "left")
    return joined.agg(
        F.count(F.lit(1)).alias("processed_rows"),
        F.count_if(F.col("_known").isNull()).alias("inserted_rows"),
        F.count_if(F.col("_known")).alias("updated_rows"),
    )


def upsert_dimension(
    existing: DataFrame, incoming: DataFrame, key: str, as_of: Column
) -> DataFrame:
    """Dimension upsert: created_at stays, updated_at moves for every incoming row."""
    stamped = incoming.withColumns({"created_at": as_of, "updated_at": as_of})
    return upsert(existing, stamped, [key], keep=["created_at"])


def upsert_log(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Log upsert: the newest row per key of both tables."""
    return latest_wins(existing.unionByName(incoming, allowMissingColumns=True), keys, newest)


def merge_alerts(existing: DataFrame, batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """Alerts after a batch was judged.

    Every reading of the batch takes its old alerts along: those of another
    severity vanish, one of the same severity is rewritten but keeps its status
    and creation time. Alerts of readings outside the batch stay.
    """
    touched = batch.select("point_id", F.col("forecast_time").alias("alert_time"), "source")
    untouched = existing.join(touched, ["point_id", "alert_time", "source"], "left_anti").select(
        *existing.columns
    )
    key = ["point_id", "alert_time", "severity", "source"]
    kept = existing.select(*key, F.col("status").alias("_status"), F.col("created_at").alias("_created"))
    rewritten = (
        fresh.join(kept, key, "left")
        .withColumns(
            {
                "status": F.coalesce("_status", "status"),
                "created_at": F.coalesce("_created", "created_at"),
            }
        )
        .select(*existing.columns)
    )
    return untouched.unionByName(rewritten)


def is_unassigned(batch: str = "batch_id", stage: str = "stage_name") -> Column:
    return clean.is_blank(F.col(batch)) | clean.is_blank(F.col(stage))


def purge_orphan_checks(checks: DataFrame, runs: DataFrame) -> DataFrame:
    """Checks without those whose run has no batch or no stage."""
    return checks.join(runs.where(is_unassigned()).select("run_id"), "run_id", "left_anti")


def backup_rows(
    rows: DataFrame,
    key: str,
    reason: str,
    backups: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows as JSON with a reason, once per id and reason."""
    packed = rows.select(
        F.col(key).cast("string").alias("original_id"),
        F.lit(reason).alias("backup_reason"),
        F.to_json(F.struct(*(columns or rows.columns))).alias("row_data"),
    )
    unique = packed.groupBy("original_id", "backup_reason").agg(F.min("row_data").alias("row_data"))
    if backups is None:
        return unique
    return unique.join(backups, ["original_id", "backup_reason"], "left_anti")


def backfill_batch_id(rows: DataFrame, sentinel: str) -> DataFrame:
    return rows.withColumn("batch_id", clean.text_or(F.col("batch_id"), F.lit(sentinel)))
