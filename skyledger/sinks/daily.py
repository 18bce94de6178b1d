"""The daily mart, kept up to date batch by batch.

Beside the summary lie the hour states it is made of (``plans.states``) and a
ledger of the batches already in them (``sources.ledger``), all below one root:

* a new valid batch merges its states into those of the days it reaches;
* a batch that was rewritten, became unusable or went away is taken out by making
  the days it reached, and reaches now, anew from the valid batches of those days;
* a batch that is unusable from the start touches nothing;
* days are summarised from their states, and only touched days are written.

The ledger is written last. A run that dies before that is done again by the next
one: merging the same hours twice, or making a day twice, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyledger.plans import marts, states
from skyledger.schema import HISTORY_SCHEMA
from skyledger.sinks.facts import rewrite_days, write_days
from skyledger.sinks.files import exists
from skyledger.sources import ledger

STATES, SUMMARY, LEDGER = "daily_states", "daily_summary", "batch_ledger"


def reached(entries: DataFrame) -> tuple[list[str], list[str]]:
    """Days to make anew, and days that only gain rows; as many as the calendar has.

    An entry that was valid reaches the days it had and those it has now.
    """
    none = F.array().cast("array<string>")
    had = F.when(F.col("was_valid"), F.coalesce("old_days", none)).otherwise(none)
    has = F.when(F.col("is_valid"), F.coalesce("days", none)).otherwise(none)
    days = entries.select("was_valid", F.explode(F.concat(had, has)).alias(states.DAY)).distinct().collect()
    again = {day for was_valid, day in days if was_valid}
    return sorted(again), sorted({day for was_valid, day in days if not was_valid})


def rows_of(spark: SparkSession, root: str, batches: DataFrame) -> DataFrame:
    """History rows of some batches, by folder if they are few enough to be named."""
    history = spark.read.schema(HISTORY_SCHEMA).parquet(root)
    names = [row.batch_id for row in batches.select("batch_id").limit(ledger.NAMED + 1).collect()]
    return ledger.only(history, names if len(names) <= ledger.NAMED else None, batches)


def put(spark: SparkSession, path: str, fresh: DataFrame, days: list[str], merge: bool) -> None:
    """Write states of ``days``: merged into the stored ones, or in their place."""
    if not exists(spark, path):
        write_days(fresh, path, states.DAY)
        return

    def replaced(stored: DataFrame) -> DataFrame:
        return states.merged(stored.withColumn(states.DAY, F.col(states.DAY).cast("string")), fresh) if merge else fresh

    rewrite_days(spark, path, days, states.DAY, replaced)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its day as text, as folders of days would be read as dates."""
    kinds = [(f.name, f.dataType) for f in spark.read.parquet(path).schema]
    schema = StructType([StructField(n, StringType() if n == states.DAY else kind) for n, kind in kinds])
    return spark.read.schema(schema).parquet(path)


def update(
    spark: SparkSession, history_root: str, locations: DataFrame, created_at: Column, root: str, announced: DataFrame | None = None
) -> list[str]:
    """Bring the daily mart up to date with the history; the days that were written.

    ``announced`` (batch_id, announced_count) is compared with what batches hold.
    """
    found = ledger.changes(spark, history_root, f"{root}/{LEDGER}", announced)
    entries = found.entries
    added = entries.where("is_valid AND NOT was_valid")
    again, more = reached(entries)
    path = f"{root}/{STATES}"
    if again:
        # Entries known before, without the changed ones, and the changed ones as they are now.
        others = ledger.read(spark, f"{root}/{LEDGER}").join(entries, "batch_id", "left_anti").where("is_valid")
        valid = others.select("batch_id", "days").unionByName(entries.where("is_valid").select("batch_id", "days"))
        reaching = valid.where(F.arrays_overlap("days", F.array(*[F.lit(day) for day in again])))
        rows = rows_of(spark, history_root, reaching)
        made = states.of_rows(rows).where(F.col(states.DAY).isin(again))
        put(spark, path, made, again, merge=False)
    if more:
        put(spark, path, states.of_rows(rows_of(spark, history_root, added)), more, merge=True)
    days = sorted({*again, *more})
    if days:
        summarise(spark, root, days, locations, created_at)
    found.commit()
    entries.unpersist()
    return days


def summarise(spark: SparkSession, root: str, days: list[str], locations: DataFrame, created_at: Column) -> None:
    """Write the summary of some days from their states."""
    touched = stored(spark, f"{root}/{STATES}").where(F.col(states.DAY).isin(days))
    hours = states.hours(touched)
    summary = marts.days_of_hours(hours, locations, created_at)
    path = f"{root}/{SUMMARY}"
    if not exists(spark, path):
        write_days(summary, path, states.DAY)
        return
    rewrite_days(spark, path, days, states.DAY, lambda _: summary)


def read(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored daily summary, of the days from ``first`` to ``last``; the bounds prune folders."""
    rows = stored(spark, f"{root}/{SUMMARY}")
    for bound, holds in ((first, F.col(states.DAY) >= first), (last, F.col(states.DAY) <= last)):
        rows = rows.where(holds) if bound is not None else rows
    return rows
