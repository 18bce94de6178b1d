"""Ledger of the batches below a history root, so that only changed batches are read again.

An entry says of a batch: the files it had, whether it may be used and why not, and
the local days it reaches. Files are told by name, size and time of change, which a
listing gives without opening them. A refresh lists the root, reads the batches whose
files differ from their newest entry, and appends one entry for each of them; a batch
without files gets an entry that says so. Appending is what makes a change known, so
whoever acts on changes does that first and may simply start again after a crash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.time import local_day
from skyledger.schema import HISTORY_SCHEMA
from skyledger.sinks.files import exists
from skyledger.sources.tables import history_report, partition_parts

SCHEMA = (
    "batch_id string, partition_date string, partition_hour string, signature string, files bigint, "
    "record_count bigint, invalid_times bigint, duplicate_rows bigint, empty_columns array<string>, "
    "is_valid boolean, days array<string>, generation bigint"
)
#: Changed batches that are named in a filter, which prunes folders; more are found by a join.
NAMED = 2_000


@dataclass(frozen=True)
class Changes:
    """What a refresh found: the entries to append, beside the ones they replace."""

    entries: DataFrame  # columns of SCHEMA, was_valid, old_days
    path: str
    count: int

    def commit(self) -> None:
        """Append the entries; from now on the changes count as known."""
        if self.count:
            names = [field.split()[0] for field in SCHEMA.split(", ")]
            self.entries.select(*names).coalesce(1).write.mode("append").parquet(self.path)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """Batches below ``root`` with their folder and the signature of their files; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    name = F.element_at(F.split("path", "/"), -1)
    one = F.concat_ws(":", name, "length", F.unix_micros("modificationTime"))
    found = files.load(root).select(*partition_parts(F.col("path")), one.alias("file")).where(F.col("batch_id").isNotNull())
    return found.groupBy("batch_id").agg(
        F.max("partition_date").alias("partition_date"),
        F.max("partition_hour").alias("partition_hour"),
        F.sha2(F.array_join(F.array_sort(F.collect_list("file")), "|"), 256).alias("signature"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every batch that has files."""
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    entries = spark.read.schema(SCHEMA).parquet(path)
    newest = entries.groupBy("batch_id").agg(F.max_by(F.struct(*entries.columns), "generation").alias("entry"))
    return newest.select("entry.*").where(F.col("signature").isNotNull())


def only(rows: DataFrame, batches: list[str] | None, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted batches: by folder if they are few enough to be named."""
    if batches is not None:
        return rows.where(F.col("batch_id").isin(batches))
    return rows.join(wanted.select("batch_id"), "batch_id", "left_semi")


def changes(spark: SparkSession, root: str, path: str, announced: DataFrame | None = None) -> Changes:
    """Compare the root with the ledger and read the batches that are new or different."""
    known = read(spark, path)
    now = listed(spark, root)
    same = now.select("batch_id", "signature").join(known.select("batch_id", "signature"), ["batch_id", "signature"])
    fresh = now.join(same, "batch_id", "left_anti").persist()
    gone = known.join(now, "batch_id", "left_anti")
    generation = (known.agg(F.max("generation")).first()[0] or 0) + 1
    names = [row.batch_id for row in fresh.select("batch_id").limit(NAMED + 1).collect()]
    names = names if len(names) <= NAMED else None
    report = history_report(spark, root, announced, lambda rows: only(rows, names, fresh))
    rows = spark.read.schema(HISTORY_SCHEMA).option("ignoreCorruptFiles", "true").parquet(root)
    days = only(rows, names, fresh).groupBy("batch_id").agg(F.array_sort(F.collect_set(local_day(F.col("forecast_time")))).alias("days"))
    kept = ["files", "record_count", "invalid_times", "duplicate_rows", "empty_columns", "is_valid"]
    entries = fresh.join(report.select("batch_id", *kept), "batch_id", "left").join(days, "batch_id", "left")
    removed = gone.select("batch_id", "partition_date", "partition_hour")
    both = entries.withColumn("is_valid", F.coalesce("is_valid", F.lit(False))).unionByName(
        removed.withColumn("is_valid", F.lit(False)), allowMissingColumns=True
    )
    before = known.select("batch_id", F.col("is_valid").alias("was_valid"), F.col("days").alias("old_days"))
    every = both.join(before, "batch_id", "left").withColumns(
        {"generation": F.lit(generation).cast("bigint"), "was_valid": F.coalesce("was_valid", F.lit(False))}
    )
    every = every.persist()
    count = every.count()
    fresh.unpersist()
    return Changes(every, path, count)
