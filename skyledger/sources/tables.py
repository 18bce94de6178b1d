"""Readers of partitioned history, single batches and CSV dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.operators.audits import batch_validity
from skyledger.schema import HISTORY_SCHEMA, REQUIRED_TEXT

#: Columns that hold a value in at least one row of any sound batch.
REQUIRED_COLUMNS = (*[c for c in REQUIRED_TEXT if c != "batch_id"], "forecast_time", "ingested_at")

# Fixed value: layout of one batch below a table root.
PARTITION_PATTERN = r"date=(\d{4}-\d{2}-\d{2})/hour=(\d{2})/batch_id=([^/]+)/[^/]+\.parquet$"


def read_history(
    spark: SparkSession,
    root: str,
    date: str | None = None,
    hour: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """All batches below ``root``; date, hour and batch prune folders.

    The schema is given, so that an hour ``05`` or a batch id of digits stays a
    text. A file that cannot be read stops the job; :func:`read_history_isolated`
    goes on without its batch.
    """
    df = spark.read.schema(HISTORY_SCHEMA).parquet(root)
    for name, wanted in (("date", date), ("hour", hour), ("batch_id", batch)):
        if wanted is not None:
            df = df.where(F.col(name) == wanted)
    return df


def history_report(
    spark: SparkSession,
    root: str,
    announced: DataFrame | None = None,
    only: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Every batch that has a folder or an announced count, and whether it may be used.

    A batch is valid if each of its files gave rows, none of its contract columns
    is without any value, its times and keys are sound, and its rows are as many
    as ``announced`` (batch_id, announced_count) says. A file that is destroyed or
    empty gives no rows; one that breaks off gives too few. ``only`` picks the batches
    to read by their ``batch_id``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    listed = files.load(root).select(*partition_parts(F.col("path")))
    listed = only(listed.groupBy("batch_id").agg(F.count(F.lit(1)).alias("files")))
    rows = spark.read.schema(HISTORY_SCHEMA).option("ignoreCorruptFiles", "true").parquet(root)
    rows = only(rows.withColumn("_file", F.col("_metadata.file_path")))
    per_file = rows.groupBy("batch_id", "_file").agg(*[F.count(c).alias(c) for c in REQUIRED_COLUMNS])
    empty = F.array(*[F.when(F.sum(c) == 0, F.lit(c)) for c in REQUIRED_COLUMNS])
    read = per_file.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("files_read"), F.array_compact(empty).alias("empty_columns")
    )
    sound = batch_validity(rows).withColumnRenamed("is_valid", "_sound")
    if announced is None:
        announced = listed.select("batch_id", F.lit(None).cast("bigint").alias("announced_count"))
    report = (
        listed.join(announced, "batch_id", "full_outer")
        .join(read, "batch_id", "left")
        .join(sound, "batch_id", "left")
        .fillna(0, ["files", "files_read", "record_count"])
    )
    good = (
        F.col("_sound")
        & (F.col("files") == F.col("files_read"))
        & (F.size("empty_columns") == 0)
        & F.coalesce(F.col("record_count") == F.col("announced_count"), F.lit(True))
    )
    return report.withColumn("is_valid", F.coalesce(good, F.lit(False))).drop("_sound")


def read_history_isolated(
    spark: SparkSession, root: str, announced: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of the valid batches, and the report that lists every other one."""
    report = history_report(spark, root, announced)
    rows = spark.read.schema(HISTORY_SCHEMA).option("ignoreCorruptFiles", "true").parquet(root)
    return rows.join(report.where("is_valid").select("batch_id"), "batch_id", "left_semi"), report


def partition_parts(path: Column) -> list[Column]:
    """Date, hour and batch id of a file path, as three columns."""
    names = ("partition_date", "partition_hour", "batch_id")
    return [
        F.nullif(F.regexp_extract(path, PARTITION_PATTERN, i + 1), F.lit("")).alias(name)
        for i, name in enumerate(names)
    ]


def valid_history(history: DataFrame, batch: str = "batch_id") -> DataFrame:
    """History without the batches that have repeated rows or unusable times."""
    good = batch_validity(history, batch).where("is_valid").select(batch)
    return history.join(good, batch, "left_semi")


def skipped_batches(history: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Every skipped batch for the build report."""
    return batch_validity(history, batch).where("NOT is_valid").select(batch, "invalid_times", "duplicate_rows")


LOAD_ORDER = "load_order"


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV dimension as text with ``load_order``; the literal ``NA`` stays a text.

    The order follows the lines of a file, which is what "the last row wins" needs.
    """
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    return df.select(*columns, F.monotonically_increasing_id().alias(LOAD_ORDER))


LOCATION_FILE_COLUMNS = ("location_id", "location_name", "region", "admin_type", "is_active")
POINT_FILE_COLUMNS = (
    "point_id",
    "location_id",
    "point_name",
    "point_type",
    "latitude",
    "longitude",
    "is_active",
)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, LOCATION_FILE_COLUMNS)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    points = read_csv(spark, path, POINT_FILE_COLUMNS)
    return points.withColumns(
        {c: clean.to_number(F.col(c)) for c in ("latitude", "longitude")}
    )


POINT_TEXTS = ("point_id", "location_id", "point_name", "point_type")


def point_defects(points: DataFrame) -> DataFrame:
    """Every row of a point file that cannot be used, active or not, with all its ``reasons``."""
    blank = [F.when(clean.is_blank(F.col(c)), F.lit(f"{c} is blank")) for c in (*POINT_TEXTS, "is_active")]
    outside = [
        F.when(~F.coalesce(F.col(c).between(-most, most), F.lit(False)), F.lit(f"{c} is not within -{most}..{most}"))
        for c, most in (("latitude", 90), ("longitude", 180))
    ]
    unread = clean.parse_boolean(F.col("is_active")).isNull() & ~clean.is_blank(F.col("is_active"))
    odd = F.when(unread, F.lit("is_active is neither yes nor no"))
    own = clean.strip("point_id")
    repeated = points.groupBy(own.alias("_id")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1 AND _id <> ''")
    marked = points.join(repeated, own == F.col("_id"), "left")
    again = F.when(F.col("_rows").isNotNull(), F.concat(F.lit("point_id is not unique: "), F.col("_id")))
    reasons = F.array_compact(F.array(*blank, *outside, odd, again))
    return marked.withColumn("reasons", reasons).drop("_id", "_rows").where(F.size("reasons") > 0)


def collectable_points(points: DataFrame) -> DataFrame:
    """Active points of a point file. A row that cannot be used stops the job, and so does a file without active points.

    :func:`point_defects` lists the rows behind such an error.
    """
    columns = [*POINT_TEXTS, "latitude", "longitude"]
    bad = point_defects(points).select(F.concat_ws(", ", "reasons").alias("text"))
    bad = bad.agg(F.count(F.lit(1)).alias("rows"), F.min("text").alias("text"))
    active = points.where(clean.is_active(F.col("is_active"))).select(*columns)
    found = active.agg(F.count(F.lit(1))).scalar()
    # The check is one row and gives none; it fails whenever the result is read.
    fault = (
        F.when(F.col("rows") > 0, F.raise_error(F.concat(F.col("rows").cast("string"), F.lit(" unusable points, such as: "), F.col("text"))))
        .when(found == 0, F.raise_error(F.lit("no active point")))
        .otherwise(F.lit(False))
    )
    checks = bad.where(fault).select(*[F.lit(None).cast(active.schema[c].dataType).alias(c) for c in columns])
    return active.unionByName(checks)
