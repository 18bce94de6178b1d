"""Audits: each is one aggregate over the table, turned into issue rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import clean
from skyledger.operators.counting import count_met, met, spread
from skyledger.operators.duplicates import key_counts
from skyledger.operators.joins import orphan_points
from skyledger.schema import ColumnRule, Contract

_KINDS = {
    "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}


def _column_checks(df: DataFrame, rule: ColumnRule) -> list[tuple[str, Column]]:
    """(issue code, condition that a row breaks it) for one column."""
    column = F.col(rule.name)
    actual = df.schema[rule.name].dataType
    is_text = isinstance(actual, T.StringType)
    if rule.kind == "string":
        empty = clean.is_blank(column.cast("string"))
    elif isinstance(actual, (T.FloatType, T.DoubleType)):
        empty = column.isNull() | F.isnan(column)
    else:
        empty = column.isNull()
    checks = [] if rule.nullable else [("NULL_NOT_ALLOWED", empty)]
    filled = ~empty
    if rule.kind == "string":
        if not is_text:
            checks.append(("INVALID_STRING", filled))
        if rule.allowed:
            known = clean.strip(column.cast("string")).isin(*rule.allowed)
            checks.append(("VALUE_NOT_ALLOWED", filled & ~known))
    elif rule.kind in ("number", "integer"):
        number = clean.to_number(column)
        checks.append(("INVALID_NUMBER", filled & number.isNull()))
        if rule.kind == "integer":
            checks.append(("INVALID_INTEGER", filled & (number % 1 != 0)))
        if rule.minimum is not None:
            checks.append(("BELOW_MINIMUM", filled & (number < rule.minimum)))
        if rule.maximum is not None:
            checks.append(("ABOVE_MAXIMUM", filled & (number > rule.maximum)))
    elif rule.kind == "datetime" and is_text:
        checks.append(("INVALID_DATETIME", filled & clean.to_timestamp(column).isNull()))
        checks.append(("TIMEZONE_REQUIRED", filled & ~clean.has_offset(column)))
    elif rule.kind == "date" and is_text:
        checks.append(("INVALID_DATE", filled & column.try_cast("date").isNull()))
    elif not isinstance(actual, _KINDS[rule.kind]):
        checks.append((f"INVALID_{rule.kind.upper()}", filled))
    return checks


def count_conditions(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Rows (code, field, invalid_count) for named conditions, in one pass."""
    counts = count_met(df, [condition for _, _, condition in checks])
    entries = [(F.lit(code).alias("code"), F.lit(field).alias("field")) for code, field, _ in checks]
    return spread(counts, entries).withColumnRenamed("row_count", "invalid_count")


def count_with_key(df: DataFrame, checks: Sequence[tuple[str, str, Column]], key: Sequence[str]) -> DataFrame:
    """The same rows and one for the key (rows whose key is not unique), still in one pass.

    Every row is unrolled to the conditions it meets and to its key, so one grouping
    counts both: conditions without a key, keys without a condition.
    """
    own = len(checks)
    places = F.concat(met([condition for _, _, condition in checks]), F.array(F.lit(own)))
    unrolled = df.select(F.explode(places).alias("position"), *[F.col(c).alias(f"_{c}") for c in key])
    keyed = [F.when(F.col("position") == own, F.col(f"_{c}")).alias(f"_{c}") for c in key]
    cells = unrolled.select("position", *keyed).groupBy("position", *[f"_{c}" for c in key]).agg(F.count(F.lit(1)).alias("n"))
    counted = F.when((F.col("position") != own) | (F.col("n") > 1), F.col("n")).otherwise(0)
    counts = cells.groupBy("position").agg(F.sum(counted).alias("row_count"))
    named = [*((code, field) for code, field, _ in checks), ("DUPLICATE_KEY", ",".join(key))]
    entries = [(F.lit(code).alias("code"), F.lit(field).alias("field")) for code, field in named]
    return spread(counts, entries).withColumnRenamed("row_count", "invalid_count")


def repeated_rows(df: DataFrame, key: Sequence[str], code: str, surplus: bool = False) -> DataFrame:
    """One issue row: rows whose key is not unique (or only the surplus copies)."""
    rows = F.col("row_count") - 1 if surplus else F.col("row_count")
    return (
        key_counts(df, key)
        .agg(F.sum(F.when(F.col("row_count") > 1, rows).otherwise(0)).alias("n"))
        .select(
            F.lit(code).alias("code"),
            F.lit(",".join(key)).alias("field"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("invalid_count"),
        )
    )


def _schema_issues(df: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    actual, wanted = set(df.columns), set(contract.column_names)
    issues = []
    if wanted - actual:
        issues.append(("MISSING_COLUMNS", ",".join(sorted(wanted - actual)), len(wanted - actual)))
    if not contract.allow_extra_columns and actual - wanted:
        issues.append(("EXTRA_COLUMNS", ",".join(sorted(actual - wanted)), len(actual - wanted)))
    return issues


def audit(df: DataFrame, contract: Contract) -> DataFrame:
    """Broken contract terms as rows (code, field, invalid_count)."""
    schema_issues = _schema_issues(df, contract)
    found = df.sparkSession.createDataFrame(
        schema_issues, "code string, field string, invalid_count bigint"
    )
    if any(code == "MISSING_COLUMNS" for code, _, _ in schema_issues):
        return found
    checks = [
        (code, rule.name, condition)
        for rule in contract.columns
        for code, condition in _column_checks(df, rule)
    ]
    result = count_with_key(df, checks, contract.key) if contract.key else count_conditions(df, checks)
    result = result.where("invalid_count > 0")
    return result.union(found) if schema_issues else result


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = count_conditions(df, [("NULL", c, F.col(c).isNull()) for c in columns])
    return counted.select(F.col("field").alias("column_name"), F.col("invalid_count").alias("null_count"))


def location_audit(locations: DataFrame, regions: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Rules of the location dimension."""
    upper = locations.withColumn("location_id", F.upper(clean.strip("location_id")))
    texts = ("location_id", "location_name", "region", "admin_type")
    checks = [("BLANK", c, clean.is_blank(F.col(c))) for c in texts]
    checks += [
        ("VALUE_NOT_ALLOWED", "region", ~clean.strip("region").isin(*regions)),
        ("VALUE_NOT_ALLOWED", "admin_type", ~clean.strip("admin_type").isin(*kinds)),
        ("INVALID_BOOLEAN", "is_active", clean.parse_boolean(F.col("is_active")).isNull()),
    ]
    return (
        count_conditions(upper, checks)
        .union(repeated_rows(upper, ["location_id"], "DUPLICATE_KEY", surplus=True))
        .union(repeated_rows(upper, ["location_name"], "DUPLICATE_KEY", surplus=True))
    )


def point_audit(points: DataFrame, locations: DataFrame) -> DataFrame:
    """Rules of the point dimension, with its reference to the locations."""
    upper = points.withColumns(
        {
            "point_id": F.upper(clean.strip("point_id")),
            "location_id": F.upper(clean.strip("location_id")),
            "latitude": clean.to_number(F.col("latitude")),
            "longitude": clean.to_number(F.col("longitude")),
        }
    )
    texts = ("point_id", "location_id", "point_name", "point_type")
    checks = [("BLANK", c, clean.is_blank(F.col(c))) for c in texts]
    for c, bound in (("latitude", 90), ("longitude", 180)):
        checks.append(("INVALID_NUMBER", c, F.col(c).isNull()))
        checks.append(("OUT_OF_RANGE", c, ~F.col(c).between(-bound, bound)))
    checks.append(
        ("INVALID_BOOLEAN", "is_active", clean.parse_boolean(F.col("is_active")).isNull())
    )
    unknown = (
        upper.select("location_id")
        .distinct()
        .join(locations.select(F.upper(clean.strip("location_id")).alias("location_id")), "location_id", "left_anti")
        .agg(F.count(F.lit(1)).alias("invalid_count"))
        .select(F.lit("UNKNOWN_LOCATION").alias("code"), F.lit("location_id").alias("field"), "invalid_count")
    )
    return (
        count_conditions(upper, checks)
        .union(repeated_rows(upper, ["point_id"], "DUPLICATE_KEY", surplus=True))
        .union(repeated_rows(upper, ["location_id", "latitude", "longitude"], "DUPLICATE_COORDINATES"))
        .union(unknown)
    )


def config_audit(points: DataFrame, locations: DataFrame) -> DataFrame:
    """Active dimension rows: repeated ids and points without an active location."""
    active = clean.is_active(F.col("is_active"))
    orphans = (
        orphan_points(points, locations)
        .agg(F.count(F.lit(1)).alias("invalid_count"))
        .select(F.lit("ORPHAN_POINT").alias("code"), F.lit("location_id").alias("field"), "invalid_count")
    )
    return (
        repeated_rows(points.where(active), ["point_id"], "DUPLICATE_ACTIVE")
        .union(repeated_rows(locations.where(active), ["location_id"], "DUPLICATE_ACTIVE"))
        .union(orphans)
    )


def batch_validity(readings: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: rows, unusable times, repeated (point, time); valid if clean."""
    cells = readings.groupBy(batch, "point_id", "forecast_time").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ingested_at").isNull()).alias("no_ingest")
    )
    no_time = F.when(F.col("forecast_time").isNull(), F.col("n")).otherwise(F.col("no_ingest"))
    return (
        cells.groupBy(batch)
        .agg(
            F.sum("n").alias("record_count"),
            F.sum(no_time).alias("invalid_times"),
            F.sum(F.col("n") - 1).alias("duplicate_rows"),
        )
        .withColumn("is_valid", (F.col("invalid_times") == 0) & (F.col("duplicate_rows") == 0))
    )


def load_precheck(readings: DataFrame, batch: str) -> DataFrame:
    """Per load: blank keys, unusable times, batch ids and repeated keys."""
    keys = ("point_id", "location_id", "source", "batch_id")
    cells = readings.groupBy(
        batch, *[clean.strip(c).alias(c) for c in ("point_id", "source")], "forecast_time"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(clean.is_blank(F.col(c))).alias(f"blank_{c}") for c in keys],
        F.count_if(F.col("ingested_at").isNull()).alias("no_ingest"),
    )
    per_load = cells.groupBy(batch).agg(
        F.sum("n").alias("record_count"),
        *[F.sum(f"blank_{c}").alias(f"blank_{c}") for c in keys],
        F.sum(F.when(F.col("forecast_time").isNull(), F.col("n")).otherwise(0)).alias("invalid_forecast_time"),
        F.sum("no_ingest").alias("invalid_ingested_at"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_rows"),
    )
    ids = (
        readings.groupBy(batch, clean.strip("batch_id").alias("_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(batch)
        .agg(F.count_if(F.col("_id") != "").alias("batch_ids"))
    )
    problems = (*[f"blank_{c}" for c in keys], "invalid_forecast_time", "invalid_ingested_at", "duplicate_rows")
    total = sum((F.col(p) for p in problems[1:]), F.col(problems[0]))
    return per_load.join(ids, batch).withColumn("loadable", (total == 0) & (F.col("batch_ids") == 1))


def dataset_audit(
    df: DataFrame, name: str, key: Sequence[str], expected_rows: Column, batch: str | None = None
) -> DataFrame:
    """One row: does a mart dataset match its build record?

    ``batch`` names the column that must hold one single batch id.
    """
    group = [clean.strip(F.coalesce(batch, F.lit(""))).alias("_batch")] if batch else []
    cells = df.groupBy(*key, *group).agg(F.count(F.lit(1)).alias("n"))
    per_key = cells.groupBy(*key).agg(F.sum("n").alias("n"), *([F.min("_batch").alias("lo"), F.max("_batch").alias("hi")] if batch else []))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("actual_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.lit(0)).alias("duplicate_rows"),
        ((F.min("lo") == F.max("hi")) if batch else F.lit(True)).alias("single_batch"),
    )
    return totals.select(
        F.lit(name).alias("dataset"),
        "actual_rows",
        expected_rows.alias("expected_rows"),
        "duplicate_rows",
        "single_batch",
    ).withColumn(
        "is_valid",
        (F.col("actual_rows") > 0)
        & (F.col("actual_rows") == F.col("expected_rows"))
        & (F.col("duplicate_rows") == 0)
        & F.coalesce("single_batch", F.lit(False)),
    )
