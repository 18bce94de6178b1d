"""Published releases: payload rows, manifest and payload audit.

Payloads are kept as rows with their position and the announced count, so one
id never has to fit into a single array; the JSON sink writes a folder per id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean
from skyledger.operators.ranking import keep_top


def _limited(df: DataFrame, key: str, order: Sequence[Column], n: int | None) -> DataFrame:
    return df if n is None else keep_top(df, [key], order, n)


def payload_rows(
    records: DataFrame, ids: DataFrame, key: str, order: Sequence[Column], limit: int | None = None
) -> DataFrame:
    """Records of each published id with the record count of its payload.

    An id without records gets one row with count 0, as its file is written
    too. Those are added by a union: an inner join may be split on a hot id from
    either side, an outer join could not be split on the side of the records.
    """
    kept = _limited(records, key, order, limit)
    counts = kept.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))
    heads = ids.select(key).distinct().join(counts, key, "left").fillna(0, ["record_count"])
    filled = kept.join(heads.where("record_count > 0"), key)
    return filled.unionByName(heads.where("record_count = 0"), allowMissingColumns=True)


def current_compatible(current: DataFrame) -> DataFrame:
    """Current mart rows that also carry the names older readers expect."""
    return current.withColumns(
        {"batch_id": F.col("source_batch_id"), "ingested_at": F.col("source_ingested_at")}
    )


def daily_compatible(daily: DataFrame) -> DataFrame:
    """Daily mart rows that also carry the names of an hourly record."""
    return daily.withColumns(
        {
            "forecast_time": F.coalesce("worst_forecast_time", "last_forecast_time"),
            "us_aqi": F.col("average_us_aqi"),
            "pm2_5": F.col("average_pm2_5"),
            "pm10": F.col("average_pm10"),
            "ozone": F.col("average_ozone"),
            "batch_id": F.col("worst_hour_source_batch_id"),
            "ingested_at": F.col("latest_source_ingested_at"),
        }
    )


def top_polluted(current: DataFrame, limit: int = 10) -> DataFrame:
    """Worst current rows; values that are no number come last."""
    index = clean.to_number(F.col("us_aqi").cast("string"))
    return current.orderBy(index.desc_nulls_last(), "location_id", "point_id").limit(limit)


def point_payloads(current: DataFrame, points: DataFrame, limit: int | None = None) -> DataFrame:
    return payload_rows(current, points, "point_id", [F.col("forecast_time").asc()], limit)


def location_payloads(current: DataFrame, locations: DataFrame, limit: int | None = None) -> DataFrame:
    order = [
        F.col("aqi_severity").desc_nulls_last(),
        F.col("us_aqi").desc_nulls_last(),
        F.col("point_id").asc(),
    ]
    return payload_rows(current, locations, "location_id", order, limit)


def history_payloads(daily: DataFrame, points: DataFrame) -> DataFrame:
    return payload_rows(daily, points, "point_id", [F.col("forecast_date").desc()])


def safe_identifiers(rows: DataFrame, key: str) -> DataFrame:
    """Distinct ids and whether each may name a file."""
    ids = rows.select(clean.strip(key).alias(key)).distinct()
    return ids.withColumn("is_safe", clean.is_safe_identifier(F.col(key))).orderBy(key)


def manifest(
    batch_id: Column, datasets: dict[str, DataFrame], statuses: dict[str, Column], generated_at: Column
) -> DataFrame:
    """One row: the batch, the status of each part and the count of each dataset."""
    names = list(datasets)
    counts = {name: df.agg(F.count(F.lit(1))).scalar() for name, df in datasets.items()}
    first = datasets[names[0]].agg(F.count(F.lit(1)).alias(names[0]))
    return first.select(
        F.lit("1.1").alias("schema_version"),
        generated_at.alias("generated_at"),
        batch_id.alias("latest_batch_id"),
        *[status.alias(f"{name}_status") for name, status in statuses.items()],
        F.col(names[0]),
        *[counts[name].alias(name) for name in names[1:]],
    )


def payload_audit(payloads: DataFrame, key: str, record: str, batch: str) -> DataFrame:
    """Payloads whose announced count differs from their rows, or without batch id."""
    audited = payloads.groupBy(key).agg(
        F.max("record_count").alias("declared"),
        F.count(record).alias("actual"),
        F.count_if(F.col(record).isNotNull() & clean.is_blank(F.col(batch))).alias("without_batch"),
    )
    return audited.withColumn(
        "is_valid", (F.col("declared") == F.col("actual")) & (F.col("without_batch") == 0)
    )


def json_ready(df: DataFrame) -> DataFrame:
    """Times as ISO text, no NaN and no infinity."""
    out = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            out.append(clean.json_number(F.col(name)).alias(name))
        elif kind == "timestamp":
            out.append(clean.json_time(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
