"""Column lists, raw-document schema and the column contracts of each layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from skyledger.functions.bands import LEVEL_CODES, LEVEL_NAMES

# Column names of the layers, the logical key and the point types.
POLLUTANTS = (
    "pm2_5",
    "pm10",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
)
AQI_COLUMNS = (
    "us_aqi",
    "us_aqi_pm2_5",
    "us_aqi_pm10",
    "us_aqi_nitrogen_dioxide",
    "us_aqi_carbon_monoxide",
    "us_aqi_ozone",
    "us_aqi_sulphur_dioxide",
)
POINT_COLUMNS = (
    "point_id",
    "location_id",
    "point_name",
    "point_type",
    "latitude",
    "longitude",
)
LINEAGE_COLUMNS = ("source", "batch_id", "schema_version", "ingested_at")
CLEAN_COLUMNS = (
    *POINT_COLUMNS,
    "forecast_time",
    *POLLUTANTS,
    *AQI_COLUMNS,
    *LINEAGE_COLUMNS,
)
LOGICAL_KEY = ("point_id", "forecast_time", "source")
REQUIRED_TEXT = (
    "point_id",
    "location_id",
    "point_name",
    "point_type",
    "source",
    "batch_id",
    "schema_version",
)
POINT_TYPES = ("urban_center", "regional_center")
SCHEMA_VERSION = "1.0"

HOURLY_TYPE = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in POLLUTANTS + AQI_COLUMNS]
)
_POINT_TYPE = T.StructType(
    [T.StructField(c, T.StringType()) for c in POINT_COLUMNS[:4]]
    + [T.StructField(c, T.DoubleType()) for c in POINT_COLUMNS[4:]]
)
# What is read from known places of a response; its hourly arrays may lie deeper.
RESPONSE_TYPE = T.StructType(
    [
        T.StructField("hourly", HOURLY_TYPE),
        T.StructField("response", T.StructType([T.StructField("hourly", HOURLY_TYPE)])),
        *_POINT_TYPE.fields,
    ]
)
# The response stays text: its form is the source's choice.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("extracted_at", T.StringType()),
        T.StructField("point", _POINT_TYPE),
        T.StructField("api_response", T.StringType()),
    ]
)

_CLEAN_TYPES = {
    **dict.fromkeys(CLEAN_COLUMNS, T.StringType()),
    **dict.fromkeys(("latitude", "longitude", *POLLUTANTS), T.DoubleType()),
    **dict.fromkeys(AQI_COLUMNS, T.IntegerType()),
    **dict.fromkeys(("forecast_time", "ingested_at"), T.TimestampType()),
}
CLEAN_SCHEMA = T.StructType([T.StructField(c, _CLEAN_TYPES[c]) for c in CLEAN_COLUMNS])
HISTORY_SCHEMA = T.StructType(
    [f for f in CLEAN_SCHEMA.fields if f.name != "batch_id"]
    + [T.StructField(c, T.StringType()) for c in ("date", "hour", "batch_id")]
)


@dataclass(frozen=True)
class ColumnRule:
    """What one column of a layer must look like."""

    name: str
    kind: str  # string, number, integer, datetime, date or boolean
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnRule, ...]
    key: tuple[str, ...] = ()
    version: str = "1.0"
    allow_extra_columns: bool = False

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(column.name for column in self.columns)


def _texts(*names: str) -> tuple[ColumnRule, ...]:
    return tuple(ColumnRule(name, "string") for name in names)


def _times(*names: str) -> tuple[ColumnRule, ...]:
    return tuple(ColumnRule(name, "datetime") for name in names)


def _amounts(*names: str, nullable: bool = False) -> tuple[ColumnRule, ...]:
    return tuple(ColumnRule(name, "number", nullable, minimum=0) for name in names)


def _counts(*names: str, minimum: int = 0, nullable: bool = False):
    return tuple(ColumnRule(name, "integer", nullable, minimum=minimum) for name in names)


_POINT_TYPE_RULE = ColumnRule("point_type", "string", allowed=POINT_TYPES)
_COORDINATES = (
    ColumnRule("latitude", "number", minimum=-90, maximum=90),
    ColumnRule("longitude", "number", minimum=-180, maximum=180),
)
_LEVEL = (
    ColumnRule("aqi_level", "string", allowed=LEVEL_NAMES),
    ColumnRule("aqi_severity", "integer", minimum=1, maximum=6),
)
_AVERAGES = _amounts(
    "average_pm2_5",
    "maximum_pm2_5",
    "average_pm10",
    "maximum_pm10",
    "average_ozone",
    "maximum_ozone",
)


def clean_contract(source: str) -> Contract:
    return Contract(
        "clean_hourly",
        (
            *_texts("point_id", "location_id", "point_name"),
            _POINT_TYPE_RULE,
            *_COORDINATES,
            *_times("forecast_time"),
            *_amounts(*POLLUTANTS),
            *_counts(*AQI_COLUMNS),
            ColumnRule("source", "string", allowed=(source,)),
            *_texts("batch_id"),
            ColumnRule("schema_version", "string", allowed=(SCHEMA_VERSION,)),
            *_times("ingested_at"),
        ),
        key=LOGICAL_KEY,
    )


def mart_source_contract(source: str) -> Contract:
    """Columns the mart builder needs from the clean layer."""
    clean = {rule.name: rule for rule in clean_contract(source).columns}
    names = (
        *POINT_COLUMNS,
        "forecast_time",
        "us_aqi",
        *LINEAGE_COLUMNS,
        *POLLUTANTS,
    )
    return Contract(
        "mart_source_hourly",
        tuple(clean[name] for name in names),
        key=LOGICAL_KEY,
        allow_extra_columns=True,
    )


def current_contract(source: str) -> Contract:
    return Contract(
        "mart_current",
        (
            *_texts("point_id", "location_id", "location_name", "region", "point_name"),
            _POINT_TYPE_RULE,
            *_COORDINATES,
            *_times("forecast_time"),
            *_counts("us_aqi"),
            *_LEVEL,
            *_amounts(*POLLUTANTS),
            ColumnRule("source", "string", allowed=(source,)),
            *_texts("source_batch_id"),
            ColumnRule("schema_version", "string", allowed=(SCHEMA_VERSION,)),
            *_times("source_ingested_at", "mart_created_at"),
        ),
        key=("point_id",),
    )


LOCATION_SUMMARY_CONTRACT = Contract(
    "mart_location_summary",
    (
        *_texts("location_id", "location_name", "region"),
        *_counts("monitoring_point_count", minimum=1),
        *_times("forecast_time"),
        *_amounts("average_us_aqi"),
        *_counts("minimum_us_aqi", "maximum_us_aqi"),
        *_AVERAGES,
        *_COORDINATES,
        *_counts("source_batch_count", minimum=1),
        *_texts("worst_point_id", "worst_point_name"),
        *_counts("worst_point_us_aqi"),
        *_LEVEL,
        *_times("mart_created_at"),
    ),
    key=("location_id",),
)

BAND_HOUR_COLUMNS = (
    "good_hours",
    "moderate_hours",
    "sensitive_group_hours",
    "unhealthy_hours",
    "very_unhealthy_hours",
    "hazardous_hours",
)

DAILY_SUMMARY_CONTRACT = Contract(
    "mart_daily_summary",
    (
        ColumnRule("forecast_date", "date"),
        *_texts("point_id", "location_id", "location_name", "region", "point_name"),
        _POINT_TYPE_RULE,
        *_COORDINATES,
        *_times("first_forecast_time", "last_forecast_time"),
        *_counts("available_hours", minimum=1),
        *_amounts("average_us_aqi"),
        *_counts("minimum_us_aqi", "maximum_us_aqi"),
        *_AVERAGES,
        *_counts(*BAND_HOUR_COLUMNS),
        *_counts("source_batch_count", minimum=1),
        *_times("latest_source_ingested_at", "worst_forecast_time"),
        *_texts("worst_hour_source_batch_id"),
        *_LEVEL,
        ColumnRule("coverage_status", "string", allowed=("COMPLETE", "PARTIAL")),
        *_times("mart_created_at"),
    ),
    key=("forecast_date", "point_id"),
)


def snapshot_contract(source: str) -> Contract:
    """Rows of the public latest-readings payload."""
    clean = {rule.name: rule for rule in clean_contract(source).columns}
    return Contract(
        "snapshot_reading",
        (
            *(clean[c] for c in ("point_id", "location_id", "point_name", "point_type")),
            *_texts("location_name", "region", "admin_type"),
            *_COORDINATES,
            *(clean[c] for c in ("forecast_time", *POLLUTANTS, *AQI_COLUMNS)),
            *(clean[c] for c in LINEAGE_COLUMNS),
        ),
        key=LOGICAL_KEY,
    )


def fact_contract(source: str) -> Contract:
    """Stored facts: measures may be missing, but not negative."""
    return Contract(
        "fact_hourly",
        (
            *_COORDINATES,
            *_amounts(*POLLUTANTS, nullable=True),
            *_counts(*AQI_COLUMNS[:3], nullable=True),
            ColumnRule("aqi_severity", "string", True, allowed=LEVEL_CODES),
            ColumnRule("source", "string", allowed=(source,)),
        ),
        key=LOGICAL_KEY,
        allow_extra_columns=True,
    )


def alert_contract(source: str) -> Contract:
    return Contract(
        "fact_alerts",
        (
            *_texts("point_id", "location_id"),
            *_times("alert_time"),
            ColumnRule("aqi_value", "integer", minimum=101),
            *_texts("aqi_level"),
            ColumnRule("severity", "string", allowed=("MEDIUM", "HIGH", "CRITICAL")),
            *_texts("message"),
            ColumnRule("status", "string", allowed=("OPEN", "ACKNOWLEDGED", "RESOLVED")),
            ColumnRule("source", "string", allowed=(source,)),
        ),
        key=("point_id", "alert_time", "severity", "source"),
        allow_extra_columns=True,
    )


def contract_catalog(source: str) -> dict[str, dict]:
    """All layer contracts as plain data, for publishing next to the tables."""
    contracts = (
        clean_contract(source),
        mart_source_contract(source),
        current_contract(source),
        LOCATION_SUMMARY_CONTRACT,
        DAILY_SUMMARY_CONTRACT,
        snapshot_contract(source),
        fact_contract(source),
        alert_contract(source),
    )
    return {
        contract.name: {
            "version": contract.version,
            "key": list(contract.key),
            "allow_extra_columns": contract.allow_extra_columns,
            "columns": [
                {**vars(rule), "allowed": list(rule.allowed)} for rule in contract.columns
            ],
        }
        for contract in contracts
    }
