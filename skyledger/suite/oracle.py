"""The registered queries as ANSI SQL over the same tables.

Shared parts are named ``m_*``; :func:`statement` puts the ones a query uses in
front of it.
"""

from __future__ import annotations

import re

from skyledger.functions import bands
from skyledger.plans import views
from skyledger.schema import CLEAN_COLUMNS, POLLUTANTS
from skyledger.sources.adapter import AQI_FACTORS, POLLUTANT_FACTORS, SOURCE, STAGES

PARTS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def case_band(x: str, choices, missing: str = "NULL") -> str:
    whens = " ".join(f"WHEN {x} <= {edge} THEN {c}" for edge, c in zip(bands.BAND_EDGES, choices))
    return f"(CASE WHEN {x} IS NULL THEN {missing} {whens} ELSE {choices[-1]} END)"


def level(x):
    return case_band(x, [text(v) for v in bands.LEVEL_NAMES])


def rank(x):
    return case_band(x, list(range(1, 7)))


def code(x):
    return case_band(x, [text(v) for v in bands.LEVEL_CODES])


def local_level(x):
    return case_band(x, [text(v) for v in bands.LOCAL_LEVELS])


def display_level(x):
    return case_band(x, [text(v) for v in bands.DISPLAY_LEVELS], text(bands.NO_DATA_LEVEL))


def severity(x):
    return case_band(x, [text(v) for v in bands.ALERT_SEVERITIES])


def color(x):
    channels = [text(",".join(map(str, c))) for c in bands.BAND_COLORS]
    return case_band(x, channels, text(",".join(map(str, bands.NO_DATA_COLOR))))


def mean(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def rnd(x: str, digits: int = 2) -> str:
    return f"(round_even(CAST({x} AS DOUBLE) * {10**digits}.0::DOUBLE, 0) / {10**digits}.0::DOUBLE)"


def labels(x: str, table: dict[str, str], unknown: str, upper: bool = True) -> str:
    word = f"upper(trim({x}))" if upper else f"trim({x})"
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items())
    return f"COALESCE(CASE {word} {whens} END, NULLIF({word}, ''), {text(unknown)})"


CREATED = "TIMESTAMP '2024-02-01 00:00:00'"
LOCAL = "INTERVAL 7 HOUR"


def point_columns(key: str) -> str:
    return f"""'P' || CAST({key} AS VARCHAR) AS point_id,
      'L' || CAST({key} % 25 AS VARCHAR) AS location_id,
      'Point ' || CAST({key} AS VARCHAR) AS point_name,
      CASE WHEN {key} % 3 = 0 THEN 'urban_center' ELSE 'regional_center' END AS point_type,
      CAST(8 AS DOUBLE) + CAST({key} % 100 AS DOUBLE) / 10 AS latitude,
      CAST(102 AS DOUBLE) + CAST({key} % 70 AS DOUBLE) / 10 AS longitude"""


def _measures() -> str:
    out = []
    for c, f in POLLUTANT_FACTORS.items():
        value = f"value * CAST({f} AS DOUBLE)"
        out.append(f"CASE WHEN event_id % 41 <> 0 THEN value END AS {c}" if c == "pm2_5" else f"{value} AS {c}")
    for c, f in AQI_FACTORS.items():
        value = f"CAST(floor(value * CAST({f} AS DOUBLE)) AS INTEGER)"
        out.append(f"CASE WHEN event_id % 41 <> 0 THEN {value} END AS {c}" if c == "us_aqi" else f"{value} AS {c}")
    return ",\n      ".join(out)


PARTS["m_readings"] = f"""
  SELECT event_id AS reading_id, {point_columns('user_id')},
      date_trunc('hour', ts) + to_hours(CAST(event_id % 24 AS INTEGER)) AS forecast_time,
      {_measures()},
      '{SOURCE}' AS source, strftime(ts, '%Y%m%d') || '_' || event_type AS batch_id,
      '1.0' AS schema_version, ts AS ingested_at
  FROM events"""
PARTS["m_dirty"] = """
  SELECT * REPLACE (
      CASE WHEN reading_id % 83 = 0 THEN ' ' ELSE point_id END AS point_id,
      CASE WHEN reading_id % 79 = 0 THEN 'L99' ELSE location_id END AS location_id,
      CASE WHEN reading_id % 61 = 0 THEN latitude + 1 WHEN reading_id % 59 = 0 THEN CAST(95 AS DOUBLE) ELSE latitude END AS latitude,
      CASE WHEN reading_id % 97 = 0 THEN -pm2_5 ELSE pm2_5 END AS pm2_5,
      CASE WHEN reading_id % 67 <> 0 THEN pm10 END AS pm10,
      CASE WHEN reading_id % 89 <> 0 THEN us_aqi END AS us_aqi,
      CASE WHEN reading_id % 53 = 0 THEN 'other' WHEN reading_id % 47 = 0 THEN ' Sensor_Feed ' ELSE source END AS source,
      CASE WHEN reading_id % 43 = 0 THEN 'foreign' ELSE batch_id END AS batch_id),
    batch_id AS load_id
  FROM m_readings"""
PARTS["m_texts"] = """
  SELECT reading_id,
      CASE WHEN reading_id % 19 <> 0 THEN ' ' || point_id END AS point_id,
      CASE WHEN reading_id % 17 = 0 THEN 'n/a' WHEN reading_id % 13 = 0 THEN CAST(us_aqi AS VARCHAR) || '.5'
           WHEN reading_id % 31 = 0 THEN '-7' ELSE CAST(us_aqi AS VARCHAR) END AS us_aqi,
      CASE WHEN reading_id % 73 = 0 THEN NULL WHEN reading_id % 71 = 0 THEN forecast_time
           WHEN reading_id % 3 = 0 THEN forecast_time ELSE forecast_time - INTERVAL 7 HOUR END AS forecast_time,
      reading_id % 73 <> 0 AND reading_id % 71 <> 0 AS is_aware,
      CASE reading_id % 7 WHEN 0 THEN 'True' WHEN 1 THEN ' YES ' WHEN 2 THEN '1' WHEN 3 THEN 'no'
           WHEN 4 THEN '0' WHEN 5 THEN 'F' ELSE 'maybe' END AS is_active
  FROM m_readings"""
PARTS["m_locations"] = """
  SELECT 'L' || CAST(n_nationkey AS VARCHAR) AS location_id, n_name AS location_name, r_name AS region,
      CASE WHEN n_nationkey % 5 = 0 THEN 'City' ELSE 'Province' END AS admin_type,
      CASE WHEN n_nationkey % 12 = 11 THEN 'no' ELSE 'Yes' END AS is_active
  FROM nation JOIN region ON n_regionkey = r_regionkey"""
PARTS["m_points"] = f"""
  SELECT {point_columns('c_custkey')}, CASE WHEN c_acctbal < -500 THEN '0' ELSE '1' END AS is_active
  FROM customer"""
PARTS["m_on_points"] = "SELECT * FROM m_points WHERE is_active = '1'"
PARTS["m_on_locations"] = "SELECT * FROM m_locations WHERE is_active = 'Yes'"
PARTS["m_facts"] = f"""
  SELECT * EXCLUDE (rn), {local_level('us_aqi')} AS aqi_level, {code('us_aqi')} AS aqi_severity
  FROM (SELECT *, row_number() OVER (PARTITION BY point_id, forecast_time, source
                                     ORDER BY ingested_at DESC, batch_id DESC) AS rn FROM m_readings)
  WHERE rn = 1"""


def _newest_hours(rows: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY point_id, forecast_time ORDER BY ingested_at DESC, batch_id DESC) AS rn
    FROM {rows}) WHERE rn = 1"""


PARTS["m_newest_hours"] = _newest_hours("m_readings")
PARTS["m_ref"] = "SELECT date_trunc('hour', max(ingested_at)) AS ref FROM m_readings"
PARTS["m_last_batch"] = "SELECT batch_id FROM m_readings ORDER BY ingested_at DESC, batch_id DESC LIMIT 1"
PARTS["m_fact_batch"] = "SELECT batch_id FROM m_facts ORDER BY ingested_at DESC, batch_id DESC LIMIT 1"
PARTS["m_batch_facts"] = "SELECT * FROM m_facts WHERE batch_id = (SELECT batch_id FROM m_fact_batch)"
PARTS["m_star"] = """
  SELECT f.* EXCLUDE (point_name, point_type, latitude, longitude), p.point_name, p.point_type, p.latitude, p.longitude,
         l.location_name, l.region, l.admin_type
  FROM m_facts f JOIN m_points p ON p.point_id = f.point_id JOIN m_locations l ON l.location_id = f.location_id"""


def _alert(rows: str, created: str, status: str = "'OPEN'", extra: str = "") -> str:
    message = (
        "'Cảnh báo chất lượng không khí: ' || point_id || ' (' || location_id || ') có US AQI=' || "
        f"CAST(us_aqi AS VARCHAR) || ', mức ''' || {local_level('us_aqi')} || '''.'"
    )
    return f"""SELECT point_id, location_id, forecast_time AS alert_time, us_aqi AS aqi_value,
      {local_level('us_aqi')} AS aqi_level, {severity('us_aqi')} AS severity, {message} AS message,
      {status} AS status, source, {created} AS created_at{extra}
    FROM {rows} WHERE us_aqi >= 101"""


PARTS["m_alerts"] = _alert(
    "(SELECT * REPLACE (us_aqi + CAST(reading_id % 40 AS INTEGER) AS us_aqi) FROM m_facts)",
    "ingested_at",
    "CASE reading_id % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'ACKNOWLEDGED' ELSE 'RESOLVED' END",
)
_STAGE_CASE = "CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STAGES)) + " END"
PARTS["m_run_log"] = f"""
  SELECT o_orderkey AS run_key, CAST(o_orderkey AS VARCHAR) AS run_id,
      CASE WHEN o_orderkey % 101 = 0 THEN ' ' WHEN o_orderkey % 103 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END AS batch_id,
      {_STAGE_CASE} AS stage_name,
      CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status,
      o_orderdate + to_seconds(o_orderkey % 86400) AS started_at,
      CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400 + o_orderkey % 600) END AS finished_at,
      CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 600 AS DOUBLE) END AS duration_seconds
  FROM orders"""
PARTS["m_check_log"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS run_id, strftime(l_shipdate, '%Y%m%d') AS batch_id,
      'CHECK_' || CAST(l_linenumber AS VARCHAR) AS check_name,
      CASE l_returnflag WHEN 'A' THEN 'PASSED' WHEN 'N' THEN 'WARNED' ELSE 'FAILED' END AS status,
      CAST(l_quantity AS BIGINT) AS bad_records_count, l_shipdate + to_seconds(l_orderkey % 86400) AS checked_at
  FROM lineitem"""


def statement(body: str) -> str:
    """A query with the shared parts it needs, in dependency order."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\bm_[a-z_]+\b", sql):
            if name in PARTS and name not in ordered:
                visit(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in ordered) + "\n" + body


def oracle(name: str, body: str) -> None:
    ORACLE[name] = statement(body)


# --- scans -----------------------------------------------------------------

oracle(
    "scan_partitioned_history",
    f"""SELECT strftime(ingested_at + {LOCAL}, '%Y-%m-%d') AS partition_date, strftime(ingested_at + {LOCAL}, '%H') AS partition_hour,
      batch_id, count(*) AS record_count, max(ingested_at) AS last_ingested_at
    FROM m_readings GROUP BY 1, 2, 3""",
)
_ok = "reading_id % 10 <> 3"
oracle(
    "partition_parts",
    f"""SELECT reading_id, CASE WHEN {_ok} THEN strftime(ingested_at + {LOCAL}, '%Y-%m-%d') END AS partition_date,
      CASE WHEN {_ok} THEN strftime(ingested_at + {LOCAL}, '%H') END AS partition_hour, CASE WHEN {_ok} THEN batch_id END AS batch_id
    FROM m_readings""",
)
PARTS["m_validity"] = """
  SELECT batch_id, CAST(sum(n) AS BIGINT) AS record_count, CAST(0 AS BIGINT) AS invalid_times,
         CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, sum(n - 1) = 0 AS is_valid
  FROM (SELECT batch_id, point_id, forecast_time, count(*) AS n FROM m_readings GROUP BY 1, 2, 3) GROUP BY 1"""
oracle("valid_batches", "SELECT * FROM m_validity")
oracle(
    "valid_history_rows",
    "SELECT reading_id, batch_id, point_id, forecast_time FROM m_readings WHERE batch_id IN (SELECT batch_id FROM m_validity WHERE is_valid)",
)
oracle(
    "skipped_batches",
    "SELECT batch_id, invalid_times, duplicate_rows FROM m_validity WHERE NOT is_valid",
)
oracle("location_dimension", "SELECT location_id, max(point_id) AS point_id, arg_max(point_name, point_id) AS point_name FROM m_points GROUP BY 1")
oracle(
    "active_points",
    "SELECT p.point_id, p.location_id, l.region FROM m_on_points p JOIN m_on_locations l ON l.location_id = p.location_id",
)
oracle(
    "collectable_points",
    "SELECT point_id, location_id, point_name, point_type, latitude, longitude FROM m_on_points",
)
oracle("latest_batch_rows", "SELECT point_id, forecast_time, us_aqi, batch_id FROM m_batch_facts")

# --- sinks as set operations -------------------------------------------------

oracle("fact_upsert", "SELECT point_id, forecast_time, source, batch_id, us_aqi, pm10, ingested_at FROM m_facts")
oracle(
    "upsert_counts",
    """SELECT count(*) AS processed_rows, count(*) FILTER (WHERE k.point_id IS NULL) AS inserted_rows,
      count(k.point_id) AS updated_rows
    FROM (SELECT DISTINCT point_id, forecast_time, source FROM m_readings
          WHERE CAST(ingested_at AS DATE) = (SELECT max(CAST(ingested_at AS DATE)) FROM m_readings)) i
    LEFT JOIN (SELECT DISTINCT point_id, forecast_time, source FROM m_readings
          WHERE CAST(ingested_at AS DATE) < (SELECT max(CAST(ingested_at AS DATE)) FROM m_readings)) k
    USING (point_id, forecast_time, source)""",
)
oracle(
    "dimension_upsert",
    f"""SELECT COALESCE(p.point_id, s.point_id) AS point_id, COALESCE(s.location_id, p.location_id) AS location_id,
      COALESCE(s.point_name || ' (seen)', p.point_name) AS point_name, p.point_type,
      CASE WHEN p.point_id IS NULL THEN {CREATED} ELSE TIMESTAMP '2023-01-01 00:00:00' END AS created_at,
      CASE WHEN s.point_id IS NULL THEN TIMESTAMP '2023-01-01 00:00:00' ELSE {CREATED} END AS updated_at
    FROM m_points p FULL JOIN (SELECT DISTINCT point_id, location_id, point_name FROM m_readings) s ON s.point_id = p.point_id""",
)
oracle(
    "run_log_upsert",
    """SELECT batch_id, stage_name, run_id, status, started_at FROM (
      SELECT *, row_number() OVER (PARTITION BY batch_id, stage_name ORDER BY started_at DESC, run_key DESC) AS rn FROM m_run_log)
    WHERE rn = 1""",
)
oracle(
    "check_log_upsert",
    """SELECT batch_id, check_name, run_id, status, bad_records_count FROM (
      SELECT *, row_number() OVER (PARTITION BY batch_id, check_name
        ORDER BY checked_at DESC, run_id DESC, bad_records_count DESC, status DESC) AS rn FROM m_check_log)
    WHERE rn = 1""",
)
PARTS["m_fresh_alerts"] = _alert("m_batch_facts", CREATED)
oracle(
    "alert_merge",
    """SELECT a.* FROM m_alerts a WHERE NOT EXISTS (SELECT 1 FROM m_batch_facts b
        WHERE b.point_id = a.point_id AND b.forecast_time = a.alert_time AND b.source = a.source)
    UNION ALL
    SELECT n.* REPLACE (COALESCE(o.status, n.status) AS status, COALESCE(o.created_at, n.created_at) AS created_at)
    FROM m_fresh_alerts n LEFT JOIN m_alerts o
      ON o.point_id = n.point_id AND o.alert_time = n.alert_time AND o.source = n.source AND o.severity = n.severity""",
)
oracle(
    "quarantine_backup",
    """SELECT run_id AS original_id, 'MISSING_BATCH_OR_STAGE' AS backup_reason, run_key, stage_name, status
    FROM m_run_log WHERE (batch_id IS NULL OR trim(batch_id) = '') AND run_key % 3 <> 0""",
)
oracle(
    "backfill_batch_id",
    "SELECT run_id, COALESCE(NULLIF(trim(batch_id), ''), 'legacy_without_batch') AS batch_id FROM m_run_log",
)
oracle(
    "purge_orphan_checks",
    """SELECT run_id, batch_id, check_name, status, bad_records_count FROM m_check_log c
    WHERE NOT EXISTS (SELECT 1 FROM m_run_log r WHERE r.run_id = c.run_id AND (r.batch_id IS NULL OR trim(r.batch_id) = ''))""",
)

# --- projections and filters --------------------------------------------------

oracle("clean_projection", f"SELECT {', '.join(CLEAN_COLUMNS)} FROM m_readings")
oracle(
    "alerts_filtered",
    "SELECT point_id, alert_time, severity, status, aqi_value FROM m_alerts WHERE severity IN ('CRITICAL', 'HIGH') AND status = 'OPEN'",
)


def _nearest(rows: str, tie: str) -> str:
    past = "forecast_time < ref," if tie == "future" else ""
    return f"""SELECT * EXCLUDE (rn, ref) FROM (
      SELECT r.*, ref, row_number() OVER (PARTITION BY point_id ORDER BY abs(epoch_us(forecast_time) - epoch_us(ref)),
        {past} forecast_time, ingested_at DESC) AS rn
      FROM {rows} r, (SELECT date_trunc('hour', max(ingested_at)) AS ref FROM {rows}) x) WHERE rn = 1"""


PARTS["m_nearest_past"] = _nearest("m_readings", "past")
PARTS["m_nearest_future"] = _nearest("m_readings", "future")
PARTS["m_batch_readings"] = "SELECT * FROM m_readings WHERE batch_id = (SELECT batch_id FROM m_last_batch)"


def _current(rows: str) -> str:
    return f"""SELECT n.point_id, n.location_id, l.location_name, l.region, n.point_name, n.point_type, n.latitude, n.longitude,
      n.forecast_time, n.us_aqi, {level('n.us_aqi')} AS aqi_level, {rank('n.us_aqi')} AS aqi_severity,
      {', '.join('n.' + c for c in POLLUTANTS)}, n.source, n.batch_id AS source_batch_id, n.schema_version,
      n.ingested_at AS source_ingested_at, {CREATED} AS mart_created_at
    FROM ({_nearest(rows, 'future')}) n LEFT JOIN m_locations l ON l.location_id = n.location_id"""


PARTS["m_current"] = _current("m_batch_readings")
PARTS["m_current_all"] = _current("m_readings")


def _averages(digits: int = 2) -> str:
    return ", ".join(
        f"{rnd(mean(c), digits)} AS average_{c}, {rnd(f'max({c})', digits)} AS maximum_{c}" for c in ("pm2_5", "pm10", "ozone")
    )


PARTS["m_worst_point"] = """
  SELECT location_id, point_id AS worst_point_id, point_name AS worst_point_name, us_aqi AS worst_point_us_aqi FROM (
    SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY us_aqi DESC NULLS LAST, point_id) AS rn FROM m_current_all)
  WHERE rn = 1"""
PARTS["m_location_summary"] = f"""
  SELECT s.*, w.worst_point_id, w.worst_point_name, w.worst_point_us_aqi,
      {level('maximum_us_aqi')} AS aqi_level, {rank('maximum_us_aqi')} AS aqi_severity, {CREATED} AS mart_created_at
  FROM (SELECT location_id, location_name, region, count(DISTINCT point_id) AS monitoring_point_count,
          max(forecast_time) AS forecast_time, {rnd('avg(us_aqi)')} AS average_us_aqi, min(us_aqi) AS minimum_us_aqi,
          max(us_aqi) AS maximum_us_aqi, {_averages()}, {rnd(mean('latitude'))} AS latitude, {rnd(mean('longitude'))} AS longitude,
          count(DISTINCT source_batch_id) AS source_batch_count
        FROM m_current_all GROUP BY 1, 2, 3) s
  LEFT JOIN m_worst_point w ON w.location_id = s.location_id"""
_BAND_HOURS = dict(
    zip(
        bands.LEVEL_NAMES,
        ("good_hours", "moderate_hours", "sensitive_group_hours", "unhealthy_hours", "very_unhealthy_hours", "hazardous_hours"),
    )
)


def _day_hours(hours: str) -> str:
    return f"""
  SELECT h.*, strftime(h.forecast_time + {LOCAL}, '%Y-%m-%d') AS forecast_date, l.location_name, l.region,
         {level('us_aqi')} AS hour_level
  FROM {hours} h LEFT JOIN m_locations l ON l.location_id = h.location_id"""


def _daily(day_hours: str) -> str:
    return f"""
  SELECT s.*, w.forecast_time AS worst_forecast_time, w.batch_id AS worst_hour_source_batch_id,
      CASE WHEN available_hours >= 24 THEN 'COMPLETE' ELSE 'PARTIAL' END AS coverage_status, {CREATED} AS mart_created_at,
      {level('maximum_us_aqi')} AS aqi_level, {rank('maximum_us_aqi')} AS aqi_severity
  FROM (SELECT forecast_date, point_id, location_id, location_name, region, point_name, point_type, latitude, longitude,
          min(forecast_time) AS first_forecast_time, max(forecast_time) AS last_forecast_time,
          count(DISTINCT forecast_time) AS available_hours, {rnd('avg(us_aqi)')} AS average_us_aqi,
          min(us_aqi) AS minimum_us_aqi, max(us_aqi) AS maximum_us_aqi, {_averages()},
          {', '.join(f"count(*) FILTER (WHERE hour_level = '{k}') AS {v}" for k, v in _BAND_HOURS.items())},
          count(DISTINCT batch_id) AS source_batch_count, max(ingested_at) AS latest_source_ingested_at
        FROM {day_hours} GROUP BY ALL) s
  LEFT JOIN (SELECT * FROM (SELECT forecast_date, point_id, forecast_time, batch_id,
               row_number() OVER (PARTITION BY forecast_date, point_id ORDER BY us_aqi DESC NULLS LAST, forecast_time) AS rn
             FROM {day_hours}) WHERE rn = 1) w
    ON w.forecast_date = s.forecast_date AND w.point_id = s.point_id"""


PARTS["m_day_hours"] = _day_hours("m_newest_hours")
PARTS["m_daily"] = _daily("m_day_hours")
PARTS["m_valid_newest_hours"] = _newest_hours("m_readings WHERE batch_id IN (SELECT batch_id FROM m_validity WHERE is_valid)")
PARTS["m_valid_day_hours"] = _day_hours("m_valid_newest_hours")
PARTS["m_valid_daily"] = _daily("m_valid_day_hours")


def _dashboard(rows: str) -> str:
    return f"""SELECT location_id, max(location_name) AS location_name, {rnd(mean('latitude'))} AS latitude,
      {rnd(mean('longitude'))} AS longitude, count(DISTINCT point_id) AS monitoring_point_count,
      avg(us_aqi) AS raw_average, max(us_aqi) AS maximum_us_aqi,
      {', '.join(f"{rnd(mean(c))} AS average_{c}" for c in ('pm2_5', 'pm10', 'ozone', 'nitrogen_dioxide'))},
      max(forecast_time) AS forecast_time, first(point_id ORDER BY us_aqi DESC NULLS LAST, point_id) AS worst_point_id,
      first(point_name ORDER BY us_aqi DESC NULLS LAST, point_id) AS worst_point_name,
      first(us_aqi ORDER BY us_aqi DESC NULLS LAST, point_id) AS worst_point_us_aqi
    FROM {rows} GROUP BY 1"""


PARTS["m_named_nearest"] = "SELECT n.*, l.location_name FROM m_nearest_past n LEFT JOIN m_locations l ON l.location_id = n.location_id"
PARTS["m_dashboard"] = _dashboard("m_named_nearest")
oracle(
    "locations_above_threshold",
    f"SELECT location_id, CAST(NULL AS VARCHAR) AS location_name, {rnd('raw_average')} AS average_us_aqi FROM m_dashboard WHERE {rnd('raw_average')} > 60",
)
oracle(
    "time_range_filter",
    """SELECT reading_id, point_id, forecast_time FROM m_readings, m_ref
    WHERE forecast_time BETWEEN ref - INTERVAL 1 HOUR AND ref + INTERVAL 24 HOUR""",
)
oracle(
    "time_range_fallback",
    """SELECT reading_id, point_id, forecast_time FROM m_readings
    WHERE forecast_time >= (SELECT max(forecast_time) FROM m_readings) - INTERVAL 23 HOUR""",
)
oracle(
    "history_date_range",
    """SELECT forecast_date, point_id, average_us_aqi, available_hours FROM m_daily
    WHERE forecast_date < '2024-01-25' AND CAST(forecast_date AS DATE) >=
      (SELECT max(CAST(forecast_date AS DATE)) FROM m_daily WHERE forecast_date < '2024-01-25') - 6""",
)
oracle(
    "daily_compat_view",
    """SELECT forecast_date, point_id, COALESCE(worst_forecast_time, last_forecast_time) AS forecast_time,
      average_us_aqi AS us_aqi, average_pm2_5 AS pm2_5, worst_hour_source_batch_id AS batch_id,
      latest_source_ingested_at AS ingested_at FROM m_daily""",
)
oracle(
    "label_fallback",
    "SELECT reading_id, f.location_id, COALESCE(l.location_name, f.location_id) AS location_label FROM m_dirty f LEFT JOIN m_locations l ON l.location_id = f.location_id",
)
oracle(
    "translated_run_log",
    f"""SELECT run_id, {labels('stage_name', views.STAGE_LABELS, views.UNKNOWN_LABEL, upper=False)} AS stage_label,
      {labels('status', views.STATUS_LABELS, views.UNKNOWN_LABEL)} AS status_label FROM m_run_log""",
)
oracle(
    "translated_alerts",
    f"""SELECT point_id, alert_time, {labels('severity', views.SEVERITY_LABELS, views.UNKNOWN_LABEL)} AS severity_label,
      {labels('status', views.STATUS_LABELS, views.UNKNOWN_LABEL)} AS status_label FROM m_alerts""",
)
oracle(
    "translated_points",
    f"SELECT point_id, {labels('point_type', views.POINT_TYPE_LABELS, views.UNKNOWN_POINT_TYPE, upper=False)} AS point_type_label FROM m_points",
)
oracle(
    "readings_filtered",
    f"""SELECT {', '.join(c for c in views.TECHNICAL_COLUMNS if c != 'location_name')} FROM m_readings
    WHERE location_id = 'L7' AND point_id IN ('P7', 'P32', 'P57')""",
)
oracle("missing_points_except", "SELECT point_id, location_id FROM m_points EXCEPT SELECT point_id, location_id FROM m_readings")

# --- joins --------------------------------------------------------------------

oracle(
    "enrich_locations",
    "SELECT reading_id, d.location_id, location_name, region FROM m_dirty d LEFT JOIN m_locations l ON l.location_id = d.location_id",
)
oracle(
    "missing_dimension_keys",
    "SELECT DISTINCT location_id FROM m_dirty WHERE location_id NOT IN (SELECT location_id FROM m_locations)",
)
oracle(
    "orphan_points",
    "SELECT point_id, location_id FROM m_on_points WHERE location_id NOT IN (SELECT location_id FROM m_on_locations)",
)
oracle(
    "positional_join",
    """SELECT batch_id || '/' || CAST(chunk AS VARCHAR) AS request_id,
      CAST(row_number() OVER (PARTITION BY batch_id, chunk ORDER BY user_key) - 1 AS INTEGER) AS position, point_id, peak
    FROM (SELECT batch_id, point_id, CAST(substr(point_id, 2) AS BIGINT) AS user_key,
            CAST(substr(point_id, 2) AS BIGINT) // 10 AS chunk, max(pm10) AS peak FROM m_readings GROUP BY 1, 2)
    WHERE chunk % 7 <> 3""",
)

# --- marts --------------------------------------------------------------------

oracle("mart_current", "SELECT * FROM m_current")
oracle("mart_current_all", "SELECT * FROM m_current_all")
oracle("mart_location_summary", "SELECT * FROM m_location_summary")
oracle("mart_daily_summary", "SELECT * FROM m_valid_daily")
oracle(
    "mart_daily_increment",
    f"""SELECT forecast_date, point_id, available_hours, average_us_aqi, maximum_us_aqi FROM m_valid_daily
    WHERE forecast_date IN (SELECT strftime(forecast_time + {LOCAL}, '%Y-%m-%d') FROM m_batch_readings)""",
)
PARTS["m_valid_days"] = f"""
  SELECT DISTINCT strftime(forecast_time + {LOCAL}, '%Y-%m-%d') AS forecast_date, point_id
  FROM m_readings WHERE batch_id IN (SELECT batch_id FROM m_validity WHERE is_valid)"""
oracle(
    "mart_build_summary",
    """SELECT *, current_rows + location_summary_rows + daily_summary_rows AS output_records FROM (
      SELECT 'SUCCESS' AS status, (SELECT batch_id FROM m_last_batch) AS batch_id,
        count(*) FILTER (WHERE is_valid) AS valid_batch_count, count(*) FILTER (WHERE NOT is_valid) AS skipped_batch_count,
        CAST(sum(record_count) FILTER (WHERE is_valid) AS BIGINT) AS history_input_records,
        (SELECT count(*) FROM m_locations) AS location_dimension_rows,
        (SELECT count(*) FROM m_batch_readings) AS latest_batch_records,
        (SELECT count(DISTINCT point_id) FROM m_batch_readings) AS current_rows,
        (SELECT count(DISTINCT location_id) FROM m_batch_readings) AS location_summary_rows,
        (SELECT count(*) FROM m_valid_days) AS daily_summary_rows
      FROM m_validity)""",
)
oracle("worst_point_per_location", "SELECT location_id, worst_point_id AS point_id, worst_point_us_aqi AS us_aqi FROM m_worst_point")
oracle(
    "worst_hour_per_day",
    """SELECT forecast_date, point_id, forecast_time, us_aqi FROM (SELECT *, row_number() OVER
      (PARTITION BY forecast_date, point_id ORDER BY us_aqi DESC NULLS LAST, forecast_time) AS rn FROM m_day_hours) WHERE rn = 1""",
)

# --- serving --------------------------------------------------------------------

_READING = """point_id, location_id, point_name, point_type, location_name, region, admin_type, latitude, longitude, forecast_time,
  pm2_5, pm10, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone, us_aqi, us_aqi_pm2_5, us_aqi_pm10,
  us_aqi_nitrogen_dioxide, us_aqi_carbon_monoxide, us_aqi_ozone, us_aqi_sulphur_dioxide, aqi_level, aqi_severity,
  source, batch_id, schema_version, ingested_at"""
_LATEST = "batch_id = (SELECT batch_id FROM m_fact_batch)"
oracle("latest_air_quality", f"SELECT {_READING} FROM m_star WHERE {_LATEST}")
oracle(
    "readings_by_location",
    f"SELECT {_READING} FROM m_star WHERE {_LATEST} AND location_id = 'L7'",
)
oracle("readings_by_point", f"SELECT {_READING} FROM m_star WHERE {_LATEST} AND point_id = 'P7'")
oracle(
    "top_polluted",
    f"""SELECT {_READING} FROM m_star WHERE {_LATEST} AND us_aqi IS NOT NULL
      AND forecast_time = (SELECT min(forecast_time) FROM m_batch_facts)
    ORDER BY us_aqi DESC, location_name, point_name LIMIT 10""",
)
oracle("point_history", f"SELECT {_READING} FROM m_star WHERE point_id = 'P7' ORDER BY forecast_time DESC LIMIT 48")
oracle(
    "history_all_points",
    """SELECT point_id, forecast_time, source, us_aqi FROM (SELECT *, row_number() OVER
      (PARTITION BY point_id ORDER BY forecast_time DESC, source) AS rn FROM m_facts) WHERE rn <= 24""",
)
oracle("active_locations", "SELECT * FROM m_on_locations")
oracle(
    "active_monitoring_points",
    """SELECT p.*, l.location_name, l.region, l.admin_type FROM m_on_points p JOIN m_on_locations l ON l.location_id = p.location_id""",
)
oracle(
    "latest_alerts",
    "SELECT point_id, alert_time, severity, created_at FROM m_alerts",
)
PARTS["m_last_runs"] = """
  SELECT * FROM m_run_log WHERE batch_id = (SELECT batch_id FROM m_run_log
    WHERE batch_id IS NOT NULL AND trim(batch_id) <> '' ORDER BY started_at DESC, batch_id DESC LIMIT 1)"""
_STAGE_RANK = "CASE stage_name " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STAGES, 1)) + " ELSE 10 END"
oracle(
    "run_health",
    f"""SELECT run_id, batch_id, stage_name, status, {_STAGE_RANK} AS stage_rank,
      (SELECT CASE WHEN bool_and(status = 'SUCCESS') THEN 'SUCCESS' ELSE 'FAILED' END FROM m_last_runs) AS pipeline_status
    FROM m_last_runs""",
)
PARTS["m_last_checks"] = """
  SELECT * FROM m_check_log WHERE batch_id = (SELECT batch_id FROM m_check_log ORDER BY checked_at DESC, batch_id DESC LIMIT 1)"""
oracle(
    "quality_status",
    """SELECT max(batch_id) AS batch_id, count(*) AS check_count, count(*) FILTER (WHERE status <> 'PASSED') AS failed_check_count,
      CASE WHEN count(*) FILTER (WHERE status <> 'PASSED') = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM m_last_checks""",
)
oracle("latest_quality_checks", "SELECT run_id, batch_id, check_name, status, bad_records_count FROM m_last_checks")

# --- quality rules --------------------------------------------------------------

_NUMBERS = (*POLLUTANT_FACTORS, *AQI_FACTORS)
RULES: list[tuple[str, str, str]] = []
for _c in ("point_id", "location_id", "point_name", "point_type", "source", "batch_id", "schema_version"):
    RULES.append((f"{_c.upper()}_REQUIRED", f"{_c} must not be blank", f"d.{_c} IS NULL OR trim(d.{_c}) = ''"))
for _c in ("forecast_time", "ingested_at"):
    RULES.append((f"{_c.upper()}_AWARE", f"{_c} must be a time with offset", f"d.{_c} IS NULL"))
for _c in _NUMBERS:
    RULES.append((f"{_c.upper()}_REQUIRED_NUMERIC", f"{_c} must be a number", f"d.{_c} IS NULL"))
    RULES.append((f"{_c.upper()}_NON_NEGATIVE", f"{_c} must be at least 0", f"d.{_c} IS NULL OR d.{_c} < 0"))
RULES += [
    ("LATITUDE_RANGE", "latitude must be within -90..90", "d.latitude NOT BETWEEN -90 AND 90"),
    ("LONGITUDE_RANGE", "longitude must be within -180..180", "d.longitude NOT BETWEEN -180 AND 180"),
    (f"SOURCE_{SOURCE.upper()}", f"source must be {SOURCE}", f"lower(trim(d.source)) <> '{SOURCE}'"),
    (
        "UNIQUE_LOGICAL_KEY",
        "point_id, forecast_time and source must be unique",
        "count(*) OVER (PARTITION BY d.load_id, d.point_id, d.forecast_time, d.source) > 1",
    ),
    ("KNOWN_ACTIVE_POINT_ID", "point_id must be an active point", "p.point_id IS NULL"),
    ("KNOWN_ACTIVE_LOCATION_ID", "location_id must be an active location", "l.location_id IS NULL"),
    ("POINT_LOCATION_MATCH", "point_id must belong to location_id", "p.point_id IS NOT NULL AND p.location_id <> d.location_id"),
    (
        "POINT_COORDINATE_MATCH",
        "coordinates must match those of the point",
        "p.point_id IS NOT NULL AND (abs(d.latitude - p.latitude) > 0.001 OR abs(d.longitude - p.longitude) > 0.001)",
    ),
    ("BATCH_ID_MATCH", "batch_id must be the id of its batch", "d.batch_id <> d.load_id"),
]
PARTS["m_judged"] = f"""
  SELECT d.*, {', '.join(f'({cond}) AS r{i}' for i, (_, _, cond) in enumerate(RULES))}
  FROM m_dirty d LEFT JOIN m_on_points p ON p.point_id = trim(d.point_id)
  LEFT JOIN m_on_locations l ON l.location_id = trim(d.location_id)"""
_CODES = "concat_ws('|', " + ", ".join(f"CASE WHEN r{i} THEN '{c}' END" for i, (c, _, _) in enumerate(RULES)) + ")"
_MESSAGES = "concat_ws(' | ', " + ", ".join(f"CASE WHEN r{i} THEN {text(m)} END" for i, (_, m, _) in enumerate(RULES)) + ")"
_ANY = "(" + " OR ".join(f"r{i}" for i in range(len(RULES))) + ")"
oracle("dq_row_rules", f"SELECT reading_id, {_CODES} AS dq_error_codes FROM m_judged")
PARTS["m_row_counts"] = (
    "SELECT load_id, count(*) AS total, count(*) FILTER (WHERE NOT "
    + _ANY
    + ") AS valid_records, "
    + ", ".join(f"count(*) FILTER (WHERE r{i}) AS c{i}" for i in range(len(RULES)))
    + " FROM m_judged GROUP BY 1"
)
PARTS["m_row_report"] = " UNION ALL ".join(
    f"SELECT load_id, '{c}' AS check_name, CASE WHEN c{i} = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, c{i} AS bad_records_count FROM m_row_counts"
    for i, (c, _, _) in enumerate(RULES)
)
oracle("dq_row_checks", "SELECT * FROM m_row_report")
oracle("dq_valid", f"SELECT reading_id, point_id, forecast_time, us_aqi FROM m_judged WHERE NOT {_ANY}")
oracle(
    "dq_bad_records",
    f"""SELECT reading_id, 'FAILED' AS dq_status, {_CODES} AS dq_error_codes, {_MESSAGES} AS dq_error_messages,
      {CREATED} AS dq_checked_at FROM m_judged WHERE {_ANY}""",
)
PARTS["m_hours_of_points"] = "SELECT DISTINCT load_id, trim(point_id) AS point_id, forecast_time FROM m_dirty"
PARTS["m_gaps"] = """
  SELECT *, (epoch_us(forecast_time) - epoch_us(lag(forecast_time) OVER (PARTITION BY load_id, point_id ORDER BY forecast_time)))
      / CAST(3600000000 AS DOUBLE) AS gap_hours FROM m_hours_of_points"""
oracle("dq_cadence", f"SELECT load_id, point_id, forecast_time, {rnd('gap_hours', 3)} AS gap_hours FROM m_gaps WHERE gap_hours <> 1")
oracle(
    "dq_hours_per_point",
    """SELECT b.load_id, p.point_id, count(h.forecast_time) AS forecast_hours
    FROM (SELECT DISTINCT load_id FROM m_dirty) b CROSS JOIN m_on_points p
    LEFT JOIN m_hours_of_points h ON h.load_id = b.load_id AND h.point_id = p.point_id GROUP BY 1, 2""",
)
oracle(
    "dq_point_coverage",
    """SELECT COALESCE(h.load_id, p.load_id) AS load_id, COALESCE(h.point_id, p.point_id) AS point_id,
      CASE WHEN h.point_id IS NULL THEN 'MISSING' WHEN p.point_id IS NULL THEN 'UNEXPECTED' ELSE 'PRESENT' END AS coverage
    FROM (SELECT DISTINCT load_id, trim(point_id) AS point_id FROM m_dirty WHERE trim(point_id) <> '') h
    FULL JOIN (SELECT b.load_id, q.point_id FROM (SELECT DISTINCT load_id FROM m_dirty) b CROSS JOIN m_on_points q) p
      ON p.load_id = h.load_id AND p.point_id = h.point_id""",
)
PARTS["m_per_point"] = """
  SELECT load_id, g.point_id, count(*) AS hours, count(*) FILTER (WHERE gap_hours <> 1) AS bad_gaps, p.point_id IS NOT NULL AS known
  FROM m_gaps g LEFT JOIN m_on_points p ON p.point_id = g.point_id GROUP BY ALL"""
PARTS["m_batch_wide"] = f"""
  SELECT i.*, q.*  EXCLUDE (load_id), e.expected, e.expected * 24 AS expected_records, e.expected - known AS missing,
      present - known AS unexpected, e.expected - complete AS incomplete, delay_minutes <= 90 AS fresh
  FROM (SELECT load_id, count(*) AS record_count, count(DISTINCT trim(batch_id)) AS batch_ids,
          count(DISTINCT lower(trim(source))) AS sources, count(*) FILTER (WHERE lower(trim(source)) = '{SOURCE}') AS own,
          {rnd("abs(epoch_us(min(forecast_time)) - epoch_us(date_trunc('hour', max(ingested_at)))) / CAST(60000000 AS DOUBLE)")} AS delay_minutes
        FROM m_dirty GROUP BY 1) i
  JOIN (SELECT load_id, count(*) FILTER (WHERE point_id <> '') AS present, count(*) FILTER (WHERE known) AS known,
          count(*) FILTER (WHERE known AND hours = 24) AS complete, count(*) FILTER (WHERE bad_gaps > 0) AS off_cadence
        FROM m_per_point GROUP BY 1) q ON q.load_id = i.load_id,
  (SELECT count(*) AS expected FROM m_on_points) e"""


def _check(name, passed, bad, actual, expected, severity_="ERROR"):
    failed = "WARNED" if severity_ == "WARNING" else "FAILED"
    return f"""SELECT load_id, '{name}' AS check_name, 'BATCH' AS check_scope, '{severity_}' AS severity,
      CASE WHEN {passed} THEN 'PASSED' ELSE '{failed}' END AS status, CAST({bad} AS BIGINT) AS bad_records_count,
      CAST({actual} AS VARCHAR) AS actual_value, CAST({expected} AS VARCHAR) AS expected_value FROM m_batch_wide"""


PARTS["m_batch_report"] = " UNION ALL ".join(
    [
        _check("EXPECTED_ACTIVE_POINTS", "missing = 0 AND unexpected = 0", "missing + unexpected", "present", "expected"),
        _check("EXPECTED_RECORD_COUNT", "record_count = expected_records", "abs(record_count - expected_records)", "record_count", "expected_records"),
        _check("EXPECTED_FORECAST_HOURS_PER_POINT", "incomplete = 0", "incomplete", "complete", "'24'"),
        _check("HOURLY_FORECAST_CADENCE", "off_cadence = 0", "off_cadence", "off_cadence", "'1 hour'"),
        _check("SINGLE_BATCH_ID", "batch_ids = 1", "greatest(batch_ids - 1, 0)", "batch_ids", "'1'"),
        _check("SINGLE_SOURCE", "sources = 1 AND own > 0", "greatest(sources - 1, 0)", "sources", "'1'"),
        _check("DATA_FRESHNESS", "fresh", "CASE WHEN fresh THEN 0 ELSE 1 END", "CAST(delay_minutes AS DECIMAL(20,2))", "'<= 90 minutes'", "WARNING"),
    ]
)
oracle("dq_batch_checks", "SELECT * FROM m_batch_report")
oracle("dq_freshness", "SELECT load_id, delay_minutes, fresh FROM m_batch_wide")
PARTS["m_scored"] = f"""
  SELECT *, {rnd('valid_percentage * CAST(0.7 AS DOUBLE) + earned / CAST(13 AS DOUBLE) * 100 * CAST(0.3 AS DOUBLE)')} AS raw_score,
      (passed < 6 OR valid_records = 0) AS failed
  FROM (SELECT w.*, r.*  EXCLUDE (load_id), {rnd('CAST(valid_records AS DOUBLE) / total * 100')} AS valid_percentage,
          CAST(p.passed AS DOUBLE) * 2 + CASE WHEN fresh THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS earned, p.passed,
          {' + '.join(f'CAST(c{i} > 0 AS BIGINT)' for i in range(len(RULES)))} AS failed_rows
        FROM m_batch_wide w JOIN m_row_counts r ON r.load_id = w.load_id
        JOIN (SELECT load_id, count(*) FILTER (WHERE status = 'PASSED' AND severity = 'ERROR') AS passed
              FROM m_batch_report GROUP BY 1) p ON p.load_id = w.load_id)"""
_VERDICT = "CASE WHEN failed THEN 'FAIL' WHEN valid_records < total OR NOT fresh THEN 'WARN' ELSE 'PASS' END"
_STATUS = "CASE WHEN failed THEN 'FAILED' WHEN valid_records < total OR NOT fresh THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END"
_SCORE = "CASE WHEN failed THEN least(raw_score, CAST(69.99 AS DOUBLE)) ELSE raw_score END"
oracle("dq_score", f"SELECT load_id, valid_percentage, {_SCORE} AS quality_score FROM m_scored")
oracle("dq_verdict", f"SELECT load_id, {_VERDICT} AS quality_status, {_STATUS} AS pipeline_status FROM m_scored")
oracle(
    "dq_summary",
    f"""SELECT load_id, total AS total_records, valid_records, total - valid_records AS bad_records, valid_percentage,
      {_SCORE} AS quality_score, {_VERDICT} AS quality_status, {_STATUS} AS pipeline_status, expected_records,
      expected AS expected_active_points, known AS actual_active_points,
      CAST({len(RULES)} + 7 - failed_rows - (6 - passed) - CASE WHEN fresh THEN 0 ELSE 1 END AS BIGINT) AS passed_check_count,
      CAST(CASE WHEN fresh THEN 0 ELSE 1 END AS BIGINT) AS warning_check_count,
      CAST(failed_rows + 6 - passed AS BIGINT) AS failed_check_count
    FROM m_scored""",
)
oracle(
    "dq_non_passed",
    """SELECT load_id, check_name, 'ROW' AS check_scope, status, bad_records_count FROM m_row_report WHERE status <> 'PASSED'
    UNION ALL SELECT load_id, check_name, check_scope, status, bad_records_count FROM m_batch_report WHERE status <> 'PASSED'""",
)
oracle("dq_time_aware", "SELECT reading_id, is_aware FROM m_texts")
oracle("duplicate_keys", "SELECT point_id, forecast_time, count(*) AS row_count FROM m_readings GROUP BY 1, 2 HAVING count(*) > 1")
oracle("duplicate_flag", "SELECT reading_id, count(*) OVER (PARTITION BY point_id, forecast_time) > 1 AS is_duplicate FROM m_readings")

# --- audits -----------------------------------------------------------------------


def issue_rows(rows: str, checks, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS code, '{f}' AS field, count(*) FILTER (WHERE {cond}) AS invalid_count{extra} FROM {rows}" for c, f, cond in checks
    )


def dup_rows(rows: str, key, code_: str, surplus: bool = False, extra: str = "") -> str:
    amount = "n - 1" if surplus else "n"
    return f"""SELECT '{code_}' AS code, '{','.join(key)}' AS field,
      CAST(COALESCE(sum(CASE WHEN n > 1 THEN {amount} ELSE 0 END), 0) AS BIGINT) AS invalid_count{extra}
      FROM (SELECT count(*) AS n FROM {rows} GROUP BY {', '.join(key)})"""


def blank(*columns):
    return [("BLANK", c, f"{c} IS NULL OR trim({c}) = ''") for c in columns]


PARTS["m_strayed_locations"] = """
  SELECT * REPLACE (CASE WHEN CAST(substr(location_id, 2) AS INTEGER) % 6 = 0 THEN 'ATLANTIS' ELSE region END AS region) FROM m_locations"""
PARTS["m_strayed_points"] = """
  SELECT * REPLACE (CASE WHEN CAST(substr(point_id, 2) AS INTEGER) % 29 = 0 THEN 'L99' ELSE location_id END AS location_id) FROM m_points"""
oracle(
    "dim_location_audit",
    issue_rows(
        "m_strayed_locations",
        [
            *blank("location_id", "location_name", "region", "admin_type"),
            ("VALUE_NOT_ALLOWED", "region", "region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"),
            ("VALUE_NOT_ALLOWED", "admin_type", "admin_type NOT IN ('City', 'Province')"),
            ("INVALID_BOOLEAN", "is_active", "lower(is_active) NOT IN ('yes', 'no')"),
        ],
    )
    + " UNION ALL "
    + dup_rows("m_strayed_locations", ["location_id"], "DUPLICATE_KEY", True)
    + " UNION ALL "
    + dup_rows("m_strayed_locations", ["location_name"], "DUPLICATE_KEY", True),
)
oracle(
    "dim_point_audit",
    issue_rows(
        "m_strayed_points",
        [
            *blank("point_id", "location_id", "point_name", "point_type"),
            ("INVALID_NUMBER", "latitude", "latitude IS NULL"),
            ("OUT_OF_RANGE", "latitude", "latitude NOT BETWEEN -90 AND 90"),
            ("INVALID_NUMBER", "longitude", "longitude IS NULL"),
            ("OUT_OF_RANGE", "longitude", "longitude NOT BETWEEN -180 AND 180"),
            ("INVALID_BOOLEAN", "is_active", "is_active NOT IN ('0', '1')"),
        ],
    )
    + " UNION ALL "
    + dup_rows("m_strayed_points", ["point_id"], "DUPLICATE_KEY", True)
    + " UNION ALL "
    + dup_rows("m_strayed_points", ["location_id", "latitude", "longitude"], "DUPLICATE_COORDINATES")
    + """ UNION ALL SELECT 'UNKNOWN_LOCATION', 'location_id', count(DISTINCT location_id) FROM m_strayed_points
      WHERE location_id NOT IN (SELECT location_id FROM m_locations)""",
)
oracle(
    "config_audit",
    dup_rows("m_on_points", ["point_id"], "DUPLICATE_ACTIVE")
    + " UNION ALL "
    + dup_rows("m_on_locations", ["location_id"], "DUPLICATE_ACTIVE")
    + """ UNION ALL SELECT 'ORPHAN_POINT', 'location_id', count(*) FROM m_on_points
      WHERE location_id NOT IN (SELECT location_id FROM m_on_locations)""",
)
oracle(
    "load_precheck",
    """SELECT c.*, i.batch_ids, (blank_point_id + blank_location_id + blank_source + blank_batch_id + duplicate_rows = 0 AND batch_ids = 1) AS loadable
    FROM (SELECT load_id, CAST(sum(n) AS BIGINT) AS record_count, CAST(sum(bp) AS BIGINT) AS blank_point_id,
            CAST(sum(bl) AS BIGINT) AS blank_location_id, CAST(sum(bs) AS BIGINT) AS blank_source, CAST(sum(bb) AS BIGINT) AS blank_batch_id,
            CAST(0 AS BIGINT) AS invalid_forecast_time, CAST(0 AS BIGINT) AS invalid_ingested_at,
            CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows
          FROM (SELECT load_id, trim(point_id) AS p, trim(source) AS s, forecast_time, count(*) AS n,
                  count(*) FILTER (WHERE trim(point_id) = '') AS bp, count(*) FILTER (WHERE trim(location_id) = '') AS bl,
                  count(*) FILTER (WHERE trim(source) = '') AS bs, count(*) FILTER (WHERE trim(batch_id) = '') AS bb
                FROM m_dirty GROUP BY 1, 2, 3, 4) GROUP BY 1) c
    JOIN (SELECT load_id, count(DISTINCT trim(batch_id)) AS batch_ids FROM m_dirty GROUP BY 1) i ON i.load_id = c.load_id""",
)
_TEXT_COLUMNS = ("point_id", "location_id", "point_name", "point_type", "source", "batch_id", "schema_version")


def contract(rows: str, columns: list[tuple[str, str]], key, extra: str = "") -> str:
    """Issues of a layer: (column, kind), kind being text, number, whole or a condition."""
    checks = []
    for c, kind in columns:
        if kind == "text":
            checks.append(("NULL_NOT_ALLOWED", c, f"{c} IS NULL OR trim({c}) = ''"))
        elif kind == "amount":
            checks.append(("NULL_NOT_ALLOWED", c, f"{c} IS NULL"))
            checks.append(("BELOW_MINIMUM", c, f"{c} < 0"))
        elif kind == "amount?":
            checks.append(("BELOW_MINIMUM", c, f"{c} < 0"))
        elif kind == "there":
            checks.append(("NULL_NOT_ALLOWED", c, f"{c} IS NULL"))
        elif kind.startswith("in:"):
            checks.append(("NULL_NOT_ALLOWED", c, f"{c} IS NULL OR trim({c}) = ''"))
            checks.append(("VALUE_NOT_ALLOWED", c, f"trim({c}) NOT IN ({kind[3:]}) AND trim({c}) <> ''"))
        elif kind.startswith("range:"):
            bound = kind[6:]
            checks.append(("NULL_NOT_ALLOWED", c, f"{c} IS NULL"))
            checks.append(("BELOW_MINIMUM", c, f"{c} < -{bound}"))
            checks.append(("ABOVE_MAXIMUM", c, f"{c} > {bound}"))
    return f"SELECT * FROM ({issue_rows(rows, checks, extra)} UNION ALL {dup_rows(rows, key, 'DUPLICATE_KEY', extra=extra)}) WHERE invalid_count > 0"


_KEY = ["point_id", "forecast_time", "source"]
_KINDS = "in:'urban_center', 'regional_center'"
oracle(
    "contract_audit_clean",
    contract(
        "m_dirty",
        [("point_id", "text"), ("location_id", "text"), ("point_name", "text"), ("point_type", _KINDS),
         ("latitude", "range:90"), ("longitude", "range:180"), *[(c, "amount") for c in _NUMBERS],
         ("source", f"in:'{SOURCE}'"), ("batch_id", "text"), ("schema_version", "in:'1.0'")],
        _KEY,
    ),
)
_NAMES = [(c, "text") for c in ("point_id", "location_id", "location_name", "region")]
_AVERAGE_COLUMNS = [(f"{a}_{c}", "amount") for c in ("pm2_5", "pm10", "ozone") for a in ("average", "maximum")]
_AQI_SUMMARY = [(c, "amount") for c in ("average_us_aqi", "minimum_us_aqi", "maximum_us_aqi")]
_LEVELS = [("aqi_level", "text"), ("aqi_severity", "amount")]
oracle(
    "contract_audit_mart",
    contract("m_current_all", [*_NAMES, ("us_aqi", "amount"), *_LEVELS, *[(c, "amount") for c in POLLUTANTS]], ["point_id"], ", 'current' AS dataset")
    + " UNION ALL "
    + contract(
        "m_location_summary",
        [*_NAMES[1:], *_AQI_SUMMARY, *_AVERAGE_COLUMNS, ("worst_point_us_aqi", "amount"), *_LEVELS],
        ["location_id"],
        ", 'location_summary' AS dataset",
    )
    + " UNION ALL "
    + contract("m_daily", [*_NAMES, *_AQI_SUMMARY, *_AVERAGE_COLUMNS, *_LEVELS], ["forecast_date", "point_id"], ", 'daily_summary' AS dataset"),
)
oracle(
    "contract_audit_fact",
    contract(
        "m_dirty",
        [("latitude", "range:90"), ("longitude", "range:180"), *[(c, "amount?") for c in _NUMBERS[:9]], ("source", f"in:'{SOURCE}'")],
        _KEY,
    ),
)
oracle("contract_audit_alerts", "SELECT 'VALUE_NOT_ALLOWED' AS code, 'source' AS field, count(*) AS invalid_count FROM m_alerts")
oracle(
    "mart_audit",
    """SELECT dataset, actual_rows, e.expected_rows, CAST(0 AS BIGINT) AS duplicate_rows, single_batch,
      (actual_rows = e.expected_rows AND single_batch) AS is_valid
    FROM (SELECT 'current' AS dataset, count(*) AS actual_rows, count(DISTINCT source_batch_id) = 1 AS single_batch FROM m_current
      UNION ALL SELECT 'current_all', count(*), count(DISTINCT source_batch_id) = 1 FROM m_current_all
      UNION ALL SELECT 'daily_summary', count(*), true FROM m_daily),
    (SELECT count(DISTINCT point_id) AS expected_rows FROM m_batch_readings) e""",
)
oracle(
    "integrity_audit",
    issue_rows("m_run_log", blank("run_id", "batch_id", "stage_name"), ", 'run_log' AS relation")
    + " UNION ALL "
    + issue_rows("m_check_log", blank("run_id", "batch_id", "check_name"), ", 'check_log' AS relation")
    + " UNION ALL "
    + issue_rows("m_dirty", [*blank("batch_id"), ("NULL", "ingested_at", "ingested_at IS NULL")], ", 'facts' AS relation")
    + " UNION ALL "
    + dup_rows("m_run_log", ["batch_id", "stage_name"], "DUPLICATE_KEY", extra=", 'run_log' AS relation"),
)
oracle(
    "null_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM m_dirty" for c in CLEAN_COLUMNS),
)
oracle(
    "batch_profile",
    """SELECT batch_id, point_id, count(*) AS record_count, min(forecast_time) AS first_time, max(forecast_time) AS last_time,
      count(*) - count(us_aqi) AS null_aqi FROM m_readings GROUP BY 1, 2""",
)

# --- windows ------------------------------------------------------------------------

oracle("nearest_per_point", "SELECT point_id, reading_id, forecast_time FROM m_nearest_future")
oracle("nearest_per_point_past", "SELECT point_id, reading_id, forecast_time FROM m_nearest_past")
oracle("latest_wins", "SELECT reading_id, point_id, forecast_time, batch_id FROM m_newest_hours")
PARTS["m_series"] = f"SELECT forecast_time, {mean('us_aqi')} AS average FROM m_readings WHERE us_aqi IS NOT NULL GROUP BY 1"
oracle(
    "nearest_hour_delta",
    f"""SELECT forecast_time, {rnd('average', 4)} AS average, {rnd('delta', 4)} AS delta FROM (
      SELECT *, average - lag(average) OVER (ORDER BY forecast_time) AS delta FROM m_series), m_ref
    ORDER BY abs(epoch_us(forecast_time) - epoch_us(ref)), forecast_time LIMIT 1""",
)
oracle("point_name_lookup", "SELECT DISTINCT point_id, point_name FROM m_readings")

# --- aggregates and views --------------------------------------------------------------

oracle(
    "level_distribution",
    f"""SELECT aqi_level, count(*) AS locations, CASE aqi_level {' '.join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(bands.DISPLAY_LEVELS, 1))} END AS band
    FROM (SELECT {display_level('raw_average')} AS aqi_level FROM m_dashboard) WHERE aqi_level <> '{bands.NO_DATA_LEVEL}' GROUP BY 1""",
)
oracle(
    "nationwide_kpis",
    "SELECT avg(us_aqi) AS average_us_aqi, max(us_aqi) AS maximum_us_aqi, max(forecast_time) AS latest_forecast_time, count(*) AS points FROM m_nearest_past",
)
oracle(
    "hourly_mean",
    f"SELECT forecast_time, {mean('us_aqi')} AS average, count(*) AS readings, forecast_time + {LOCAL} AS local_time FROM m_readings WHERE us_aqi IS NOT NULL GROUP BY 1",
)
oracle(
    "hourly_mean_by_location",
    f"SELECT forecast_time, location_id, {mean('pm10')} AS average, count(*) AS readings, forecast_time + {LOCAL} AS local_time FROM m_readings GROUP BY 1, 2",
)
oracle(
    "alert_counts",
    f"""SELECT count(*) AS input_records, count(us_aqi) AS classified_records, count(*) - count(us_aqi) AS null_aqi_records,
      count(*) FILTER (WHERE us_aqi > 100) AS alerts_generated, count(*) FILTER (WHERE {severity('us_aqi')} = 'MEDIUM') AS medium_alerts,
      count(*) FILTER (WHERE {severity('us_aqi')} = 'HIGH') AS high_alerts, count(*) FILTER (WHERE {severity('us_aqi')} = 'CRITICAL') AS critical_alerts
    FROM m_facts""",
)
oracle(
    "alert_kpis",
    """SELECT count(*) AS total_alerts, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
      count(*) FILTER (WHERE severity = 'HIGH') AS high_alerts, count(*) FILTER (WHERE status = 'OPEN') AS open_alerts FROM m_alerts""",
)
oracle(
    "alert_precheck",
    issue_rows(
        "m_dirty",
        [*blank("point_id", "location_id", "source"), ("WRONG_SOURCE", "source", f"trim(source) <> '{SOURCE}'"), ("NOT_CLASSIFIABLE", "us_aqi", "us_aqi < 0")],
    )
    + " UNION ALL "
    + dup_rows("m_dirty", _KEY, "DUPLICATE_KEY"),
)
oracle(
    "run_log_kpis",
    "SELECT count(*) FILTER (WHERE status <> 'SUCCESS') AS failed_stages, sum(duration_seconds) AS total_duration FROM m_run_log",
)
_MARKER = "least(greatest(COALESCE({0}, 0), 0), 300) * 110 + 22000"
PARTS["m_dashboard_view"] = f"""
  SELECT * EXCLUDE (raw_average), {rnd('raw_average')} AS average_us_aqi, {display_level('raw_average')} AS aqi_level,
    COALESCE(location_name, location_id) AS location_label, {color('raw_average')} AS fill_color,
    CAST({_MARKER.format('raw_average')} AS DOUBLE) AS marker_radius
  FROM m_dashboard"""
oracle("dashboard_location_summary", "SELECT * FROM m_dashboard_view")
_VIEW = """location_id, location_name, latitude, longitude, CAST(monitoring_point_count AS BIGINT) AS monitoring_point_count,
  average_us_aqi, CAST(maximum_us_aqi AS DOUBLE) AS maximum_us_aqi, average_pm2_5, average_pm10, average_ozone,
  {no2} AS average_nitrogen_dioxide, worst_point_id, worst_point_name, CAST(worst_point_us_aqi AS DOUBLE) AS worst_point_us_aqi,
  forecast_time, aqi_level, COALESCE(location_name, location_id) AS location_label"""
oracle(
    "location_view",
    f"""SELECT {_VIEW.format(no2='CAST(NULL AS DOUBLE)')}, {color('average_us_aqi')} AS fill_color,
      CAST({_MARKER.format('average_us_aqi')} AS DOUBLE) AS marker_radius FROM m_location_summary""",
)
oracle(
    "location_view_fallback",
    f"SELECT {_VIEW.format(no2='average_nitrogen_dioxide')}, fill_color, marker_radius FROM m_dashboard_view",
)
oracle(
    "location_ranking",
    """SELECT location_id, location_label, average_us_aqi FROM m_dashboard_view WHERE average_us_aqi IS NOT NULL
    ORDER BY average_us_aqi DESC, maximum_us_aqi DESC, location_id LIMIT 15""",
)
oracle(
    "history_kpis",
    f"""SELECT count(DISTINCT CAST(forecast_time + {LOCAL} AS DATE)) AS days, {mean('us_aqi')} AS average_us_aqi, min(us_aqi) AS minimum_us_aqi,
      max(us_aqi) AS maximum_us_aqi, first(forecast_time ORDER BY us_aqi DESC NULLS LAST, forecast_time) AS worst_time FROM m_facts""",
)
oracle(
    "history_daily",
    f"""SELECT CAST(forecast_time + {LOCAL} AS DATE) AS forecast_date, {rnd('avg(us_aqi)', 1)} AS average_us_aqi, min(us_aqi) AS minimum_us_aqi,
      max(us_aqi) AS maximum_us_aqi, count(DISTINCT forecast_time) AS available_hours, {_averages(1)} FROM m_facts GROUP BY 1""",
)
oracle(
    "batch_status",
    """SELECT load_id, count(*) AS points, count(*) FILTER (WHERE lost = 0) AS successful_points,
      CAST(COALESCE(sum(n) FILTER (WHERE lost = 0), 0) AS BIGINT) AS records,
      CASE WHEN count(*) FILTER (WHERE lost = 0) = count(*) THEN 'SUCCESS' WHEN count(*) FILTER (WHERE lost = 0) > 0 THEN 'PARTIAL_SUCCESS' ELSE 'FAILED' END AS status
    FROM (SELECT load_id, location_id, count(*) AS n, count(*) - count(pm10) AS lost FROM m_dirty GROUP BY 1, 2) GROUP BY 1""",
)
oracle(
    "data_updated_at",
    """SELECT count(*) AS record_count, greatest(max(ingested_at), (SELECT max(finished_at) FROM m_run_log), (SELECT max(created_at) FROM m_alerts)) AS updated_at
    FROM m_readings""",
)
oracle(
    "available_hours",
    "SELECT (epoch_us(max(forecast_time)) - epoch_us(min(forecast_time))) // 3600000000 + 1 AS available_hours FROM m_readings",
)
oracle(
    "view_counts",
    "SELECT count(*) AS record_count, count(DISTINCT location_id) AS locations, count(DISTINCT forecast_time) AS times FROM m_readings",
)
oracle(
    "pollutants_long",
    " UNION ALL ".join(
        f"SELECT reading_id, '{c}' AS pollutant, {c} AS concentration FROM m_dirty WHERE {c} IS NOT NULL" for c in POLLUTANTS
    ),
)
oracle(
    "filter_values",
    """SELECT DISTINCT 'point' AS filter, upper(point_id) AS value FROM m_readings
    UNION ALL SELECT DISTINCT 'severity', severity FROM m_alerts
    UNION ALL SELECT DISTINCT 'status', status FROM m_alerts
    UNION ALL SELECT DISTINCT 'location', upper(location_name) FROM m_locations""",
)

# --- releases ----------------------------------------------------------------------------

oracle(
    "top_polluted_mart",
    "SELECT point_id, location_id, us_aqi FROM m_current_all ORDER BY us_aqi DESC NULLS LAST, location_id, point_id LIMIT 10",
)
oracle(
    "release_points",
    """SELECT p.point_id, CASE WHEN c.point_id IS NULL THEN CAST(0 AS BIGINT) ELSE 1 END AS record_count, c.forecast_time, c.us_aqi, c.source_batch_id AS batch_id
    FROM m_points p LEFT JOIN m_current_all c ON c.point_id = p.point_id""",
)
oracle(
    "release_locations",
    """SELECT l.location_id, COALESCE(n, 0) AS record_count, c.point_id, c.us_aqi, c.source_batch_id AS batch_id
    FROM m_locations l LEFT JOIN (SELECT location_id, count(*) AS n FROM m_current_all GROUP BY 1) k ON k.location_id = l.location_id
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY aqi_severity DESC NULLS LAST, us_aqi DESC NULLS LAST, point_id) AS rn
               FROM m_current_all) c ON c.location_id = l.location_id""",
)
oracle(
    "release_history",
    """SELECT p.point_id, COALESCE(n, 0) AS record_count, d.forecast_date, d.average_us_aqi AS us_aqi, d.worst_hour_source_batch_id AS batch_id
    FROM m_points p LEFT JOIN (SELECT point_id, count(*) AS n FROM m_daily GROUP BY 1) k ON k.point_id = p.point_id
    LEFT JOIN m_daily d ON d.point_id = p.point_id""",
)
oracle(
    "release_manifest",
    f"""SELECT '1.1' AS schema_version, {CREATED} AS generated_at, (SELECT batch_id FROM m_fact_batch) AS latest_batch_id, 'SUCCESS' AS mart_status,
      (SELECT count(*) FROM m_on_locations) AS locations,
      (SELECT count(*) FROM m_on_points WHERE location_id IN (SELECT location_id FROM m_on_locations)) AS monitoring_points,
      (SELECT count(*) FROM m_current_all) AS current_records, (SELECT count(*) FROM m_daily) AS daily_records,
      least((SELECT count(*) FROM m_current_all), 10) AS top_polluted_records, (SELECT count(*) FROM m_alerts) AS alert_records""",
)
oracle(
    "release_audit",
    """SELECT l.location_id, COALESCE(n, 0) AS declared, COALESCE(n, 0) AS actual, COALESCE(bad, 0) AS without_batch, COALESCE(bad, 0) = 0 AS is_valid
    FROM m_locations l LEFT JOIN (SELECT location_id, count(*) AS n, count(*) FILTER (WHERE us_aqi > 150) AS bad FROM m_current_all GROUP BY 1) c
      ON c.location_id = l.location_id""",
)
oracle(
    "safe_identifiers",
    """SELECT point_id, regexp_matches(point_id, '^[A-Za-z0-9_-]+$') AS is_safe
    FROM (SELECT DISTINCT trim(point_id || location_id) AS point_id FROM m_dirty)""",
)

# --- scalar functions -----------------------------------------------------------------------

oracle("aqi_bands", f"SELECT reading_id, {level('us_aqi')} AS aqi_level, {rank('us_aqi')} AS aqi_severity FROM m_readings")
oracle(
    "aqi_classified",
    f"""SELECT reading_id, error AS classification_error, {local_level('x')} AS aqi_level, {code('x')} AS aqi_severity, {severity('x')} AS alert_severity
    FROM (SELECT reading_id, error, CASE WHEN error IS NULL THEN CAST(us_aqi AS INTEGER) END AS x FROM (
      SELECT *, CASE WHEN us_aqi IS NULL THEN NULL WHEN us_aqi = 'n/a' THEN 'NOT_A_NUMBER' WHEN us_aqi LIKE '%.5' THEN 'FRACTIONAL'
        WHEN us_aqi LIKE '-%' THEN 'NEGATIVE' END AS error FROM m_texts))""",
)
PARTS["m_fact_alerts"] = _alert("m_facts", "ingested_at")
oracle("alert_messages", "SELECT point_id, alert_time, severity, message FROM m_fact_alerts")
oracle(
    "map_markers",
    f"SELECT reading_id, {color('pm2_5')} AS fill_color, {_MARKER.format('pm2_5')} AS marker_radius FROM m_readings",
)
_titles = [text(v) for v in bands.ADVICE_TITLES]
_bodies = [text(v) for v in bands.ADVICE_BODIES]
_colors = [text(v) for v in bands.ADVICE_COLORS]
oracle(
    "health_advice",
    f"""SELECT reading_id, {case_band('us_aqi', _titles, text(bands.NO_DATA_ADVICE))} AS title,
      {case_band('us_aqi', _bodies, text(bands.NO_DATA_BODY))} AS body,
      {case_band('us_aqi', _colors, text(bands.NO_DATA_ADVICE_COLOR))} AS color FROM m_readings""",
)
oracle(
    "coerced_records",
    """SELECT reading_id, COALESCE(trim(point_id), '') AS point_id, TRY_CAST(us_aqi AS DOUBLE) AS us_aqi,
      CASE WHEN us_aqi LIKE '%.5' THEN CAST(-1 AS BIGINT) ELSE COALESCE(TRY_CAST(us_aqi AS BIGINT), -1) END AS us_aqi_integer, forecast_time FROM m_texts""",
)
oracle("local_time", f"SELECT reading_id, forecast_time + {LOCAL} AS local_time FROM m_readings")
oracle(
    "local_day_hour",
    f"""SELECT reading_id, strftime(forecast_time + {LOCAL}, '%Y-%m-%d') AS local_date, CAST(hour(forecast_time + {LOCAL}) AS INTEGER) AS local_hour,
      date_trunc('hour', ingested_at) AS ingest_hour FROM m_readings""",
)
oracle(
    "partition_strings",
    f"""SELECT batch_id, strftime(min(ingested_at) + {LOCAL}, '%Y-%m-%d') AS partition_date, strftime(min(ingested_at) + {LOCAL}, '%H') AS partition_hour
    FROM m_readings GROUP BY 1""",
)
oracle("batch_id_valid", "SELECT reading_id, reading_id % 11 <> 0 AS is_batch_id FROM m_readings")
PARTS["m_age"] = """
  SELECT reading_id, greatest(0, CAST(floor((epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(ingested_at)) / 1000000.0) AS BIGINT)) AS s FROM m_readings"""
oracle(
    "data_age",
    """SELECT reading_id, s // 60 AS age_minutes, CASE WHEN s < 60 THEN 'vừa cập nhật'
        WHEN s // 60 < 60 THEN 'cách đây ' || CAST(s // 60 AS VARCHAR) || ' phút'
        WHEN s // 3600 < 24 THEN 'cách đây ' || CAST(s // 3600 AS VARCHAR) || ' giờ'
        ELSE 'cách đây ' || CAST(s // 86400 AS VARCHAR) || ' ngày' END AS age_text,
      CASE WHEN s // 60 > 120 THEN 'STALE_2H' WHEN s // 60 > 60 THEN 'STALE_1H' ELSE 'FRESH' END AS stale_tier FROM m_age""",
)
oracle(
    "parse_boolean",
    """SELECT reading_id, CASE WHEN reading_id % 7 <= 2 THEN true WHEN reading_id % 7 <= 4 THEN false END AS strict_flag,
      reading_id % 7 <= 2 AS is_active FROM m_texts""",
)
oracle(
    "json_safe",
    """SELECT reading_id, CASE WHEN reading_id % 5 <> 0 AND reading_id % 7 <> 0 THEN pm10 END AS pm10,
      strftime(forecast_time, '%Y-%m-%dT%H:%M:%S+00:00') AS forecast_time FROM m_readings""",
)

# --- raw documents ------------------------------------------------------------------------------

PARTS["m_doc_hours"] = """
  SELECT *, CAST(substr(point_id, 2) AS BIGINT) AS k FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, point_id, forecast_time
    ORDER BY ingested_at DESC) AS rn FROM m_readings) WHERE rn = 1"""
PARTS["m_docs"] = """
  SELECT batch_id, point_id, location_id, point_name, point_type, latitude, longitude, k, count(*) AS hours, max(ingested_at) AS extracted,
    CASE WHEN k % 31 = 9 THEN 'BAD_COORDINATES' WHEN k % 29 = 11 THEN 'NO_HOURLY' WHEN k % 23 = 7 THEN 'BAD_TIME'
         WHEN k % 17 = 3 AND k % 7 <> 0 THEN 'LENGTH_MISMATCH' WHEN k % 19 = 5 AND count(us_aqi) > 0 THEN 'FRACTIONAL_AQI' END AS failure
  FROM m_doc_hours GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""
oracle(
    "locate_hourly",
    """SELECT batch_id, point_id, CASE WHEN k % 29 = 11 THEN NULL WHEN k % 13 = 4 THEN 'response.hourly'
      WHEN k % 11 = 2 THEN 'data.hourly' WHEN k % 19 = 8 THEN 'body.result.series.model.hourly' ELSE 'hourly' END AS path FROM m_docs""",
)
oracle("raw_record_counts", "SELECT batch_id, point_id, CASE WHEN k % 29 = 11 THEN CAST(0 AS BIGINT) ELSE hours END AS record_count FROM m_docs")
oracle(
    "point_metadata",
    """SELECT batch_id, point_id, location_id, CASE WHEN k % 37 = 6 THEN point_id ELSE point_name END AS point_name,
      CASE WHEN k % 37 = 6 THEN 'unknown' ELSE point_type END AS point_type,
      CASE WHEN k % 31 = 9 THEN CAST(123 AS DOUBLE) ELSE latitude END AS latitude, longitude FROM m_docs""",
)
oracle(
    "explode_hourly",
    """SELECT h.batch_id, h.point_id, forecast_time, pm10, CASE WHEN h.k % 7 <> 0 THEN ozone END AS ozone, us_aqi, d.extracted AS ingested_at
    FROM m_doc_hours h JOIN m_docs d ON d.batch_id = h.batch_id AND d.point_id = h.point_id WHERE d.failure IS NULL""",
)
oracle("transform_failures", "SELECT batch_id, point_id, failure FROM m_docs WHERE failure IS NOT NULL")
oracle(
    "transform_batch",
    """SELECT *, CAST(0 AS BIGINT) AS duplicate_rows, CASE WHEN records_transformed = 0 THEN 'FAILED' WHEN failed_objects > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status
    FROM (SELECT batch_id, count(*) AS input_objects, count(*) FILTER (WHERE failure IS NULL) AS successful_objects, count(failure) AS failed_objects,
            CAST(COALESCE(sum(hours) FILTER (WHERE failure IS NULL), 0) AS BIGINT) AS records_transformed FROM m_docs GROUP BY 1)""",
)
_FOUND = "(k % 29 <> 11 AND (k % 13 = 4 OR (k % 11 <> 2 AND k % 19 <> 8)))"
oracle(
    "raw_audit",
    " UNION ALL ".join(
        f"SELECT batch_id, point_id, '{c}' AS code, '{f}' AS field FROM m_docs WHERE {cond}"
        for c, f, cond in [
            ("RAW_POINT_FIELD_MISSING", "point.location_id", "k % 41 = 8"),
            ("RAW_POINT_STRING", "point.location_id", "k % 41 = 8"),
            ("RAW_POINT_FIELD_MISSING", "point.point_name", "k % 37 = 6"),
            ("RAW_POINT_STRING", "point.point_name", "k % 37 = 6"),
            ("RAW_POINT_FIELD_MISSING", "point.point_type", "k % 37 = 6"),
            ("RAW_POINT_STRING", "point.point_type", "k % 37 = 6"),
            ("RAW_POINT_FIELD_MISSING", "point.latitude", "k % 31 = 9"),
            ("RAW_COORDINATE_RANGE", "point.latitude", "k % 31 = 9"),
            ("RAW_HOURLY_OBJECT", "api_response.hourly", f"NOT {_FOUND}"),
            ("RAW_HOURLY_FIELD", "hourly.ozone", f"{_FOUND} AND k % 7 = 0"),
            ("RAW_HOURLY_LENGTH", "hourly.ozone", f"{_FOUND} AND k % 7 <> 0 AND k % 17 = 3"),
        ]
    ),
)

# --- run logs -----------------------------------------------------------------------------------

PARTS["m_batches"] = """
  SELECT batch_id, count(*) AS n, count(DISTINCT point_id) AS p, min(ingested_at) AS t0,
    max(ingested_at) AS t1 FROM m_readings GROUP BY 1"""
_STAGE_ROWS = {
    "extract": ("CASE WHEN n % 5 = 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END", "n + CAST(n % 2 = 0 AS BIGINT)", "n + CAST(n % 2 = 0 AS BIGINT)", "n % 3"),
    "transform": ("'SUCCESS'", "p", "n", "0"),
    "data_quality": ("CASE WHEN n % 4 = 0 THEN 'FAILED' ELSE 'PARTIAL_SUCCESS' END", "n", "n - n % 7", "n % 7"),
    "load_timescaledb": ("'SUCCESS'", "n", "n", "0"),
    "alerts": ("'SUCCESS'", "n", "n % 13", "0"),
    "mart": ("CASE WHEN n % 9 = 0 THEN 'FAILED' ELSE 'SUCCESS' END", "n", "p", "0"),
}
oracle(
    "run_log_rows",
    " UNION ALL ".join(
        f"""SELECT batch_id || ':{stage}' AS run_id, batch_id, 'hourly_pipeline' AS pipeline_name, '{SOURCE}' AS source, '{stage}' AS stage_name,
      {status} AS status, t0 AS started_at, CASE WHEN n % 6 <> 0 THEN t1 END AS finished_at, n / CAST(8 AS DOUBLE) AS duration_seconds,
      CAST({into} AS BIGINT) AS input_records, CAST({out} AS BIGINT) AS output_records, CAST({lost} AS BIGINT) AS failed_records,
      {"CASE WHEN n % 3 > 0 THEN '{" + '"point_id":"P0","position":' + "' || CAST(n AS VARCHAR) || '}' END" if stage == 'extract' else 'CAST(NULL AS VARCHAR)'} AS error_message,
      '{stage}/batch_id=' || batch_id || '/summary.json' AS summary_object_name
    FROM m_batches{' WHERE n % 10 <> 0' if stage == 'alerts' else ''}"""
        for stage, (status, into, out, lost) in _STAGE_ROWS.items()
    ),
)
_CHECKED = """'seen' AS message, CASE WHEN n % 6 <> 0 THEN t1 END AS checked_at,
  'data_quality/batch_id=' || batch_id || '/summary.json' AS summary_object_name FROM m_batches"""
oracle(
    "check_log_rows",
    f"""SELECT batch_id || ':data_quality' AS run_id, batch_id, 'RECORD_COUNT' AS check_name, CASE WHEN n % 2 = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
      n % 2 AS bad_records_count, {_CHECKED}
    UNION ALL SELECT batch_id || ':data_quality', batch_id, 'FRESHNESS', CASE WHEN n % 4 = 0 THEN 'UNKNOWN' ELSE 'WARNED' END, CAST(0 AS BIGINT), {_CHECKED}""",
)
oracle(
    "latest_loadable_batch",
    """SELECT batch_id, 'data_quality/batch_id=' || batch_id || '/summary.json' AS object_name, 'PARTIAL_SUCCESS' AS status,
      CASE WHEN n % 6 <> 0 THEN t1 ELSE t0 END AS moment
    FROM m_batches WHERE n % 4 <> 0 AND n - n % 7 > 0 ORDER BY moment DESC, object_name DESC LIMIT 1""",
)
oracle(
    "batch_identity_check",
    "SELECT batch_id, n % 11 <> 0 AS identity_ok, true AS status_ok, true AS rows_ok, true AS path_ok FROM m_batches",
)
oracle(
    "latest_valid_mart",
    """SELECT batch_id, 'mart/batch_id=' || batch_id || '/summary.json' AS object_name, p AS current_aqi_rows, p % 25 AS location_summary_rows, n AS daily_summary_rows
    FROM m_batches WHERE n % 9 <> 0 AND n % 8 <> 0 ORDER BY object_name DESC LIMIT 1""",
)
oracle(
    "stage_chain",
    """SELECT batch_id, n % 7 <> 0 AS is_complete, n % 10 <> 0 AS has_alerts, n % 7 <> 0 AND n % 11 <> 0 AS is_valid FROM m_batches""",
)
