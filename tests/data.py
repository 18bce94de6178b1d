"""Small inputs shared by the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from skyledger.schema import AQI_COLUMNS, CLEAN_SCHEMA, POLLUTANTS

SOURCE = "sensor_feed"
START = datetime(2026, 7, 20, 12)


def reading(point="P1", location="L1", hour=0, **changes):
    row = {
        "point_id": point,
        "location_id": location,
        "point_name": f"Point {point}",
        "point_type": "urban_center",
        "latitude": 21.0 if point == "P1" else 10.0,
        "longitude": 105.0 if point == "P1" else 106.0,
        "forecast_time": START + timedelta(hours=hour),
        **{c: 10.0 for c in POLLUTANTS},
        **{c: 40 for c in AQI_COLUMNS},
        "source": SOURCE,
        "batch_id": "B1",
        "schema_version": "1.0",
        "ingested_at": START + timedelta(minutes=5),
    }
    return {**row, **changes}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in CLEAN_SCHEMA) for r in rows], CLEAN_SCHEMA)


def points(spark, active=("Yes", "Yes")):
    rows = [
        ("P1", "L1", "Point P1", "urban_center", 21.0, 105.0, active[0]),
        ("P2", "L2", "Point P2", "urban_center", 10.0, 106.0, active[1]),
    ]
    return spark.createDataFrame(
        rows,
        "point_id string, location_id string, point_name string, point_type string, "
        "latitude double, longitude double, is_active string",
    )


def locations(spark):
    rows = [
        ("L1", "North", "R1", "City", "1"),
        ("L2", "South", "R2", "Province", "true"),
        ("NA", "Coast", "R2", "Province", "y"),
    ]
    return spark.createDataFrame(
        rows, "location_id string, location_name string, region string, admin_type string, is_active string"
    )


def batch():
    return [reading(p, l, h) for p, l in (("P1", "L1"), ("P2", "L2")) for h in range(3)]
