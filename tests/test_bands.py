import pytest
from pyspark.sql import functions as F

from skyledger.functions import bands

EDGES = [0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301]
CODES = (
    ["GOOD"] * 2
    + ["MODERATE"] * 2
    + ["UNHEALTHY_SENSITIVE"] * 2
    + ["UNHEALTHY"] * 2
    + ["VERY_UNHEALTHY"] * 2
    + ["HAZARDOUS"]
)


def one(spark, value, expression, kind="double"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()[0]


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in EDGES], "x int")
    rows = df.select("x", bands.level_code(F.col("x")).alias("c"), bands.alert_severity(F.col("x")).alias("s")).collect()
    assert [r.c for r in sorted(rows)] == CODES
    assert [r.s for r in sorted(rows)] == [None] * 4 + ["MEDIUM"] * 2 + ["HIGH"] * 2 + ["CRITICAL"] * 3


def test_missing_and_negative(spark):
    assert one(spark, None, bands.level_name) is None
    assert one(spark, float("nan"), bands.level_name) is None
    assert one(spark, -3.0, bands.level_name) == "Good"
    assert one(spark, None, bands.display_level) == bands.NO_DATA_LEVEL
    assert one(spark, 301.0, bands.local_level) == "Nguy hại"
    assert one(spark, 301.0, bands.display_level) == "Nguy hiểm"


@pytest.mark.parametrize(
    "value, error", [("75", None), (None, None), ("7.5", "FRACTIONAL"), ("-1", "NEGATIVE"), ("n/a", "NOT_A_NUMBER")]
)
def test_strict_classification(spark, value, error):
    assert one(spark, value, bands.classification_error, "string") == error
    if error is None:
        assert one(spark, value, bands.strict_value, "string") == (None if value is None else int(value))
    else:
        with pytest.raises(Exception, match="cannot be classified"):
            one(spark, value, bands.strict_value, "string")


def test_alert_message(spark):
    df = spark.createDataFrame([("P1", "L1", 181), ("P2", "L2", 90)], "p string, l string, x int")
    texts = [r[0] for r in df.select(bands.alert_message(F.col("p"), F.col("l"), F.col("x"))).collect()]
    assert texts == ["Cảnh báo chất lượng không khí: P1 (L1) có US AQI=181, mức 'Không tốt'.", None]


def test_marker_and_color(spark):
    assert one(spark, 400.0, bands.marker_radius) == 300 * 110 + 22000
    assert one(spark, None, bands.marker_radius) == 22000
    assert one(spark, 120.0, bands.fill_color) == [249, 115, 22, 230]
