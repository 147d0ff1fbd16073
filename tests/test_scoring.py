"""Column functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import clean, scoring


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return df.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "rowkey, pattern, expected",
    [
        ("R1-ABC123_0", "upper", "ABC123"),
        ("R1-abc123_0", "upper", ""),
        ("R1-abc123_0", "bounded", "abc123"),
        ("R1-ABC123", "bounded", ""),
        ("R1-ABC123", "open", "ABC123"),
        ("nothing", "open", ""),
        (None, "upper", None),
    ],
)
def test_serial(spark, rowkey, pattern, expected):
    assert one(spark, clean.serial(F.lit(rowkey), pattern)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("866Mbps", 866), ("866.7Mbps", 866), (" 12 Mbps", 12), ("", None), ("n/a", None), ("NaN", None), (None, None)],
)
def test_rate(spark, text, expected):
    assert one(spark, clean.rate(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "name, pattern, expected",
    [
        ("part-2024-01-05.csv", "either", "2024-01-05"),
        ("20240105", "compact", "2024-01-05"),
        ("date=20240105", "dashed", None),
        ("2024-13-45.csv", "dashed", None),
        ("a 2024-01-05 then 2024-01-06", "dashed", "2024-01-05"),
        ("none", "either", None),
    ],
)
def test_day_in_name(spark, name, pattern, expected):
    found = one(spark, clean.day_in_name(F.lit(name), pattern))
    assert (str(found) if found else None) == expected


def test_epoch(spark):
    ms = F.lit(1759244399999)  # 2025-09-30 14:59:59.999 UTC
    assert one(spark, clean.epoch_hour(ms)) == "14"
    assert one(spark, clean.epoch_day(ms)) == "20250930"


@pytest.mark.parametrize(
    "steps, value, expected",
    [
        (scoring.STATION_RSSI_2_4G, -65.0, 4),
        (scoring.STATION_RSSI_2_4G, -65.5, None),
        (scoring.STATION_RSSI_2_4G, -66.0, 3),
        (scoring.STATION_RSSI_2_4G, -85.0, 2),
        (scoring.STATION_RSSI_2_4G, -85.1, 1),
        (scoring.STATION_PHY_5G, 99.5, None),
        (scoring.SPEED_TX_2_4G, 120.0, 3),
        (scoring.SPEED_TX_2_4G, 120.5, 4),
        (scoring.SPEED_TX_2_4G, 79.0, 1),
        (scoring.COVERAGE_RSSI_5G, -77.5, 1),
        (scoring.AIRTIME_2_4G, 39, 4),
        (scoring.AIRTIME_2_4G, 40, 3),
        (scoring.AIRTIME_2_4G, 50, 3),
        (scoring.AIRTIME_2_4G, 70, 2),
        (scoring.AIRTIME_2_4G, 71, 1),
        (scoring.STATION_PHY_5G, None, None),
    ],
)
def test_ladder(spark, steps, value, expected):
    assert one(spark, scoring.ladder(F.lit(value).cast("double"), steps)) == expected


@pytest.mark.parametrize("a, b, expected", [(4, 3, 3.5), (4, None, 4.0), (None, None, None)])
def test_mean_present(spark, a, b, expected):
    assert one(spark, scoring.mean_present(F.lit(a).cast("int"), F.lit(b).cast("int"))) == expected


@pytest.mark.parametrize("mean, number, name", [(3.51, 4, "Excellent"), (3.5, 3, "Good"), (2.5, 2, "Fair"), (1.5, 1, "Poor"), (None, 1, "Poor")])
def test_classes(spark, mean, number, name):
    chosen = scoring.class_number(F.lit(mean).cast("double"))
    assert one(spark, chosen) == number
    assert one(spark, scoring.class_name(chosen)) == name


def test_report_label(spark):
    assert one(spark, clean.report_label(F.lit("2025-05-02").cast("date"), "Data")) == "Data Q2 2025"
