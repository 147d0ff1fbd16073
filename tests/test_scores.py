"""Score rules on hand-made records, and the naive form of every score."""

import pytest
from compare import rows
from pyspark.sql import functions as F

from benchmarks.naive import NAIVE
from fleetlens import adapters as A
from fleetlens import schema
from fleetlens.operators import profile, scores
from fleetlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
HOURLY = (
    "sn string, station_mac string, station_name string, band string, rssi double, snr double, phy_rate int, "
    "tx_phy_rate int, model string, hour string, date string, son int, p50_rssi int, p90_rssi int, mobility_status string"
)


def records(mac="m1", n=9, sn="S1", band="5GHz", rssi=-60.0, snr=30.0, phy=250, tx=350, model="A", name="n", mobility="Stationary", son=0):
    return [(sn, mac, name, band, rssi, snr, phy, tx, model, "05", "20250101", son, int(rssi), int(rssi), mobility)] * n


def hourly(spark, *groups):
    return spark.createDataFrame([r for g in groups for r in g], HOURLY)


def used(spark, *rows_):
    return spark.createDataFrame([("S1", mac, "20250101", "05", b) for mac, b in rows_], "sn string, station_mac string, date string, hour string, total_bytes long").withColumn("total_bytes", F.col("total_bytes").cast("decimal(38,0)"))


def no_reliability(spark):
    return spark.createDataFrame([], "sn string, date string, hour string, p90_airtime_util_2_4g int, reliability_score_num int")


def history(spark, rows_, date="20250101", hour="05"):
    """rows_: (rowkey, mac, signal, ts, bs, br)."""
    data = [(key, "A", (mac, "n", "5GHz", sig, 20.0, "866Mbps", "400Mbps", ts, bs, br), date, hour) for key, mac, sig, ts, bs, br in rows_]
    return spark.createDataFrame(data, schema.STATION_HISTORY)


@pytest.mark.parametrize("name", sorted(NAIVE))
def test_same_as_naive(spark, name):
    mine, naive = QUERIES[name](spark, SF), NAIVE[name](spark, SF)
    if name == "station_score":
        mine = mine.select(*scores.STATION, "variation_score", "base_score")
    naive = naive.select(mine.columns)
    assert rows([tuple(r) for r in mine.collect()], mine.columns) == rows([tuple(r) for r in naive.collect()], naive.columns)


def test_records_are_dated_in_the_time_zone_of_the_session(spark):
    from fleetlens.session import configure

    rows_ = [("R-S1_0", "m", -50.0, 1735700400000, 1, 1)]  # 2025-01-01 03:00 UTC
    try:
        configure(spark, "America/New_York")
        assert tuple(profile.hourly_records(history(spark, rows_)).select("date", "hour").first()) == ("20241231", "22")
    finally:
        configure(spark)
    assert tuple(profile.hourly_records(history(spark, rows_)).select("date", "hour").first()) == ("20250101", "03")


def test_fractions_of_airtime_count(spark):
    radio = lambda text: [{"_2_4g": {"enable": "1", "airtime_util": text}}]
    data = [("G-S1", radio("45.7"), "d", "h"), ("G-S1", radio("n/a"), "d", "h"), ("G-S2", radio("-0.5"), "d", "h"), ("G-S3", radio("101.2"), "d", "h")]
    found = scores.reliability_score(spark.createDataFrame(data, schema.DEVICE_GROUPS)).collect()
    assert {r["sn"]: r["p90_airtime_util_2_4g"] for r in found} == {"S1": 45, "S2": 0}


# --- stationarity ------------------------------------------------------------


def _label(spark, signals):
    rows_ = [("R-S1_0", "m", float(s), 0, 1, 1) for s in signals]
    return [r["mobility_status"] for r in profile.stationarity(history(spark, rows_)).collect()]


def test_constant_signal_has_no_label(spark):
    assert _label(spark, [-60] * 20) == []


def test_labels(spark):
    assert _label(spark, [-60, -61, -62, -59, -58] * 4) == ["Stationary"]
    assert _label(spark, [-60 - 2 * i for i in range(20)]) == ["Non-stationary"]


def test_null_signal_is_ignored(spark):
    df = history(spark, [("R-S1_0", "m", None, 0, 1, 1)])
    assert profile.stationarity(df).count() == 0


def test_hourly_fact_attaches_per_device_not_home(spark):
    rows_ = [("R-S1_0", "m", -50.0, 0, 1, 1), ("R-S2_0", "m", -70.0, 0, 1, 1), ("R-S3_0", None, -80.0, 0, 1, 1)]
    mobility = spark.createDataFrame([("S1", "m", "Stationary")], "sn string, station_mac string, mobility_status string")
    out = {r["sn"]: r for r in profile.hourly_fact(history(spark, rows_), mobility).collect()}
    assert {sn: (r["p50_rssi"], r["p90_rssi"]) for sn, r in out.items()} == {"S1": (-70, -50), "S2": (-70, -50), "S3": (-80, -80)}
    assert out["S1"]["mobility_status"] == "Stationary" and out["S2"]["mobility_status"] is None
    assert (out["S1"]["hour"], out["S1"]["date"]) == ("00", "19700101")


# --- station score -----------------------------------------------------------


def test_station_score_takes_the_worst_and_the_variation(spark):
    df = hourly(
        spark,
        records("good", rssi=-60.0, phy=250),
        records("worst", rssi=-60.0, phy=60),
        records("varied", 8) + records("varied", 1, snr=50.0),
        records("nothing", band="6GHz"),
        records("few", 8),
        records(None, 9),
    )
    out = {r["station_mac"]: (r["base_score"], r["variation_score"], r["station_score"], r["station_score_num"]) for r in scores.station_score(df).collect()}
    assert out == {
        "good": (4, 0, "Excellent", 4),
        "worst": (2, 0, "Fair", 2),
        "varied": (4, 1, "Good", 3),
        "nothing": (None, 0, "Poor", 1),
    }


def test_variation_limits_are_exclusive(spark):
    at = records("a", 8, snr=10.0, phy=100) + records("a", 1, snr=23.0, phy=400)
    over = records("b", 8, snr=10.0) + records("b", 1, snr=23.5)
    sons = records("c", 7, son=1) + records("c", 2)
    out = {r["station_mac"]: r["variation_score"] for r in scores.variation_components(hourly(spark, at, over, sons)).collect()}
    assert out == {"a": 0, "b": 1, "c": 1}


# --- consumption -------------------------------------------------------------


def test_consumption_limit_and_missing_struct(spark):
    limit = scores.MAX_TOTAL_BYTES
    rows_ = [("R-S1_0", "at", 0.0, 0, limit - 1, 1), ("R-S1_0", "below", 0.0, 0, limit - 2, 1), ("R-s2_0", "low", 0.0, 0, 1, 1)]
    df = history(spark, rows_).union(spark.createDataFrame([("R-S9_0", "A", None, "20250101", "05")], schema.STATION_HISTORY))
    out = {(r["sn"], r["station_mac"]): int(r["total_bytes"]) for r in scores.data_consumption(df).collect()}
    assert out == {("S1", "below"): limit - 1, ("s2", "low"): 2}


# --- speed, coverage, composite ----------------------------------------------


def test_small_home_scores_at_most_0_8(spark):
    df = hourly(spark, *[records(f"m{i}", tx=500) for i in range(3)])
    row = scores.speed_score(df, used(spark)).first()
    assert row["home_weighted_avg_base_score_speed"] == 3.2
    assert scores.speed_score(df, used(spark), renormalize=True).first()["home_weighted_avg_base_score_speed"] == 4.0


def test_top_five_by_consumption(spark):
    groups = [records(f"m{i}", tx=500 if i < 5 else 100) for i in range(7)]
    bytes_ = [(f"m{i}", 1000 - i) for i in range(6)]
    row = scores.speed_score(hourly(spark, *groups), used(spark, *bytes_)).first()
    assert row["home_weighted_avg_base_score_speed"] == 3.4  # 0.8 * 4 + 0.2 * 1


def test_slow_rows_and_invalid_snr(spark):
    df = hourly(
        spark,
        records("ok"),
        records("slow", tx=24),
        records("no snr", snr=60.0),
        records("edge", 8, snr=50.0) + records("edge", 1, snr=0.0),
    )
    out = {r["station_mac"]: r["speed_variation_score"] for r in scores.speed_score(df, used(spark)).collect()}
    assert out == {"ok": 0, "edge": 1}


def test_home_without_scored_band_counts_zero(spark):
    df = hourly(spark, records("m1", 8, band="6GHz") + records("m1", 1, band="6GHz", snr=0.0))
    row = scores.speed_score(df, used(spark)).first()
    assert (row["home_weighted_avg_base_score_speed"], row["speed_score_num"]) == (0.0, -1.0)
    wifi = scores.wifi_score(df, used(spark), no_reliability(spark)).first()
    assert (wifi["wifi_score_num_unrounded"], wifi["wifi_score_num"]) == (-0.5, 1)


def test_null_attributes_drop_out_of_the_composite(spark):
    df = hourly(spark, records("full"), records("anon", name=None))
    macs = lambda **o: sorted(r["station_mac"] for r in scores.wifi_score(df, used(spark), no_reliability(spark), **o).collect())
    assert macs() == ["full"]
    assert macs(null_safe=True) == ["anon", "full"]


def test_attributes_must_agree_between_speed_and_coverage(spark):
    df = hourly(spark, records("m1", 9, model="A") + records("m1", 1, model="Z", tx=5))
    assert scores.wifi_score(df, used(spark), no_reliability(spark)).count() == 0
    row = scores.wifi_score(df, used(spark), no_reliability(spark), attributes="coverage").first()
    assert row["model"] == "Z"


def test_composite_with_and_without_reliability(spark):
    df = hourly(spark, records("m1", tx=500, rssi=-50.0))
    reliable = spark.createDataFrame([("S1", "20250101", "05", 45, 3)], no_reliability(spark).schema)
    with_, without = (scores.wifi_score(df, used(spark), r).first() for r in (reliable, no_reliability(spark)))
    assert with_["wifi_score_num_unrounded"] == pytest.approx(3.13)  # (3.2 + 3.2 + 3) / 3
    assert (without["wifi_score_num_unrounded"], without["reliability_score_num"]) == (3.2, None)
    assert without["wifi_score_category"] == "Good"


@pytest.mark.parametrize("null_safe", [False, True])
def test_fused_composite_equals_joined_tables(spark, null_safe):
    hourly_rows = profile.hourly_fact(A.station_history(spark, SF), profile.stationarity(A.previous_day_history(spark, SF)))
    consumption = scores.data_consumption(A.station_history(spark, SF), A.MAX_BYTES)
    reliability = scores.reliability_score(A.device_groups(spark, SF))
    fused = scores.wifi_score(hourly_rows, consumption, reliability, null_safe=null_safe)
    joined = scores.composite_score(
        scores.speed_score(hourly_rows, consumption), scores.coverage_score(hourly_rows, consumption), reliability, null_safe
    )
    assert fused.columns == joined.columns and len(fused.columns) == 28
    assert rows([tuple(r) for r in fused.collect()], fused.columns) == rows([tuple(r) for r in joined.collect()], joined.columns)


# --- reliability -------------------------------------------------------------


def test_reliability_filters(spark):
    radio = lambda enable, air: {"_2_4g": {"enable": enable, "airtime_util": air}}
    data = [
        ("G-S1", [radio("1", "40"), radio("0", "1"), radio("1", ""), radio("1", None), radio("1", "101"), radio("1", "x")], "d", "05"),
        ("G-S2_7", [radio("1", "70")], "d", "05"),
        ("G-S3", None, "d", "05"),
        ("G-S4", [radio("0", "10")], "d", "05"),
    ]
    out = {r["sn"]: (r["p90_airtime_util_2_4g"], r["reliability_score_num"]) for r in scores.reliability_score(spark.createDataFrame(data, schema.DEVICE_GROUPS)).collect()}
    assert out == {"S1": (40, 3), "S2": (70, 2)}
