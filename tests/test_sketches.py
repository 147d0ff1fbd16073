"""Mergeable state: signal sketches, day bitmaps, co-moments, sketched group sizes and ranges."""

import datetime as dt
import math
import re

import numpy as np
import pytest
from compare import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens import adapters as A
from fleetlens.operators import daymaps, features, freshness, grouping, profile, sketches
from fleetlens.session import scratch_path, stage

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cells = [[tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect()] for df in (a, b)]
    assert rows(cells[0], a.columns) == rows(cells[1], b.columns)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


# --- signal sketches -----------------------------------------------------------


def history(spark, signals, hours=6):
    """Signals of stations, dealt over the hours of a day."""
    cells = [(f"R-S1_{n}", mac, s, 1_700_000_000_000 + (n % hours) * 3_600_000) for mac, own in signals.items() for n, s in enumerate(own)]
    return spark.createDataFrame(cells, "rowkey string, station_mac string, signal_strength double, ts long")


def test_merged_labels_are_those_of_the_raw_rows(spark):
    r = np.random.default_rng(1)
    signals = {f"m{k}": (r.normal(-60, k / 4, 200)).tolist() for k in range(30)}
    signals |= {"one": [-50.0], "none": [None, None], "some": [None, -40.0, -41.0], "equal": [-50.0] * 40}
    raw = history(spark, signals)
    hours = stage(sketches.station_hours(raw), "hours")
    same(sketches.stationarity(hours), profile.stationarity(raw))
    same(sketches.device_signal(hours), profile.device_signal(raw))
    assert hours.where("signals is null").select("station_mac").distinct().count() == 2
    assert sketches.station_hours(raw.where("false")).collect() == []


def test_merging_in_steps_gives_the_same(spark):
    raw = history(spark, {"a": [float(x % 37) for x in range(300)], "b": [float(x) for x in range(100)]})
    hours = sketches.station_hours(raw)
    halves = sketches.merged(hours, ["sn", "station_mac", "date"])
    same(sketches.device_signal(halves), sketches.device_signal(hours))


def test_large_groups_stay_within_the_stated_error(spark):
    raw = history(spark, {"m": np.random.default_rng(2).permutation(40_000).astype(float).tolist()}, hours=20)
    got = sketches.merged(sketches.station_hours(raw), ["station_mac"]).select(sketches.quantiles("signals", 0.03, 0.1, 0.5, 0.9).alias("p"))
    for fraction, value in zip((0.03, 0.1, 0.5, 0.9), got.first()["p"]):
        assert abs(value / 40_000 - fraction) <= sketches.rank_error()


def test_the_fact_reads_history_once(spark):
    raw = stage(A.station_history(spark, SF), "history")
    hours = stage(sketches.station_hours(raw), "hours")
    mobility = stage(sketches.stationarity(hours), "mobility")
    df = sketches.hourly_fact(raw, hours, mobility)
    assert len(re.findall(r"FileScan parquet \[rowkey", plan(df))) == 1
    same(df, profile.hourly_fact(raw, profile.stationarity(raw)))


# --- day bitmaps ---------------------------------------------------------------


def observed(spark, days):
    return spark.createDataFrame([(n, dt.date.fromisoformat(d) if d else None) for n, d in days], "name string, observed_date date")


def registry(spark, cells):
    return spark.createDataFrame(cells, "name string, expect_delay int, calendar string")


DAYS = [("a", "2024-01-30"), ("a", "2024-01-29"), ("a", "2024-01-29"), ("b", "2024-02-05"), ("b", "2024-01-12"), ("c", "1960-01-01"), ("d", None), ("e", "2059-09-19"), ("e", "2059-09-20")]
CELLS = [("a", 0, "daily"), ("b", 2, "business"), ("c", 0, None), ("d", -1, "business"), ("e", 1, "daily"), ("f", 0, None)]


@pytest.mark.parametrize("as_of", ["2024-01-31", "2059-09-25"])
def test_reports_from_maps(spark, as_of):
    known, seen = registry(spark, CELLS), observed(spark, DAYS)
    maps = daymaps.day_maps(seen)
    for span in (freshness.window("folder"), freshness.window("table")):
        same(daymaps.report(known, maps, as_of, span, ["2024-01-15"]), freshness.report(known, seen, as_of, span, ["2024-01-15"]))
        same(daymaps.missing(known, maps, as_of, span), freshness.missing_days(known, seen, as_of, span))


def test_maps_are_kept_and_merged(spark):
    path, known = scratch_path(spark, "maps"), registry(spark, CELLS)
    assert daymaps.read(spark, path).collect() == []
    for part in (DAYS[:2], DAYS[2:6], DAYS[6:], DAYS[2:6], []):
        maps = daymaps.update(path, observed(spark, part))
    span = freshness.window("file_drop")
    same(daymaps.report(known, maps, "2024-01-31", span), freshness.report(known, observed(spark, DAYS), "2024-01-31", span))
    # Two bitmaps of 32,768 days each: until 2059-09-19, and after.
    assert {(r["name"], r["bucket"]) for r in maps.collect()} >= {("e", 1), ("e", 2)}


def test_a_run_reads_new_days_only(spark):
    path = scratch_path(spark, "maps")
    old, new = (stage(observed(spark, part), name) for part, name in ((DAYS[:3], "old_days"), (DAYS[3:], "new_days")))
    daymaps.update(path, old)
    report = daymaps.report(registry(spark, CELLS), daymaps.update(path, new), "2024-01-31", freshness.window("folder"))
    assert "old_days" not in plan(report) and "new_days" not in plan(report)
    assert "old_days" not in plan(daymaps.merged(daymaps.read(spark, path), daymaps.day_maps(new)))


def test_no_calendar_is_a_daily_one(spark):
    known, seen = registry(spark, [("a", 0, None)]), observed(spark, [("a", "2024-01-31")])
    missing = freshness.missing_days(known, seen, "2024-01-31", freshness.window("folder"))
    report = freshness.report(known, seen, "2024-01-31", freshness.window("folder")).first()
    assert missing.count() == len(report["miss_days"]) == 21


# --- co-moments ----------------------------------------------------------------


def frame(spark, values):
    names = [f"c{k}" for k in range(len(values[0]))]
    return spark.createDataFrame(values, ", ".join(f"{n} double" for n in names)).repartition(5), names


def matrix(df, names):
    long = features.correlation_matrix(df, names)
    return {(r["col_a"], r["col_b"]): (r["r"], r["n"]) for r in long.collect()}


def test_many_columns(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(400, 3))
    values = base @ r.normal(size=(3, 70)) + r.normal(size=(400, 70)) + 1e9 * r.integers(0, 2, 70)
    cells = [[None if r.random() < 0.1 else float(x) for x in row] for row in values]
    for row in cells:
        row[5], row[6] = (0.1 if row[5] is not None else None), None
    df, names = frame(spark, cells)
    found = matrix(df, names)
    assert len(found) == 70 * 70
    masked = np.array([[np.nan if x is None else x for x in row] for row in cells])
    for a, b in [(0, 1), (1, 0), (3, 3), (10, 69), (64, 65), (2, 40)]:
        both = ~np.isnan(masked[:, a]) & ~np.isnan(masked[:, b])
        x, y = masked[both, a], masked[both, b]
        x, y = x - x.mean(), y - y.mean()
        assert found[names[a], names[b]][1] == both.sum()
        assert found[names[a], names[b]][0] == pytest.approx((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()), rel=1e-6)
    assert found["c5", "c5"][0] is None and found["c5", "c9"][0] is None and found["c9", "c5"][0] is None
    assert found["c6", "c1"] == (None, 0)
    assert features.correlation_matrix(df.where("false"), names).collect() == []


def test_both_forms_agree(spark, monkeypatch):
    cells = [[1.0, None, 3.0, 1e9], [2.0, 5.0, 3.0, 1e9 + 1], [4.0, 1.0, 3.0, None], [None, 2.0, 3.0, 1e9 + 3], [8.0, 2.5, None, 1e9 - 2]]
    df, names = frame(spark, cells)
    few = matrix(df, names)
    monkeypatch.setattr(features, "FEW_COLUMNS", 0)
    many = matrix(df, names)
    assert few.keys() == many.keys()
    for k, (r, n) in few.items():
        assert many[k][1] == n and (many[k][0] == pytest.approx(r, rel=1e-6) if r is not None else many[k][0] is None)
    cells[0][0] = math.nan
    found = matrix(frame(spark, cells)[0], names)
    assert math.isnan(found["c0", "c3"][0]) and not math.isnan(found["c1", "c3"][0])


def test_matrices_are_added_up_in_a_tree(spark):
    df, names = frame(spark, [[float(k * j % 7) for k in range(12)] for j in range(50)])
    wanted = {(r["col_a"], r["col_b"]): r["c"] for r in features.comoments(df, names).collect()}
    found = features.comoments(df, names, stripe=5, cuts=2)
    assert {(r["col_a"], r["col_b"]): pytest.approx(r["c"], abs=1e-9) for r in found.collect()} == wanted
    assert len(wanted) == 78 and "Generate" not in plan(found)  # no pairs per row


# --- group sizes and ranges ----------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(0, 30_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"),
        F.when(F.col("id") % 9 > 0, F.exp(F.randn(5) * 3)).alias("bytes"),
    )


@pytest.mark.parametrize("large", [10, 700, 1_000_000])
def test_group_sizes(skewed, large):
    wanted = skewed.withColumn("record_count", F.count(F.lit(1)).over(Window.partitionBy("k")))
    same(grouping.record_count_by_cuts(skewed, ["k"], large=large).drop("bytes"), wanted.drop("bytes"))


def test_a_large_group_is_cut(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = grouping.record_count_by_cuts(skewed, ["k"], large=500)
        hot = out.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        text = plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(r["count"] for r in hot) == 10_000 and len(hot) >= 6 and max(r["count"] for r in hot) < 5_000
    assert len(re.findall(r"Exchange hashpartitioning\(__group", text)) == 1


def test_ranges_hold_equally_many_values(skewed):
    wanted = skewed.withColumn("place", F.rank().over(Window.partitionBy("k").orderBy(F.desc_nulls_last("bytes"))))
    same(grouping.rank_within(skewed, ["k"], "bytes", None, "place"), wanted)
    values = skewed.where("bytes is not null").select("k", "bytes").distinct()
    bounds = grouping.range_bounds(values, ["k"], "bytes", 64)
    dealt = grouping.attach(values, bounds, ["k"]).where("k = 'hot'")
    sizes = dealt.groupBy(F.size(F.filter("__bounds", lambda b: b <= F.col("bytes"))).alias("range")).count().collect()
    total = sum(r["count"] for r in sizes)
    assert len(sizes) == 64 and max(r["count"] for r in sizes) <= 1.2 * total / 64
