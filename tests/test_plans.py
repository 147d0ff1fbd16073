"""Shapes of the plans, and the hourly job from folders to tables."""

import re

import pytest
from pyspark.sql import functions as F

from fleetlens import adapters as A
from fleetlens.operators import features, freshness, profile, scores
from fleetlens.plans.hourly import read_hour, score_hour
from fleetlens.session import stage, stage_bucketed
from fleetlens.sinks.files import children, overwrite_partitions

SF = "/root/testdata/sf0.001"


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def count(df, node):
    return len(re.findall(rf"[-+ ]{node}\b", plan(df)))


@pytest.fixture(scope="module")
def fact(spark):
    return stage(profile.hourly_fact(A.station_history(spark, SF), profile.stationarity(A.previous_day_history(spark, SF))), "fact")


def test_stationarity_is_one_aggregate(spark):
    df = profile.stationarity(A.previous_day_history(spark, SF))
    assert (count(df, "Exchange"), count(df, "Window")) == (1, 0)


def test_nested_fields_are_pruned_and_partition_columns_are_optional(spark):
    written = stage(A.nested_history(spark, SF).drop("date", "hour"), "nested")
    read = re.search(r"ReadSchema: (.*)", plan(profile.stationarity(written))).group(1)
    assert "signal_strength" in read and not re.search("link_rate|snr|bs:", read)


def test_station_score_is_one_aggregate(fact):
    df = scores.station_score(fact)
    assert (count(df, "Exchange"), count(df, "FileScan"), count(df, "Window")) == (1, 1, 0)
    assert "Join" not in plan(df)


def test_scores_read_only_their_columns(fact):
    scan = re.search(r"FileScan parquet \[(.*?)\]", plan(scores.station_quality(fact, speed=False))).group(1)
    assert not re.search(r"snr|tx_phy_rate|p50_rssi|son", scan)
    assert "IsNotNull(sn)" in plan(scores.station_quality(fact, speed=False))


def test_staged_wifi_score_reads_the_fact_once(spark, fact):
    written = []

    def staged(df, name):
        written.append(count(df, "FileScan"))
        return stage(df, name)

    none = spark.createDataFrame([], "sn string, station_mac string, date string, hour string, total_bytes decimal(38,0)")
    reliability = scores.reliability_score(A.device_groups(spark, SF))
    df = scores.wifi_score(fact, none, reliability, stage=staged)
    assert written == [1]
    assert "record_count" not in plan(df) and "station_connection" not in plan(df)


def test_percentiles_of_a_large_group(spark):
    """Ten thousand values: approximate with the default accuracy, exact with more."""
    from fleetlens.operators.grouping import percentiles

    df = spark.range(0, 20_001, 1, 8).select((F.col("id") * 7919 % 20_001).alias("v"))
    near, exact = df.agg(percentiles("v", 0.9)[0], percentiles("v", 0.9, accuracy=100_000)[0]).first()
    assert exact == 18_000 and abs(near - 18_000) <= 3


def test_correlation_is_one_pass(spark):
    df = features.correlation_matrix(A.table(spark, SF, "lineitem"), ["l_quantity", "l_tax", "l_discount"])
    assert (count(df, "FileScan"), count(df, "Exchange")) == (1, 1)


def test_missing_days_shrinks_before_it_moves(spark):
    df = freshness.missing_days(A.registry(spark, SF), A.observed_dates(spark, SF), A.AS_OF, (0, 20))
    assert "LeftAnti" in plan(df) and "CartesianProduct" not in plan(df)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", plan(df))
    assert any("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in pushed)


def test_reports_read_recent_days_only(spark):
    registry = A.registry(spark, SF).where("expect_delay = 0")
    df = freshness.report(registry, A.observed_dates(spark, SF), A.AS_OF, (0, 5))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", plan(df))
    assert any("GreaterThanOrEqual(ts" in p for p in pushed)


def test_daily_features_push_their_days(spark):
    written = stage(A.daily_features(spark, SF), "features")
    df = features.daily_wide(written, "serial_num", "day", ["2024-01-03", "2024-01-04"], ["home_score"])
    assert "GreaterThanOrEqual(day" in plan(df)


def test_a_day_moves_once_for_its_copies_and_the_join(spark):
    written = stage(A.daily_features(spark, SF), "features")
    days = {d: written.where(F.col("day") == F.lit(d).cast("date")).drop("day") for d in ("2024-01-03", "2024-01-04")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = features.daily_wide_join(days, "serial_num", ["num_station", "poor_rssi", "poor_phyrate", "home_score"])
        assert count(df, "Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_station_score_moves_no_raw_rows(spark):
    history = A.station_history(spark, SF)
    mobility = profile.stationarity(A.previous_day_history(spark, SF))
    df = scores.station_score(profile.hourly_records(history), profile.device_signal(history), mobility)
    text = plan(df)
    moved = [re.search(r"Exchange.*\n[\s:+-]*(?:\*\(\d+\) )?(\w+)", part).group(1) for part in re.split(r"(?=[-+ ](?:Broadcast)?Exchange\b)", text)[1:]]
    assert count(df, "FileScan") == 3 and "Window" not in text and "Scan" not in moved


def test_hourly_fact_reads_and_moves_whole_rows_once(spark):
    mobility = profile.stationarity(A.previous_day_history(spark, SF))
    text = plan(profile.hourly_fact(A.station_history(spark, SF), mobility))
    wide = [x for x in re.findall(r"FileScan parquet \[(.*?)\]", text) if "l_extendedprice" in x]
    assert text.count("FileScan") == 4 and len(wide) == 1


def test_many_columns_correlate_in_one_small_aggregate(spark):
    wide = spark.range(300).select(*[(F.col("id") * (k + 1) % 17).cast("double").alias(f"c{k}") for k in range(30)])
    columns = wide.columns
    out = features.correlation_matrix(wide, columns)
    assert (count(out, "Exchange"), out.count()) == (1, 900)
    assert out.where("col_a = 'c0' and col_b = 'c3'").first()["r"] == pytest.approx(wide.corr("c0", "c3"))


def _history(spark, date, hour, macs, ts):
    row = lambda mac, i: ("R-S1_0", "A", (mac, "n", "5GHz", -50.0 - i % 3, 20.0, "866Mbps", "500Mbps", ts, 10, 5), date, hour)
    from fleetlens import schema

    return spark.createDataFrame([row(m, i) for m in macs for i in range(10)], schema.STATION_HISTORY)


def test_hourly_job(spark, tmp_path):
    from fleetlens import schema

    history, groups, out = (f"{tmp_path}/{n}" for n in ("history", "groups", "out"))
    at = {("20250930", "05"): 1759208400000, ("20251001", "05"): 1759294800000, ("20251001", "06"): 1759298400000}
    for (date, hour), ts in at.items():
        overwrite_partitions(_history(spark, date, hour, ["m1", "m2"], ts), history)
    radios = [{"_2_4g": {"enable": "1", "airtime_util": "30"}}]
    overwrite_partitions(
        spark.createDataFrame([("G-S1", radios, "20251001", h) for h in ("05", "06")], schema.DEVICE_GROUPS), groups
    )
    for hour in (5, "06", 5):  # a run again replaces its own hour
        paths = score_hour(spark, history, groups, out, "20251001", hour)
    wifi = spark.read.parquet(paths["wifi_score"])
    assert wifi.groupBy("hour").count().count() == 2 and wifi.count() == 4
    row = read_hour(spark, paths["wifi_score"], "20251001", "05").first()
    assert (row["hour"], row["mobility_status"], row["reliability_score_num"]) == ("05", "Stationary", 4)
    assert row["wifi_score_num_unrounded"] == pytest.approx(3.47)  # (3.2 + 3.2 + 4) / 3
    assert spark.read.parquet(paths["station_score"]).where(F.col("station_score_num") == 4).count() == 4
    assert children(spark, out) == ["station_connection", "station_score", "wifi_score"]


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which test data counts as large: no broadcast, partitions of 20 KB are split."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_group_is_split_among_tasks(spark, small_partitions):
    from fleetlens.operators.grouping import group_record_count

    df = spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    out = group_record_count(df, ["k"])
    assert out.where("k = 'hot'").select(F.max("record_count")).first()[0] == 20000
    out.collect()
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_home_is_split_in_the_score_join(spark, small_partitions):
    stations = spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("S"), F.col("id") % 4000)).alias("sn"),
        F.lit("d").alias("date"),
        F.lit("h").alias("hour"),
        F.sha2(F.col("id").cast("string"), 256).alias("station_mac"),
        F.lit(1).alias("n_fast"),
        (F.col("id") % 4 + 1.0).alias(scores.SPEED_MEAN),
        F.when(F.col("id") % 2 == 0, F.col("id")).cast("decimal(38,0)").alias("total_bytes"),
    )
    homes = scores.home_scores(stations, coverage=False)
    out = stations.join(homes, scores.HOME)
    assert len(out.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    top = sorted((r["id"] for r in spark.range(60000).where("id % 6 = 0").collect()), reverse=True)[:5]
    rest = [i for i in range(0, 60000, 3) if i not in top]
    mean = lambda ids: sum(i % 4 + 1.0 for i in ids) / len(ids)
    wanted = round(0.8 * mean(top) + 0.2 * mean(rest), 2)
    assert homes.where("sn = 'hot'").first()["home_weighted_avg_base_score_speed"] == pytest.approx(wanted)


def test_composite_moves_no_raw_rows(spark, small_partitions):
    """With the label as a table, every exchange below the staged station table holds partial aggregates or stations."""
    seen = []

    def staged(df, name):
        seen.append(plan(df))
        return stage(df, name)

    records = profile.hourly_records(A.station_history(spark, SF))
    mobility = profile.stationarity(A.previous_day_history(spark, SF))
    consumption = scores.data_consumption(A.station_history(spark, SF))
    scores.wifi_score(records, consumption, scores.reliability_score(A.device_groups(spark, SF)), mobility=mobility, stage=staged)
    (text,) = seen
    # Three aggregates, and the station-hours once for their label; consumption is joined where it lies.
    assert len(re.findall(r"[-+ ]Exchange\b", text)) == 4
    moved = [re.search(r"Exchange.*\n[\s:+-]*(?:\*\(\d+\) )?(\w+)", part).group(1) for part in re.split(r"(?=[-+ ]Exchange\b)", text)[1:]]
    assert sorted(moved) == ["HashAggregate", "ObjectHashAggregate", "ObjectHashAggregate", "Project"]


def test_scores_of_the_written_fact_table_move_no_rows(spark, fact):
    """Both scores read fact table and consumption where they lie; copies and null keys stay as they are."""
    written, plans = [], []

    def staged(df, name):
        plans.append(plan(df))
        written.append(stage(df, name))
        return written[-1]

    copies = fact.unionByName(fact.limit(50)).unionByName(fact.limit(20).withColumn("station_mac", F.lit(None).cast("string")))
    copies = stage(copies, "copies")
    consumption = scores.data_consumption(A.station_history(spark, SF))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        hourly = stage_bucketed(copies, "hourly", scores.STATION)
        used = stage_bucketed(consumption, "used", scores.STATION)
        for score in (scores.speed_score, scores.coverage_score):
            score(hourly, used, stage=staged)
            score(copies, consumption, stage=staged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [len(re.findall(r"[-+ ]Exchange\b", p)) > 0 for p in plans] == [False, True] * 2
    assert "ObjectHashAggregate" in plans[0] and "SortMergeJoin" in plans[0]
    rows = lambda df: sorted(map(str, df.collect()))
    assert hourly.columns == copies.columns and rows(hourly) == rows(copies)
    assert rows(written[0]) == rows(written[1]) and rows(written[2]) == rows(written[3])
