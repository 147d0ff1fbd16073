"""A plain form of every headline query, as a yardstick for the benchmark.

What one would write first: windows over whole groups, one after another, and
pivots.  Results are the same as the library's; only used for timing and in tests.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import adapters as A
from fleetlens.functions import clean, scoring
from fleetlens.operators import freshness, profile, scores
from fleetlens.plans import catalog
from fleetlens.session import scratch_path

DEVICE = ["sn", "station_mac"]


def _over(keys: list[str]):
    return Window.partitionBy(*keys)


def _records(spark, sf):
    return profile.hourly_records(A.station_history(spark, sf))


def stationarity(spark, sf):
    rows = profile.hourly_records(A.previous_day_history(spark, sf)).where("rssi is not null")
    rows = rows.withColumn("p", F.percentile_approx("rssi", [0.03, 0.1, 0.5, 0.9]).over(_over(DEVICE)))
    inlier = rows.where("rssi > least(p[0], 3 * p[1] - 2 * p[3])")
    label = F.expr("if(p[3] - p[2] > 5, 'Non-stationary', 'Stationary')")
    return inlier.select("sn", "station_mac", label.alias("mobility_status")).distinct()


def hourly_fact(spark, sf):
    device = F.percentile_approx("rssi", [0.5, 0.9]).over(Window.partitionBy("station_mac"))
    rows = _records(spark, sf).withColumn("p", device)
    rows = rows.select("*", F.expr("int(p[0])").alias("p50_rssi"), F.expr("int(p[1])").alias("p90_rssi")).drop("p")
    return rows.join(stationarity(spark, sf), ["sn", "station_mac"], "left")


def group_record_count(spark, sf):
    rows = _records(spark, sf).select(*scores.STATION, "band", "rssi", "phy_rate")
    return rows.withColumn("record_count", F.count("*").over(_over(scores.STATION)))


def _often(rows: DataFrame) -> DataFrame:
    return rows.withColumn("record_count", F.count("*").over(_over(scores.STATION))).where("record_count > 8")


def min_sample_gate(spark, sf):
    return _often(_records(spark, sf)).groupBy(*scores.STATION).agg(
        F.max("record_count").alias("record_count"), F.avg("rssi").alias("avg_rssi")
    )


def _by_band(rows: DataFrame, values: dict[str, tuple[str, list[float]]], *others, spread: bool = False) -> DataFrame:
    """Percentiles per band, the bands side by side by a pivot, joined with aggregates over all of them."""
    bands = rows.withColumn("kind", F.expr("case substring(band, 1, 2) when '2.' then '2_4g' when '5G' then '5g' end"))
    aggs = [F.percentile_approx(F.col(c).cast("double"), p).alias(n) for n, (c, p) in values.items()]
    # A pivot of one aggregate would not name it.
    rate = (F.max(F.col("phy_rate").cast("double")) - F.min("phy_rate")).alias("range")
    aggs.append(rate if spread else F.count(F.lit(1)).alias("n"))
    wide = bands.groupBy(*scores.STATION).pivot("kind", ["2_4g", "5g"]).agg(*aggs)
    return rows.groupBy(*scores.STATION).agg(*scores.attribute_aggregates(), *others).join(wide, scores.STATION)


def station_score(spark, sf):
    rows = _often(hourly_fact(spark, sf))
    spread = (F.max("snr") - F.min("snr")).alias("snr_range")
    wide = _by_band(
        rows, {"r": ("p90_rssi", [0.9, 0.5, 0.95]), "p": ("phy_rate", [0.9])}, spread, F.count_if(F.col("son") > 0).alias("son_count"),
        spread=True,
    )
    wide = wide.selectExpr(
        "*", "2_4g_r[0] as p90_rssi_2_4g", "5g_r[0] as p90_rssi_5g", "2_4g_p[0] as p90_phy_rate_2_4g", "5g_p[0] as p90_phy_rate_5g"
    )
    over = F.expr("snr_range > 13 or son_count > 6 or 2_4g_range > 30 or 5g_range > 300")
    ladders = scores.with_scores(wide, scores.STATION_SCORES)
    return ladders.withColumns(
        {"base_score": F.least(*scores.STATION_SCORES), "variation_score": F.coalesce(over, F.lit(False)).cast("int")}
    )


def data_consumption(spark, sf):
    rows = A.station_history(spark, sf).withColumn("sn", clean.serial("rowkey", "bounded"))
    total = F.sum(F.expr("cast(bs as decimal(38, 0)) + cast(br as decimal(38, 0))")).cast("decimal(38,0)")
    return rows.groupBy(*scores.STATION).agg(total.alias("total_bytes")).where(F.col("total_bytes") < A.MAX_BYTES)


def consumption_rank(spark, sf):
    stations = _often(_records(spark, sf)).groupBy(*scores.STATION).agg(F.max("rssi").alias("max_rssi"))
    joined = stations.join(data_consumption(spark, sf), scores.STATION, "left")
    return joined.withColumn("rank_per_sn", F.rank().over(_over(scores.HOME).orderBy(F.desc_nulls_last("total_bytes"))))


def _placed(stations: DataFrame, spark, sf, score: str) -> DataFrame:
    """Averages of the five heaviest and of the rest, as conditional averages over the home's window."""
    joined = stations.join(data_consumption(spark, sf), scores.STATION, "left")
    placed = joined.withColumn("place", F.rank().over(_over(scores.HOME).orderBy(F.desc_nulls_last("total_bytes"))))
    return placed.withColumns(
        {
            "avg_top": F.avg(F.when(F.col("place") < 6, F.col(score))).over(_over(scores.HOME)),
            "avg_rest": F.avg(F.when(F.col("place") > 5, F.col(score))).over(_over(scores.HOME)),
        }
    )


def _speed_stations(spark, sf):
    rows = _often(hourly_fact(spark, sf))
    valid = F.when(F.col("snr").between(0, 50), F.col("snr"))
    spread = rows.withColumn("snr_range_variation", F.max(valid).over(_over(scores.STATION)) - F.min(valid).over(_over(scores.STATION)))
    wide = _by_band(
        spread.where("tx_phy_rate > 24"), {"r": ("tx_phy_rate", [0.9])},
        F.max("snr_range_variation").alias("snr_range_variation"),
    )
    wide = wide.selectExpr("*", "2_4g_r[0] as p90_phy_rate_2_4g_speed", "5g_r[0] as p90_phy_rate_5g_speed")
    ladders = scores.with_scores(wide, scores.SPEED_SCORES)
    return ladders.withColumn(scores.SPEED_MEAN, scoring.mean_present(*scores.SPEED_SCORES))


def speed_score(spark, sf):
    placed = _placed(_speed_stations(spark, sf), spark, sf, scores.SPEED_MEAN).where("snr_range_variation is not null")
    home = scores.weighted_home_score("avg_top", "avg_rest").alias("home_weighted_avg_base_score_speed")
    columns = [*scores.SCORE_KEYS, *scores.SPEED_COLUMNS[:5], scores.SPEED_MEAN, *scores.SPEED_COLUMNS[5:]]
    return placed.select("*", home).select("*", *scores.speed_output()).select(*columns)


def _coverage_stations(rows: DataFrame) -> DataFrame:
    wide = _by_band(rows, {"r": ("rssi", [0.9])})
    wide = wide.selectExpr("*", "2_4g_r[0] as p90_rssi_2_4g", "5g_r[0] as p90_rssi_5g")
    ladders = scores.with_scores(wide, scores.COVERAGE_SCORES)
    return ladders.withColumn(scores.COVERAGE_MEAN, scoring.mean_present(*scores.COVERAGE_SCORES))


def coverage_score(spark, sf):
    placed = _placed(_coverage_stations(_often(hourly_fact(spark, sf))), spark, sf, scores.COVERAGE_MEAN)
    home = scores.weighted_home_score("avg_top", "avg_rest").alias("home_weighted_avg_base_score_coverage")
    columns = [*scores.SCORE_KEYS, *scores.COVERAGE_COLUMNS[:5], scores.COVERAGE_MEAN, *scores.COVERAGE_COLUMNS[5:]]
    return placed.select("*", home).select("*", *scores.coverage_output()).select(*columns)


def top_rest_weighted(spark, sf):
    rows = _often(_records(spark, sf).withColumn("mobility_status", F.lit(None).cast("string")))
    placed = _placed(_coverage_stations(rows), spark, sf, scores.COVERAGE_MEAN)
    weighted = scores.weighted_home_score("avg_top", "avg_rest").alias("weighted")
    return placed.select(*scores.HOME, "avg_top", "avg_rest", weighted).distinct()


def reliability_score(spark, sf):
    radios = A.device_groups(spark, sf).select("*", F.explode("group_diag_history_radio_wifi_info").alias("radio"))
    airtime = radios.where("radio._2_4g.enable = '1'").selectExpr(
        "regexp_extract(rowkey, '-([^-_]+)', 1) as sn", "date", "hour", "int(try_cast(radio._2_4g.airtime_util as double)) as airtime"
    )
    p90 = F.percentile_approx("airtime", 0.9).alias("p90_airtime_util_2_4g")
    found = airtime.where("airtime between 0 and 100").groupBy(*scores.HOME).agg(p90)
    return scores.with_scores(found, {"reliability_score_num": ("p90_airtime_util_2_4g", scoring.AIRTIME_2_4G)})


def composite_score(spark, sf):
    return scores.composite_score(speed_score(spark, sf), coverage_score(spark, sf), reliability_score(spark, sf))


def _probed(spark, sf, first: int, last: int) -> DataFrame:
    """Every dataset with every probed day, from a list of all days that can matter."""
    registry = A.registry(spark, sf).withColumn("expected", F.expr(f"date_sub(date'{A.AS_OF}', expect_delay)"))
    start = date.fromisoformat(A.AS_OF) - timedelta(days=60)
    days = spark.createDataFrame([(start + timedelta(days=n),) for n in range(90)], "day date")
    return registry.join(days, F.expr(f"day between date_sub(expected, {last}) and date_sub(expected, {first})"))


def missing_days_inclusive(spark, sf):
    seen = A.observed_dates(spark, sf).groupBy("name", F.col("observed_date").alias("day")).count()
    gaps = _probed(spark, sf, *freshness.window("file_drop")).join(seen, ["name", "day"], "left").where("count is null")
    return gaps.select("name", F.col("day").alias("missing_day"))


def freshness_report(spark, sf):
    observed = A.observed_dates(spark, sf)
    closed = "dayofweek(day) in (1, 7) or day in (date'" + "', date'".join(A.EXCLUDED_DAYS) + "')"
    probed = _probed(spark, sf, *freshness.window("folder")).where(f"calendar <> 'business' or not ({closed})")
    gaps = probed.join(observed.select("name", F.col("observed_date").alias("day")), ["name", "day"], "left_anti")
    lists = gaps.groupBy("name").agg(F.sort_array(F.collect_list("day"), False).alias("days"))
    latest = observed.groupBy("name").agg(F.max("observed_date").alias("latest_date"))
    joined = A.registry(spark, sf).join(latest, "name", "left").join(lists, "name", "left")
    return joined.selectExpr(
        "name", "latest_date", f"datediff(date_sub(date'{A.AS_OF}', expect_delay), latest_date) as delayed_days",
        "coalesce(array_join(cast(days as array<string>), ','), '') as miss_days",
    )


def rows_per_day(spark, sf):
    return A.table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("row_count")
    )


def latest_file(spark, sf):
    days = A.file_names(spark, sf).withColumn("day", clean.day_in_name("entry")).where("day is not null")
    newest = Window.partitionBy("name").orderBy(F.desc("day"), "entry")
    first = days.withColumn("n", F.row_number().over(newest)).where("n = 1")
    return first.selectExpr("name", "day as latest_date", "entry as latest_file")


def dedup_rows(spark, sf):
    rows = A.table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    return rows.groupBy(*rows.columns).count().drop("count")


def wide_daily_features(spark, sf):
    days = catalog._days(3, 9)
    daily = A.daily_features(spark, sf).withColumn("day", F.col("day").cast("string"))
    wide = daily.groupBy("serial_num").pivot("day", days).agg(*[F.first(c).alias(c) for c in catalog.FEATURES])
    whole = reduce(lambda a, b: a & b, [F.col(f"{d}_num_station").isNotNull() for d in days])
    named = wide.where(whole).withColumnsRenamed({f"{d}_{c}": f"{c}_{d}" for d in days for c in catalog.FEATURES})
    return catalog._installs(spark, sf).join(named, "serial_num")


def correlation_matrix(spark, sf):
    table = A.table(spark, sf, "lineitem")
    cells = [
        table.agg(F.round(F.corr(a, b) if a != b else F.lit(1.0), 6).alias("r"), F.count_if(F.expr(f"{a} + {b} is not null")).alias("n"))
        .select(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), "r", "n")
        for a in catalog.MEASURES
        for b in catalog.MEASURES
    ]
    return reduce(DataFrame.union, cells)


def export_filtered(spark, sf):
    folder = scratch_path(spark, "plain_export")
    kept = spark.read.parquet(f"{sf}/part.parquet").where("p_brand in ('Brand#1', 'Brand#2', 'Brand#3')")
    kept.write.csv(folder, header=True)
    return spark.read.csv(folder, header=True, schema=A.SCHEMAS["part"])


def message_encode(spark, sf):
    return A.table(spark, sf, "events").selectExpr(
        "to_json(struct(event_id, user_id, event_type as kind, cast(value as decimal(10, 2)) as value)) as value"
    )


def message_decode(spark, sf):
    rows = catalog._messages(A.table(spark, sf, "events"))
    kind = T.ArrayType(T.StructType([T.StructField("k", T.IntegerType())]))
    whole = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), kind, {"mode": "FAILFAST"})
    good = F.expr("value rlike '^\\\\{[^{}]*\\\\}$' and try_cast(get_json_object(value, '$.k') as int) is not null")
    return rows.select(
        "event_id", F.when(good, whole[0]["k"]).alias("k"), F.when(~good, F.col("value")).alias("_corrupt_record")
    )


NAIVE = {
    f.__name__: f
    for f in (
        stationarity,
        hourly_fact,
        group_record_count,
        min_sample_gate,
        station_score,
        data_consumption,
        consumption_rank,
        top_rest_weighted,
        speed_score,
        coverage_score,
        reliability_score,
        composite_score,
        missing_days_inclusive,
        freshness_report,
        rows_per_day,
        latest_file,
        dedup_rows,
        wide_daily_features,
        correlation_matrix,
        export_filtered,
        message_encode,
        message_decode,
    )
}
