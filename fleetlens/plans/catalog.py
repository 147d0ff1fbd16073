"""Every operator as a query over the sample tables: ``QUERIES[name](spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import adapters as A
from fleetlens.functions import clean, scoring
from fleetlens.operators import daymaps, features, freshness, grouping, profile, scores, sketches
from fleetlens.plans.daily import wide_features
from fleetlens.session import configure, scratch_path, stage, stage_bucketed
from fleetlens.sinks import files as sinks
from fleetlens.sinks import published
from fleetlens.sources import files as sources
from fleetlens.sources import metadata
from fleetlens.streaming import messages, redelivery

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return fn


# --- inputs ------------------------------------------------------------------


def records(spark, sf):
    return profile.hourly_records(A.station_history(spark, sf))


def mobility(spark, sf):
    return profile.stationarity(A.previous_day_history(spark, sf))


def fact(spark, sf):
    return profile.hourly_fact(A.station_history(spark, sf), mobility(spark, sf))


def banded(spark, sf):
    signal = profile.device_signal(A.station_history(spark, sf))
    return scores.banded_percentiles(records(spark, sf), signal, mobility(spark, sf))


def consumption(spark, sf):
    return scores.data_consumption(A.station_history(spark, sf), A.MAX_BYTES)


# --- scalar functions --------------------------------------------------------


@query
def flatten_struct(spark, sf):
    history = A.nested_history(spark, sf)
    return profile.flatten_struct(history, "station_data_connect_data", "rowkey", "Tplg_Data_model_name")


@query
def serial_extract(spark, sf):
    keys = A.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """concat('R-', case l_returnflag when 'R' then 's' else 'S' end, l_suppkey,
                  case l_returnflag when 'N' then '' else concat('_', l_orderkey) end) as rowkey""",
    )
    return keys.select("*", *[clean.serial("rowkey", p).alias(f"sn_{p}") for p in clean.SERIAL_PATTERNS])


@query
def rate_parse(spark, sf):
    texts = A.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """case l_returnflag when 'A' then concat(cast(l_extendedprice as decimal(12, 2)), 'Mbps')
                when 'R' then concat(' ', l_linenumber, ' Mbps')
                when 'N' then case l_linestatus when 'F' then 'n/a' else '' end end as link_rate""",
    )
    return texts.withColumn("phy_rate", clean.rate("link_rate"))


@query
def epoch_parts(spark, sf):
    times = A.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "unix_seconds(cast(l_shipdate as timestamp)) * 1000 + (l_orderkey * 97777) % 86400000 as ts",
    )
    return times.select("*", clean.epoch_hour("ts").alias("hour"), clean.epoch_day("ts").alias("date"))


@query
def score_ladders(spark, sf):
    values = A.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "-40 - l_quantity * l_linenumber / 4 as signal", "l_extendedprice / 200 as rate"
    )
    ladders = {
        "station_rssi_2_4g": ("signal", scoring.STATION_RSSI_2_4G),
        "station_rssi_5g": ("signal", scoring.STATION_RSSI_5G),
        "station_phy_2_4g": ("rate", scoring.STATION_PHY_2_4G),
        "station_phy_5g": ("rate", scoring.STATION_PHY_5G),
        "speed_tx_2_4g": ("rate", scoring.SPEED_TX_2_4G),
        "speed_tx_5g": ("rate", scoring.SPEED_TX_5G),
        "coverage_rssi_2_4g": ("signal", scoring.COVERAGE_RSSI_2_4G),
        "coverage_rssi_5g": ("signal", scoring.COVERAGE_RSSI_5G),
        "airtime_2_4g": ("rate", scoring.AIRTIME_2_4G),
    }
    return scores.with_scores(values, ladders).drop("signal", "rate")


@query
def null_math(spark, sf):
    stations = banded(spark, sf)
    return stations.select(
        *scores.STATION,
        F.least("p90_rssi_2_4g", "p90_rssi_5g").alias("worst_rssi"),
        F.coalesce("p90_rssi_2_4g", F.lit(0.0)).alias("rssi_or_zero"),
        F.nullif("son_count", F.lit(0)).alias("son_or_null"),
        F.round("snr_range", 2).alias("snr_range"),
    )


@query
def mean_present(spark, sf):
    stations = scores.station_quality(records(spark, sf), labelled=False)
    return stations.select(
        *scores.STATION,
        scoring.mean_present(*scores.SPEED_SCORES).alias("speed_mean"),
        scoring.mean_present(*scores.COVERAGE_SCORES).alias("coverage_mean"),
        scoring.mean_present(*scores.SPEED_SCORES, *scores.COVERAGE_SCORES).alias("overall_mean"),
    )


# --- station profile and scores ----------------------------------------------


@query
def group_record_count(spark, sf):
    rows = records(spark, sf).select(*scores.STATION, "band", "rssi", "phy_rate")
    return grouping.record_count_by_cuts(rows, scores.STATION)


@query
def min_sample_gate(spark, sf):
    count, average = F.count(F.lit(1)).alias("record_count"), F.avg("rssi").alias("avg_rssi")
    return grouping.gated(records(spark, sf), scores.STATION, count, average)


@query
def stationarity(spark, sf):
    return mobility(spark, sf)


@query
def stationarity_merged(spark, sf):
    """The label from the stored sketches of the day's hours; raw rows are read once, to make them."""
    hours = stage(sketches.station_hours(A.previous_day_history(spark, sf)), "sketches")
    return sketches.stationarity(hours)


@query
def hourly_fact_merged(spark, sf):
    """The fact with device signals and stations from stored sketches of its hours."""
    history = A.nested_history(spark, sf)
    hours = stage(sketches.station_hours(history), "sketches")
    day_before = stage(sketches.station_hours(A.previous_day_history(spark, sf)), "sketches")
    return sketches.hourly_fact(history, hours, sketches.stationarity(day_before))


@query
def hourly_fact(spark, sf):
    return profile.hourly_fact(A.nested_history(spark, sf), mobility(spark, sf))


@query
def banded_percentiles(spark, sf):
    return banded(spark, sf).drop(*scores.VARIATION_PARTS)


@query
def variation_components(spark, sf):
    return scores.variation_components(A.with_son(records(spark, sf)))


@query
def station_score(spark, sf):
    signal = profile.device_signal(A.station_history(spark, sf))
    return scores.station_score(records(spark, sf), signal, mobility(spark, sf))


@query
def data_consumption(spark, sf):
    return consumption(spark, sf)


@query
def consumption_rank(spark, sf):
    stations = grouping.gated(records(spark, sf), scores.STATION, F.max("rssi").alias("max_rssi"))
    return scores.consumption_rank(stations, consumption(spark, sf), A.MAX_BYTES, stage=stage)


@query
def top_rest_weighted(spark, sf):
    scored = scores.station_quality(records(spark, sf), speed=False, labelled=False)
    stations = scored.join(consumption(spark, sf), scores.STATION, "left")
    averages = grouping.top_rest_averages(
        stations,
        scores.HOME,
        "total_bytes",
        {"avg": (F.lit(True), F.col("individual_station_avg_base_score_coverage"))},
        ["station_mac"],
    )
    return averages.select("*", scores.weighted_home_score("avg_top", "avg_rest").alias("weighted"))


@query
def speed_score(spark, sf):
    return scores.speed_score(records(spark, sf), consumption(spark, sf), mobility=mobility(spark, sf), stage=stage)


@query
def coverage_score(spark, sf):
    return scores.coverage_score(records(spark, sf), consumption(spark, sf), mobility=mobility(spark, sf), stage=stage)


@query
def reliability_score(spark, sf):
    return scores.reliability_score(A.device_groups(spark, sf))


@query
def composite_score(spark, sf):
    """From the raw records to the composite class of every station's home."""
    return scores.wifi_score(
        records(spark, sf),
        consumption(spark, sf),
        scores.reliability_score(A.device_groups(spark, sf)),
        mobility=mobility(spark, sf),
        stage=stage,
    )


@query
def composite_join(spark, sf):
    """The same from the written fact table and three separately computed score tables.

    Fact table and consumption are written where their station-hours are, so that both scores read them without a shuffle.
    """
    hourly = stage_bucketed(fact(spark, sf), "hourly_fact", scores.STATION)
    bytes_used = stage_bucketed(consumption(spark, sf), "consumption", scores.STATION)
    return scores.composite_score(
        scores.speed_score(hourly, bytes_used, stage=stage),
        scores.coverage_score(hourly, bytes_used, stage=stage),
        scores.reliability_score(A.device_groups(spark, sf)),
    )


# --- freshness ---------------------------------------------------------------


def _checked(spark, sf):
    return A.registry(spark, sf), A.observed_dates(spark, sf)


def _missing(variant, business=False):
    def run(spark, sf):
        registry, observed = _checked(spark, sf)
        if not business:
            registry = registry.withColumn("calendar", F.lit("daily"))
        return freshness.missing_days(
            registry, observed, A.AS_OF, freshness.window(variant), A.EXCLUDED_DAYS if business else ()
        )

    return run


for _name, _variant in {
    "missing_days_inclusive": "file_drop",
    "missing_days_shifted": "folder",
    "missing_days_shifted_short": "folder_short",
    "missing_days_table": "table",
}.items():
    _fn = _missing(_variant)
    _fn.__name__ = _name
    query(_fn)

_fn = _missing("folder", business=True)
_fn.__name__ = "missing_days_business"
query(_fn)


@query
def rows_per_day(spark, sf):
    return freshness.rows_per_day(A.table(spark, sf, "orders"), "o_orderdate")


@query
def latest_day_rowcount(spark, sf):
    return freshness.latest_day_rowcount(A.table(spark, sf, "orders"), "o_orderdate")


@query
def distinct_days_topn(spark, sf):
    return freshness.distinct_days(A.table(spark, sf, "orders"), "o_orderdate", freshness.LOOKBACK)


@query
def listing_dates(spark, sf):
    return freshness.days_in_names(A.file_names(spark, sf)).distinct()


@query
def file_drop_dates(spark, sf):
    """Days of drops that share folders, told apart by the templates of their names."""
    return freshness.days_of_drops(A.drop_files(spark, sf), A.drops(spark, sf)).distinct()


@query
def table_days(spark, sf):
    """Days that a table and the folders of a written table hold, one dataset each."""
    base = scratch_path(spark, "half_days")
    sinks.overwrite_partitions(_events_by_half_day(spark, sf), base)
    orders = sources.read_table(spark, "parquet", path=f"{sf}/orders.parquet")
    in_folders = sources.observed_partitions(sources.read_table(spark, "parquet", path=base), "events")
    days = sources.observed_in_table(orders, "orders", "o_orderdate").unionByName(in_folders)
    return freshness.observed_days(days)


@query
def folder_listing(spark, sf):
    """Names and days of the folders of written tables; a dataset without a folder has none."""
    base = scratch_path(spark, "listed")
    events = A.table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    sinks.overwrite_partitions(events, base, ["day"])
    listed = metadata.list_folders(metadata.folders_of(spark, {"events": base, "absent": f"{base}/absent"}))
    return freshness.days_in_names(listed, "dashed")


def _orders_by_month(spark, sf) -> DataFrame:
    """Files of a table written in order of its day, and one written in none."""
    base = scratch_path(spark, "orders")
    orders = A.table(spark, sf, "orders")
    orders.repartitionByRange(12, "o_orderdate").sortWithinPartitions("o_orderdate").write.parquet(f"{base}/ordered")
    orders.repartition(3, "o_orderkey").write.parquet(f"{base}/dealt")
    names = {"ordered": f"{base}/ordered", "dealt": f"{base}/dealt", "absent": f"{base}/absent"}
    return metadata.data_files(metadata.folders_of(spark, names))


@query
def newest_days_footers(spark, sf):
    """The newest days of tables from their footers; of the ordered one, few row groups are read."""
    return metadata.newest_days(_orders_by_month(spark, sf), "o_orderdate", freshness.LOOKBACK)


@query
def latest_day_footers(spark, sf):
    """The newest day of tables and its rows."""
    return metadata.newest_day_rows(_orders_by_month(spark, sf), "o_orderdate")


@query
def folder_days(spark, sf):
    """Days of a foldered table by its folder names; no file is opened."""
    base = scratch_path(spark, "half_days")
    sinks.overwrite_partitions(_events_by_half_day(spark, sf), base)
    return metadata.folder_days(metadata.folders_of(spark, {"events": base, "absent": f"{base}/absent"}))


@query
def latest_per_dataset(spark, sf):
    return freshness.latest(A.observed_dates(spark, sf))


@query
def latest_file_drop(spark, sf):
    days = freshness.days_in_names(A.file_names(spark, sf))
    return freshness.latest(days, A.AS_OF, freshness.LOOKBACK)


@query
def latest_file(spark, sf):
    return freshness.latest_file(A.file_names(spark, sf))


@query
def delay_days(spark, sf):
    registry, observed = _checked(spark, sf)
    return freshness.delay(registry, freshness.latest(observed), A.AS_OF)


def _as_text(report: DataFrame) -> DataFrame:
    lists = [c for c in report.columns if c.endswith("miss_days")]
    return report.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in lists})


@query
def freshness_report(spark, sf):
    registry, observed = _checked(spark, sf)
    return _as_text(
        freshness.report(registry, observed, A.AS_OF, freshness.window("folder"), A.EXCLUDED_DAYS)
    )


@query
def freshness_report_paired(spark, sf):
    registry, observed = _checked(spark, sf)
    folder = freshness.days_in_names(A.file_names(spark, sf))
    return _as_text(freshness.paired_report(
        registry, observed, folder, A.AS_OF, excluded=A.EXCLUDED_DAYS, folder_calendar="folder_calendar"
    ))


#: The day up to which the kept maps were made; later observations are merged into them.
_KEPT = "2024-01-20"


def _kept_maps(spark, observed: DataFrame) -> DataFrame:
    """Maps of an earlier run, brought up to date by one scan of what came after it."""
    path, late = scratch_path(spark, "day_maps"), F.col("observed_date") > F.lit(_KEPT).cast("date")
    daymaps.update(path, observed.where(~late))
    return daymaps.update(path, observed.where(late))


@query
def freshness_report_maps(spark, sf):
    registry, observed = _checked(spark, sf)
    maps = _kept_maps(spark, observed)
    return _as_text(daymaps.report(registry, maps, A.AS_OF, freshness.window("folder"), A.EXCLUDED_DAYS))


@query
def freshness_report_paired_maps(spark, sf):
    registry, observed = _checked(spark, sf)
    folder = freshness.days_in_names(A.file_names(spark, sf))
    return _as_text(freshness.paired_report(
        registry, _kept_maps(spark, observed), _kept_maps(spark, folder), A.AS_OF, excluded=A.EXCLUDED_DAYS,
        folder_calendar="folder_calendar", one=daymaps.report,
    ))


@query
def missing_days_maps(spark, sf):
    registry, observed = _checked(spark, sf)
    return daymaps.missing(registry, _kept_maps(spark, observed), A.AS_OF, freshness.window("folder"), A.EXCLUDED_DAYS)


@query
def report_label(spark, sf):
    days = A.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", clean.report_label("day", "Data availability").alias("label"))


# --- several days, exploration -----------------------------------------------


def _days(first: int, last: int) -> list[str]:
    return [f"2024-01-{d:02d}" for d in range(first, last + 1)]


@query
def multi_day_union(spark, sf):
    """Day folders written first; the days read are those written, and some that do not exist."""
    base = scratch_path(spark, "daily_events")
    events = A.table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    sinks.overwrite_partitions(events, base, ["day"])
    written = [n.removeprefix("day=") for n in sinks.children(spark, base) if n.startswith("day=")]
    union = sources.read_tolerant(spark, base + "/day={}", [*written, "2024-02-30"])
    return union.select("event_id", "user_id", "event_type", "value")


@query
def loader_union(spark, sf):
    """Tables of unequal schemas read and shaped by a loader, put together by name."""
    base = scratch_path(spark, "unequal")
    A.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).write.parquet(f"{base}/a")
    A.table(spark, sf, "part").select(F.col("p_size").alias("size"), F.col("p_partkey").alias("k")).write.parquet(f"{base}/b")
    shaped = lambda s, path: s.read.parquet(path).withColumn("source", F.lit(path[-1]))
    return sources.read_tolerant(spark, base + "/{}", ["a", "b", "c"], shaped)


@query
def positional_union(spark, sf):
    customers = A.table(spark, sf, "customer").selectExpr("c_custkey as key", "c_name as name")
    parts = A.table(spark, sf, "part").selectExpr("p_partkey as part", "p_name as label")
    return features.union_frames([customers, parts], positional=True)


@query
def dedup_rows(spark, sf):
    return features.dedup_rows(
        A.table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    )


def _installs(spark, sf):
    return A.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("serial_num"),
        F.col("c_mktsegment").alias("date_string"),
        F.col("c_acctbal").alias("before_home_score"),
    )


BUCKETS = 8
# The features of a home.
FEATURES = ["num_station", "poor_rssi", "poor_phyrate", "home_score"]


@query
def wide_daily_features(spark, sf):
    wide = features.daily_wide(A.daily_features(spark, sf), "serial_num", "day", _days(3, 9), FEATURES)
    return _installs(spark, sf).join(wide, "serial_num")


@query
def wide_daily_join(spark, sf):
    """One folder per day, written first, then joined day by day."""
    base = scratch_path(spark, "daily_features")
    sinks.overwrite_partitions(A.daily_features(spark, sf), base, ["day"])
    days = {d: spark.read.parquet(f"{base}/day={d}") for d in _days(3, 9)}
    wide = features.daily_wide_join(days, "serial_num", FEATURES)
    return _installs(spark, sf).join(wide, "serial_num")


@query
def wide_daily_bucketed(spark, sf):
    """Day tables bucketed by home when they are written; the join of all days then moves nothing."""
    base, daily = scratch_path(spark, "bucketed"), stage(A.daily_features(spark, sf), "daily")
    name = lambda x: f"{base.rsplit('/', 1)[-1]}_{x}".replace("-", "_")
    store = lambda df, x: features.store_bucketed(df, name(x), f"{base}/{x}", "serial_num", BUCKETS)
    days = {d: store(daily.where(F.col("day") == F.lit(d).cast("date")).drop("day"), d) for d in _days(3, 9)}
    wide = features.bucketed_wide_join(days, "serial_num", FEATURES)
    return store(_installs(spark, sf), "installs").join(wide.hint("merge"), "serial_num")


@query
def daily_feature_job(spark, sf):
    """The feature table of seven days before a day: models filtered, columns dropped, copies removed, targets joined."""
    base = scratch_path(spark, "daily_records")
    sinks.overwrite_partitions(A.daily_records(spark, sf), base, ["day"])
    main = _installs(spark, sf).withColumn("after_home_score", F.col("before_home_score") + 1)
    return wide_features(
        spark, main, base + "/day={}", date(2024, 1, 10), "serial_num", FEATURES,
        drop=["mdn"], models=["G0", "G1", "G2"],
    ).select("serial_num", "date_string", "before_home_score", "after_home_score", *[f"{c}_{d}" for d in _days(3, 9) for c in FEATURES])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def correlation_matrix(spark, sf):
    matrix = features.correlation_matrix(A.table(spark, sf, "lineitem"), MEASURES)
    return matrix.withColumn("r", F.round("r", 6))


@query
def correlation_wide(spark, sf):
    matrix = features.correlation_matrix(A.table(spark, sf, "lineitem"), MEASURES)
    return features.correlation_wide(matrix.withColumn("r", F.round("r", 6)), MEASURES)


# --- sources and sinks -------------------------------------------------------


def _events_by_half_day(spark, sf):
    return A.table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "value",
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(F.hour("ts") < 12, "00").otherwise("12").alias("hour"),
    )


@query
def partition_read(spark, sf):
    base = scratch_path(spark, "partitioned")
    sinks.overwrite_partitions(_events_by_half_day(spark, sf), base)
    return sources.read_partition(spark, base, "20240107", 12)


@query
def partition_overwrite(spark, sf):
    """All partitions written, then one hour of one day replaced."""
    base = scratch_path(spark, "replaced")
    events = _events_by_half_day(spark, sf)
    sinks.overwrite_partitions(events, base)
    one_hour = sources.read_partition(spark, base, "20240107", 12)
    changed = stage(one_hour.groupBy("user_id", "date", "hour").agg(
        F.max("event_id").alias("event_id"), F.max("value").alias("value")), "changed")
    sinks.overwrite_partitions(changed, base)
    full = T.StructType([*events.schema.fields])
    return spark.read.schema(full).parquet(base)


@query
def full_overwrite(spark, sf):
    """A table written twice holds what was written last."""
    path = scratch_path(spark, "overwritten")
    sinks.overwrite(A.table(spark, sf, "customer"), path)
    sinks.overwrite(A.table(spark, sf, "part"), path)
    return spark.read.parquet(path)


@query
def csv_roundtrip(spark, sf):
    folder = scratch_path(spark, "part_csv")
    sinks.csv_folder(A.table(spark, sf, "part"), folder)
    return sources.load_csv(spark, folder, A.SCHEMAS["part"])


@query
def export_filtered(spark, sf):
    folder = scratch_path(spark, "export")
    sinks.export_models(
        spark, f"{sf}/part.parquet", folder, ["Brand#1", "Brand#2", "Brand#3"], column="p_brand"
    )
    return sources.load_csv(spark, folder, A.SCHEMAS["part"])


@query
def single_csv_report(spark, sf):
    """A small summary of the whole table as one CSV file, read back with inferred types."""
    folder = scratch_path(spark, "report")
    summary = A.table(spark, sf, "part").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.max("p_size").alias("max_size")
    )
    path = sinks.single_csv(summary, folder, "summary.csv")
    return sources.load_csv(spark, path).select(
        "p_brand", F.col("n").cast("bigint").alias("n"), F.col("max_size").cast("int").alias("max_size")
    )


@query
def single_csv_parts(spark, sf):
    """The same kind of file of a whole table, in order, made of the parts that tasks wrote."""
    folder = scratch_path(spark, "csv_parts")
    table = A.table(spark, sf, "part").orderBy("p_partkey")
    path = published.csv_from_parts(table, folder, "parts.csv")
    return sources.load_csv(spark, path, table.schema)


@query
def publish_verified(spark, sf):
    """Published by two in turn: the first copy counts, and is what its manifest says."""
    base, customers = scratch_path(spark, "verified"), A.table(spark, sf, "customer")
    won = [published.publish_verified(spark, rows, base) for rows in (customers, customers.where("c_custkey % 2 = 0"))]
    if won != [True, False]:
        raise RuntimeError(f"published {won}")
    return published.read_published(spark, base, verify=True)


@query
def publish_if_absent(spark, sf):
    """Published once; the second call finds the target and leaves it alone."""
    target = scratch_path(spark, "published")
    sinks.publish_if_absent(spark, f"{sf}/customer.parquet", target)
    sinks.publish_if_absent(spark, f"{sf}/supplier.parquet", target)
    return spark.read.parquet(target)


@query
def publish_partitioned(spark, sf):
    """A table foldered by date and hour, published, and read with its folders as text."""
    source, target = scratch_path(spark, "unpublished"), scratch_path(spark, "published")
    sinks.overwrite_partitions(_events_by_half_day(spark, sf), source)
    sinks.publish_if_absent(spark, source, target)
    days = [n.removeprefix("date=") for n in sinks.children(spark, target) if n.startswith("date=")]
    return features.union_frames([sources.read_partition(spark, target, day) for day in days])


# --- messages ----------------------------------------------------------------

MESSAGE = T.StructType([T.StructField("k", T.IntegerType())])


def _messages(events: DataFrame) -> DataFrame:
    """Good messages, and some broken in syntax or type, followed by something, or two in one."""
    return events.selectExpr(
        "event_id",
        """case when event_type = 'error' then substring(props, 1, length(props) - 1)
                when event_type = 'signup' then concat('{"k": "', user_id, 'x"}')
                when event_id % 11 = 0 then concat(props, ' x')
                when event_id % 11 = 1 then concat(props, props)
                when event_id % 11 = 2 then concat('[', props, ']') else props end as value""",
    )


@query
def message_encode(spark, sf):
    events = A.table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "event_type", "cast(value as decimal(10, 2)) as value"
    )
    return messages.encode(events, lambda df: df.withColumnRenamed("event_type", "kind"))


@query
def message_decode(spark, sf):
    return messages.decode(_messages(A.table(spark, sf, "events")), MESSAGE)


def _received(spark, table):
    event_id = T.StructField("event_id", T.LongType())
    good = messages.received(spark, table, MESSAGE, "ok", event_id).withColumn(
        messages.CORRUPT, F.lit(None).cast("string")
    )
    return good.unionByName(messages.received(spark, table, MESSAGE, "bad", event_id))


@query
def message_stream(spark, sf):
    """The same messages received by two streams into one table: good ones and quarantined ones."""
    # A pattern makes the folder the base path, whether the table is one file or a folder of files; this one fits it only.
    path = f"{sf}/events.parque[t]"
    arriving = spark.readStream.schema(A.SCHEMAS["events"]).parquet(path)
    table = scratch_path(spark, "received")
    for part in (0, 1):
        own = _messages(arriving.where(F.col("event_id") % 2 == part))
        messages.receive(own, MESSAGE, table, scratch_path(spark, "checkpoint")).awaitTermination()
    return _received(spark, table)


@query
def message_redelivery(spark, sf):
    """Messages of every fourth user are understood on the second attempt only; broken ones are given up after three."""
    base = scratch_path(spark, "retries")
    encoded = _messages(A.table(spark, sf, "events")).select("value")
    encoded.repartition(2).write.text(f"{base}/in")

    def handle(due: DataFrame) -> DataFrame:
        rows = messages.decode(due.withColumn("text", F.col("value")), MESSAGE, "text")
        late = (F.col("k") % 4 == 0) & (F.col("attempts") < 2)
        return rows.withColumn("ok", F.col(messages.CORRUPT).isNull() & ~F.coalesce(late, F.lit(False))).select("value", "attempts", "k", "ok")

    table, state = f"{base}/out", f"{base}/state"
    run = redelivery.receive_with_retries(
        messages.message_folder(spark, f"{base}/in", max_files=1), handle, table, state, f"{base}/checkpoint"
    )
    run.awaitTermination()
    while redelivery.redeliver(spark, handle, table, state, str(run.id)):
        pass
    found = [redelivery.handled(spark, table, "value string, attempts int, k int", x).withColumn("status", F.lit(x)) for x in ("ok", "dead")]
    return found[0].unionByName(found[1])


@query
def message_archive(spark, sf):
    """Files of text lines received as a stream, which archives what it has consumed."""
    inbox, archive, table = (scratch_path(spark, n) for n in ("inbox", "archive", "received"))
    values = _messages(A.table(spark, sf, "events")).select("value")
    values.write.text(inbox)
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        messages.receive(messages.message_folder(spark, inbox, archive), MESSAGE, table, checkpoint).awaitTermination()
    found = messages.received(spark, table, MESSAGE, "ok").withColumn(messages.CORRUPT, F.lit(None).cast("string"))
    return found.unionByName(messages.received(spark, table, MESSAGE, "bad"))


@query
def whole_file_messages(spark, sf):
    """Files of one message each."""
    folder = scratch_path(spark, "files")
    counts = A.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("int").alias("k"))
    counts.selectExpr("c_nationkey", "to_json(struct(k)) as value").write.partitionBy("c_nationkey").text(folder)
    return messages.decode(messages.whole_files(spark, f"{folder}/*"), MESSAGE)
