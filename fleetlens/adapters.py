"""The sample tables seen as fleet telemetry, device diagnostics and dataset dates.

Stand-ins for the real inputs: every function is a projection of one table, so
its size and cost follow that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
MAX_BYTES = 900_000
EXCLUDED_DAYS = ["2024-01-15", "2024-01-16"]


# Declared, so that opening a table starts no job.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


_GOOD = "l_suppkey % 4 = 1"
_RSSI = f"""
    floor(-40 - l_quantity * (case when {_GOOD} then 0.3D else 1.0D end)
              - (case when {_GOOD} then 0 else 12 * ((l_suppkey + l_linenumber) % 4) end))
"""
_RATE = f"""
    cast(floor(l_extendedprice / 200.0D / case (case when {_GOOD} then 0 else (l_suppkey + 2 * l_linenumber) % 4 end)
        when 0 then 1 when 1 then 4 when 2 then 12 else 30 end) as int)
"""
# Day-level signal: constant in every tenth home, otherwise the wider the higher the line number.
_DAY_SIGNAL = """
    case when l_suppkey % 10 = 0 then -60.0D else -40 - round(l_quantity * l_linenumber / 14.0D, 1) end
"""


# Three days (by ship year) of two hours; the records of some orders arrive an hour late.
_YEAR = "(1996 + year(l_shipdate) % 3)"


_CONNECT_DATA = [
    "station_mac",
    "station_name",
    "connect_type",
    "signal_strength",
    "snr",
    "link_rate",
    "tx_link_rate",
    "ts",
    "bs",
    "br",
]


def _history(lineitem: DataFrame, signal: str) -> DataFrame:
    return lineitem.selectExpr(
        "concat('R-S', l_suppkey, '_', l_orderkey) as rowkey",
        "concat('Model#', l_partkey % 25) as Tplg_Data_model_name",
        "concat('m', l_suppkey, 'x', l_linenumber) as station_mac",
        "case when l_linenumber = 7 then null else concat('n', l_linenumber) end as station_name",
        "case l_returnflag when 'A' then '2.4GHz' when 'R' then '5GHz' else '6GHz' end as connect_type",
        f"cast({signal} as double) as signal_strength",
        "l_quantity * 0.2D * (1 + l_suppkey % 3) - case when l_linenumber = 6 then 40 else 0 end as snr",
        f"concat({_RATE}, 'Mbps') as link_rate",
        f"concat({_RATE}, 'Mbps') as tx_link_rate",
        f"""unix_seconds(cast(concat({_YEAR}, '-01-01') as timestamp)) * 1000 + (l_orderkey % 3600) * 1000
            + (l_partkey % 2 + case when l_orderkey % 97 = 0 then 1 else 0 end) * 3600000 as ts""",
        "cast(floor(l_extendedprice) as bigint) as bs",
        "cast(floor(l_extendedprice * l_tax) as bigint) as br",
        f"concat({_YEAR}, '0101') as date",
        "lpad(l_partkey % 2, 2, '0') as hour",
    )


def station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat connection records: home = supplier, station = line number, day by ship year, hour by part."""
    return _history(table(spark, sf_dir, "lineitem"), _RSSI)


def nested_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in the nested form in which they arrive."""
    return station_history(spark, sf_dir).select(
        "rowkey", "Tplg_Data_model_name", F.struct(*_CONNECT_DATA).alias("station_data_connect_data"), "date", "hour"
    )


def previous_day_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records from which the mobility label is taken."""
    return _history(table(spark, sf_dir, "lineitem"), _DAY_SIGNAL)


def device_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two radios per event: the second only of views, with the plain value as airtime."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('G-S', user_id) as rowkey",
        """array(
            named_struct('_2_4g', named_struct(
                'enable', case event_type when 'error' then '0' else '1' end,
                'airtime_util', case event_type when 'signup' then '' else
                    concat(cast(floor(value / (1 + user_id % 3)) as int), case when user_id % 2 = 0 then '.5' else '' end) end)),
            named_struct('_2_4g', named_struct(
                'enable', case event_type when 'view' then '1' else '0' end,
                'airtime_util', cast(cast(floor(value) as int) as string)))
        ) as group_diag_history_radio_wifi_info""",
        "concat(1996 + event_id % 3, '0101') as date",
        "lpad(event_id div 3 % 2, 2, '0') as hour",
    )


def dataset_name() -> str:
    return "concat(case when user_id % 3 = 0 then 'biz_' else 'ds_' end, user_id)"


def with_son(records: DataFrame) -> DataFrame:
    """Records that belong to a self-organizing network now and then."""
    return records.withColumn("son", F.expr("cast(cast(abs(rssi) as bigint) % 2 as int)"))


def drop_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``folder, entry``: files of two drops in every folder, days in both spellings."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('in', user_id % 5) as folder",
        """concat(case event_type when 'error' then 'returns' else 'sales' end, '_',
                  date_format(ts, case when event_id % 2 = 0 then 'yyyy-MM-dd' else 'yyyyMMdd' end),
                  case when event_id % 7 = 0 then '_old.csv' else '.csv' end) as entry""",
    )


def drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, folder, template`` of the drops in the folders."""
    folders = table(spark, sf_dir, "events").selectExpr("concat('in', user_id % 5) as folder").distinct()
    return folders.selectExpr(
        "folder", "explode(array('sales', 'returns')) as kind"
    ).selectExpr("concat(folder, '_', kind) as name", "folder", "concat(kind, '_{}.csv') as template")


def observed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, observed_date``: one dataset per user, seen on the days of its events."""
    return table(spark, sf_dir, "events").selectExpr(
        f"{dataset_name()} as name", "cast(ts as date) as observed_date"
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, entry``: the same days as file names in both date formats, some after another number, sign-ups undated."""
    return table(spark, sf_dir, "events").selectExpr(
        f"{dataset_name()} as name",
        """case when event_type = 'signup' then concat('part-', event_type, '.csv')
                when event_id % 2 = 0 then concat('part-', date_format(ts, 'yyyy-MM-dd'), '.csv')
                when event_id % 5 = 1 then concat('99999999_', date_format(ts, 'yyyyMMdd'), '.csv')
                when event_id % 5 = 3 then concat('12345678_', date_format(ts, 'yyyy-MM-dd'), '.csv')
                else concat('part-', date_format(ts, 'yyyyMMdd'), '.csv') end as entry""",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, expect_delay, calendar, folder_calendar`` of every dataset.

    Some run ahead of their day; the folders of some are filled on workdays only, their tables daily.
    """
    return (
        table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .selectExpr(
            f"{dataset_name()} as name",
            "cast(case user_id % 8 when 7 then 30 when 6 then -2 else user_id % 8 end as int) as expect_delay",
            "case when user_id % 3 = 0 then 'business' else 'daily' end as calendar",
            "case when user_id % 3 = 0 or user_id % 5 = 0 then 'business' else 'daily' end as folder_calendar",
        )
    )


def daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of home features per user and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("serial_num"), F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("num_station"),
            F.count_if(F.col("event_type") == "error").alias("poor_rssi"),
            F.count_if(F.col("event_type") == "view").alias("poor_phyrate"),
            F.max("value").alias("home_score"),
        )
    )


def daily_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily features as they arrive: with a model, columns nobody needs, and every row of some homes twice."""
    rows = daily_features(spark, sf_dir).withColumns(
        {
            "dg_model_indiv": F.concat(F.lit("G"), F.col("serial_num").cast("int") % 4),
            "mdn": F.concat(F.lit("n"), F.col("serial_num")),
        }
    )
    times = F.when(F.col("serial_num").cast("int") % 3 == 0, 2).otherwise(1)
    return rows.select("*", F.explode(F.array_repeat(F.lit(0), times)).alias("__")).drop("__")
