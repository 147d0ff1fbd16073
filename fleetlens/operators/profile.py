"""Per-station signal profile: mobility label and the typed hourly fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import clean
from fleetlens.operators.grouping import ACCURACY, attach, percentiles

# Fixed value: largest p90 - p50 signal distance of a stationary device.
STATIONARY_SPREAD = 5

_DATA = "station_data_connect_data"


def flatten_struct(df: DataFrame, struct: str, *keep: str) -> DataFrame:
    """The fields of a struct column as columns of their own, after the kept ones."""
    return df.select(*keep, f"{struct}.*")


def fields_of(history: DataFrame, *fields: str) -> DataFrame:
    """Fields of the connection struct as columns, beside the row key, model and partition.

    History that is flat already is taken as it is.  From nested parquet only
    these fields are read.
    """
    nested = _DATA in history.columns
    kept = [c for c in ("rowkey", "Tplg_Data_model_name", "date", "hour") if c in history.columns]
    return history.select(*kept, *[f"{_DATA}.{f}" if nested else f for f in fields])


def stationarity(history: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """``sn, station_mac, mobility_status`` from one (the previous) day of history.

    A row is an outlier unless its signal exceeds the lower of p3 and
    ``p10 - 2 * (p90 - p10)``; the label depends on the group alone, so a station
    keeps its label exactly if its strongest signal is no outlier.
    """
    return mobility_label(
        fields_of(history, "station_mac", "signal_strength")
        .where(F.col("signal_strength").isNotNull())
        .groupBy(clean.serial("rowkey").alias("sn"), "station_mac")
        .agg(
            percentiles("signal_strength", 0.03, 0.1, 0.5, 0.9, accuracy=accuracy).alias("p"),
            F.max("signal_strength").alias("strongest"),
        )
    )


def mobility_label(stations: DataFrame) -> DataFrame:
    """The label from ``p``, the percentiles 3, 10, 50 and 90 of a station's signal, and ``strongest``."""
    p3, p10, p50, p90 = (F.col("p")[i] for i in range(4))
    fence = F.least(p10 - 2 * (p90 - p10), p3)
    label = F.when(p90 - p50 <= STATIONARY_SPREAD, "Stationary").otherwise("Non-stationary")
    return stations.where(F.col("strongest") > fence).select("sn", "station_mac", label.alias("mobility_status"))


def hourly_records(history: DataFrame) -> DataFrame:
    """Raw history rows, flattened to the needed fields, parsed and renamed."""
    flat = fields_of(
        history,
        "station_mac",
        "station_name",
        "connect_type",
        "signal_strength",
        "snr",
        "link_rate",
        "tx_link_rate",
        "ts",
    )
    return flat.select(
        clean.serial("rowkey").alias("sn"),
        "station_mac",
        "station_name",
        F.col("connect_type").alias("band"),
        F.col("signal_strength").alias("rssi"),
        "snr",
        clean.rate("link_rate").alias("phy_rate"),
        clean.rate("tx_link_rate").alias("tx_phy_rate"),
        F.col("Tplg_Data_model_name").alias("model"),
        clean.epoch_hour("ts").alias("hour"),
        clean.epoch_day("ts").alias("date"),
        F.lit(0).alias("son"),
    )


def device_signal(history: DataFrame, key: str = "station_mac", accuracy: int = ACCURACY) -> DataFrame:
    """``p50_rssi`` and ``p90_rssi`` of each device, from its signals alone."""
    signals = fields_of(history, "station_mac", "signal_strength")
    signals = signals.withColumn("sn", clean.serial("rowkey"))
    return signals.groupBy(key).agg(percentiles("signal_strength", 0.5, 0.9, accuracy=accuracy).alias("p")).select(
        key, F.col("p")[0].cast("int").alias("p50_rssi"), F.col("p")[1].cast("int").alias("p90_rssi")
    )


def hourly_fact(
    history: DataFrame, mobility: DataFrame, signal_key: str = "station_mac", accuracy: int = ACCURACY
) -> DataFrame:
    """Hourly records with the p50/p90 signal of their device and its mobility label.

    The wide rows are moved once, on ``(sn, station_mac)``: what is attached to them is put
    together beforehand from narrow columns, which are read twice more.  Attaching signal and
    label one after the other needs one scan less but moves the wide rows
    """
    records = hourly_records(history)
    keys = list(dict.fromkeys(["sn", "station_mac", signal_key]))
    stations = fields_of(history, "station_mac").withColumn("sn", clean.serial("rowkey")).select(*keys).distinct()
    known = attach(stations, device_signal(history, signal_key, accuracy), [signal_key])
    profile = known.join(mobility, ["sn", "station_mac"], "left").select(*keys, "p50_rssi", "p90_rssi", "mobility_status")
    return attach(records, profile, keys)
