"""Signal statistics of station-hours, kept as mergeable sketches.

Raw history is read once, when an hour arrives: every station-hour becomes a row with a
quantile sketch.  Labels and signals of any longer span, or of any coarser
key, are merged from those rows and never need the raw rows again.

A sketch holds all values of a group of up to ``k``, so its quantiles are exact there.  Beyond, the
rank of a quantile is off by at most ``rank_error(k)`` of the group (with 99 % confidence),
however often sketches were merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import clean
from fleetlens.operators.profile import attach, fields_of, hourly_records, mobility_label

#: Size parameter of the sketches, unless told otherwise.
K = 512

HOUR = ("sn", "station_mac", "date", "hour")


def rank_error(k: int = K) -> float:
    """Largest error of a quantile's rank, as a share of the group."""
    return 2.296 / k**0.9723


def station_hours(history: DataFrame, k: int = K) -> DataFrame:
    """``sn, station_mac, date, hour, signals, strongest, n``: a sketch of the signals of each station-hour.

    ``signals`` is null, and ``n`` 0, where a station sent no signal; such rows keep the station known.
    Hours are those of the records' own time, as in ``hourly_records``.
    """
    rows = fields_of(history, "station_mac", "signal_strength", "ts").select(
        clean.serial("rowkey").alias("sn"),
        "station_mac",
        clean.epoch_day("ts").alias("date"),
        clean.epoch_hour("ts").alias("hour"),
        F.col("signal_strength").cast("double").alias("signal"),
    )
    return _without_empty(
        rows.groupBy(*HOUR).agg(
            F.kll_sketch_agg_double("signal", F.lit(k)).alias("signals"),
            F.max("signal").alias("strongest"),
            F.count("signal").alias("n"),
        )
    )


def merged(sketches: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """The rows of ``station_hours`` (or of an earlier merge) by coarser ``keys``."""
    return _without_empty(
        sketches.groupBy(*keys).agg(
            F.kll_merge_agg_double("signals", F.lit(k)).alias("signals"),
            F.max("strongest").alias("strongest"),
            F.sum("n").alias("n"),
        )
    )


def _without_empty(rows: DataFrame) -> DataFrame:
    """A sketch without values has no quantiles, so it counts as none."""
    return rows.withColumn("signals", F.when(F.col("n") > 0, F.col("signals")))


def quantiles(sketch: Column | str, *fractions: float) -> Column:
    """Values of the given ranks, as one array; null for no sketch."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(f)) for f in fractions]))


def stationarity(sketches: DataFrame, k: int = K) -> DataFrame:
    """``profile.stationarity`` of the span that the sketches cover."""
    stations = merged(sketches, ["sn", "station_mac"], k).where("n > 0")
    return mobility_label(stations.withColumn("p", quantiles("signals", 0.03, 0.1, 0.5, 0.9)))


def device_signal(sketches: DataFrame, key: str = "station_mac", k: int = K) -> DataFrame:
    """``profile.device_signal`` from sketches."""
    return merged(sketches, [key], k).withColumn("p", quantiles("signals", 0.5, 0.9)).select(
        key, F.col("p")[0].cast("int").alias("p50_rssi"), F.col("p")[1].cast("int").alias("p90_rssi")
    )


def hourly_fact(
    history: DataFrame, sketches: DataFrame, mobility: DataFrame, signal_key: str = "station_mac", k: int = K
) -> DataFrame:
    """``profile.hourly_fact`` with the history read once: signals and stations come from its sketches."""
    keys = list(dict.fromkeys(["sn", "station_mac", signal_key]))
    stations = sketches.select(*keys).distinct()
    known = attach(stations, device_signal(sketches, signal_key, k), [signal_key])
    known = known.join(mobility, ["sn", "station_mac"], "left")
    return attach(hourly_records(history), known.select(*keys, "p50_rssi", "p90_rssi", "mobility_status"), keys)
