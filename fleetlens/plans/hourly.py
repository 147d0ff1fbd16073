"""The hourly scoring job: history folders in, fact and score tables out."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schema
from fleetlens.operators import profile, scores
from fleetlens.session import scratch_path, stage
from fleetlens.sinks.files import delete, overwrite_partitions
from fleetlens.sources.files import read_partition


def score_hour(
    spark: SparkSession,
    history_base: str,
    groups_base: str,
    output_base: str,
    date: str,
    hour: str | int,
    max_bytes: int = scores.MAX_TOTAL_BYTES,
) -> dict[str, str]:
    """Score one hour; returns the paths of the tables it wrote to, by name.

    Every table is partitioned by date and hour, and only the partitions written
    to are replaced.  The fact table is read back for scoring, which cuts the
    lineage and prunes each score to its columns.
    """
    hour = str(hour).zfill(2)
    day_before = (datetime.strptime(date, "%Y%m%d") - timedelta(days=1)).strftime("%Y%m%d")
    paths = {name: f"{output_base.rstrip('/')}/{name}" for name in ("station_connection", "station_score", "wifi_score")}

    history = read_partition(spark, history_base, date, hour, schema.STATION_HISTORY)
    mobility = profile.stationarity(read_partition(spark, history_base, day_before, None, schema.STATION_HISTORY))
    _file_under(profile.hourly_fact(history, mobility), date, hour, paths["station_connection"])

    hourly = read_hour(spark, paths["station_connection"], date, hour)
    _file_under(scores.station_score(hourly), date, hour, paths["station_score"])
    reliability = scores.reliability_score(read_partition(spark, groups_base, date, hour, schema.DEVICE_GROUPS))
    staging = scratch_path(spark, "score_hour")
    try:
        wifi = scores.wifi_score(
            hourly, scores.data_consumption(history, max_bytes), reliability, stage=partial(stage, folder=staging)
        )
        _file_under(wifi, date, hour, paths["wifi_score"])
    finally:
        delete(spark, staging)
    return paths


def _file_under(df: DataFrame, date: str, hour: str, path: str) -> None:
    """Replace one hour of a table.

    Partitions follow the input folder.  A late record keeps its own date and
    hour as ``record_date`` and ``record_hour`` and so replaces no other hour.
    """
    renamed = df.withColumnsRenamed({"date": "record_date", "hour": "record_hour"})
    filed = renamed.withColumns({"date": F.lit(date), "hour": F.lit(hour)})
    overwrite_partitions(filed, path, rebalance=False)


def read_hour(spark: SparkSession, path: str, date: str, hour: str) -> DataFrame:
    """One written hour of a table, with the dates and hours of its records."""
    return (
        read_partition(spark, path, date, hour)
        .drop("date", "hour")
        .withColumnsRenamed({"record_date": "date", "record_hour": "hour"})
    )
