"""Observed days of datasets as bitmaps that are kept and merged from run to run.

A dataset has one bitmap per 32,768 days, and its latest day beside it.  A run
reads only what arrived since the last one, merges it into the maps, and answers
delay and missing days from them by looking at bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import freshness
from fleetlens.sinks import files as sinks

SCHEMA = "name string, bucket bigint, days binary, latest_date date"


def _number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")


def day_maps(observed: DataFrame) -> DataFrame:
    """``name, bucket, days, latest_date`` of observations ``(name, observed_date)``; rows without a day do not count."""
    number = _number(F.col("observed_date"))
    rows = observed.where(F.col("observed_date").isNotNull()).select(
        "name",
        F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).alias("bit"),
        "observed_date",
    )
    return rows.groupBy("name", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("days"), F.max("observed_date").alias("latest_date")
    )


def merged(*maps: DataFrame) -> DataFrame:
    """Maps of several runs as one."""
    whole = maps[0]
    for further in maps[1:]:
        whole = whole.unionByName(further)
    return whole.groupBy("name", "bucket").agg(
        F.bitmap_or_agg("days").alias("days"), F.max("latest_date").alias("latest_date")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The maps kept at ``path``; none before the first run."""
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def update(path: str, observed: DataFrame) -> DataFrame:
    """Merges new observations into the maps kept at ``path``, and returns them.

    The maps of the run before keep their name until the new ones are complete.  Merging the same
    observations again changes nothing, so a run may be repeated.
    """
    spark = observed.sparkSession
    sinks.replace(merged(read(spark, path), day_maps(observed)), path)
    return read(spark, path)


def seen(maps: Column | str, day: Column) -> Column:
    """Whether ``day`` is in ``maps``, a map from bucket to bitmap."""
    bit = F.bitmap_bit_position(_number(day))
    days = F.try_element_at(maps, F.bitmap_bucket_number(_number(day)))
    byte = F.conv(F.hex(F.substring(days, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (bit % 8).cast("int") + 1)) > 0, F.lit(False))


def by_dataset(maps: DataFrame) -> DataFrame:
    """``name``, ``latest_date`` and ``days``, the bitmaps of the dataset by bucket."""
    return maps.groupBy("name").agg(
        F.max("latest_date").alias("latest_date"),
        F.map_from_entries(F.collect_list(F.struct("bucket", "days"))).alias("days"),
    )


def missing(registry: DataFrame, maps: DataFrame, as_of: Column | str, span: tuple[int, int], excluded: Sequence[str] = ()) -> DataFrame:
    """``freshness.missing_days`` from maps."""
    found = report(registry, maps, as_of, span, excluded)
    return found.select("name", F.explode("miss_days").alias("missing_day"))


def report(
    registry: DataFrame,
    maps: DataFrame,
    as_of: Column | str,
    span: tuple[int, int],
    excluded: Sequence[str] = (),
    calendar_column: str = "calendar",
) -> DataFrame:
    """``freshness.report`` from maps; a dataset without a map was never seen."""
    known = registry.join(by_dataset(maps), "name", "left")
    probed = freshness.probed_days(as_of, span, calendar_column, excluded)
    return known.select(
        "name",
        "latest_date",
        freshness.delayed_days(as_of).alias("delayed_days"),
        F.filter(probed, lambda d: ~seen("days", d)).alias("miss_days"),
    )
