"""Reading date/hour-foldered tables, days that may be missing, CSV files and folder listings."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.features import union_frames

log = logging.getLogger(__name__)

PARTITION_KEYS = ("date", "hour")


def read_partition(
    spark: SparkSession, base: str, date: str, hour: str | int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """One day, or one hour of it, of a table foldered ``date=YYYYMMDD/hour=HH``.

    Only that folder is listed; ``date`` and ``hour`` stay text columns.
    """
    base = base.rstrip("/")
    leaf = f"{base}/date={date}" + ("" if hour is None else f"/hour={str(hour).zfill(2)}")
    reader = spark.read.option("basePath", base)
    found = schema or reader.parquet(leaf).schema
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in PARTITION_KEYS else f for f in found.fields]
    )
    return reader.schema(as_text).parquet(leaf)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; types are inferred (one more pass) unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def _absent(error: Exception) -> bool:
    if isinstance(error, PySparkException):
        return error.getCondition() == "PATH_NOT_FOUND"
    return isinstance(error, Py4JJavaError) and "FileNotFoundException" in error.java_exception.getClass().getName()


def read_tolerant(
    spark: SparkSession,
    pattern: str,
    values: Iterable,
    loader: Callable[[SparkSession, str], DataFrame] = load_parquet,
    positional: bool = False,
    on_error: str = "raise",
    skipped: list[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """Union of ``pattern.format(value)`` over the values whose path is there; None if there is none.

    ``loader`` reads one path and may shape it.  With the default loader and
    equal schemas all paths become one scan.  Absent paths are left out; any other error is
    raised, or with ``on_error="skip"`` the path is left out too.  What was
    left out, and why, is added to ``skipped``.
    """
    frames = {}
    for path in (pattern.format(v) for v in values):
        try:
            frames[path] = loader(spark, path)
        except (PySparkException, Py4JJavaError) as error:
            if not _absent(error) and on_error != "skip":
                raise
            reason = str(error).splitlines()[0]
            log.warning("skipped %s: %s", path, reason)
            if skipped is not None:
                skipped.append((path, reason))
    schemas = [df.schema for df in frames.values()]
    if loader is load_parquet and len(frames) > 1 and all(s == schemas[0] for s in schemas):
        return spark.read.schema(schemas[0]).parquet(*frames)
    return union_frames(list(frames.values()), positional)


def list_names(spark: SparkSession, folders: Mapping[str, str], on_error: str = "raise") -> DataFrame:
    """``(name, entry)``: the direct children, files and folders, of each dataset's folder.

    Only names are listed, all of a folder in one call, and no folder is descended
    into.  A folder that is not there gives no row, so its dataset shows up as never seen; one
    that cannot be read is an error unless ``on_error`` is ``"skip"``.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    rows = []
    for name, folder in folders.items():
        path = jvm.org.apache.hadoop.fs.Path(folder)
        try:
            found = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(path.getFileSystem(conf).listStatus(path))
        except Py4JJavaError as error:
            if not _absent(error) and on_error != "skip":
                raise
            log.warning("cannot list %s: %s", folder, error.java_exception.getMessage())
            continue
        if found:
            before = found[0].getParent().toString().rstrip("/") + "/"
            listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(found)[1:-1].removeprefix(before)
            rows += [(name, entry) for entry in listed.split(f",{before}")]
    return spark.createDataFrame(rows, "name string, entry string")


def observed_partitions(df: DataFrame, name: str, column: str = "date", fmt: str = "yyyyMMdd") -> DataFrame:
    """``(name, observed_date)`` from the partition values of a foldered table."""
    return df.select(F.lit(name).alias("name"), F.try_to_date(column, fmt).alias("observed_date")).distinct()


def read_table(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """A table of any store that Spark has a source for (``jdbc``, ``orc``, ...)."""
    return spark.read.format(fmt).options(**options).load()


def observed_in_table(df: DataFrame, name: str, ts: str) -> DataFrame:
    """``(name, observed_date)`` from a timestamp, date or ISO text column of a table."""
    return df.select(F.lit(name).alias("name"), F.to_date(F.col(ts)).alias("observed_date")).distinct()
