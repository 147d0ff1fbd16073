"""Writing results: whole tables, single partitions, CSV exports, publishing once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetlens.operators.features import keep_values


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder."""
    fs, hadoop = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop))


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _path(spark, source)
    _, new = _path(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _path(spark, path)
    fs.delete(hadoop, True)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Replace a table that ``df`` may read itself; the old one keeps its name until the new one is complete."""
    spark, (folder, name) = df.sparkSession, path.rstrip("/").rsplit("/", 1)
    growing, old = f"{folder}/_growing_{name}", f"{folder}/_old_{name}"
    df.write.mode("overwrite").parquet(growing)
    delete(spark, old)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, growing, path)
    delete(spark, old)


def overwrite_partitions(
    df: DataFrame, path: str, keys: Sequence[str] = ("date", "hour"), rebalance: bool = True
) -> None:
    """Replace only the partitions that ``df`` has rows for.

    Rows are brought together by partition first, else every task would write a
    file into each of them; adaptive execution splits a partition that is too
    large for one task.  Not needed for a single partition.
    """
    if rebalance:
        df = df.hint("rebalance", *keys)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def csv_folder(df: DataFrame, folder: str, header: bool = True) -> None:
    """CSV export of any size: one file per task."""
    df.write.mode("overwrite").option("header", header).csv(folder)


def part_file(spark: SparkSession, folder: str, extension: str = ".csv") -> str:
    """The only data file of a folder; a success marker beside it is removed."""
    names = children(spark, folder)
    if "_SUCCESS" in names:
        delete(spark, f"{folder}/_SUCCESS")
    parts = [n for n in names if n.startswith("part-") and n.endswith(extension)]
    if len(parts) != 1:
        raise OSError(f"{len(parts)} data files in {folder}, expected one")
    return f"{folder}/{parts[0]}"


def single_csv(
    df: DataFrame, folder: str, filename: str, header: bool = True, mode: str = "overwrite", ordered: bool = False
) -> str:
    """Write ``df`` as the one CSV file ``folder/filename`` and return its path.

    One task writes the file, but the work before it stays parallel; use
    ``csv_folder`` for results that do not have to be a single file.  ``ordered``
    keeps the row order of a sorted ``df``.  ``mode`` is ``overwrite``, ``error``
    or ``ignore``, and concerns the final file.
    """
    if mode not in ("overwrite", "error", "ignore"):
        raise ValueError(f"unknown mode {mode}")
    spark = df.sparkSession
    target, staging = f"{folder}/{filename}", f"{folder}/_temp_{filename}"
    if exists(spark, target) and mode != "overwrite":
        if mode == "ignore":
            return target
        raise FileExistsError(target)
    one = df.coalesce(1) if ordered else df.repartition(1)
    one.write.mode("overwrite").option("header", header).csv(staging)
    part, old = part_file(spark, staging), f"{folder}/_old_{filename}"
    # The old file keeps its rows until the new one has its name.
    delete(spark, old)
    if exists(spark, target):
        rename(spark, target, old)
    rename(spark, part, target)
    delete(spark, old)
    delete(spark, staging)
    return target


def export_models(
    spark: SparkSession, source: str, folder: str, models: Sequence[str], filename: str | None = None,
    column: str = "model_name",
) -> str:
    """Rows of a parquet table whose ``column`` is one of ``models``, as CSV with header.

    With ``filename`` as one file, otherwise as a folder of files.
    """
    kept = keep_values(spark.read.parquet(source), column, models)
    if filename:
        return single_csv(kept, folder, filename)
    csv_folder(kept, folder)
    return folder


def partition_keys(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition columns of a foldered table, outermost first."""
    keys: list[str] = []
    while True:
        fs, hadoop = _path(spark, path)
        if not fs.getFileStatus(hadoop).isDirectory():
            return keys
        below = [n for n in children(spark, path) if "=" in n and n[0] not in "._"]
        if not below:
            return keys
        keys.append(below[0].split("=", 1)[0])
        path = f"{path}/{below[0]}"


def publish_if_absent(spark: SparkSession, source: str, target: str, fmt: str = "parquet", **options) -> bool:
    """Copy a table to another store unless it is there already; True if it was copied.

    Rows are read and rewritten by the executors in parallel, in the same
    partition folders, whose values stay text as they are.  The copy grows beside the target and takes
    its name when it is complete, so a copy that failed does not count.  A missing source is an error.
    """
    if not exists(spark, source):
        raise FileNotFoundError(source)
    if exists(spark, target):
        return False
    reader = spark.read.format(fmt).options(**options)
    rows, keys = reader.load(source), partition_keys(spark, source)
    if keys:
        text = [T.StructField(f.name, T.StringType()) if f.name in keys else f for f in rows.schema.fields]
        rows = reader.schema(T.StructType(text)).load(source).hint("rebalance", *keys)
    folder, name = target.rstrip("/").rsplit("/", 1)
    growing = f"{folder}/_publishing_{name}"
    rows.write.format(fmt).options(**options).mode("overwrite").partitionBy(*keys).save(growing)
    rename(spark, growing, target)
    return True
