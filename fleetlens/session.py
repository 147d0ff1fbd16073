"""Session helpers: settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Runtime settings: dates in ``time_zone``, adaptive plans with skew-join splitting.

    Every one is a SQL runtime setting, so it works on a session that somebody
    else started.  Partition counts are left to the cluster.  Records are dated in ``time_zone``;
    it has to be the one that the folders of the history are named in.
    """
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(
    app: str = "fleetlens", cpus: int | str = "*", shuffle_partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or where that is unset the warehouse.

    A warehouse on a machine's own disk will do for a local session only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and re.match(r"(file:)?/", root):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in a folder of this application that goes when the application ends."""
    own = f"{shared_dir(spark)}/fleetlens/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(path):
        fs.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    For results that feed several branches of one plan: the input is read once,
    a lost executor costs no recomputation, and the planner sees real sizes.
    The table stays until ``folder`` (by default one of this application's own,
    which ends with it) is deleted.
    """
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """``stage`` as a table bucketed and sorted by ``keys``, a file per bucket and as many as shuffles have partitions.

    Aggregates by ``keys`` read each group in one place, and joins on them move no row.
    All copies of a row are kept.
    """
    path, buckets = scratch_path(df.sparkSession, name), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, list(keys)).sortBy(list(keys))
    dealt.option("path", path).saveAsTable(table, format="parquet")
    return df.sparkSession.table(table)
