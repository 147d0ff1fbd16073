"""What the operators of this folder share: settings, staged tables, Arrow pieces, components.

Operators take a table and the names of its columns, select what they need and
rename it, so further columns never clash with their own.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import session

#: Rows of a table that may be broadcast; beyond it the table is shuffled.
BROADCAST_ROWS = 500_000
#: Bytes of text that a task looks at together.
PIECE_BYTES = 1 << 20
#: Paths of the tables that are staged, in order.
_staged: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Package settings, this package for Python workers, and Arrow batches small enough for long texts."""
    session.configure(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, as their workers import it."""
    context, home = spark.sparkContext, Path(session.__file__).parent
    if any(f.endswith(".zip") and f"/{home.name}-code-" in f for f in context.listFiles):
        return
    path = session.scratch_path(spark, f"{home.name}-code") + ".zip"
    store, place = fs.FileSystem.from_uri(path)
    with store.open_output_stream(place, compression=None) as out, zipfile.ZipFile(out, "w") as archive:
        for source in sorted(home.rglob("*.py")):
            archive.write(source, source.relative_to(home.parent))
    context.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write once to the shared folder, with the writer's ``options``, and continue from the written table."""
    path = session.scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside are deleted at the end; what is made of them has to be written by then."""
    before = len(_staged)
    yield
    for path in _staged[before:]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    del _staged[before:]


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that end inside are deleted at their end, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def few(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it is counted to have at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def apart(kept: tuple[str, ...], made: Iterable[str]) -> None:
    """Refuses to keep columns that bear the name of a result."""
    clash = sorted(set(kept) & set(made))
    if clash:
        raise ValueError(f"columns to keep have names of results: {', '.join(clash)}; rename them")


def crc(column: str, parts: int):
    """crc32 of the number as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (nulls are empty)."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "")
    kind = np.int64 if array.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, at, data = array.buffers()
    offsets = np.frombuffer(at, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64) if len(array) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, a longer text by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, first, total = np.cumsum(sizes), 0, 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, total + limit, "right")))
            yield batch.slice(first, last - first)
            first, total = last, int(ends[last - 1])


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Smallest member of each connected component: ``node``, ``root`` for nodes of ``edges`` (``a``, ``b``).

    Alternating large-star and small-star steps; each step is written to the
    shared folder, so no lineage grows, and no edge reaches the driver.  A node
    with very many edges is an ordinary aggregate and an equi-join on its key.
    """

    def marked(e):
        e = stage(e, name)
        return e, e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e, mark = marked(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(rounds):
        if not mark[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = mark
        e, mark = marked(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
