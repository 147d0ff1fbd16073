"""Publishing a table once, verified, on stores of any kind; and one CSV file made of parallel parts.

A copy grows in a folder of its own.  It is compared with the source by its number of rows and a fingerprint
that does not depend on their order, and counts from the moment a manifest names it.  The manifest is
created only if there is none, so of several publishers one wins, and no folder
is ever renamed.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.sinks import files as sinks
from fleetlens.sources.metadata import opener

MANIFEST = "manifest.json"

#: Bytes of a file that are held while parts are joined.
CHUNK = 4 << 20


class Damaged(OSError):
    """A copy that is not what it should be."""


def fingerprint(df: DataFrame) -> dict:
    """``rows`` and ``content``: sums over two 64-bit hashes of every row, for any order and number of files."""
    whole = [F.to_json(c) if isinstance(t.dataType, T.MapType) else F.col(c) for c, t in ((f"`{f.name}`", f) for f in df.schema.fields)]
    # Which columns are null takes part, as hashes pass over nulls.
    one = F.xxhash64(*whole, *[c.isNull() for c in whole])
    total = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0)).cast("string")
    row = df.select(one.alias("one")).agg(
        F.count(F.lit(1)).alias("rows"), total(F.col("one")).alias("a"), total(F.xxhash64("one", F.lit("again"))).alias("b")
    ).first()
    return {"rows": row["rows"], "content": f"{row['a']},{row['b']}"}


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of this name; the store decides between several writers."""
    fs, hadoop = sinks._path(spark, path)
    try:
        out = fs.create(hadoop, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(hadoop):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def manifest(spark: SparkSession, target: str) -> dict | None:
    """The manifest of a published table; None if nothing is published, or it is being written just now."""
    path = f"{target.rstrip('/')}/{MANIFEST}"
    if not sinks.exists(spark, path):
        return None
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    return json.loads(text) if text else None


def publish_verified(spark: SparkSession, source: DataFrame, target: str) -> bool:
    """Copy a table to ``target`` unless it is published there; True if this copy is the one that counts.

    A copy that differs from its source raises ``Damaged`` and is deleted, as is one that came second.  A
    publisher that dies leaves a folder that no manifest names.
    """
    target = target.rstrip("/")
    if sinks.exists(spark, f"{target}/{MANIFEST}"):
        return False
    name = f"data-{uuid.uuid4().hex}"
    own, expected = f"{target}/{name}", fingerprint(source)
    source.write.parquet(own)
    found = fingerprint(spark.read.schema(source.schema).parquet(own))
    if found != expected:
        sinks.delete(spark, own)
        raise Damaged(f"{own}: {found}, expected {expected}")
    schema = json.loads(source.schema.json())
    won = create_if_absent(spark, f"{target}/{MANIFEST}", json.dumps({"data": name, "schema": schema, **expected}))
    if not won:
        sinks.delete(spark, own)
    return won


def read_published(spark: SparkSession, target: str, verify: bool = False) -> DataFrame:
    """The table that the manifest of ``target`` names; with ``verify`` compared with it first."""
    held = manifest(spark, target)
    if held is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    rows = spark.read.schema(T.StructType.fromJson(held["schema"])).parquet(f"{target.rstrip('/')}/{held['data']}")
    if verify and (found := fingerprint(rows)) != {k: held[k] for k in found}:
        raise Damaged(f"{target}: {found}, expected {held['rows']} rows, {held['content']}")
    return rows


def csv_from_parts(df: DataFrame, folder: str, filename: str, header: bool = True) -> str:
    """Write ``df`` as the one CSV file ``folder/filename`` and return its path.

    Every task writes a part, in the order of a sorted ``df``.  Parts are joined byte by byte, by the store where it can, else by a
    task that appends one after another and holds ``CHUNK`` bytes; no task has all rows.  An old file keeps its name until
    the new one is complete.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    staging, target = f"{folder}/_parts_{filename}", f"{folder}/{filename}"
    sinks.delete(spark, staging)
    df.write.option("header", False).csv(f"{staging}/rows")
    parts = [f"{staging}/rows/{n}" for n in sinks.children(spark, f"{staging}/rows") if n.startswith("part-")]
    if header:
        names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(df.columns))])
        spark.createDataFrame([tuple(df.columns)], names).coalesce(1).write.csv(f"{staging}/header")
        parts.insert(0, sinks.part_file(spark, f"{staging}/header"))
    whole = f"{staging}/whole"
    if not _concat(spark, whole, parts):
        _append(spark, whole, parts)
    old = f"{folder}/_old_{filename}"
    sinks.delete(spark, old)
    if sinks.exists(spark, target):
        sinks.rename(spark, target, old)
    sinks.rename(spark, whole, target)
    sinks.delete(spark, old)
    sinks.delete(spark, staging)
    return target


def _concat(spark: SparkSession, whole: str, parts: list[str]) -> bool:
    """Joined by the store itself, which moves no bytes; False where it cannot."""
    fs, hadoop = sinks._path(spark, whole)
    if fs.getScheme() not in ("hdfs", "webhdfs", "abfs"):
        return False
    full = [p for p in parts if fs.getFileStatus(sinks._path(spark, p)[1]).getLen()]
    fs.create(hadoop, True).close()
    paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(full))
    for k, part in enumerate(full):
        paths[k] = sinks._path(spark, part)[1]
    try:
        fs.concat(hadoop, paths)
    except Py4JJavaError as error:
        if "UnsupportedOperation" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def _append(spark: SparkSession, whole: str, parts: list[str]) -> None:
    place, chunk = opener(), CHUNK

    def run(batches):
        for batch in batches:
            for paths in batch.column(0).to_pylist():
                store, target = place(whole)
                with store.open_output_stream(target, compression=None) as out:
                    for path in paths:
                        own, inner = place(path)
                        with own.open_input_stream(inner, compression=None) as source:
                            while data := source.read(chunk):
                                out.write(data)
                yield pa.RecordBatch.from_arrays([pa.array([len(paths)])], names=["parts"])

    one = spark.createDataFrame([(parts,)], "paths array<string>").coalesce(1)
    one.mapInArrow(run, "parts long").collect()
