"""Messages whose handling failed, tried again with later batches and given up after some attempts.

A handler takes a table of messages and says of each whether it is done.  Messages that are not
wait in a table beside the stream and join its next batch; after ``attempts`` tries they are
dead letters.  What waits after a batch is written once, under the batch's number, and read by
the next, so a batch that is run again finds what it found before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.session import stage
from fleetlens.sinks import files as sinks

#: Messages ``(value, attempts)`` to the same rows and columns with ``ok`` (null counts as not done) and any others.
Handler = Callable[[DataFrame], DataFrame]

WAITING = "value string, attempts int"


def _pass_name(batch_id: int, again: int = 0) -> str:
    return f"pass={batch_id:019d}.{again:06d}"


def _passes(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in sinks.children(spark, folder) if n.startswith("pass=")] if sinks.exists(spark, folder) else []


def waiting(spark: SparkSession, state: str, stream: str, before: str | None = None) -> DataFrame:
    """Messages that wait after the last pass, or after the last one before a pass; ``attempts`` counts the tries so far."""
    done = [n for n in _passes(spark, f"{state}/{stream}") if before is None or n < before]
    if not done:
        return spark.createDataFrame([], WAITING)
    return spark.read.schema(WAITING).parquet(f"{state}/{stream}/{max(done)}")


def _try(due: DataFrame, handle: Handler, attempts: int, table: str, state: str, stream: str, name: str) -> None:
    """One pass: handled messages and dead letters go to ``table``, the others wait."""
    tried = stage(handle(due.withColumn("attempts", F.col("attempts") + 1)), "tried")
    ok = F.coalesce("ok", F.lit(False))
    status = F.when(ok, "ok").when(F.col("attempts") >= attempts, "dead").otherwise("waiting")
    tried = tried.withColumn("status", status).drop("ok")
    done = tried.where("status <> 'waiting'")
    done.write.mode("overwrite").partitionBy("status").parquet(f"{table}/stream_id={stream}/{name}")
    spark, growing = due.sparkSession, f"{state}/{stream}/_growing_{name}"
    tried.where("status = 'waiting'").select("value", "attempts").write.mode("overwrite").parquet(growing)
    sinks.delete(spark, f"{state}/{stream}/{name}")
    sinks.rename(spark, growing, f"{state}/{stream}/{name}")
    for old in _passes(spark, f"{state}/{stream}")[:-2]:  # the pass before may be needed once more
        sinks.delete(spark, f"{state}/{stream}/{old}")


def receive_with_retries(
    messages: DataFrame, handle: Handler, table: str, state: str, checkpoint: str, attempts: int = 3, **trigger
) -> StreamingQuery:
    """Handles a stream of messages (``value``) batch by batch, with those that wait from before.

    ``table`` gets the handler's rows with ``status`` ``ok`` or ``dead``, in a folder per stream and pass that a
    repeated batch replaces; ``state`` holds what waits.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream, name = spark.sparkContext.getLocalProperty("sql.streaming.queryId"), _pass_name(batch_id)
        if not stream:
            raise ValueError("a batch without its stream")
        new = batch.select(F.col("value").cast("string").alias("value"), F.lit(0).alias("attempts"))
        _try(new.unionByName(waiting(spark, state, stream, name)), handle, attempts, table, state, stream, name)

    query = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def redeliver(spark: SparkSession, handle: Handler, table: str, state: str, stream: str, attempts: int = 3) -> int:
    """Tries the waiting messages of a stream that is not running once more, without new ones; returns how many wait then."""
    last = max(_passes(spark, f"{state}/{stream}"), default=_pass_name(0))
    batch, again = last.removeprefix("pass=").split(".")
    _try(waiting(spark, state, stream), handle, attempts, table, state, stream, _pass_name(int(batch), int(again) + 1))
    return waiting(spark, state, stream).count()


def handled(spark: SparkSession, table: str, schema: str, status: str = "ok") -> DataFrame:
    """Rows of ``table`` of one status: ``schema`` has the handler's columns, ``value`` and ``attempts`` among them."""
    rows = spark.read.schema(f"{schema}, stream_id string, pass string, status string").parquet(table)
    return rows.where(F.col("status") == status).drop("stream_id", "pass", "status")
