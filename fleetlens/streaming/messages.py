"""JSON messages: publishing rows and files, receiving with a quarantine for bad ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

CORRUPT = "_corrupt_record"


def encode(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One JSON text ``value`` per row, after an optional transformation of the rows."""
    rows = df.transform(transform) if transform else df
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def publish(
    df: DataFrame, fmt: str, transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append", **options
) -> None:
    """Write the encoded rows to a topic or any other sink with a text ``value``."""
    encode(df, transform).write.format(fmt).options(**options).mode(mode).save()


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file as one message."""
    return spark.read.text(path, wholetext=True)


def _parsed(value: str, schema: T.StructType) -> Column:
    """The message, null unless the text is one object and nothing else.

    The parser stops after the first object, so the text is parsed again as the
    content of an array: an object with something after it is then broken, or one of several.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    whole = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), T.ArrayType(with_corrupt), options)
    is_object = F.startswith(F.ltrim(F.translate(F.col(value), "\n\r\t", "   ")), F.lit("{"))
    return F.when((F.size(whole) == 1) & is_object, F.from_json(F.col(value), with_corrupt, options))


def decode(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The message fields and, for a message that is no such object, its text in ``_corrupt_record``."""
    kept = [c for c in df.columns if c != value]
    return df.withColumn("__message", _parsed(value, schema)).select(
        *kept,
        *[F.col(f"__message.{f.name}").alias(f.name) for f in schema.fields],
        F.when(F.col("__message").isNull(), F.coalesce(value, F.lit("")))
        .otherwise(F.col(f"__message.{CORRUPT}"))
        .alias(CORRUPT),
    )


def message_folder(
    spark: SparkSession, folder: str, archive: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of the text lines of the files that arrive in a folder.

    With ``archive`` a consumed file is moved there once a later batch has been
    committed.
    """
    reader = spark.readStream.format("text")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def receive(
    messages: DataFrame, schema: T.StructType, table: str, checkpoint: str, value: str = "value", **trigger
) -> StreamingQuery:
    """Decode a stream of messages into a table split by ``status`` (``ok`` or ``bad``).

    Each batch replaces its own partition, named by the stream and ``batch_id``, so a batch
    that is run again after a failure leaves no copies.  The stream's identity lives in its
    checkpoint: a stream with a new checkpoint adds to the table and replaces
    nothing.  One pass writes both the good messages and the quarantined ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise ValueError("a batch without its stream")
        status = F.when(F.col(CORRUPT).isNull(), "ok").otherwise("bad")
        (
            decode(batch, schema, value)
            .withColumn("status", status)
            .write.mode("overwrite")
            .partitionBy("status")
            .parquet(f"{table}/stream_id={stream}/batch_id={batch_id}")
        )

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def received(spark: SparkSession, table: str, schema: T.StructType, status: str = "ok", *extra: T.StructField) -> DataFrame:
    """Good (``ok``) or quarantined (``bad``) messages of a table written by ``receive``."""
    names = {"stream_id": T.StringType(), "batch_id": T.LongType(), "status": T.StringType()}
    partitions = [T.StructField(n, t) for n, t in names.items()]
    full = T.StructType([*extra, *schema.fields, T.StructField(CORRUPT, T.StringType()), *partitions])
    rows = spark.read.schema(full).parquet(table).where(F.col("status") == status).drop(*names)
    return rows.drop(CORRUPT) if status == "ok" else rows
