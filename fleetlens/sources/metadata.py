"""What names and Parquet footers tell, looked up by tasks: listings, days of a table, files that cannot be read.

Folders and files are rows.  Tasks list them and open footers (``pyarrow.fs`` has to know the
store), so neither names nor statistics pass the driver, and row groups
are read only where their statistics leave a question open.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import stage

#: Names in a batch of a listing.
NAMES = 10_000


def opener() -> Callable:
    """Store and path of an address, by value, as tasks need not have this package."""

    def place(address: str):
        address = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "/", address))
        return fs.FileSystem.from_uri(address)

    return place


def _spread(rows: DataFrame) -> DataFrame:
    """One folder or file may be slow, so each may get a task of its own."""
    return rows.repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism))


def list_folders(folders: DataFrame, on_error: str = "raise") -> DataFrame:
    """``name, entry, path, is_folder``: the direct children of every folder of ``folders`` (``name``, ``folder``).

    A folder that is not there gives no row; one that cannot be listed is an error unless
    ``on_error`` is ``"skip"``.  No folder is descended into.
    """
    place = opener()
    schema = pa.schema([("name", pa.string()), ("entry", pa.string()), ("path", pa.string()), ("is_folder", pa.bool_())])

    def run(batches):
        for batch in batches:
            for name, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if folder is None:
                    continue
                try:
                    store, path = place(folder)
                    found = store.get_file_info(fs.FileSelector(path, allow_not_found=False))
                except FileNotFoundError:
                    continue
                except OSError:
                    if on_error != "skip":
                        raise
                    continue
                for k in range(0, len(found), NAMES):
                    part = found[k : k + NAMES]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "name": [name] * len(part),
                            "entry": [f.base_name for f in part],
                            "path": [f"{folder.rstrip('/')}/{f.base_name}" for f in part],
                            "is_folder": [f.type == fs.FileType.Directory for f in part],
                        },
                        schema=schema,
                    )

    rows = _spread(folders.select(F.col("name").cast("string"), F.col("folder").cast("string")))
    return rows.mapInArrow(run, "name string, entry string, path string, is_folder boolean")


def folders_of(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """``name, folder`` rows of a mapping."""
    return spark.createDataFrame(list(folders.items()), "name string, folder string")


def data_files(folders: DataFrame) -> DataFrame:
    """``name, path`` of the data files below the folders, level by level; hidden names and their contents do not count.

    Each level is written to the shared folder.
    """
    found, level = None, folders.select("name", "folder")
    while True:
        listed = list_folders(level).where(~F.col("entry").rlike("^[._]"))
        listed = stage(listed.select("name", "path", "is_folder"), "listing")
        files = listed.where(~F.col("is_folder")).select("name", "path")
        found = files if found is None else found.unionByName(files)
        level = listed.where("is_folder").select("name", F.col("path").alias("folder"))
        if level.isEmpty():
            return found


def folder_days(folders: DataFrame, column: str = "date", fmt: str = "yyyyMMdd") -> DataFrame:
    """``name, observed_date`` from the partition folders ``column=value`` of tables, whether or not they hold rows."""
    names = list_folders(folders).where(F.col("is_folder") & F.col("entry").startswith(f"{column}="))
    value = F.try_to_date(F.substring_index("entry", "=", -1), fmt)
    return names.select("name", value.alias("observed_date")).where("observed_date is not null").distinct()


def row_groups(files: DataFrame, column: str, time_zone: str = "UTC") -> DataFrame:
    """``name, path, row_group, n_rows, n_null, low, high``: each row group, and its first and last day of ``column``.

    From footers alone.  ``low`` and ``high`` are null where there are no statistics, and for types whose
    smallest value need not be on the first day (text, say) or that have none (96-bit timestamps).  Instants are dated in ``time_zone``.
    """
    place = opener()
    schema = pa.schema([
        ("name", pa.string()), ("path", pa.string()), ("row_group", pa.int32()), ("n_rows", pa.int64()),
        ("n_null", pa.int64()), ("low", pa.date32()), ("high", pa.date32()),
    ])

    def day(value, kind):
        if pa.types.is_date(kind):
            return value
        scalar = pa.scalar(value, kind)
        if kind.tz:
            scalar = pc.local_timestamp(scalar.cast(pa.timestamp(kind.unit, time_zone)))
        return scalar.cast(pa.date32(), safe=False).as_py()

    def run(batches):
        for batch in batches:
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, inner = place(path)
                with store.open_input_file(inner) as source:
                    file = pq.ParquetFile(source)
                    kind, at = file.schema_arrow.field(column).type, file.schema.names.index(column)
                    rows = []
                    for k in range(file.metadata.num_row_groups):
                        group = file.metadata.row_group(k)
                        stats = group.column(at).statistics
                        dated = pa.types.is_date(kind) or pa.types.is_timestamp(kind)
                        known = stats is not None and stats.has_min_max and dated
                        nulls = stats.null_count if stats is not None and stats.has_null_count else None
                        low, high = (day(stats.min, kind), day(stats.max, kind)) if known else (None, None)
                        rows.append((name, path, k, group.num_rows, nulls, low, high))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    fields = "name string, path string, row_group int, n_rows long, n_null long, low date, high date"
    return _spread(files.select("name", "path")).mapInArrow(run, fields)


def read_days(groups: DataFrame, column: str, time_zone: str = "UTC") -> DataFrame:
    """``name, day, n``: rows per day of the given row groups, of which only ``column`` is read."""
    place = opener()
    schema = pa.schema([("name", pa.string()), ("day", pa.date32()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for name, path, group in zip(*(batch.column(k).to_pylist() for k in range(3))):
                store, inner = place(path)
                with store.open_input_file(inner) as source:
                    file = pq.ParquetFile(source)
                    values = file.read_row_group(group, columns=[column]).column(0)
                    if file.schema.column(file.schema.names.index(column)).physical_type == "INT96":  # an instant
                        values = pc.assume_timezone(values, "UTC")
                if pa.types.is_timestamp(values.type) and values.type.tz:
                    values = pc.local_timestamp(values.cast(pa.timestamp(values.type.unit, time_zone)))
                if pa.types.is_string(values.type):
                    values = pc.utf8_slice_codeunits(values, 0, 10)
                counts = pc.value_counts(pc.drop_null(values.cast(pa.date32(), safe=False)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(counts), pa.string()), counts.field(0).cast(pa.date32()), counts.field(1)], schema=schema
                )

    rows = _spread(groups.select("name", "path", "row_group"))
    return rows.mapInArrow(run, "name string, day date, n long").groupBy("name", "day").agg(F.sum("n").alias("n"))


def open_groups(groups: DataFrame, n: int) -> DataFrame:
    """The row groups that may hold one of the ``n`` newest days of their table without its being the first or last day of any.

    A group's first and last day are days of the table.  Only a group that reaches beyond the n-th newest of
    those, and has days between its own two, can hold others; so can one without statistics.
    """
    days = groups.select("name", F.explode(F.array("low", "high")).alias("day")).where("day is not null").distinct()
    newest = days.groupBy("name").agg(F.slice(F.sort_array(F.collect_set("day"), asc=False), 1, n).alias("days"))
    bound = newest.select("name", F.when(F.size("days") == n, F.try_element_at("days", F.lit(n))).alias("bound"))
    inside = (F.datediff("high", "low") > 1) & (F.col("bound").isNull() | (F.col("high") > F.col("bound")))
    known = groups.join(bound, "name", "left")
    return known.where(((F.col("low").isNull()) & (F.coalesce("n_null", F.lit(-1)) < F.col("n_rows"))) | inside).drop("bound")


def newest_days(files: DataFrame, column: str, n: int, time_zone: str = "UTC") -> DataFrame:
    """``name, observed_date``: the ``n`` newest days of every table, from footers where they suffice.

    The newest day (``n`` = 1) is the last one of some row group, so nothing is read for it where there are statistics.
    """
    groups = stage(row_groups(files, column, time_zone), "row-groups")
    days = groups.select("name", F.explode(F.array("low", "high")).alias("day")).where("day is not null")
    days = days.unionByName(read_days(open_groups(groups, n), column, time_zone).select("name", "day")).distinct()
    newest = days.groupBy("name").agg(F.sort_array(F.collect_set("day"), asc=False).alias("days"))
    return newest.select("name", F.explode(F.slice("days", 1, n)).alias("observed_date"))


def newest_day_rows(files: DataFrame, column: str, time_zone: str = "UTC") -> DataFrame:
    """``name, day, row_count`` of the newest day of every table; a row group that holds nothing else is not read."""
    groups = stage(row_groups(files, column, time_zone), "row-groups")
    open_ = groups.where("low is null")
    loose = stage(read_days(open_, column, time_zone), "days")
    last = groups.select("name", F.col("high").alias("day")).unionByName(loose.select("name", "day"))
    last = last.groupBy("name").agg(F.max("day").alias("day"))
    on = groups.join(last, "name").where(F.col("high") == F.col("day"))
    whole = (F.col("low") == F.col("high")) & F.col("n_null").isNotNull()
    counted = on.where(whole).select("name", "day", (F.col("n_rows") - F.col("n_null")).alias("n"))
    mixed = read_days(on.where(~whole), column, time_zone).join(last, ["name", "day"])
    parts = counted.unionByName(mixed).unionByName(loose.join(last, ["name", "day"]))
    return parts.groupBy("name", "day").agg(F.sum("n").alias("row_count")).where("day is not null")


def unreadable(files: DataFrame) -> DataFrame:
    """``name, path, reason`` of the files whose footer cannot be read."""
    place = opener()
    schema = pa.schema([("name", pa.string()), ("path", pa.string()), ("reason", pa.string())])

    def run(batches):
        for batch in batches:
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    store, inner = place(path)
                    with store.open_input_file(inner) as source:
                        pq.ParquetFile(source)
                except (OSError, pa.ArrowException) as error:
                    reason = str(error).splitlines()[0]
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (name, path, reason)], schema=schema)

    return _spread(files.select("name", "path")).mapInArrow(run, "name string, path string, reason string")


def read_sound(spark: SparkSession, folders: DataFrame, schema) -> tuple[DataFrame, DataFrame]:
    """Rows of all Parquet files below the folders that can be read, in one scan, and the others with their reason.

    Folders that are not there count for nothing.
    """
    files = data_files(folders)
    bad = stage(unreadable(files), "unreadable")
    there = [r["folder"] for r in folders.join(files.select("name").distinct(), "name", "left_semi").select("folder").collect()]
    if not there:
        return spark.createDataFrame([], schema), bad
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true" if not bad.isEmpty() else "false")
    return reader.parquet(*there), bad
