"""Counts of keys over a whole corpus, brought back to where the keys are.

Texts are put into blocks of some megabytes.  A block asks once for each of its
distinct keys, with its own values (say, counts); requests are dealt by the
leading bits of the key, so a frequent key costs one entry per block however
often it occurs.  Each bucket of keys is sorted, neighbours that are equal are
combined, and every block gets the totals of its keys in order, so that keys
need not travel back.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import record, stage

#: Bytes of text in a block, and blocks per bucket of keys.
BLOCK, BLOCKS_PER_BUCKET = 2 << 20, 6

Asked = tuple[np.ndarray, list[np.ndarray]]


def configure(df: DataFrame) -> None:
    """Rows are large here, so few of them make a batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, first bytes first, which compresses well."""
    x = np.ascontiguousarray(x)
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes())


def unplanes(data: bytes, kind) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(plain.reshape(width, -1).T).view(kind).reshape(-1)


def blocks(rows: DataFrame, flag: str, size: int = BLOCK) -> DataFrame:
    """``block``, ``flag``, ``content`` (Arrow rows, compressed) of ``rows`` with a column ``text``, staged.

    Rows of different ``flag`` (an integer) are in different blocks.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        base, made, held = TaskContext.get().partitionId() << 32, 0, {}
        schema = pa.schema([("block", pa.int64()), ("flag", pa.int32()), ("content", pa.binary())])

        def flush(value: int) -> pa.RecordBatch:
            nonlocal made
            parts, _ = held.pop(value)
            out = io.BytesIO()
            with pa.ipc.new_stream(out, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(pa.Table.from_batches(parts).combine_chunks())
            made += 1
            return record(schema, [base + made], [value], [out.getvalue()])

        for batch in batches:
            for value in pc.unique(batch.column(flag)).to_pylist():
                own = batch.filter(pc.equal(batch.column(flag), value))
                sizes = np.cumsum(pc.fill_null(pc.binary_length(own.column("text")), 0).to_numpy(zero_copy_only=False))
                first = 0
                while first < own.num_rows:
                    parts, full = held.setdefault(value, ([], 0))
                    before = sizes[first - 1] if first else 0
                    last = max(first + 1, int(np.searchsorted(sizes, before + size - full, "right")))
                    parts.append(own.slice(first, last - first))
                    held[value] = parts, full + int(sizes[last - 1] - before)
                    first = last
                    if held[value][1] >= size or first < own.num_rows:
                        yield flush(value)
        for value in list(held):
            yield flush(value)

    configure(rows)
    return stage(rows.mapInArrow(run, "block long, flag int, content binary"), "blocks")


def rows_of(content: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(content) as reader:
        return reader.read_all().combine_chunks().to_batches()[0]


def bucket_bits(count: int) -> int:
    """Bits of the key that name its bucket, for ``count`` blocks."""
    return max(0, (max(1, count // BLOCKS_PER_BUCKET) - 1).bit_length())


REQUESTS = "bucket long, block long, keys binary, values array<binary>"
REQUEST = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("values", pa.list_(pa.binary()))])


def requests_of(block: int, asked: Asked, bits: int) -> pa.RecordBatch:
    """A row per bucket; keys are sorted and distinct, values are integers beside them."""
    keys, values = asked
    bounds = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    cuts = np.append(np.searchsorted(keys, bounds), len(keys))
    full = np.flatnonzero(np.diff(cuts))
    parts = [slice(cuts[k], cuts[k + 1]) for k in full]
    return record(
        REQUEST, full, [block] * len(full),
        [planes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts],
        [[planes(v[p].astype(np.int64)) for v in values] for p in parts],
    )


def ask(table: DataFrame, asked: Callable[[pa.RecordBatch], Asked], bits: int) -> DataFrame:
    """Requests of all blocks."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, content in zip(batch.column("block").to_pylist(), batch.column("content")):
                yield requests_of(block, asked(rows_of(content.as_buffer())), bits)

    return table.select("block", "content").mapInArrow(run, REQUESTS)


def answer(requests: DataFrame, combine: list[np.ufunc], name: str, summarize: Callable | None = None) -> DataFrame:
    """``bucket``, ``block``, ``totals``: values combined over all blocks, in the order of the block's keys; staged.

    ``combine`` has a ufunc per value (np.add, np.minimum).  ``summary`` holds, in
    one row of each bucket, the integers that ``summarize(keys, totals)`` makes of its distinct keys.
    """
    schema = pa.schema([
        ("bucket", pa.int64()), ("block", pa.int64()), ("totals", pa.list_(pa.binary())), ("summary", pa.list_(pa.int64()))
    ])

    def run(key, table):
        own = [np.cumsum(unplanes(k.as_buffer(), np.uint64), dtype=np.uint64) for k in table.column("keys")]
        cuts = np.cumsum([0, *map(len, own)])
        keys = np.concatenate(own)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        del keys, own
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        groups = np.empty(len(order), np.int32)
        groups[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(order))))
        distinct = ordered[first]
        del ordered
        totals = []
        for k, how in enumerate(combine):
            value = np.concatenate([unplanes(v[k].as_buffer(), np.int64) for v in table.column("values")])
            totals.append(how.reduceat(value[order], first))
        rows = [[planes(t[groups[a:b]]) for t in totals] for a, b in zip(cuts[:-1], cuts[1:])]
        summary = [summarize(distinct, totals) if summarize else None] + [None] * (len(rows) - 1)
        out = record(schema, table.column("bucket").combine_chunks(), table.column("block").combine_chunks(), rows, summary)
        return pa.Table.from_batches([out])

    made = "bucket long, block long, totals array<binary>, summary array<long>"
    return stage(requests.groupBy("bucket").applyInArrow(run, made), name)


def totals_of(table: pa.Table, count: int) -> list[np.ndarray]:
    """Answers to one block, put together in the order of its keys."""
    rows = sorted(zip(table.column("bucket").to_pylist(), range(table.num_rows)))
    column = table.column("totals")
    found = [[unplanes(column[i][k].as_buffer(), np.int64) for _, i in rows] for k in range(count)]
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]


def meet(table: DataFrame, answers: DataFrame, use: Callable[[int, pa.RecordBatch, pa.Table], Iterator[pa.RecordBatch]], schema: str, empty: pa.Schema) -> DataFrame:
    """Every block with its answers: ``use(block, rows, answers)`` gives the resulting rows."""

    def run(key, left, right):
        found = []
        for content in left.column("content"):
            found += use(key[0].as_py(), rows_of(content.as_buffer()), right)
        return pa.Table.from_batches(found, schema=empty)

    return (
        table.select("block", "content").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
    )


def count_blocks(table: DataFrame) -> int:
    return table.select(F.count("*")).first()[0]
