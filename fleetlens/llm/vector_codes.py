"""Vectors as short codes: each part named by the nearest entry of its codebook.

The nearest entry is found in a GNAT over the entries: a node's split points
store the least and greatest distance to the entries of every child, and a child
that no entry as near as the nearest so far can be in is left out whole.
All distances are integers; ties go to the lower entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import few, record, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node; a node with at most twice as many entries is a leaf.
SPLITS = 12
#: Vectors that are assigned together.
TOGETHER = 4096
#: Distances between integers are rounded by less than this share; ranges are widened by it.
SLACK = 1e-9


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, in 64-bit integers."""
    found = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        apart = points[:, k, None] - entries[None, :, k]
        found += apart * apart
    return found


class Gnat:
    """Nearest entry of a codebook, exactly; equally near ones by the lower index."""

    def __init__(self, entries: np.ndarray, index: np.ndarray | None = None):
        self.entries, self.children = entries, []
        self.index = np.arange(len(entries)) if index is None else index
        if len(entries) <= 2 * SPLITS:
            return
        apart, chosen = squares(entries, entries[:1])[:, 0], [0]
        while len(chosen) < SPLITS and apart.max() > 0:  # far from each other
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, squares(entries, entries[chosen[-1:]])[:, 0])
        if len(chosen) < 2:  # all entries are equal
            return
        apart = squares(entries, entries[chosen])
        owner = apart.argmin(1)
        owner[chosen] = -1
        self.splits = np.array(chosen)
        distance = np.sqrt(apart.astype(np.float64))
        self.low, self.high = np.full((len(chosen),) * 2, np.inf), np.full((len(chosen),) * 2, -np.inf)
        for c in range(len(chosen)):  # range of distances from each split point to the entries of child c
            own = np.flatnonzero(owner == c)
            if len(own):
                self.low[:, c], self.high[:, c] = distance[own].min(0), distance[own].max(0)
                self.children.append((c, Gnat(entries[own], self.index[own])))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every point."""
        best = np.full(len(points), np.iinfo(np.int64).max), np.full(len(points), np.iinfo(np.int64).max)
        self.search(points, np.arange(len(points)), *best)
        return best[1], best[0]

    def search(self, points: np.ndarray, rows: np.ndarray, least: np.ndarray, which: np.ndarray) -> None:
        """Looks for entries nearer than ``least`` (or as near and lower than ``which``) to the points ``rows``."""
        splits = self.splits if self.children else slice(None)
        entries, index = self.entries[splits], self.index[splits]
        found = squares(points[rows], entries)
        near = found.min(1)
        lowest = np.where(found == near[:, None], index, np.iinfo(np.int64).max).min(1)
        better = (near < least[rows]) | ((near == least[rows]) & (lowest < which[rows]))
        least[rows[better]], which[rows[better]] = near[better], lowest[better]
        if not self.children:
            return
        distance = np.sqrt(found.astype(np.float64))
        for c, child in self.children:
            # An entry of the child is at least this far, by the triangle inequality on every split point.
            bound = np.maximum(distance - self.high[:, c], self.low[:, c] - distance).max(1)
            slack = SLACK * (distance.max(1) + self.high[:, c].max())
            keep = bound - slack <= np.sqrt(least[rows].astype(np.float64))
            if keep.any():
                child.search(points, rows[keep], least, which)


def limit_of(width: int) -> int:
    """Components stay below this (a power of two), so that all sums of squares are exact in 64 bits."""
    return 1 << (58 - max(1, width).bit_length()) // 2


def integers(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``vec_id``, ``label``, ``n`` (components), ``ints`` (32-bit) of vectors that can be coded, staged."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    types = rows.limit(0).toArrow().schema
    schema = pa.schema([types.field("vec_id"), types.field("label"), ("n", pa.int32()), ("ints", pa.binary())])
    finite = "vector is not null and size(vector) > 0 and size(vector) % 4 = 0"
    finite += " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            n = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            whole = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            most = np.repeat([limit_of(int(x) // PARTS) for x in n], n)
            whole = np.clip(whole, -most, most).astype(np.int32)
            ends = np.cumsum(n)
            cells = [whole[a:b].tobytes() for a, b in zip(ends - n, ends)]
            yield record(schema, batch.column("vec_id"), batch.column("label"), n, cells)

    columns = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    made = rows.where(finite).mapInArrow(run, f"{columns}, n int, ints binary")
    return stage(made, "vector-ints", compression="zstd")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Vectors by components."""
    cells = b"".join(x.as_py() for x in batch.column("ints"))
    return np.frombuffer(cells, np.int32).reshape(batch.num_rows, -1).astype(np.int64)


def assigned(batches, shared) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches with their components, and of every part the nearest entry and its squared distance."""
    books = shared.value
    trees = [Gnat(b) for b in books]
    width = books[0].shape[1]
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            rows = batch.slice(start, TOGETHER)
            values = matrix(rows)
            found = [tree.nearest(values[:, k * width : (k + 1) * width]) for k, tree in enumerate(trees)]
            yield rows, values, np.stack([x for x, _ in found], 1), np.stack([x for _, x in found], 1)


def moved(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Entries at the floor of the mean of their parts; unused ones stay.

    A task adds up its own parts; sums of components and counts are all that is moved.
    """
    shared, (count, width) = rows.sparkSession.sparkContext.broadcast(books), books[0].shape
    schema = pa.schema([("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((PARTS * count, width), np.int64), np.zeros(PARTS * count, np.int64)
        for _, values, entry, _ in assigned(batches, shared):
            for k in range(PARTS):
                at = entry[:, k] + k * count
                np.add.at(sums, at, values[:, k * width : (k + 1) * width])
                n += np.bincount(at, minlength=len(n))
        used = np.flatnonzero(n)
        yield record(schema, used.astype(np.int32), n[used], sums[used].tolist())

    made = rows.select("ints").mapInArrow(run, "entry int, n long, sums array<long>")
    whole = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    total = made.groupBy("entry").agg(F.sum("n").alias("n"), *whole).toArrow()  # entries, whatever the input
    books = [b.copy() for b in books]
    for row in total.to_pylist():
        books[row["entry"] // count][row["entry"] % count] = [int(row[f"s{k}"]) // row["n"] for k in range(width)]
    return books


def codebooks(rows: DataFrame) -> list[np.ndarray]:
    """Fitted entries of every part; the first are the parts of the rows of the smallest ids."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES).select("ints").toArrow()
    start = np.concatenate([matrix(b) for b in first.to_batches() if b.num_rows])
    books = [np.ascontiguousarray(b) for b in np.split(start, PARTS, axis=1)]
    for _ in range(ROUNDS):
        books = moved(rows, books)
    return books


def codes(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id``, ``label``, ``code`` (an entry per part), ``error`` of every row that can be coded, and the codebooks.

    Vectors that are null, or hold null or non-finite components, are left out; so are those
    that four equal parts cannot be cut from, and those of another length than the vector of the smallest id
    has (nulls last, then by components).  Components beyond a bound of at least 2**18 are put at it: no sum overflows then.
    Repeated rows are coded one by one.  Without vectors there are no codes and no codebooks.
    """
    rows = integers(vectors, vec_id, vector, label)
    lead = rows.orderBy(F.col("vec_id").asc_nulls_last(), "n", "ints").select("n").first()
    kind = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    columns = f"{kind}, code array<int>, error long"
    if lead is None:
        return rows.sparkSession.createDataFrame([], columns), []
    rows = rows.where(F.col("n") == lead.n)
    books = codebooks(rows)
    shared, types = rows.sparkSession.sparkContext.broadcast(books), rows.limit(0).toArrow().schema
    schema = pa.schema([types.field("vec_id"), types.field("label"), ("code", pa.list_(pa.int32())), ("error", pa.int64())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch, _, entry, error in assigned(batches, shared):
            yield record(schema, batch.column("vec_id"), batch.column("label"), entry.tolist(), error.sum(1))

    return rows.select("vec_id", "label", "ints").mapInArrow(run, columns), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``label``, ``label_error``: errors added up by label, those without label together."""
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    return sums.withColumn("label_error", F.expr("try_cast(label_error as long)"))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Rows of ``codes`` with the errors of their label; few labels are broadcast, many are joined."""
    coded = stage(coded, "codes")
    sums = label_errors(coded).withColumnRenamed("label", "__label")
    sums = few(stage(sums, "label-errors"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label")), "left").drop("__label")
