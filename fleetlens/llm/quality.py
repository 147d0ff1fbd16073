"""Quality of a text: votes of its nearest labelled texts in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import flat, pieces, record
from fleetlens.llm.words import NOT_SPACE, STEP, Words, mix

#: Hashed features, dimensions of the latent space, neighbours that vote.
FEATURES, DIMENSIONS, NEIGHBOURS = 2048, 48, 25
#: Labelled rows that the space and the votes are made of, at most.
SAMPLE = 6000

_upper = np.array([65 <= b <= 90 for b in range(256)])
_letter = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
_digit = np.array([48 <= b <= 57 for b in range(256)])


def shapes(w: Words, data: np.ndarray) -> np.ndarray:
    """What each word looks like: its case, length, marks around and inside, and whether it repeats one of the two before it."""
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.uint64)

    def inside(member: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(member[data]))
        return total[w.end] - total[w.start]

    length, upper, letters, digits = w.end - w.start, inside(_upper), inside(_letter), inside(_digit)
    mark = lambda b: np.where(_letter[b] | _digit[b], 0, b)
    case = np.where(upper == 0, 0, np.where(upper == letters, 3, np.where(_upper[data[w.start]] & (upper == 1), 1, 2)))
    again = np.zeros(n, np.int64)
    for k in (1, 2):
        again[k:] |= (w.hash[k:] == w.hash[:-k]) & (w.doc[k:] == w.doc[:-k])
    parts = [
        (case, 4), (np.minimum(length // 4, 5), 6), (np.minimum(length - letters - digits, 4), 5), (np.minimum(digits, 2), 3),
        (again, 2), (mark(data[w.start]), 256), (mark(data[w.end - 1]), 256),
    ]
    key = np.zeros(n, np.uint64)
    for values, size in parts:
        key = key * np.uint64(size) + values.astype(np.uint64)
    return key


def counts(texts: pa.Array, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hashed feature and count, by text and feature.

    Half of the features are single shapes, shapes of two words in a row, and the length of the
    text; the other half are the words themselves.  Every text has a feature, if only its length.
    """
    data, offsets = flat(texts)
    w = Words(data, offsets, NOT_SPACE)
    shape, half = shapes(w, data), np.uint64(features // 2)
    n = len(offsets) - 1
    pair = w.doc[1:] == w.doc[:-1]
    size = np.floor(np.log2(np.diff(w.first) + 1)).astype(np.uint64)
    keys = [
        mix(shape * STEP + np.uint64(1)) % half,
        mix((shape[:-1] * STEP + shape[1:]) * STEP + np.uint64(2))[pair] % half,
        mix(size * STEP + np.uint64(3)) % half,
        mix(w.hash + np.uint64(4)) % half + half,
    ]
    docs = [w.doc, w.doc[1:][pair], np.arange(n), w.doc]
    cell = np.concatenate(docs).astype(np.int64) * features + np.concatenate(keys).astype(np.int64)
    cell, times = np.unique(cell, return_counts=True)
    return cell // features, cell % features, times


@dataclass
class Model:
    """``weight`` of each feature, projection to the space, labelled vectors of length 1 and their labels."""

    weight: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def place(self, doc: np.ndarray, feature: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
        """Unit vectors of ``n`` texts from their sparse counts."""
        dense = np.zeros((n, self.project.shape[1]), np.float32)
        value = (1 + np.log(times)).astype(np.float32) * self.weight[feature]
        if len(doc):
            # Sums over each text, some thousands of entries at a time.
            first = np.searchsorted(doc, np.arange(n + 1))
            row = 0
            while row < n:
                last = max(row + 1, int(np.searchsorted(first, first[row] + 20_000, "right")) - 1)
                block = np.zeros((last - row, len(self.weight)), np.float32)
                own = slice(first[row], first[last])
                block[doc[own] - row, feature[own]] = value[own]
                dense[row:last] = block @ self.project
                row = last
        return unit(dense)

    def scores(self, texts: pa.Array, neighbours: int) -> np.ndarray:
        n = len(texts)
        if not len(self.labels):
            return np.full(n, self.share)
        vectors, out = self.place(*counts(texts, len(self.weight)), n), np.empty(n)
        k = min(neighbours, len(self.labels))
        for a in range(0, n, 512):
            cosine = vectors[a : a + 512] @ self.vectors.T
            top = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, top, 1).astype(np.float64), 0) ** 8 + 1e-9
            out[a : a + 512] = (weight * self.labels[top]).sum(1) / weight.sum(1)
        return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    features: int = FEATURES,
    dimensions: int = DIMENSIONS,
) -> Model:
    """The space and the voters, from at most ``sample`` labelled rows chosen by a hash of their id.

    Half of them are of either label as far as there are any; a text of several
    labels has their majority, ties count as 1.  Null labels and ids are left out.  Without
    any label every score is 0.5.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")).dropna()
    known = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(sizes.values())
    if not total:
        return Model(np.zeros(features, np.float32), np.zeros((features, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    few = min(sizes.get(0, 0), sample // 2)
    many = min(sizes.get(1, 0), sample - few)
    few = min(sizes.get(0, 0), sample - many)
    order = F.xxhash64("doc_id")
    chosen = known.where("label = 0").orderBy(order, "doc_id").limit(few).unionByName(
        known.where("label = 1").orderBy(order, "doc_id").limit(many)
    )
    # At most `sample` ids and labels, so these may be broadcast.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    schema = pa.schema([("doc_id", pa.string()), ("label", pa.int32()), ("feature", pa.binary()), ("times", pa.binary())])

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            doc, feature, times = counts(batch.column("text"), features)
            cut = np.searchsorted(doc, np.arange(1, batch.num_rows))
            yield record(
                schema, batch.column("doc_id"), batch.column("label"),
                [x.astype(np.int16).tobytes() for x in np.split(feature, cut)],
                [x.astype(np.int32).tobytes() for x in np.split(times, cut)],
            )

    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "label", "text")
    counted = rows.mapInArrow(count, "doc_id string, label int, feature binary, times binary")
    # Repeated rows of one id would exceed the bound: one row each.
    found = counted.groupBy("doc_id").agg(F.min("label").alias("label"), F.min(F.struct("feature", "times")).alias("x"))
    table = found.select("doc_id", "label", "x.*").toArrow().sort_by("doc_id")
    n = table.num_rows
    matrix = np.zeros((n, features), np.float32)
    for i, (feature, times) in enumerate(zip(table.column("feature"), table.column("times"))):
        at = np.frombuffer(feature.as_buffer(), np.int16)
        matrix[i, at] = 1 + np.log(np.frombuffer(times.as_buffer(), np.int32))
    weight = np.log((1 + n) / (1 + (matrix > 0).sum(0))).astype(np.float32) + 0.1
    matrix *= weight
    matrix = unit(matrix)
    project = principal(matrix, min(dimensions, n, features))
    labelled = table.column("label").to_numpy().astype(np.float64)
    return Model(weight, project, unit(matrix @ project), labelled, float(labelled.mean()) if n else 0.5)


def principal(matrix: np.ndarray, dimensions: int, seed: int = 1) -> np.ndarray:
    """Leading right singular vectors by randomized subspace iteration."""
    if not len(matrix):
        return np.zeros((matrix.shape[1], 1), np.float32)
    rng = np.random.default_rng(seed)
    basis = rng.standard_normal((matrix.shape[1], min(dimensions + 16, *matrix.shape)), np.float32)
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :dimensions].astype(np.float32)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) of every row, from whole texts.

    Null texts score as empty ones.  Repeated rows are kept.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = pa.array(shared.value.scores(batch.column("text"), neighbours), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double")
