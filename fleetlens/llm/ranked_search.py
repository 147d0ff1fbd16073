"""The highest-scoring documents of many queries: impact vectors in buckets of equal length.

A document is a vector of integer impacts over the queries' terms, a query a
vector of term weights times repeats.  Documents are ordered by the length of
their vectors and cut into buckets.  A query skips a bucket whose longest vector cannot reach
the score it already has ten times (Cauchy-Schwarz); in the others its heaviest
coordinates are multiplied out and the rest is bounded by lengths; what is left
is scored exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import flat, pieces, record, stage
from fleetlens.llm.words import ALPHANUMERIC, Words

#: Cells (terms x queries) of one pass over the documents; further queries make further passes.
CELLS = 1 << 22
#: Documents in a bucket, heaviest coordinates of a query, and longest vectors that give the first bounds.
BUCKET, FOCUS, FIRST = 256, 6, 4096
#: Entries that are scored together.
ENTRIES = 1 << 20
#: Bounds are computed in doubles and raised by this share, which is beyond their rounding.
SLACK = 1 + 1e-9


def terms_of(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item``, ``terms`` (distinct hashes), ``times``, ``n`` for every item with terms, staged.  Repeated rows stay."""
    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    schema = pa.schema([
        rows.select("item").limit(0).toArrow().schema.field(0), ("terms", pa.binary()), ("times", pa.binary()), ("n", pa.int64())
    ])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            w = Words(*flat(batch.column("text")), ALPHANUMERIC)
            found = [np.unique(w.hash[a:b], return_counts=True) for a, b in zip(w.first[:-1], w.first[1:])]
            yield record(
                schema, batch.column("item"), [k.tobytes() for k, _ in found], [n.tobytes() for _, n in found], [len(k) for k, _ in found]
            )

    kind = rows.schema["item"].dataType.simpleString()
    return stage(rows.mapInArrow(run, f"item {kind}, terms binary, times binary, n long").where("n > 0"), "items")


def query_blocks(items: DataFrame) -> Iterator[list]:
    """Rows of ``terms_of``, some at a time, so that a block's terms times its queries stay below ``CELLS``."""
    block, terms = [], 0
    for row in items.toLocalIterator(prefetchPartitions=False):
        if block and (terms + row.n) * (len(block) + 1) > CELLS:
            yield block
            block, terms = [], 0
        block.append(row)
        terms += row.n
    if block:
        yield block


class Queries:
    """A block of queries as a matrix of weights, terms by queries, and the documents' statistics."""

    def __init__(self, rows: list):
        hashes = [np.frombuffer(r.terms, np.uint64) for r in rows]
        times = [np.frombuffer(r.times, np.int64) for r in rows]
        self.terms = np.unique(np.concatenate(hashes))
        self.repeats = np.zeros((len(self.terms), len(rows)), np.int64)
        for k, (h, n) in enumerate(zip(hashes, times)):
            self.repeats[np.searchsorted(self.terms, h), k] = n

    def weigh(self, documents: int, words: int, held: np.ndarray) -> None:
        """``held``: documents that hold each term.  Document and query each get the root of a term's weight for the bounds."""
        self.documents, self.words = documents, words
        weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)
        self.weights = self.repeats * weight[:, None]
        self.root = np.sqrt(weight.astype(np.float64))
        self.vectors = self.repeats * self.root[:, None]
        self.length = np.sqrt((self.vectors**2).sum(0))
        focus = np.argsort(-self.vectors, axis=0, kind="stable")[:FOCUS]
        self.heavy = np.zeros(self.vectors.shape, bool)
        np.put_along_axis(self.heavy, focus, True, 0)
        self.heavy &= self.vectors > 0
        self.rest = np.sqrt(np.where(self.heavy, 0, self.vectors**2).sum(0))

    def impacts(self, n: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Impact of a term that occurs ``times`` in a document of ``n`` terms."""
        m = 100 - 75 + (75 * n * self.documents) // max(1, self.words)
        return (1_000_000_000 * times) // (1000 * times + 8 * m)


def counted(texts, terms: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Number of terms of each text; which of ``terms`` it holds, and how often."""
    w = Words(*flat(texts), ALPHANUMERIC)
    place = np.minimum(np.searchsorted(terms, w.hash), len(terms) - 1)
    known = np.flatnonzero(terms[place] == w.hash)
    pair, times = np.unique(w.doc[known].astype(np.int64) * len(terms) + place[known], return_counts=True)
    cuts = np.searchsorted(pair, np.arange(1, len(w.first) - 1) * len(terms))
    return np.diff(w.first), np.split((pair % len(terms)).astype(np.int32), cuts), np.split(times.astype(np.int32), cuts)


def vectors(docs: DataFrame, terms: np.ndarray, doc_type: pa.Field, kind: str) -> DataFrame:
    """``doc``, ``n``, ``terms``, ``times`` of documents that hold a term of the block, and a row of statistics per task.

    Staged, as every step after it reads these and no text.
    """
    schema = pa.schema([
        doc_type, ("n", pa.int64()), ("terms", pa.binary()), ("times", pa.binary()), ("documents", pa.int64()), ("held", pa.binary())
    ])
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches) -> Iterator[pa.RecordBatch]:
        own, documents, words, held = shared.value, 0, 0, np.zeros(len(shared.value), np.int64)
        for batch in pieces(batches, "text"):
            n, at, times = counted(batch.column("text"), own)
            documents, words = documents + int((n > 0).sum()), words + int(n.sum())
            held += np.bincount(np.concatenate([*at, np.zeros(0, np.int32)]), minlength=len(own))
            some = [i for i, x in enumerate(at) if len(x)]
            none = [None] * len(some)
            yield record(
                schema, batch.column("doc").take(pa.array(some, pa.int64())), n[some], [at[i].tobytes() for i in some],
                [times[i].tobytes() for i in some], none, none,
            )
        yield record(schema, [None], [words], [None], [None], [documents], [held.tobytes()])

    made = docs.mapInArrow(run, f"doc {kind}, n long, terms binary, times binary, documents long, held binary")
    return stage(made, "vectors", compression="zstd")


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and documents that hold each term of the block."""

    def unfold(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for held in batch.column("held"):
                total += np.frombuffer(held.as_buffer(), np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "held"])

    rows = found.where("held is not null")
    whole = rows.agg(F.sum("documents"), F.sum("n")).first()
    held = np.zeros(size, np.int64)
    sums = rows.select("held").mapInArrow(unfold, "term long, held long").groupBy("term").agg(F.sum("held").alias("held")).toArrow()
    held[sums.column("term").to_numpy()] = sums.column("held").to_numpy()
    return whole[0] or 0, whole[1] or 0, held


class Bucket:
    """Documents of similar length, as rows of one sparse matrix."""

    def __init__(self, batch: pa.RecordBatch, queries: Queries):
        at = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column("terms")]
        times = [np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in batch.column("times")]
        self.size = np.array([len(x) for x in at])
        self.first = np.cumsum(self.size) - self.size
        self.term = np.concatenate(at)
        self.row = np.repeat(np.arange(len(at)), self.size)
        n = batch.column("n").to_numpy()
        self.impact = queries.impacts(n[self.row], np.concatenate(times))
        self.value = self.impact * queries.root[self.term]
        self.square = np.add.reduceat(self.value**2, self.first)

    def survivors(self, queries: Queries, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and queries whose score may reach ``least`` (and is above 0, as far as bounds tell)."""
        alive = np.flatnonzero(queries.length * np.sqrt(self.square.max()) * SLACK >= least)
        if not len(alive):
            return alive, alive
        focus = np.flatnonzero(queries.heavy[:, alive].any(1))
        column = np.full(len(queries.terms), -1)
        column[focus] = np.arange(len(focus))
        inside = column[self.term] >= 0
        dense = np.zeros((len(self.size), len(focus)))
        dense[self.row[inside], column[self.term[inside]]] = self.value[inside]
        heavy = queries.heavy[np.ix_(focus, alive)]
        exact = dense @ np.where(heavy, queries.vectors[np.ix_(focus, alive)], 0)
        left = self.square[:, None] * SLACK - (dense**2) @ heavy
        bound = (exact + np.sqrt(np.maximum(left, 0)) * queries.rest[alive]) * SLACK
        row, query = np.nonzero((bound >= least[alive]) & (bound > 0))
        return row, alive[query]

    def scores(self, queries: Queries, row: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of the pairs, in 64-bit integers."""
        found, ends, at = [], np.cumsum(self.size[row]), 0
        while at < len(row):
            last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, "right")))
            size = self.size[row[at:last]]
            start = np.cumsum(size) - size
            entry = np.repeat(self.first[row[at:last]] - start, size) + np.arange(size.sum())
            product = self.impact[entry] * queries.weights[self.term[entry], np.repeat(query[at:last], size)]
            found.append(np.add.reduceat(product, start))
            at = last
        return np.concatenate([*found, np.zeros(0, np.int64)])


def best(table: pa.Table, top: int) -> pa.Table:
    """The ``top`` rows of each query: highest scores, then smallest documents (nulls last)."""
    table = table.sort_by([("query", "ascending"), ("score", "descending"), ("doc", "ascending")])
    query = table.column("query").to_numpy()
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return table.filter(pa.array(rank < top))


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = 10,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` rows of ``docs`` for every row of ``items``.

    Terms are runs of ASCII letters, digits and all other than ASCII characters, A-Z
    lowered, known by 64-bit hashes.  A term held by df of the N documents that have terms
    weighs floor(1000 ln((2N + 2) / (2df + 1))); its impact where it occurs tf times is 10**9 tf div (1000 tf + 8 m),
    m being 25 + 75 n N div L for a document of n terms and L in all.  A score sums weight times impact over
    the item's terms, repeats included.  Only scores above 0 count, equal ones go by ascending ``doc_id``
    (nulls last).  Repeated rows are ranked one by one.  Null and empty texts have no terms; items without any, and empty tables, give no rows.

    Queries are broadcast in blocks of a bounded matrix, one pass over the texts each.
    """
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    doc_type, kind = rows.select("doc").limit(0).toArrow().schema.field(0), rows.schema["doc"].dataType.simpleString()
    asked = terms_of(items, item_id, item_text)
    results = [ranked(rows, block, doc_type, kind, top, asked.schema["item"]) for block in query_blocks(asked)]
    if not results:
        item = asked.schema["item"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {item}, rank int, doc_id {kind}, score long")
    found = results[0]
    for further in results[1:]:
        found = found.unionByName(further)
    return found


def ranked(rows: DataFrame, block: list, doc_type: pa.Field, kind: str, top: int, item_field) -> DataFrame:
    """One block of queries against all rows."""
    spark, queries = rows.sparkSession, Queries(block)
    found = vectors(rows, queries.terms, doc_type, kind)
    queries.weigh(*statistics(found, len(queries.terms)))
    shared = spark.sparkContext.broadcast(queries)
    vector = pa.schema([doc_type, ("n", pa.int64()), ("terms", pa.binary()), ("times", pa.binary()), ("length", pa.float64())])

    def measure(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                length = np.sqrt(Bucket(batch, shared.value).square)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length)], schema=vector)

    columns = f"doc {kind}, n long, terms binary, times binary"
    measured = found.where("held is null").select("doc", "n", "terms", "times").mapInArrow(measure, f"{columns}, length double")
    out = pa.schema([("query", pa.int32()), doc_type, ("score", pa.int64())])

    def scan(least: np.ndarray):
        def run(batches) -> Iterator[pa.RecordBatch]:
            own, bound, held = shared.value, least.astype(np.float64), out.empty_table()
            for batch in batches:
                for start in range(0, batch.num_rows, BUCKET):
                    bucket = batch.slice(start, BUCKET)
                    b = Bucket(bucket, own)
                    row, query = b.survivors(own, bound)
                    score = b.scores(own, row, query)
                    good = np.flatnonzero(score >= np.maximum(bound[query], 1))
                    if len(good):
                        new = record(out, query[good], bucket.column("doc").take(pa.array(row[good])), score[good])
                        held = best(pa.concat_tables([held, pa.Table.from_batches([new])]), top)
                        number, scores = held.column("query").to_numpy(), held.column("score").to_numpy()
                        full = np.flatnonzero(np.arange(len(number)) - np.searchsorted(number, number) == top - 1)
                        bound[number[full]] = np.maximum(bound[number[full]], scores[full])
            yield from held.combine_chunks().to_batches()

        return run

    result = f"query int, doc {kind}, score long"
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())

    def leading(scored: DataFrame) -> DataFrame:
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # Some thousand longest vectors, where they lie, give every query a score that its tenth best has at least.
    shortest = measured.select("length").orderBy(F.desc("length")).limit(FIRST).agg(F.min("length")).first()[0]
    longest = measured.where(F.col("length") >= F.lit(shortest)).drop("length")
    tenth = leading(longest.mapInArrow(scan(np.zeros(len(block))), result)).where(F.col("rank") == top)
    least = np.zeros(len(block), np.int64)
    for row in tenth.select("query", "score").collect():
        least[row.query] = row.score
    # Equal lengths (of copies, say) may lie in several ranges.
    by_length = [F.desc("length"), F.xxhash64("doc", F.monotonically_increasing_id())]
    ordered = measured.repartitionByRange(*by_length).sortWithinPartitions(F.desc("length")).drop("length")
    scored = leading(ordered.mapInArrow(scan(least), result))
    names = spark.createDataFrame(
        [(k, r.item) for k, r in enumerate(block)], f"query int, item {item_field.dataType.simpleString()}"
    )
    return scored.join(F.broadcast(names), "query").select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"
    )
