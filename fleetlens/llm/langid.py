"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import pieces, record
from fleetlens.llm.words import STEP

UNKNOWN = "und"


def grams(texts: list[str], orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and where each text's begin.

    Texts are lowered and set apart by spaces, so that an n-gram never joins two
    of them.  There is one run of buckets per order; both results hold one array per order.
    """
    pad = " " * max(orders)
    lowered = [pad + t.lower() for t in texts]
    codes = np.frombuffer(("".join(lowered) + pad).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum([0, *map(len, lowered)])
    total, found = len(codes) - max(orders), []
    for n in orders:
        key = np.zeros(total, np.uint64)
        for k in range(n):
            key = (key + codes[k : k + total] + np.uint64(1)) * STEP
        found.append(((key + np.uint64(n)) * STEP >> np.uint64(64 - bits)).astype(np.int32))
    return found, starts


class Model:
    """``langs`` in order, and log-probabilities by bucket (rows) and language."""

    def __init__(self, langs: list[str], rows: np.ndarray, prior: np.ndarray, orders: tuple[int, ...], bits: int):
        self.langs, self.rows, self.prior, self.orders, self.bits = langs, rows, prior, orders, bits

    def scores(self, texts: list[str]) -> np.ndarray:
        found, starts = grams(texts, self.orders, self.bits)
        total = np.zeros((len(texts), len(self.langs)))
        for buckets in found:
            for j in range(len(self.langs)):
                total[:, j] += np.add.reduceat(self.rows[j][buckets], starts[:-1], dtype=np.float64)
        return total + self.prior


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    orders: tuple[int, ...] = (1, 2, 3),
    bits: int = 15,
    smoothing: float = 0.5,
    max_cells: int = 1 << 25,
) -> Model:
    """Counts over all rows whose ``lang`` and ``text`` are not null, one row per bucket and language.

    Every task counts into one array per language, so what is shuffled and
    collected is bounded by 2**bits rows per language; with more than
    ``max_cells`` cells in all the fit is refused.  The prior is the share of
    documents.  Without any such row the model knows no language.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64()), ("docs", pa.int64())])

    def count(batches) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        number: dict[str, int] = {}
        for batch in pieces(batches, "text"):
            texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), object)
            for name in set(langs):
                own = [t for t, x in zip(texts, langs) if x == name]
                counts = seen.setdefault(name, np.zeros(1 << bits, np.int64))
                number[name] = number.get(name, 0) + len(own)
                for buckets in grams(own, orders, bits)[0]:
                    counts += np.bincount(buckets, minlength=1 << bits)
        for name, counts in seen.items():
            at = np.flatnonzero(counts)
            at = at if len(at) else np.zeros(1, np.int64)
            docs_here = np.zeros(len(at), np.int64)
            docs_here[0] = number[name]
            yield record(schema, [name] * len(at), at.astype(np.int32), counts[at], docs_here)

    counted = rows.mapInArrow(count, "lang string, bucket int, n long, docs long")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    got = sums.limit(max_cells + 1).toArrow()
    if got.num_rows > max_cells:
        raise ValueError(f"more than {max_cells} cells of languages and buckets")
    name, bucket, n, number = (got.column(c).to_numpy() for c in ("lang", "bucket", "n", "docs"))
    langs = sorted(set(name.tolist()))
    table, share = np.full((len(langs), 1 << bits), smoothing), np.zeros(len(langs))
    for j, x in enumerate(langs):
        own = name == x
        table[j, bucket[own]] += n[own]
        share[j] = number[own].sum()
    table /= table.sum(1, keepdims=True) if langs else 1
    prior = np.log(share / share.sum()) if langs else share
    return Model(langs, np.log(table).astype(np.float32), prior, orders, bits)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (posterior of that language) for every row.

    ``und`` with score 0 for null, empty and letterless texts, and for all texts if the
    model knows no language.  Whole texts are scored, ties go to the first language in order.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in pieces(batches, "text"):
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if t is not None and m.langs]
            best, p = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if known:
                s = m.scores([texts[i] for i in known])
                top = s.argmax(1)
                best[known] = np.array(m.langs, object)[top]
                p[known] = 1 / np.exp(s - s.max(1, keepdims=True)).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(p)], names=["doc_id", "lang_pred", "score"]
            )

    return rows.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def recognized(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows and columns of ``docs`` whose text has a letter, ``lang`` being the predicted language, whatever its score.

    A model that knows no language rejects the same rows and leaves ``lang`` as it is.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    if not model.langs:
        return whole.where(F.col("text").rlike(r"\p{L}")).select("row.*")
    found = predict(whole, model, "row", "text").where(F.col("lang_pred") != UNKNOWN)
    kind = docs.schema[lang].dataType
    return found.select(
        *[F.col("lang_pred").cast(kind).alias(c) if c == lang else F.col(f"doc_id.`{c}`") for c in docs.columns]
    )
