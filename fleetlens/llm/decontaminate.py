"""Passages of benchmark items in documents: Wu-Manber search over words.

The alphabet is words, a block is two of them.  Per pattern length one table
tells by a block's hash how far the search may move on; where it may not, the
block (the pattern's suffix) selects the test strings, which are compared
directly.  Many stretches of text are searched in step, as numpy arrays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import apart, flat, pieces, record, stage
from fleetlens.llm.words import ALPHANUMERIC, Words, runs

#: Start positions that one stretch of text covers.
STRETCH = 128
#: Bytes of patterns that are searched for in one pass.
PATTERN_BYTES = 16 << 20


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", length: int = 10) -> DataFrame:
    """Distinct ``item``, ``n`` (words), ``pattern`` (lowered words joined by spaces) of all items.

    Every run of ``length`` words, or the whole item if it has fewer; nothing for
    null or wordless texts.  A null id is the empty string.
    """
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    schema = pa.schema([("item", pa.string()), ("n", pa.int32()), ("pattern", pa.binary())])

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            w = Words(*flat(batch.column("text")), ALPHANUMERIC)
            for i, item in enumerate(batch.column("item").to_pylist()):
                first, last = w.first[i], w.first[i + 1]
                n = min(length, last - first)
                if n:
                    patterns = sorted({w.bytes_of(k, n) for k in range(first, last - n + 1)})
                    yield record(schema, [item] * len(patterns), [n] * len(patterns), patterns)

    return rows.mapInArrow(cut, "item string, n int, pattern binary").distinct()


class Patterns:
    """Shift tables and suffix buckets of one block of patterns, by pattern length."""

    def __init__(self, rows: list[tuple[str, int, bytes]], bits: int = 16):
        self.bits, self.by_length = bits, {}
        owners: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for item, n, pattern in rows:
            owners[n][pattern].append(item)
        for m, found in sorted(owners.items()):
            texts = list(found)
            joined = b" ".join(texts)
            hashes = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), ALPHANUMERIC).hash.reshape(-1, m)
            b = min(2, m)
            shift = np.full(1 << bits, m - b + 1, np.int64)
            for j in range(m - b + 1):
                block = self.blocks(hashes[:, j : j + b])
                np.minimum.at(shift, self.slot(block), m - b - j)
            buckets: dict[int, dict[bytes, list[str]]] = defaultdict(dict)
            for key, text in zip(self.blocks(hashes[:, m - b :]).tolist(), texts):
                buckets[key][text] = found[text]
            self.by_length[m] = (b, shift, dict(buckets), np.array(sorted(buckets), np.uint64))

    @staticmethod
    def blocks(hashes: np.ndarray) -> np.ndarray:
        b = hashes.shape[1]
        return runs(hashes.reshape(-1), b)[::b] if b > 1 else runs(hashes.reshape(-1), 1)

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, w: Words) -> Iterator[tuple[int, int, list[str]]]:
        """First word, number of words and items of every occurrence in the texts."""
        for m, (b, shift, buckets, suffixes) in self.by_length.items():
            block = runs(w.hash, b)
            move = shift[self.slot(block)]
            # Stretches of start positions, within one text each.
            room = np.diff(w.first) - m + 1
            own = np.flatnonzero(room > 0)
            parts = -(-room[own] // STRETCH)
            base = np.repeat(w.first[own], parts)
            nth = np.arange(len(base)) - np.repeat(np.cumsum(parts) - parts, parts)
            at = base + nth * STRETCH
            end = np.minimum(at + STRETCH, np.repeat(w.first[own] + room[own], parts))
            stops = []
            while len(at):
                by = move[at + m - b]
                stops.append(at[by == 0])
                at = at + np.maximum(by, 1)
                going = at < end
                at, end = at[going], end[going]
            at = np.sort(np.concatenate(stops)) if stops else np.zeros(0, np.int64)
            key = block[at + m - b]
            near = np.searchsorted(suffixes, key)
            hit = suffixes[np.minimum(near, len(suffixes) - 1)] == key
            for s, k in zip(at[hit].tolist(), key[hit].tolist()):
                items = buckets[k].get(w.bytes_of(s, m))
                if items:
                    yield s, m, items


def search(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = 10,
    keep: tuple[str, ...] = ("doc_id",),
    pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """The ``keep`` columns of every row with ``n_words``, ``spans`` and ``items``.

    ``spans``: merged word ranges (``start``, ``end``) that occurrences cover;
    ``items``: sorted distinct ids (as strings) of items with an occurrence.
    Rows are kept one for one, repeated ones too, and columns named as a result are refused; null texts have no words and an empty
    benchmark has no occurrences.

    Patterns are broadcast in blocks of about ``pattern_bytes``, measured before
    and dealt by their hash.  With more than one block, each makes a pass and its
    finds are staged with the rows.
    """
    apart(keep, ("n_words", "spans", "items", "__text"))
    spark = docs.sparkSession
    found = stage(windows(items, item_id, item_text, length), "patterns")
    size = found.agg(F.sum(F.length("pattern") + F.length("item"))).first()[0] or 0
    blocks = max(1, -(-size // pattern_bytes))
    rows = docs.select(F.col(text).alias("__text"), *keep)
    range_type = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    extra = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(range_type)), ("items", pa.list_(pa.string()))])
    result = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"

    def scan(shared, carried: bool, last: bool):
        def run(batches) -> Iterator[pa.RecordBatch]:
            patterns = Patterns(shared.value)
            for batch in pieces(batches, "__text"):
                w = Words(*flat(batch.column("__text")), ALPHANUMERIC)
                count = batch.num_rows
                spans: list[list] = [[] for _ in range(count)]
                ids: list[set] = [set() for _ in range(count)]
                if carried:
                    spans = [[(x["start"], x["end"]) for x in s] for s in batch.column("spans").to_pylist()]
                    ids = [set(x) for x in batch.column("items").to_pylist()]
                for start, n, items_here in patterns.search(w):
                    i = w.doc[start]
                    spans[i].append((start - w.first[i], start - w.first[i] + n))
                    ids[i].update(items_here)
                made = record(extra, np.diff(w.first), [merged(s) for s in spans], [sorted(x) for x in ids])
                own = [n for n in batch.schema.names if n not in extra.names and not (last and n == "__text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in own] + made.columns, names=own + extra.names
                )

        return run

    for k in range(blocks):
        own = found if blocks == 1 else found.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])
        last = k == blocks - 1
        columns = [f for f in rows.schema.fields if f.name not in extra.names and not (last and f.name == "__text")]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        rows = rows.mapInArrow(scan(shared, k > 0, last), f"{schema}, {result}")
        if not last:
            rows = stage(rows, "decontaminate")
    return rows


def clean(docs: DataFrame, items: DataFrame, text: str = "text", length: int = 10) -> DataFrame:
    """The rows and columns of ``docs`` in which no item occurs."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    return search(whole, items, keep=("row",), length=length).where(F.size("spans") == 0).select("row.*")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": int(a), "end": int(b)} for a, b in out]
