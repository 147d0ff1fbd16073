"""Token sequences of fixed length from whole documents, by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import pieces, record, stage
from fleetlens.llm.words import STEP, mix

CAPACITY = 2048
#: Rests of documents are cut to pieces of at most so many tokens.
PIECE = 512
#: Rests that are packed together, on average.
GROUP = 1024

_encoders: dict[tuple[str, str], tuple] = {}


def encoder(vocabulary: str, ranks: str):
    """A function from texts to lists of token ids, kept per Python worker.

    ``vocabulary`` is a file of the library tokenizers; ``ranks`` holds the same
    byte-pair ranks for tiktoken, which gives the same ids several times faster.
    Texts that hold one of the added tokens go to the former.
    """
    if (vocabulary, ranks) not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(vocabulary) as f:
            added = [t["content"] for t in json.load(f).get("added_tokens", [])]
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        _encoders[vocabulary, ranks] = fast, added, []
    fast, added, slow = _encoders[vocabulary, ranks]

    def encode(text: str) -> list[int]:
        if any(t in text for t in added):
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(vocabulary))
            return slow[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(total: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: full sequences, then its rest in pieces."""
    full = total // capacity * capacity
    found = [(s, capacity) for s in range(0, full, capacity)]
    return found + [(s, min(piece, total - s)) for s in range(full, total, piece)]


def tokenize(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all rows: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``unit`` (and ``ids``).

    Null and empty texts are the end id alone.  Repeated rows are documents of
    their own.  ``unit`` is a well-mixed number of the piece, to deal pieces out by; ``ids`` are
    little-endian unsigned 32-bit numbers.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(vocabulary, ranks), np.uint64(TaskContext.get().partitionId() << 36)
        for batch in pieces(batches, "text"):
            owner, start, length, crc, total, ids = [], [], [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                own = np.array([*(encode(t) if t else ()), end_id], "<u4")
                for s, n in cut(len(own), capacity, piece):
                    owner.append(i)
                    start.append(s)
                    length.append(n)
                    part = own[s : s + n].tobytes()
                    crc.append(zlib.crc32(part))
                    total.append(len(own))
                    if with_ids:
                        ids.append(part)
            unit = mix((number + np.arange(len(owner), dtype=np.uint64)) * STEP).view(np.int64)
            number += np.uint64(len(owner))
            columns = {"doc_id": batch.column("doc_id").take(pa.array(owner, pa.int64()))}
            columns |= {
                n: pa.array(x, pa.int64())
                for n, x in (("start", start), ("length", length), ("ids_crc32", crc), ("doc_tokens", total), ("unit", unit))
            }
            columns |= {"ids": pa.array(ids, pa.binary())} if with_ids else {}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, unit long"
    return rows.mapInArrow(run, schema + ", ids binary" * with_ids)


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each item, sums nearly equal: Karmarkar-Karp differencing into ``windows`` parts.

    A partial partition is its non-empty parts by falling sum.  The two partitions of
    the largest imbalance are merged, large parts of one onto small parts of
    the other, until one is left.
    """
    n = len(sizes)
    parent = np.arange(2 * n, dtype=np.int64)  # a joined part is a new node above two old ones
    nodes = n
    held = {i: (np.array([sizes[i]]), np.array([i])) for i in range(n)}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    following = n
    while len(heap) > 1:
        (p_sums, p_ids), (q_sums, q_ids) = (held.pop(heapq.heappop(heap)[1]) for _ in range(2))
        joint = len(p_sums) + len(q_sums) - windows
        if joint > 0:
            first = windows - len(q_sums)
            above, below = slice(first, first + joint), slice(len(q_sums) - joint, None)
            made = np.arange(nodes, nodes + joint)
            parent[p_ids[above]] = made
            parent[q_ids[below][::-1]] = made
            nodes += joint
            sums = np.concatenate([p_sums[:first], p_sums[above] + q_sums[below][::-1], q_sums[: len(q_sums) - joint]])
            ids = np.concatenate([p_ids[:first], made, q_ids[: len(q_ids) - joint]])
        else:
            sums, ids = np.concatenate([p_sums, q_sums]), np.concatenate([p_ids, q_ids])
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        held[following] = sums, ids
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == windows else 0)), following))
        following += 1
    ids = held[heap[0][1]][1]
    window = np.full(2 * n, -1, np.int64)
    window[ids] = np.arange(len(ids))
    for node in range(nodes - 1, -1, -1):  # parents come after their children
        if window[node] < 0:
            window[node] = window[parent[node]]
    return window[:n]


def assign(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item, no window over ``capacity``: the window count rises until that holds."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = differencing(sizes, windows)
        if np.bincount(found, sizes).max() <= capacity:
            return found
        windows += 1


def pack(pieces_table: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces_table`` with ``sequence_id`` and ``offset`` in place of ``unit``.

    Full pieces are sequences by themselves, numbered where they lie.  Rests are dealt into groups
    of about ``group`` by ``unit``, and each group is packed in one task.
    """
    table = stage(pieces_table, "pieces", compression="zstd")  # ids have many zero bytes
    rests = table.where(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group))
    fields = [f for f in table.schema.fields if f.name != "unit"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"

    def run(key, batch: pa.Table) -> pa.Table:
        sizes = batch.column("length").to_numpy()
        # A fixed order, whatever order the rows came in.
        order = np.lexsort((batch.column("unit").to_numpy(), -sizes))
        sizes = sizes[order]
        window = assign(sizes, capacity)
        by_window = np.argsort(window, kind="stable")
        sizes, window = sizes[by_window], window[by_window]
        ends = np.cumsum(sizes)
        opening = np.flatnonzero(np.diff(window, prepend=-1))
        offset = ends - sizes - np.repeat((ends - sizes)[opening], np.diff(np.append(opening, len(window))))
        made = batch.take(pa.array(order[by_window])).select([f.name for f in fields])
        base = key[0].as_py() << 31
        return made.append_column("sequence_id", pa.array(base + window)).append_column("offset", pa.array(offset))

    dealt = rests.withColumn("group", F.pmod("unit", F.lit(groups)))
    packed = dealt.groupBy("group").applyInArrow(lambda key, t: run(key, t.drop(["group"])), schema)
    number = F.monotonically_increasing_id() + F.lit(groups << 31)  # above those of the groups
    full = table.where(F.col("length") >= capacity).withColumn("sequence_id", number)
    return full.withColumn("offset", F.lit(0).cast("long")).select(packed.columns).unionByName(packed)
