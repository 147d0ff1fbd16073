"""Fingerprints under which a small edit distance is a small Hamming distance.

Randomised edit embedding: a walk reads the text and, at every step, puts out
the character it stands on; a random bit, shared by all texts and drawn by step and
character, says whether it moves on.  Two walks that an edit has set apart
drift until they meet and stay together from then on.  A fingerprint is a nested sample
of walk positions, so texts of any two lengths can be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm import forest
from fleetlens.llm.common import components, pieces, record, stage
from fleetlens.llm.words import STEP, mix

#: Characters are walked by class; the random bits repeat after ``PERIOD`` steps.
CLASSES, PERIOD = 64, 1 << 13
#: Most positions in a fingerprint.
POSITIONS = 256
#: Texts that are walked in step; fewer are walked one by one.
TOGETHER = 24
#: Walks of ``near``; bands of each, and positions in a band.
WALKS, BANDS, ROWS = 4, 16, 3


@lru_cache
def dwell(number: int) -> np.ndarray:
    """Steps that walk ``number`` spends on a character, by its class and the step of arrival (modulo the period)."""
    seeds = np.arange(CLASSES * PERIOD, dtype=np.uint64) + np.uint64(1 + number * CLASSES * PERIOD)
    bits = (mix(seeds * STEP) >> np.uint64(63)).astype(bool)
    bits = bits.reshape(CLASSES, PERIOD)
    twice = np.concatenate([bits, bits], 1)
    after = np.where(twice, np.arange(2 * PERIOD), 4 * PERIOD)
    after = np.minimum.accumulate(after[:, ::-1], 1)[:, ::-1][:, :PERIOD]
    return np.minimum(after - np.arange(PERIOD) + 1, 255).astype(np.uint8).reshape(-1)


def symbols(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each code point for the walk, and the byte (1 to 255) it leaves in a fingerprint."""
    h = mix((codes.astype(np.uint64) + np.uint64(1)) * STEP)
    return (h >> np.uint64(58)).astype(np.uint8), ((h & np.uint64(0xFFFFFF)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def walk(classes: np.ndarray, offsets: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The step after which each character is left, for all texts, and the whole length of each walk."""
    table, left = dwell(number), np.empty(len(classes), np.int64)
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    begin, size = offsets[:-1][order], size[order]
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")  # texts with a character at i
    at = np.zeros(len(size), np.int64)
    i = 0
    while i < len(active) and active[i] >= TOGETHER:
        now = at[: active[i]]
        place = begin[: active[i]] + i
        now += table[classes[place].astype(np.int64) * PERIOD + (now & (PERIOD - 1))]
        left[place] = now
        i += 1
    if i < len(active):  # the longest texts of the piece
        rows = [r.tobytes() for r in table.reshape(CLASSES, PERIOD)]
        for k in range(active[i]):
            j, found = int(at[k]), []
            for c in classes[begin[k] + i : begin[k] + size[k]].tobytes():
                j += rows[c][j & (PERIOD - 1)]
                found.append(j)
            left[begin[k] + i : begin[k] + size[k]] = found
            at[k] = j
    length = np.zeros(len(size), np.int64)
    length[order] = at
    return left, length


def sampled(level: int, count: int) -> np.ndarray:
    """One walk position in each of the first ``count`` stretches of 2**level steps.

    A stretch takes the position of one of its halves, by a shared bit, so the
    positions of a level are some of those of the level below.
    """
    at = np.arange(count, dtype=np.uint64)
    for k in range(level, 0, -1):
        at = at * np.uint64(2) + half(k, at)
    return at.astype(np.int64)


def half(level: int, at: np.ndarray) -> np.ndarray:
    return mix((at * np.uint64(64) + np.uint64(level)) * STEP + np.uint64(11)) >> np.uint64(63)


def level_of(length: int) -> int:
    """Smallest level at which a walk of this length has at most ``POSITIONS`` stretches."""
    return max(0, (max(1, -(-length // POSITIONS)) - 1).bit_length())


def fingerprint(texts: list[str], number: int = 0) -> list[bytes]:
    """Level in the first byte, then the symbol at each sampled position (0 where the walk has ended)."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum([0, *map(len, texts)])
    classes, symbol = symbols(codes)
    left, length = walk(classes, offsets, number)
    found = []
    for a, b, n in zip(offsets[:-1], offsets[1:], length.tolist()):
        level = level_of(n)
        at = sampled(level, -(-n >> level) if n else 0)
        on = np.searchsorted(left[a:b], at, "right")
        inside = on < b - a
        marks = np.zeros(len(at), np.uint8)
        marks[inside] = symbol[a:b][on[inside]]
        found.append(bytes([level]) + marks.tobytes())
    return found


def coarser(print_: bytes, level: int) -> np.ndarray:
    """The symbols of a fingerprint at a level not below its own."""
    own, marks = print_[0], np.frombuffer(print_, np.uint8, offset=1)
    while own < level:
        own += 1
        at = np.arange(-(-len(marks) // 2), dtype=np.uint64)
        at = (at * np.uint64(2) + half(own, at)).astype(np.int64)
        marks = np.append(marks, np.uint8(0))[np.minimum(at, len(marks))]
    return marks


def likeness(x: bytes, y: bytes) -> float:
    """Share of positions with equal symbols, of the longer walk's; 1 for two empty texts."""
    level = max(x[0], y[0])
    a, b = coarser(x, level), coarser(y, level)
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    return float(((a == b[: len(a)]) & (a > 0)).sum() / max(1, (b > 0).sum())) if len(b) else 1.0


OUT = pa.schema([
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def compared(texts: list[str], prints: list[bytes]) -> list[list]:
    """Columns ``OUT`` for all texts but the last, each with the one after it."""
    cut = [len(t) // 3 for t in texts[:-1]]
    edited = [t[: len(t) - n] + following[:n] for t, n, following in zip(texts, cut, texts[1:])]
    changed = fingerprint(edited)
    return [
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        prints[:-1],
        changed,
        [likeness(x, y) for x, y in zip(prints, changed)],
        [likeness(x, y) for x, y in zip(prints, prints[1:])],
    ]


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the columns ``OUT`` of every row: its text, its edited text, and the next row's text.

    Rows are in descending order of ``doc_id`` (nulls last, repeated ids by the hash of the
    text, rows alike in any order), and the first follows the last.  The edited text
    has its last floor(n_chars / 3) characters replaced by as many of the next text's first ones, or all
    it has.  Null is empty; a table of one row follows itself.

    Whole texts are moved once, into ranges of ids, and compared in a stream.
    Every range leaves its first and last row over, which meet in a small join.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("row")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    out = pa.schema([id_type, *OUT, ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in pieces(batches, "text"):
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            prints = fingerprint(texts)
            if held is None:  # the range's first text, for the range before
                yield record(out, ids.slice(0, 1), *[[None]] * len(OUT), [part], [texts[0]], [None])
            else:
                ids = pa.concat_arrays([held[0], ids])
                texts, prints = [held[1], *texts], [held[2], *prints]
            held = ids.slice(len(ids) - 1), texts[-1], prints[-1]
            if len(texts) > 1:
                none = [None] * (len(texts) - 1)
                yield record(out, ids.slice(0, len(none)), *compared(texts, prints), [part] * len(none), none, none)
        if held is not None:
            yield record(out, held[0], *[[None]] * len(OUT), [part], [None], [held[1]])

    made = ranges.mapInArrow(run, f"doc_id {kind}, {columns}, part int, first string, last string")
    made = stage(made, "edited", compression="zstd")
    found = made.where("first is null and last is null").drop("part", "first", "last")
    # One row per range, without texts, is ordered to find the next range that has rows.
    ends = made.where("last is not null").select("doc_id", "part", "last")
    starts = made.where("first is not null").select("part", "first")
    ranges = Window.orderBy("part")
    after = F.coalesce(F.lead("part").over(ranges), F.min("part").over(ranges))
    step = ends.join(starts.select("part", after.alias("after")), "part")
    step = step.join(starts.select(F.col("part").alias("after"), "first"), "after").select("doc_id", "last", "first")
    done = pa.schema([id_type, *OUT])

    def finish(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (x, y) in enumerate(zip(batch.column("last").to_pylist(), batch.column("first").to_pylist())):
                yield record(done, batch.column("doc_id").slice(i, 1), *compared([x, y], fingerprint([x, y])))

    return found.unionByName(step.mapInArrow(finish, f"doc_id {kind}, {columns}"))


def text_of(column: str):
    """A fingerprint as a string of hexadecimal digits."""
    return F.lower(F.hex(column))


def bands(print_: bytes, number: int) -> list[int]:
    """Keys of sampled positions: ``BANDS`` for the length's own power of two, and where 1.25 times it has another, for that too."""
    marks = coarser(print_, print_[0])
    steps, found = int((marks > 0).sum()) << print_[0], []
    for power in sorted({(max(1, int(n)) - 1).bit_length() for n in (steps, 1.25 * steps)} if steps else set()):
        level = max(0, power - POSITIONS.bit_length() + 1, print_[0])
        marks = np.append(coarser(print_, level), np.uint8(0)).astype(np.uint64)
        span = max(1, (1 << power) >> level)
        seeds = mix((np.arange(BANDS * ROWS, dtype=np.uint64) + np.uint64(power * 4096)) * STEP).reshape(BANDS, ROWS)
        at = (seeds % np.uint64(span)).astype(np.int64)
        at[::2] = (seeds[::2] % np.uint64(max(1, span * 2 // 5))).astype(np.int64)  # all texts of this class reach here
        values = marks[np.minimum(at, len(marks) - 1)]
        key = (np.arange(BANDS, dtype=np.uint64) + np.uint64((number * 64 + power) * BANDS + 1)) * STEP
        for k in range(ROWS):
            key = mix(key + values[:, k] * STEP)
        found += key[(values > 0).all(1)].view(np.int64).tolist()
    return found


def near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``doc_id``, ``component_id`` for every row: the smallest id that likenesses of at least ``least`` lead to.

    Equal texts are one class.  Classes that share a band, a hash of ``ROWS`` sampled
    positions of one walk, are candidates; the whole fingerprints of that walk are compared where
    bands meet, and only a spanning forest of what is alike goes on.  An edit may set a walk apart for
    long, so there are several, and one that stays together is enough.  Null and empty
    texts are alone; a null id is named only if all ids of its component are null.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("node", F.when(F.length("text") > 0, F.xxhash64("text")))
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = pa.struct([("print", pa.binary()), ("bands", pa.list_(pa.int64()))])
    schema = pa.schema([id_type, ("node", pa.int64()), ("walks", pa.list_(found))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            walks = [[{"print": p, "bands": bands(p, k)} for p in fingerprint(texts, k)] for k in range(WALKS)]
            yield record(schema, batch.column("doc_id"), batch.column("node"), list(map(list, zip(*walks))))

    made = f"doc_id {kind}, node long, walks array<struct<print: binary, bands: array<long>>>"
    rows = stage(rows.mapInArrow(run, made), "prints", compression="zstd")
    classes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.min("walks").alias("walks"))
    classes = stage(classes, "classes", compression="zstd")
    listed = classes.select("node", F.inline("walks"))
    listed = listed.select(F.explode("bands").alias("list"), "node", F.col("node").alias("root"), "print")

    def alike(table: pa.Table):
        prints = [p.as_py() for p in table.column("print")]
        return lambda i, j: np.array([likeness(prints[a], prints[b]) >= least for a, b in zip(i, j)], bool)

    links = forest.links(listed, alike, "edit")
    final = components(links, "edit-components")
    low = classes.select("node", "low").join(final, "node").groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(final.join(low, "root").select("node", "component_id"), "node", "left")
    named = named.select("node", F.coalesce("component_id", "low").alias("component_id"))
    return rows.select("doc_id", "node").join(named, "node", "left").select(
        "doc_id", F.coalesce("component_id", "doc_id").alias("component_id")
    )
