"""Passages that several documents share, by a sparse suffix array.

Suffixes are kept only where a word n-gram is the smallest (by hash) among some in
a row, so the same passage keeps the same suffix wherever it stands.  Suffixes are put in
the order of their words, in ranges over tasks; neighbours with the same first words make
a run, whose members are extended left and right, word by word.  Hashes choose
suffixes and set aside those that nothing else begins like; whether words are equal is
told by the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from fleetlens.llm import exchange
from fleetlens.llm.common import flat, record, stage
from fleetlens.llm.words import ALPHANUMERIC, Words, runs

#: Words in a passage, in an n-gram, and n-grams among which one is chosen.
LENGTH, GRAM, AMONG = 50, 8, 16
#: Bytes of a word; a longer one is moved as its SHA-256.
LONG = 65
#: Bytes of suffixes that are compared at a time, and suffixes that are cut out of a text at a time.
CELL, SLICE = 8 << 20, 4096

NOBODY = np.iinfo(np.int64).max

#: A suffix: its first words, the text, words before and after them, how far back passages through it begin, where it is.
SUFFIX = pa.schema([
    ("run", pa.string()), ("row", pa.int64()), ("doc_id", pa.int64()), ("left", pa.string()), ("right", pa.string()),
    ("near", pa.int32()), ("far", pa.int32()), ("at", pa.list_(pa.int32())),
])
#: What comparing gives.  ``DONE``: suffixes with the same words around them, where they are, and from how far to how near before
#: them repeated passages begin.  Of runs that may go on in another cell ``OPEN``: where such suffixes are; ``AROUND``: a passage through
#: them, which begins ``far`` words before; ``COUNTED``: its words and count in this cell.
DONE, OPEN, AROUND, COUNTED = range(4)
FOUND = pa.schema([
    ("kind", pa.int32()), ("cell", pa.int64()), ("context", pa.int64()), ("passage", pa.int64()), ("words", pa.string()),
    ("far", pa.int64()), ("near", pa.int64()), ("n_docs", pa.int64()), ("low", pa.int64()),
    ("row", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.int64())), ("at", pa.list_(pa.int64())),
])


def ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def smallest(hashes: np.ndarray, among: int) -> np.ndarray:
    """Where the smallest of every ``among`` hashes in a row is (the leftmost of equal ones), by doubling."""
    place, low, span = np.arange(len(hashes)), hashes, 1
    while span < among:
        step = min(span, among - span)
        if len(low) <= step:
            return np.zeros(0, np.int64)
        left, right = low[: len(low) - step], low[step:]
        take = right < left
        place = np.where(take, place[step:], place[: len(place) - step])
        low = np.where(take, right, left)
        span += step
    return place


def slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Texts made of the bytes from ``begin`` to ``end``."""
    size = np.maximum(end - begin, 0)
    ends = np.append(0, np.cumsum(size))
    source = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)
    return pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[source])])


class Passages:
    """Kept suffixes of the texts of a block, and from where to where passages through them begin.

    A passage belongs to the smallest n-gram among its own, which its words alone decide.
    ``near`` and ``far``: how many words before the suffix its passages begin, at least and at most.
    """

    def __init__(self, rows: pa.RecordBatch, length: int, gram: int, among: int):
        self.w = w = Words(*flat(rows.column("text")), ALPHANUMERIC)
        self.among = among
        self.right = length - among + 1  # words that a passage has from its suffix on, at least
        starts = np.flatnonzero(np.arange(len(w.doc)) + length <= w.first[w.doc + 1])
        own = smallest(runs(w.hash, gram), among)[starts] if len(starts) else starts
        self.begins, one = np.unique(own, return_index=True)  # passages of a suffix follow one another
        back = own - starts
        last = np.append(one[1:], len(own)) - 1
        self.far, self.near = back[one], back[last] if len(one) else back[one]
        self.suffix = runs(w.hash, self.right)[self.begins] if len(one) else np.zeros(0, np.uint64)

    def suffixes(self) -> exchange.Asked:
        """Distinct suffix hashes, and in how many documents of the block they are."""
        order = np.argsort(self.suffix, kind="stable")  # documents stay in order
        keys, doc = self.suffix[order], self.w.doc[self.begins[order]]
        opens = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
        fresh = opens | np.append(True, doc[1:] != doc[:-1])[: len(keys)]
        start = np.flatnonzero(opens)
        return keys[start], [np.add.reduceat(fresh.astype(np.int64), start) if len(start) else start]

    def joined(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Words ``i`` to ``j``, a space after each, and where each begins."""
        w = self.w
        data = w.low[w.start[i] : w.end[j - 1]]
        start, end = w.start[i:j] - w.start[i], w.end[i:j] - w.start[i]
        long = np.flatnonzero(end - start > LONG)
        if len(long):
            digests = [b"\x01" + hashlib.sha256(data[s:e].tobytes()).hexdigest().encode() for s, e in zip(start[long], end[long])]
            start[long] = len(data) + LONG * np.arange(len(long))
            end[long] = start[long] + LONG
            data = np.append(data, np.frombuffer(b"".join(digests), np.uint8))
        at = np.append(0, np.cumsum(end - start + 1))
        source = np.arange(at[-1]) + np.repeat(start - at[:-1], np.diff(at))
        out = data[np.minimum(source, len(data) - 1)]
        out[at[1:] - 1] = 32
        return out, at

    def cut(self, chosen: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The chosen suffixes (``SUFFIX``); those that a text has twice with all words around are one."""
        w, i = self.w, 0
        while i < len(chosen):
            first = self.begins[chosen[i]]
            j = min(i + SLICE, i + int(np.searchsorted(self.begins[chosen[i:]], first + 16 * SLICE)))
            own = chosen[i:j]
            p, near, far = self.begins[own], self.near[own], self.far[own]
            after = p + self.right + self.among - 1 - near
            base = int((p - far).min())
            data, at = self.joined(base, int(after.max()))
            where = lambda x: at[x - base]
            doc = w.doc[p]
            columns = [
                slices(data, where(p), where(p + self.right) - 1), rows[doc], ids[doc],
                slices(data, where(p - far), where(p) - 1),
                slices(data, where(p + self.right), where(after) - 1),
                near, far, p - w.first[doc],
            ]
            names, kinds = SUFFIX.names, [*SUFFIX.types[:-1], pa.int32()]
            table = pa.table([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            table = table.group_by(names[:-1], use_threads=False).aggregate([("at", "list")]).rename_columns(names)
            yield from table.cast(SUFFIX).to_batches()
            i = j


def matrix(texts: pa.Array, counts: np.ndarray, width: int, backwards: bool) -> np.ndarray:
    """A number per distinct word: row by row, those of a text from its beginning (or end) on, then -1."""
    words = pc.split_pattern(texts, " ").flatten()
    codes = words.filter(pc.not_equal(words, "")).dictionary_encode().indices.to_numpy()
    out = np.full((len(counts), width), -1, np.int32)
    owner = np.repeat(np.arange(len(counts)), counts)
    k = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[owner, np.repeat(counts, counts) - 1 - k if backwards else k] = codes
    return out


def ranks(group: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Row k: equal numbers for members of a group whose first k words are equal.

    Members are ordered by words; how many words neighbours share tells the rest.
    """
    n, width = words.shape
    order = np.lexsort((*words.T[::-1], group))
    ordered, own = words[order], group[order]
    apart = np.concatenate([ordered[1:] != ordered[:-1], np.ones((n - 1, 1), bool)], 1)
    shared = np.where(own[1:] != own[:-1], -1, apart.argmax(1))
    out = np.empty((width + 1, n), np.int64)
    for k in range(width + 1):
        out[k, order] = np.append(0, np.cumsum(shared < k))
    return out


def same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every combination of values, and whether a member is the first with its own."""
    order = np.lexsort(columns)
    opens = np.append(True, np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0))
    numbers, one = np.empty(len(order), np.int64), np.zeros(len(order), bool)
    numbers[order] = np.cumsum(opens) - 1
    one[order[opens]] = True
    return numbers, one


def compare(rows: pa.Table, cell: int, among: int, before: bool, after: bool) -> Iterator[pa.RecordBatch]:
    """Passages (``FOUND``) of suffixes in order.

    ``before``, ``after``: the first and the last run may go on in other cells.
    """
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    column = lambda name: rows.column(name).combine_chunks()
    run, left, right, at = (column(c) for c in ("run", "left", "right", "at"))
    row, ids, near, far = (column(c).to_numpy() for c in ("row", "doc_id", "near", "far"))
    n = len(row)
    group = np.append(0, np.cumsum(pc.not_equal(run[1:], run[:-1]).to_numpy(zero_copy_only=False)))
    is_open = ((group == 0) & before) | ((group == group[-1]) & after)
    lefts = ranks(group, matrix(left, far, among - 1, True))
    rights = ranks(group, matrix(right, among - 1 - near, among - 1, False))
    most, low = np.zeros(n, np.int64), np.full(n, NOBODY)
    nearest, farthest = np.full(n, among), np.full(n, -1)
    lists = at.value_lengths().to_numpy().astype(np.int64)
    places, begin = at.flatten().to_numpy().astype(np.int64), np.cumsum(lists) - lists
    contexts, ones = same(near, far, lefts[far, np.arange(n)], rights[among - 1 - near, np.arange(n)])
    made = 0

    def found(kind, size: int, **columns) -> pa.RecordBatch:
        kinds = np.full(size, kind, np.int32) if np.isscalar(kind) else kind
        return record(FOUND, kinds, np.full(size, cell), *[columns.get(f.name, pa.nulls(size, f.type)) for f in FOUND][2:])

    def positions(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members, once for every place at which they stand, and the places."""
        size = lists[of]
        return np.repeat(of, size), places[np.repeat(begin[of], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]

    for back in range(among):
        own = np.flatnonzero((near <= back) & (back <= far))
        if not len(own):
            continue
        key = lefts[back, own] * n + rights[among - 1 - back, own]
        order = np.argsort(key, kind="stable")  # texts stay in order
        own, key = own[order], key[order]
        opens = np.append(True, key[1:] != key[:-1])
        fresh = opens | np.append(True, row[own[1:]] != row[own[:-1]])
        start, number = np.flatnonzero(opens), np.cumsum(opens) - 1
        docs, least = np.add.reduceat(fresh.astype(np.int64), start), np.minimum.reduceat(ids[own], start)
        good = (docs[number] > 1) & ~is_open[own]
        m, k = own[good], number[good]
        most[m], low[m] = np.maximum(most[m], docs[k]), np.minimum(low[m], least[k])
        nearest[m], farthest[m] = np.minimum(nearest[m], back), np.maximum(farthest[m], back)
        kept = is_open[own]
        if kept.any():
            around = ones[own] & kept
            m, k = own[around], number[around]
            yield found(AROUND, len(m), far=np.full(len(m), back), context=contexts[m], passage=k + made)
            k = np.unique(number[kept])
            one = own[start[k]]
            words = [
                " ".join([*left[i].as_py().split(" ")[far[i] - back : far[i]], run[i].as_py(), *right[i].as_py().split(" ")[: among - 1 - back]])
                for i in one.tolist()
            ]
            yield found(COUNTED, len(k), n_docs=docs[k], low=least[k], passage=k + made, words=words)
        made += len(start)
    listed = np.flatnonzero(is_open | (most > 1))
    m, p = positions(listed[np.argsort(contexts[listed], kind="stable")])
    if len(m):
        begins = np.flatnonzero(np.append(True, contexts[m[1:]] != contexts[m[:-1]]))
        bounds, one = pa.array(np.append(begins, len(m)), pa.int32()), m[begins]
        members = {k: pa.ListArray.from_arrays(bounds, pa.array(v, pa.int64())) for k, v in (("row", row[m]), ("doc_id", ids[m]), ("at", p))}
        kinds = np.where(is_open[one], OPEN, DONE).astype(np.int32)
        yield found(kinds, len(one), context=contexts[one], far=farthest[one], near=nearest[one], n_docs=most[one], low=low[one], **members)


def cells(batches, among: int, size: int = CELL) -> Iterator[pa.RecordBatch]:
    """Compares the ordered suffixes of a task some megabytes at a time.

    They are cut between runs; a run that is longer is cut between texts and, like the
    first and the last of the task, stays open.
    """
    held, full, made, before = [], 0, 0, True
    base = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0
    last = lambda c: int(np.flatnonzero(np.append(True, pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)))[-1])
    for batch in batches:
        held.append(batch)
        full += batch.nbytes
        if full < size:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        at = last(table.column("run").combine_chunks())
        inside = not at
        if inside:
            at = last(table.column("row").combine_chunks())
        if at:
            yield from compare(table.slice(0, at), base + made, among, before, inside)
            made, before = made + 1, inside
            table = table.slice(at)
        held = table.to_batches()
        # What is left over of one text in one run waits for as much again.
        full = 0 if at else -table.nbytes
    if held:
        yield from compare(pa.Table.from_batches(held), base + made, among, before, True)


def repeated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    among: int = AMONG,
    block: int = exchange.BLOCK,
    cell: int = CELL,
) -> DataFrame:
    """``doc_id``, ``start``, ``end``, ``n_docs``, ``first_doc``: every stretch of repeated passages.

    A passage is ``length`` words (runs of letters, digits and other than ASCII
    characters, A-Z lowered); it counts if at least two rows hold it.  Words from ``start``
    to ``end`` of a document are all in such passages, which overlap; ``n_docs``
    is the most rows that hold one of them, ``first_doc`` the smallest id among them all.
    Nothing for documents without any, and for null, empty and shorter texts.  Repeated
    rows count as documents; null ids come last.  Ids may be of any type that has an order.
    Words are compared as such, those of more than ``LONG`` bytes by SHA-256.
    """
    if length - among + 1 < gram:
        raise ValueError("length must leave room for an n-gram after the kept suffix")
    if not isinstance(docs.schema[doc_id].dataType, IntegralType):
        return by_number(docs, doc_id, text, length=length, gram=gram, among=among, block=block, cell=cell)
    row = F.monotonically_increasing_id().alias("row")
    rows = docs.select(F.lit(0).alias("flag"), row, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    table = exchange.blocks(rows, "flag", block)
    bits = exchange.bucket_bits(exchange.count_blocks(table))
    counted = exchange.ask(table, lambda r: Passages(r, length, gram, among).suffixes(), bits)
    counted = exchange.answer(counted, [np.add], "suffixes")

    def suffixes(number: int, own: pa.RecordBatch, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        p, held = Passages(own, length, gram, among), exchange.totals_of(answers, 1)[0]
        if len(held):
            chosen = np.flatnonzero(held[np.unique(p.suffix, return_inverse=True)[1]] > 1)
            yield from p.cut(chosen, own.column("row").to_numpy(), own.column("doc_id").fill_null(NOBODY).to_numpy())

    kept = exchange.meet(table, counted, suffixes, ddl(SUFFIX), SUFFIX)
    # Equal first words go on in the next range with another text, so that no passage is too much for a task.
    ordered = kept.repartitionByRange("run", "row").sortWithinPartitions("run", "row")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    found = stage(ordered.mapInArrow(lambda batches: cells(batches, among, cell), ddl(FOUND)), "passages")

    parts = found.where(F.col("kind") == COUNTED).select("cell", "passage", "words", "n_docs", "low")
    whole = parts.groupBy("words").agg(F.sum("n_docs").alias("n_docs"), F.min("low").alias("low")).where("n_docs > 1")
    whole = parts.select("cell", "passage", "words").join(whole, "words").drop("words")
    # Suffixes with the same words around them have the same passages and are one row until they go back to their texts.
    around = found.where(F.col("kind") == AROUND).select("cell", "context", "passage", F.col("far").alias("back"))
    around = around.join(whole, ["cell", "passage"]).groupBy("cell", "context").agg(
        F.max("back").alias("far"), F.min("back").alias("near"), F.max("n_docs").alias("n_docs"), F.min("low").alias("low")
    )
    resolved = found.where(F.col("kind") == OPEN).select("cell", "context", "row", "doc_id", "at").join(around, ["cell", "context"])
    columns = ["far", "near", "n_docs", "low", F.explode(F.arrays_zip("row", "doc_id", "at")).alias("m")]
    every = found.where(F.col("kind") == DONE).select(resolved.columns).unionByName(resolved).select(columns)
    first, last = F.col("m.at") - F.col("far"), F.col("m.at") - F.col("near")
    every = every.select("m.row", "m.doc_id", first.alias("first"), last.alias("last"), "n_docs", "low")
    order = Window.partitionBy("row").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = every.withColumn("opens", F.coalesce(F.col("first") > reach + length, F.lit(True)).cast("int"))
    parted = opened.withColumn("stretch", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = parted.groupBy("row", "stretch").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("start"), (F.max("last") + length).alias("end"),
        F.max("n_docs").alias("n_docs"), F.min("low").alias("first_doc"),
    )
    known = lambda c: F.when(F.col(c) != int(NOBODY), F.col(c)).alias(c)
    return stretches.select(known("doc_id"), "start", "end", "n_docs", known("first_doc"))


def by_number(docs: DataFrame, doc_id: str, text: str, **options) -> DataFrame:
    """``repeated`` for ids that are no integers: by numbers in the order of the ids, put back afterwards."""
    ids = docs.select(F.col(doc_id).alias("id")).where("id is not null").distinct()
    # Ranges of ids, numbered range by range.
    ids = stage(ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("number", F.monotonically_increasing_id()), "ids")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(ids, "id", "left")
    found = repeated(rows, "number", "text", **options)
    names = lambda c: ids.select(F.col("id").alias(f"{c}_id"), F.col("number").alias(c))
    named = found.join(names("doc_id"), "doc_id", "left").join(names("first_doc"), "first_doc", "left")
    return named.select(F.col("doc_id_id").alias("doc_id"), "start", "end", "n_docs", F.col("first_doc_id").alias("first_doc"))
