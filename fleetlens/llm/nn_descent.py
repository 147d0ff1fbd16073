"""Near-duplicate vectors from a neighbour graph that refines itself (NN-descent).

Equal vectors are one node.  Lists of neighbours start from vectors that lie next
to each other along random directions, and improve by comparing the neighbours of
each node with one another.  Lists grow while they lack links of a few nodes that they
have room for.  Edges over the threshold make components.  Nodes
whose lists are full of such edges cannot name all their links: a few of them are compared with each other,
more look for neighbours in other components, again and again, until no list is full of links;
within a component all are compared in blocks.  The result is audited: nodes are compared
with all vectors until enough of them have links, or all have been compared.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import components, record, stage
from fleetlens.llm.forest import Union

log = logging.getLogger(__name__)

#: Neighbours in a list at first and at most, directions that lists start from, rounds of refinement.
NEIGHBOURS, MOST, DIRECTIONS, ROUNDS = 8, 64, 4, 6
#: Nodes that are compared at once, and nodes per group when lists are merged.
BLOCK, GROUP = 512, 4096
#: Nodes, about, that stand for a component when directions are to show others next to it.
THIN = 16
#: Nodes of the audit, and the recall it asks for.
AUDIT, RECALL = 256, 0.95
#: Nodes with links that the audit of the result has to see, and the most nodes it compares in one pass.
LINKED, PASS = 64, 4096
#: Nodes with full lists that are compared with each other directly, and links that a task joins into components.
DIRECT, SMALL = 4096, 1 << 20
#: Bytes of vectors that are one side of a cell when the members of a component are compared.
TILE = 4 << 20
#: Tiles into which a component is cut anyway, as far as they have so many members.
SPREAD, LEAST = 8, 64

EDGES = pa.schema([("node", pa.int64()), ("nbr", pa.int64()), ("sim", pa.float64())])
EDGES_SQL = "node long, nbr long, sim double"
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SEEN = pa.schema([("node", pa.int64()), ("nbr", pa.int64()), ("n", pa.int64()), ("got", pa.int64())])


class Audit(NamedTuple):
    """Share of the true links that were found (the lower of that of all links and the mean of nodes), the links and
    nodes with links it is from, and whether all nodes were compared: then the result is exact."""

    share: float
    links: int
    nodes: int
    whole: bool


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, of length 1, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # the squares of very large and small numbers stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def best(node: np.ndarray, nbr: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` most similar distinct neighbours of each node."""
    order = np.lexsort((nbr, -sim, node))
    node, nbr, sim = node[order], nbr[order], sim[order]
    # Equal pairs have equal similarity up to rounding: the pair's first row counts.
    pair = np.lexsort((np.arange(len(node)), nbr, node))
    again = np.zeros(len(node), bool)
    again[pair[1:]] = (node[pair[1:]] == node[pair[:-1]]) & (nbr[pair[1:]] == nbr[pair[:-1]])
    keep = ~again & (node != nbr)
    node, nbr, sim = node[keep], nbr[keep], sim[keep]
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1])[: len(node)])
    rank = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
    return node[rank < k], nbr[rank < k], sim[rank < k]


def top(x: np.ndarray, ids: np.ndarray, roots: np.ndarray, k: int) -> tuple:
    """Edges to the ``k`` most similar vectors of other roots, for each vector of a block."""
    sim = np.where(roots[:, None] == roots[None, :], -np.inf, x @ x.T)
    k = min(k, len(ids))
    at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    node, nbr, sim = np.repeat(ids, k), ids[at].ravel(), np.take_along_axis(sim, at, 1).ravel()
    other = sim > -np.inf
    return node[other], nbr[other], sim[other]


def merged(edges: DataFrame, nodes: int, k: int, name: str) -> DataFrame:
    """Lists of at most ``k`` from candidate edges, staged; nodes are dealt into groups of bounded size."""
    groups = max(1, -(-nodes // GROUP))

    def run(key, table):
        found = best(*(table.column(c).to_numpy() for c in EDGES.names), k)
        return pa.Table.from_batches([record(EDGES, *found)])

    dealt = edges.withColumn("grp", F.pmod(F.xxhash64("node"), F.lit(groups)))
    return stage(dealt.groupBy("grp").applyInArrow(run, EDGES_SQL), name)


def neighbours_along(vectors: DataFrame, nodes: int, k: int, seed: int, directions: int = DIRECTIONS) -> DataFrame:
    """Edges among vectors that one of some random directions (with signs of more) puts next to each other.

    All directions are sorted in one exchange, one after another.
    """
    partitions = max(1, -(-nodes // GROUP)) * directions

    def project(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            own = [batch.column(c) for c in ("node", "vector", "root")]
            for turn in range(directions):
                axes = np.random.default_rng([seed + turn, x.shape[1]]).standard_normal((x.shape[1], 13))
                y = x @ axes
                signs = (y[:, 1:] > 0) @ (1 << np.arange(12))
                place = pa.array(signs + 0.5 + np.arctan(y[:, 0]) / np.pi)
                turns = pa.array(np.full(len(x), turn, np.int32))
                yield pa.RecordBatch.from_arrays([*own, turns, place], names=["node", "vector", "root", "turn", "place"])

    def compare(batches) -> Iterator[pa.RecordBatch]:
        waiting, size, now = [], 0, None

        def edges(table: pa.Table) -> pa.RecordBatch:
            ids, roots, x = table.column("node").to_numpy(), table.column("root").to_numpy(), matrix(table.column("vector"))
            return record(EDGES, *best(*top(x, ids, roots, k), k))

        def by_turn() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                turns = batch.column("turn").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(turns)) + 1).tolist(), len(turns)]
                yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)

        for batch in by_turn():
            turn = batch.column("turn")[0].as_py()
            if size and turn != now:
                yield edges(pa.Table.from_batches(waiting).combine_chunks())
                waiting, size = [], 0
            waiting.append(batch)
            size, now = size + batch.num_rows, turn
            while size >= BLOCK:
                table = pa.Table.from_batches(waiting).combine_chunks()
                yield edges(table.slice(0, BLOCK))
                # Half of a block stays, so that neighbours across its end meet too.
                rest = table.slice(BLOCK // 2)
                waiting, size = rest.to_batches(), rest.num_rows
        if size:
            yield edges(pa.Table.from_batches(waiting).combine_chunks())

    kind = vectors.schema["vector"].dataType.simpleString()
    placed = vectors.select("node", "vector", "root").mapInArrow(
        project, f"node long, vector {kind}, root long, turn int, place double"
    )
    # A node id settles equal places, so the order is the same in every run.
    order = ("turn", "place", "node")
    return placed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(compare, EDGES_SQL)


def refined(lists: DataFrame, vectors: DataFrame, nodes: int, k: int) -> DataFrame:
    """Candidate edges between neighbours (either way) of each node, with the vectors and roots joined to them.

    A node that very many others name meets them in parts of bounded size, so no
    node is a task of its own.
    """
    both = lists.select("node", "nbr").unionByName(lists.select(F.col("nbr").alias("node"), F.col("node").alias("nbr")))
    both = both.distinct()
    parts = both.groupBy("node").agg(F.ceil(F.count("*") / (8.0 * k)).cast("long").alias("parts"))
    dealt = both.join(parts, "node").select("node", F.pmod(F.xxhash64("nbr"), "parts").alias("part"), "nbr")
    carried = dealt.join(vectors.select(F.col("node").alias("nbr"), "vector", "root"), "nbr")
    groups = max(1, -(-nodes // (GROUP // 4)))
    carried = carried.withColumn("grp", F.pmod(F.xxhash64("node", "part"), F.lit(groups)))

    def run(key, table):
        node, part, nbr, root = (table.column(c).to_numpy() for c in ("node", "part", "nbr", "root"))
        x = matrix(table.column("vector"))
        order = np.lexsort((nbr, part, node))
        node, part, nbr, root, x = node[order], part[order], nbr[order], root[order], x[order]
        first = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (part[1:] != part[:-1])))
        found = []
        for a, b in zip(first, np.append(first[1:], len(node))):
            if b - a > 1:
                found.append(top(x[a:b], nbr[a:b], root[a:b], k))
        if not found:
            return pa.Table.from_batches([], schema=EDGES)
        return pa.Table.from_batches([record(EDGES, *best(*map(np.concatenate, zip(*found)), k))])

    return carried.select("grp", "node", "part", "nbr", "vector", "root").groupBy("grp").applyInArrow(run, EDGES_SQL)


def recall(lists: DataFrame, vectors: DataFrame, threshold: float, k: int, audit: int = AUDIT) -> float:
    """Share of the links of ``audit`` nodes (chosen by a hash) that lists of ``k`` hold, as far as they have room.

    The nodes are compared with all vectors.
    """
    chosen = vectors.select("node", "vector").orderBy(F.xxhash64("node"), "node").limit(audit).toArrow()
    if not chosen.num_rows:
        return 1.0
    shared = vectors.sparkSession.sparkContext.broadcast((chosen.column("node").to_numpy(), matrix(chosen.column("vector"))))

    def brute(batches) -> Iterator[pa.RecordBatch]:
        ids, x = shared.value
        for batch in batches:
            sim = x @ matrix(batch.column("vector")).T
            i, j = np.nonzero(sim >= threshold)
            other = batch.column("node").to_numpy()[j]
            apart = ids[i] != other
            yield record(EDGES, ids[i][apart], other[apart], sim[i, j][apart])

    true = vectors.select("node", "vector").mapInArrow(brute, EDGES_SQL)
    wanted = true.groupBy("node").agg(F.count("*").alias("n"))
    held = lists.where(F.col("sim") >= threshold).groupBy("node").agg(F.count("*").alias("got"))
    sums = wanted.join(held, "node", "left").agg(
        F.sum(F.least("n", F.lit(k))), F.sum(F.least(F.coalesce("got", F.lit(0)), F.col("n"), F.lit(k)))
    ).first()
    return float(sums[1] / sums[0]) if sums[0] else 1.0


def descend(
    vectors: DataFrame, nodes: int, threshold: float, k: int, seed: int, guide: DataFrame | None = None
) -> DataFrame:
    """Lists of at most ``k`` neighbours of other roots (``vectors`` has ``node``, ``vector``, ``root``).

    With a ``guide`` (more edges), its neighbours are compared with those of the lists too, and lists start
    from a few nodes of each root besides, so that a large component does not hide its surroundings.
    """
    starts = neighbours_along(vectors, nodes, k, seed)
    if guide is not None:
        sizes = vectors.groupBy("root").agg(F.ceil(F.count("*") / float(THIN)).cast("long").alias("every"))
        few = vectors.join(sizes, "root").where(F.pmod(F.xxhash64("node", F.lit(seed)), "every") == 0)
        few = stage(few.select("node", "vector", "root"), "few")
        starts = starts.unionByName(neighbours_along(few, few.count(), k, seed))
    lists = merged(starts, nodes, k, "lists")
    before = None
    for _ in range(ROUNDS):
        close = lists.agg(F.count("*"), F.sum(F.round("sim", 6)), F.sum((F.col("sim") >= threshold).cast("long"))).first()
        # Settled when lists are hardly better than the last time and no link is new.
        if before and close[2] == before[2] and (close[1] or 0) - (before[1] or 0) <= 1e-3 * max(1, close[0]):
            break
        before = close
        wide = lists if guide is None else lists.unionByName(guide)
        lists = merged(lists.unionByName(refined(wide, vectors, nodes, k)), nodes, k, "lists")
    return lists


def graph(vectors: DataFrame, nodes: int, threshold: float, k: int = NEIGHBOURS) -> tuple[DataFrame, float, int]:
    """Neighbour lists, their audited recall, and the length they grew to."""
    alone = vectors.select("node", "vector", F.col("node").alias("root"))
    while True:
        lists = descend(alone, nodes, threshold, k, 1000 * k)
        found = recall(lists, vectors, threshold, k)
        if found >= RECALL or k >= MOST:
            if found < RECALL:
                log.warning("lists of %d neighbours hold %.3f of the audited links", k, found)
            return lists, found, k
        k *= 2


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (``a``, ``b``) and the smallest that they lead it to."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    union = Union(np.arange(len(ids)))
    union.joined(place[: len(a)], place[len(a) :])
    return ids, ids[union.labels()]


def connected(links: DataFrame, name: str) -> DataFrame:
    """``node``, ``root`` (the smallest of its component) for the nodes of ``links`` (``a``, ``b``).

    Tasks reduce their links, ``SMALL`` at a time, to one per node.  If no more than ``SMALL`` are left, one task
    joins them; more are joined by ``components``.
    """

    def reduced(batches) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def joined() -> pa.RecordBatch:
            node, root = stars(*(np.concatenate([b.column(c).to_numpy() for b in waiting]) for c in PAIRS.names))
            return record(PAIRS, node, root)

        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= SMALL:
                yield joined()
                waiting, size = [], 0
        if size:
            yield joined()

    kind = "a long, b long"
    forest = stage(links.select("a", "b").mapInArrow(reduced, kind), name)
    if forest.count() > SMALL:
        return components(forest, name)
    # Fewer links than one reduction takes, so it is the last.
    return forest.coalesce(1).mapInArrow(reduced, kind).select(F.col("a").alias("node"), F.col("b").alias("root"))


def rejoined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (``node``, ``root``) once the components that ``links`` (``node``, ``nbr``) touch are one."""
    sides = [roots.select(F.col("node").alias(c), F.col("root").alias(r)) for c, r in (("node", "a"), ("nbr", "b"))]
    pairs = links.select("node", "nbr").join(sides[0], "node").join(sides[1], "nbr").select("a", "b")
    joint = connected(pairs, "vector-components").select(F.col("node").alias("old"), F.col("root").alias("new"))
    found = roots.join(joint, roots["root"] == joint["old"], "left")
    return stage(found.select("node", F.coalesce("new", "root").alias("root")), "vector-roots")


def crossing(held: DataFrame, threshold: float) -> DataFrame:
    """Links (``node``, ``nbr``) that join all components between which nodes of ``held`` (few enough for a task) link."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        table = pa.Table.from_batches(own)
        node, x = table.column("node").to_numpy(), matrix(table.column("vector"))
        root = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]
        union, found = Union(np.arange(root.max() + 1)), []
        for s in range(0, len(node), BLOCK):
            i, j = np.nonzero(x[s : s + BLOCK] @ x.T >= threshold)
            label = union.labels()
            apart = label[root[i + s]] != label[root[j]]
            i, j = i[apart] + s, j[apart]
            chosen = union.joined(root[i], root[j])
            found += zip(node[i[chosen]].tolist(), node[j[chosen]].tolist())
        yield record(PAIRS, [a for a, _ in found], [b for _, b in found])

    made = held.select("node", "root", "vector").coalesce(1).mapInArrow(run, "a long, b long")
    return stage(made.select(F.col("a").alias("node"), F.col("b").alias("nbr")), "crossing")


def bridged(lists: DataFrame, roots: DataFrame, vectors: DataFrame, threshold: float, k: int) -> DataFrame:
    """``roots`` with the links that ``lists`` of ``k`` had no room for, as far as they join components.

    A link is in neither end's list only if both lists are full of links.  At most ``DIRECT`` such
    nodes are all compared with each other.  More of them get lists of neighbours in other components
    instead, until none of these is full of links: each turn joins components, so the turns end.
    """
    guide, turn = None, 0
    while True:
        links = lists.where(F.col("sim") >= threshold)
        full = links.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("node")
        held = stage(vectors.select("node", "vector").join(full, "node").join(roots, "node"), "full")
        low, high, nodes = held.agg(F.min("root"), F.max("root"), F.count("*")).first()
        if low == high:
            return roots
        if nodes <= DIRECT:
            links = crossing(held, threshold)
            return roots if links.isEmpty() else rejoined(roots, links)
        turn += 1
        guide = links if guide is None else guide.unionByName(links)
        lists = descend(held, nodes, threshold, k, 1000 * k + 10 * turn, guide)
        links = lists.where(F.col("sim") >= threshold)
        if links.isEmpty():
            return roots
        roots = rejoined(roots, links)


def audited(
    roots: DataFrame, vectors: DataFrame, nodes: int, threshold: float, at: int, whole: bool = False
) -> tuple[Audit, DataFrame, int]:
    """Audit of ``roots`` by nodes not compared so far, the links that it saw missing, and where to go on.

    Nodes are dealt into slices of about ``AUDIT`` by a hash; those before ``at`` are left out.  Slices
    are compared with all vectors, each pass more of them, until ``LINKED`` nodes had links, or to the last if ``whole``.  A
    link counts as found if its ends are in one component, where all are compared.
    """
    slices = max(1, -(-nodes // AUDIT))
    table = stage(vectors.select("node", "vector").join(roots, "node"), "audit")
    number = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(slices))
    found, width, sums, links, share = None, 1, (0, 0, 0, 0.0), 0, 1.0
    while at < slices and (whole or sums[0] < LINKED):
        chosen = table.where((number >= at) & (number < at + width)).toArrow()
        at, width = min(slices, at + width), min(4 * width, max(1, PASS // AUDIT))
        if not chosen.num_rows:
            continue
        shared = vectors.sparkSession.sparkContext.broadcast(
            (chosen.column("node").to_numpy(), chosen.column("root").to_numpy(), matrix(chosen.column("vector")))
        )

        def brute(batches, shared=shared) -> Iterator[pa.RecordBatch]:
            ids, root, x = shared.value
            n, got = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for batch in batches:
                other, other_root = batch.column("node").to_numpy(), batch.column("root").to_numpy()
                close = x @ matrix(batch.column("vector")).T >= threshold
                close &= ids[:, None] != other[None, :]
                i, j = np.nonzero(close)
                same = root[i] == other_root[j]
                n += np.bincount(i, minlength=len(ids))
                got += np.bincount(i[same], minlength=len(ids))
                none = np.zeros((~same).sum(), np.int64)
                yield record(SEEN, ids[i[~same]], other[j[~same]], none, none)
            some = np.flatnonzero(n)
            yield record(SEEN, ids[some], pa.nulls(len(some), pa.int64()), n[some], got[some])

        seen = stage(table.mapInArrow(brute, "node long, nbr long, n long, got long"), "audit-links")
        found = seen if found is None else found.unionByName(seen)
        own = seen.groupBy("node").agg(F.sum("n").alias("n"), F.sum("got").alias("got"))
        own = own.agg(F.count("*"), F.sum("n"), F.sum("got"), F.sum(F.col("got") / F.col("n"))).first()
        sums = tuple(x + (y or 0) for x, y in zip(sums, own))
        shared.unpersist()
    if sums[0]:
        share = float(min(sums[2] / sums[1], sums[3] / sums[0]))
    missing = vectors.select("node", F.col("node").alias("nbr")).where("false") if found is None else found.where("nbr is not null")
    return Audit(share, int(sums[1]), int(sums[0]), at >= slices), missing.select("node", "nbr"), at


def joined(vectors: DataFrame, nodes: int, threshold: float, exact: bool = False) -> tuple[DataFrame, Audit]:
    """``node``, ``root`` (its component) for all ``vectors`` (``node``, ``vector``), and the audit that it passed.

    After an audit that falls short, the search goes on from what is known, by other directions and longer
    lists, and other nodes audit it.  Links that an audit saw missing are kept.  If the longest lists fall
    short as well, the audit goes on to the last node when ``exact``, so that every component is
    known, and raises ``RuntimeError`` otherwise.
    """
    lists, _, k = graph(vectors, nodes, threshold)
    links = lists.where(F.col("sim") >= threshold).select(F.col("node").alias("a"), F.col("nbr").alias("b"))
    first = vectors.select("node").join(connected(links, "vector-components"), "node", "left")
    roots = stage(first.select("node", F.coalesce("root", "node").alias("root")), "vector-roots")
    at = 0
    while True:
        roots = bridged(lists, roots, vectors, threshold, k)
        audit, missing, at = audited(roots, vectors, nodes, threshold, at)
        log.info("lists of %d neighbours: %s", k, audit)
        if not missing.isEmpty():
            roots = rejoined(roots, missing)
        if audit.share >= RECALL or audit.whole:
            return roots, audit
        if k >= MOST and exact:
            audit, missing, _ = audited(roots, vectors, nodes, threshold, at, whole=True)
            return (roots if missing.isEmpty() else rejoined(roots, missing)), audit
        if k >= MOST:
            raise RuntimeError(f"lists of {k} neighbours lead to {audit.share:.3f} of {audit.links} audited links")
        k *= 2
        held = stage(vectors.select("node", "vector").join(roots, "node"), "again")
        lists = descend(held, nodes, threshold, k, 1000 * k + 500, lists)
        roots = rejoined(roots, lists.where(F.col("sim") >= threshold))


def linked_within(groups: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``links`` of every node of ``groups`` (``node``, ``root``): all in its component that are close enough.

    Links count as often as their vector occurs (``times``).  Components are
    compared in cells of two tiles of at most about ``TILE`` bytes, so none has to fit into a task, and a vector is
    copied once per tile of its component.  Components of more than ``LEAST`` are cut into up to ``SPREAD`` tiles in any case, so
    that more tasks share the largest.
    """
    length = vectors.select(F.size("vector")).first()
    tile = max(BLOCK, TILE // (8 * max(1, length[0]))) if length else BLOCK
    n = F.count("*")
    blocks = F.greatest(F.ceil(n / float(tile)), F.least(F.lit(SPREAD), F.ceil(n / float(LEAST)))).cast("long")
    sizes = groups.groupBy("root").agg(blocks.alias("blocks"))
    dealt = groups.join(sizes, "root").select("node", "root", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("own"))
    dealt = dealt.join(vectors.select("node", "vector", "times"), "node")
    # Each block once as rows of every pair of blocks it is in.
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = pairs.select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "vector", "times"
    )
    cells = pairs.withColumn("cell", F.xxhash64("root", "i", "j"))
    out = pa.schema([("node", pa.int64()), ("links", pa.int64())])

    def run(key, table):
        x, node, times, own = (matrix(table.column("vector")), *(table.column(c).to_numpy() for c in ("node", "times", "own")))
        i, j, root = (table.column(c).to_numpy() for c in ("i", "j", "root"))
        found = []
        for r, a, b in {*zip(root.tolist(), i.tolist(), j.tolist())}:  # more than one if hashes collide
            here = (root == r) & (i == a) & (j == b)
            left, right = np.flatnonzero(here & (own == a)), np.flatnonzero(here & (own == b))
            for s in range(0, len(left), BLOCK):
                rows = left[s : s + BLOCK]
                near = x[rows] @ x[right].T >= threshold
                near &= node[rows][:, None] != node[right][None, :]
                found.append((node[rows], near @ times[right]))
                if a != b:
                    found.append((node[right], near.T @ times[rows]))
        return pa.Table.from_batches([record(out, *map(np.concatenate, zip(*found)))])

    counted = cells.groupBy("cell").applyInArrow(run, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, exact: bool = False
) -> DataFrame:
    """The table of ``near_audited``."""
    return near_audited(rows, vec_id, vector, threshold, exact)[0]


def near_audited(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, exact: bool = False
) -> tuple[DataFrame, dict[int, Audit]]:
    """``vec_id``, ``n_links``, ``component_id`` for every row, and by length of vectors the audit of the result.

    Two rows link when the cosine of their vectors is at least ``threshold``.  Vectors that
    are null, empty, zero, or hold null or non-finite numbers link with nothing, and so do vectors of
    different lengths.  ``component_id`` is the smallest id that links lead to; repeated
    rows link with each other; a null id is its own component unless it is linked.
    If the longest lists do not pass their audit, all vectors are compared, some at a time, when ``exact``; otherwise
    there is no result (``RuntimeError``).
    """
    base = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.coalesce(
        (F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    # Equal vectors have equal bits once -0.0 is 0.0.
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    base = base.select("vec_id", F.when(good, plain).alias("vector")).withColumn(
        "name", F.when(F.col("vector").isNotNull(), F.sha2(F.concat_ws(",", F.transform("vector", lambda x: x.cast("string"))), 256))
    )
    base = stage(base, "vectors")
    nodes = base.where("name is not null").groupBy("name").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("times"), F.first("vector").alias("vector")
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    results, audits = [], {}
    for length in [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]:
        own = nodes.where(F.size("vector") == length)
        roots, audits[length] = joined(own, own.count(), threshold, exact)
        groups = roots.join(roots.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root"), "root")
        counted = linked_within(groups, own, threshold)
        low = groups.join(own.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("c"))
        found = groups.join(low, "root").join(counted, "node", "left").select("node", "c", "links")
        results.append(stage(found, "links"))
    named = nodes.select("name", "node", "low", "times")
    for k, found in enumerate(results):
        together = found if not k else together.unionByName(found)
    if results:
        named = named.join(together, "node", "left")
    else:
        named = named.withColumn("c", F.lit(None).cast(base.schema["vec_id"].dataType)).withColumn("links", F.lit(None).cast("long"))
    named = named.select("name", F.coalesce("c", "low").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"))
    found = base.drop("vector").join(named, "name", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")
    )
    return found, audits
