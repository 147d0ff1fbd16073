"""Links between members of the same list, of which only a spanning forest leaves the tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import record, stage

#: Members of a list that are compared at once, cells that a task compares, and pairs looked at together.
PART, CELLS, PAIRS = 512, 64, 200_000

#: Given the rows of a bucket, a test of two arrays of row numbers.
Alike = Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], np.ndarray]]


class Union:
    """Sets of numbers below ``n``, joined pair by pair."""

    def __init__(self, first: np.ndarray):
        self.root = first.copy()

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def labels(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return up
            self.root = up

    def joined(self, i: np.ndarray, j: np.ndarray) -> list[int]:
        """Numbers of the pairs that join two sets, taken in order."""
        found, todo, step = [], np.arange(len(i)), 256
        while len(todo):
            for k in todo[:step].tolist():
                a, b = self.find(int(i[k])), self.find(int(j[k]))
                if a != b:
                    self.root[max(a, b)] = min(a, b)
                    found.append(k)
            todo, step = todo[step:], step * 2
            label = self.labels()
            todo = todo[label[i[todo]] != label[j[todo]]]
        return found


def pairs_of(cells: np.ndarray):
    """Row numbers (i, j) of all pairs within a cell, some at a time."""
    order = np.argsort(cells, kind="stable")
    ordered = cells[order]
    following = np.searchsorted(ordered, ordered, "right") - np.arange(len(order)) - 1
    reach, at = np.cumsum(following), 0
    while at < len(order):
        last = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PAIRS, "right")))
        count = following[at:last]
        i = np.repeat(np.arange(at, last), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        yield order[i], order[j]
        at = last


def links(listed: DataFrame, alike: Alike, name: str) -> DataFrame:
    """``a``, ``b``: links that connect all members (``node``) which links within any list connect.

    ``listed`` has ``list``, ``node`` (long), ``root`` (of equal ones no pair is
    compared) and what ``alike`` looks at.  A long list is cut into parts, and each two of them
    meet in a cell, so no task gets a whole list; a bucket of cells returns fewer
    links than it has members.
    """
    lists = listed.groupBy("list").agg(
        F.ceil(F.count("*") / float(PART)).cast("int").alias("parts"), F.min("root").alias("x"), F.max("root").alias("y")
    )
    lists = stage(lists.where("x <> y").select("list", "parts"), f"{name}-lists")
    total = lists.agg(F.sum(F.col("parts") * (F.col("parts") + 1) / 2)).first()[0] or 0
    dealt = listed.join(lists, "list").withColumn("__part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    dealt = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("list", F.least("__part", "__other"), F.greatest("__part", "__other"))
    dealt = dealt.select(
        F.pmod(cell, F.lit(max(1, int(total) // CELLS))).alias("bucket"), cell.alias("cell"),
        (F.col("__part") - F.col("__other")).alias("side"), *[c for c in listed.columns if c != "list"],
    )
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key, table):
        cells, side, node, root = (table.column(c).to_numpy() for c in ("cell", "side", "node", "root"))
        test, number = alike(table), np.unique(root, return_inverse=True)[1]
        member = np.unique(node, return_index=True, return_inverse=True)
        first = np.zeros(number.max() + 1, np.int64)
        first[number] = member[2]
        union, found = Union(np.arange(len(member[0]))), []
        union.joined(member[2], first[number])  # members of one root are together from the start
        for i, j in pairs_of(cells):
            label = union.labels()
            keep = (label[member[2][i]] != label[member[2][j]]) & ((side[i] == 0) | (np.sign(side[i]) != np.sign(side[j])))
            i, j = i[keep], j[keep]
            if len(i):
                good = test(i, j)
                i, j = i[good], j[good]
                chosen = union.joined(member[2][i], member[2][j])
                found += [(node[i[k]], node[j[k]]) for k in chosen]
        found = sorted({(min(a, b), max(a, b)) for a, b in found})
        return pa.Table.from_batches([record(out, [int(a) for a, _ in found], [int(b) for _, b in found])])

    return stage(dealt.groupBy("bucket").applyInArrow(run, "a long, b long"), f"{name}-links")
