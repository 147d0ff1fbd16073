"""Near-duplicate vectors and quality scores against brute force and held-out labels."""

import numpy as np
import pytest
from helpers import components, crc, docs, sentences

from fleetlens.llm import nn_descent, quality
from fleetlens.llm.common import configure
from fleetlens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, node int, vector string, times int, root long"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    configure(spark)


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2, 3) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def expected(vectors, threshold=0.95):
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(v, np.float32).astype(float) if usable(v) else None for v in vectors]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    links = [
        (i, j)
        for i in range(len(units))
        for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold
    ]
    root, n = components(range(len(units)), links), np.zeros(len(units), int)
    for pair in links:
        n[list(pair)] += 1
    return {i: (n[i], root[i]) for i in range(len(units))}


def clusters(seed, sizes, dimensions=32, noise=0.03):
    r = np.random.default_rng(seed)
    return [c + noise * r.standard_normal(dimensions) for n in sizes for c in [r.standard_normal(dimensions)] for _ in range(n)]


def test_links_and_components(spark):
    vectors = clusters(1, [1] * 150 + [2] * 20 + [5] * 10 + [120, 700])
    vectors += [vectors[0], vectors[0], vectors[0] * 1000, None, [], [0.0] * 32, [1.0] * 31 + [None], [1.0] * 31 + [float("nan")]]
    vectors += [[1.0] * 31 + [float("inf")], [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0], [1e30] * 32]
    found = nn_descent.near(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected(vectors)
    assert len(found) == len(vectors)


def test_chains_are_one_component(spark):
    angle = np.arange(60) * 0.2
    vectors = [np.array([np.cos(a), np.sin(a)] + [0.0] * 6) for a in angle[:20]]
    found = nn_descent.near(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected(vectors)
    assert {r.component_id for r in found} == {0}


def test_awkward_tables(spark):
    assert nn_descent.near(frame(spark, [])).collect() == []
    found = nn_descent.near(frame(spark, [None, [0.0]])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [(0, 0, 0), (1, 0, 1)]
    found = nn_descent.near(frame(spark, [[1.0, 0], [1.0, 0], [0, 1.0]], ids=[None, 4, None])).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in found], key=str) == [(4, 1, 4), (None, 0, None), (None, 1, 4)]


def test_audit_sees_missing_links(spark):
    vectors = nn_descent.stage(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clusters(2, [4] * 50))], "node long, vector array<double>"), "v"
    )
    lists, recall, _ = nn_descent.graph(vectors, 200, 0.95)
    assert recall >= 0.95 == nn_descent.RECALL
    assert nn_descent.recall(lists.where("node % 4 > 1"), vectors, 0.95, 8) < 0.8


def nested(seed, groups, of, dimensions=64):
    """Pairs of tight groups: cosines are about 0.999 inside a group and 0.96 between the two."""
    r = np.random.default_rng(seed)
    found = []
    for _ in range(groups):
        a, b = np.linalg.qr(r.standard_normal((dimensions, 2)))[0].T
        for c in (a, 0.962 * a + np.sqrt(1 - 0.962**2) * b):
            found += [c + 0.003 * r.standard_normal(dimensions) for _ in range(of)]
    return found


def test_full_lists_hide_no_links(spark):
    vectors = nested(3, 3, 20) + nested(4, 1, 700) + clusters(5, [1] * 300, 64)
    table = nn_descent.stage(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "node long, vector array<double>"), "v")
    lists, _, k = nn_descent.graph(table, len(vectors), 0.95)
    alone = table.select("node", nn_descent.F.col("node").alias("root"))
    roots = nn_descent.rejoined(alone, lists.where("sim >= 0.95"))
    whole = {r.node: r.root for r in nn_descent.bridged(lists, roots, table, 0.95, k).collect()}
    truth = expected(vectors)
    assert whole == {i: root for i, (_, root) in truth.items()}
    found = nn_descent.near(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == truth


def no_edges(vectors, *_):
    return vectors.select("node", nn_descent.F.col("node").alias("nbr"), nn_descent.F.lit(0.0).alias("sim")).where("false")


def test_few_links_are_audited_too(spark, monkeypatch):
    vectors = clusters(6, [1] * 1500 + [2], 64)
    monkeypatch.setattr(nn_descent, "neighbours_along", no_edges)  # a search that finds nothing
    found = nn_descent.near(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected(vectors)


def test_missed_audit_is_no_result(spark, monkeypatch):
    vectors = clusters(7, [2] * 200, 64)
    monkeypatch.setattr(nn_descent, "AUDIT", 16)
    monkeypatch.setattr(nn_descent, "LINKED", 4)
    assert nn_descent.near_audited(frame(spark, vectors))[1][64].share >= nn_descent.RECALL
    monkeypatch.setattr(nn_descent, "MOST", 8)
    monkeypatch.setattr(nn_descent, "neighbours_along", no_edges)
    with pytest.raises(RuntimeError):
        nn_descent.near(frame(spark, vectors))


def test_missed_audit_goes_on_exactly(spark, monkeypatch):
    vectors = clusters(7, [2] * 200 + [1] * 50, 64)
    for name, value in (("AUDIT", 16), ("LINKED", 4), ("MOST", 8), ("PASS", 64)):
        monkeypatch.setattr(nn_descent, name, value)
    monkeypatch.setattr(nn_descent, "neighbours_along", no_edges)
    found, audits = nn_descent.near_audited(frame(spark, vectors), exact=True)
    assert {r.vec_id: (r.n_links, r.component_id) for r in found.collect()} == expected(vectors)
    assert audits[64].whole and audits[64].share < nn_descent.RECALL


def test_many_full_lists_look_in_other_components(spark, monkeypatch):
    vectors = nested(3, 3, 20) + nested(8, 1, 60) + clusters(5, [1] * 100, 64)
    monkeypatch.setattr(nn_descent, "DIRECT", 0)
    found = nn_descent.near(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected(vectors)


def test_components_in_one_task_and_in_many(spark, monkeypatch):
    r = np.random.default_rng(9)
    pairs = [tuple(map(int, p)) for p in r.integers(0, 400, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    truth = components(sorted({x for p in pairs for x in p}), pairs)
    links = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    for small in (1 << 20, 16):
        monkeypatch.setattr(nn_descent, "SMALL", small)
        found = {x.node: x.root for x in nn_descent.connected(links, "c").collect()}
        assert {n: found.get(n, n) for n in truth} == truth
    assert nn_descent.connected(links.where("false"), "c").collect() == []


def test_components_of_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "TILE", 1)
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    vectors = clusters(10, [1] * 20 + [100, 37, 3], 32, 0.04)
    found = nn_descent.near(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected(vectors)


def test_vectors_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    truth = expected([rows[i] for i in range(len(rows))])
    found = QUERIES["op9_nn_descent"](spark, sf).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == truth
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_quality_votes(spark):
    good = [t.capitalize() + "." for t in sentences(1, 60, 40)]
    bad = [" | ".join(t.upper().split(" ")) + " !!!" for t in sentences(2, 60, 30)]
    texts = good + bad + [None, "", good[0], bad[0], (bad[1] + " ") * 2000]
    table = docs(spark, texts)
    labels = spark.createDataFrame(
        [(i, int(i < 60), 0, "t") for i in range(0, 120, 2)] + [(0, None, 0, "t"), (None, 1, 0, "t"), (999, 0, 0, "t"), (0, 0, 0, "t")],
        "doc_id long, quality int, toxic int, text string",
    )
    model = quality.fit(table, labels)
    assert np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-4)
    found = {r.doc_id: r.score for r in quality.score(table, model).collect()}
    assert len(found) == len(texts) and all(0 <= s <= 1 for s in found.values())
    assert all(found[i] > 0.8 for i in range(1, 60, 2)) and all(found[i] < 0.2 for i in range(61, 120, 2))
    assert found[120] == found[121] and found[124] < 0.2
    small = quality.fit(table, labels, sample=10)
    assert len(small.labels) == 10 and small.labels.sum() == 5
    nothing = quality.fit(table, labels.where("false"))
    assert {r.score for r in quality.score(table, nothing).collect()} == {0.5}
    assert quality.score(table.where("false"), model).collect() == []


def test_neighbours_are_exact():
    r = np.random.default_rng(4)
    vectors = quality.unit(r.standard_normal((300, 8)).astype(np.float32))
    labels = r.integers(0, 2, 300).astype(float)
    model = quality.Model(np.ones(8, np.float32), np.eye(8, dtype=np.float32), vectors, labels, 0.5)
    model.place = lambda *_: vectors[:20]
    import pyarrow as pa

    got = model.scores(pa.array(["x"] * 20), 5)
    for i in range(20):
        near = sorted(range(300), key=lambda j: -float(vectors[i] @ vectors[j]))[:5]
        weight = np.array([max(float(vectors[i] @ vectors[j]), 0) ** 8 + 1e-9 for j in near])
        assert got[i] == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-3)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_quality"](spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert len(rows) > 500 and all(crc(r.doc_id, 5) == 0 for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows) > 0.97


def test_text_ids_without_any_vector(spark):
    rows = spark.createDataFrame([("a", None), ("b", [0.0])], "vec_id string, embedding array<double>")
    assert sorted(map(tuple, nn_descent.near(rows).select("vec_id", "n_links", "component_id").collect())) == [("a", 0, "a"), ("b", 0, "b")]
