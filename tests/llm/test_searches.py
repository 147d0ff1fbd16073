"""Fingerprints, ranked search and vector codes against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, lower, sentences

from fleetlens.llm import edit_embedding as ee
from fleetlens.llm import forest, ranked_search, vector_codes
from fleetlens.llm.common import configure, flat
from fleetlens.llm.words import ALPHANUMERIC

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    configure(spark)


# Fingerprints


def edited(text, r, times):
    text = list(text)
    for _ in range(times):
        at, what = r.randrange(len(text)), r.random()
        if what < 0.4:
            text[at] = "q"
        elif what < 0.7:
            text.insert(at, "z")
        else:
            del text[at]
    return "".join(text)


def test_walks_are_those_of_the_shared_bits():
    texts = ["", "a", "aé漢😀 b", *sentences(1, 30, 40), "".join(sentences(2, 3, 900))]
    table = ee.dwell(0).reshape(ee.CLASSES, -1)
    for text, found in zip(texts, ee.fingerprint(texts)):
        classes, marks = ee.symbols(np.array([ord(c) for c in text], np.uint32))
        walked = []
        for c, m in zip(classes.tolist(), marks.tolist()):
            walked += [m] * int(table[c][len(walked) % ee.PERIOD])
        level = ee.level_of(len(walked))
        assert len(walked) >> level <= ee.POSITIONS and found[0] == level
        expected = [walked[p] if p < len(walked) else 0 for p in ee.sampled(level, -(-len(walked) >> level)).tolist()]
        assert list(found[1:]) == (expected if walked else [])


def test_samples_are_nested():
    fine = set(ee.sampled(2, 4096).tolist())
    assert set(ee.sampled(5, 512).tolist()) <= fine
    text = "".join(sentences(5, 1, 400))
    one, longer = ee.fingerprint([text, text + "".join(sentences(6, 1, 1200))])
    assert longer[0] > one[0]
    assert ee.likeness(one, one) == 1 and 0.2 < ee.likeness(one, longer) < 0.4
    assert ee.likeness(*ee.fingerprint(["", ""])) == 1 and ee.likeness(*ee.fingerprint(["", "abc"])) == 0


def test_few_edits_leave_a_likeness():
    r = random.Random(3)
    text = " ".join(sentences(3, 10, 50))
    near = [max(ee.likeness(*ee.fingerprint([text, edited(text, r, 3)], k)) for k in range(ee.WALKS)) for _ in range(20)]
    far = [ee.likeness(*ee.fingerprint([text, " ".join(sentences(k, 10, 50))])) for k in range(50, 70)]
    assert np.mean(near) > 0.85 and np.max(far) < 0.3


def by_hand(rows):
    """Texts in order, with their edited texts."""
    out = []
    for k, (i, text) in enumerate(rows):
        following, cut = rows[(k + 1) % len(rows)][1], len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest(), following))
    return out


@pytest.mark.parametrize("count", [1, 2, 90])
def test_neighbours(spark, count):
    texts = (["", None, "x", "é漢😀" * 30, "long text " * 20_000] + sentences(4, 90))[:count]
    frame = docs(spark, texts)
    found = {r.doc_id: r for r in ee.neighbours(frame).collect()}
    rows = [(i, texts[i] or "") for i in reversed(range(count))]
    assert len(found) == count
    for (i, n, sha, following), (_, text) in zip(by_hand(rows), rows):
        r = found[i]
        own, other = ee.fingerprint([text, following])
        assert (r.n_chars, r.edited_sha256, bytes(r.fingerprint)) == (n, sha, own)
        assert r.near_next == ee.likeness(own, other)
        assert r.near_edited == ee.likeness(own, bytes(r.edited_fingerprint))


def test_neighbours_of_awkward_rows(spark):
    assert ee.neighbours(docs(spark, [])).collect() == []
    same = ee.neighbours(docs(spark, ["abcdef"] * 40, ids=[7] * 40)).collect()
    assert len(same) == 40 and all(r.near_edited < 1 and r.near_next == 1 for r in same)
    named = docs(spark, ["abcdef", "uvwxyz", None]).selectExpr("if(doc_id = 2, null, string(doc_id)) part", "text first", "lang last")
    found = {r.doc_id: r for r in ee.neighbours(named, "part", "first").collect()}
    assert set(found) == {"0", "1", None} and found[None].n_chars == 0
    assert found["1"].edited_sha256 == hashlib.sha256(b"uvwxab").hexdigest()
    assert found["0"].edited_sha256 == hashlib.sha256(b"abcd").hexdigest()


def test_near_texts_are_found(spark):
    r = random.Random(9)
    texts = [" ".join(sentences(k, 6, 40)) for k in range(12)]
    texts += [edited(t, r, 1) for t in texts] + [None, "", None, texts[0], texts[0]]
    found = {x.doc_id: x.component_id for x in ee.near(docs(spark, texts)).collect()}
    assert sum(found[i + 12] == i for i in range(12)) >= 11
    assert all(found[i] == i for i in [*range(12), 24, 25, 26]) and found[27] == found[28] == 0
    assert ee.near(docs(spark, [])).collect() == []


def test_a_large_group_gives_a_forest(spark, monkeypatch):
    monkeypatch.setattr(forest, "PART", 16)
    rows = [(1, n, n, n % 3) for n in range(300)] + [(2, n, n, 5) for n in range(300, 303)] + [(3, 0, 0, 0), (3, 400, 400, 1)]
    listed = spark.createDataFrame(rows, "list long, node long, root long, kind int")

    def alike(table):
        kind = table.column("kind").to_numpy()
        return lambda i, j: kind[i] == kind[j]

    links = forest.links(listed, alike, "t").collect()
    root = {n: n for n in range(401)}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for x in links:
        a, b = sorted((find(x.a), find(x.b)))
        root[b] = a
    assert [find(n) for n in range(300)] == [n % 3 for n in range(300)]
    assert [find(n) for n in (300, 301, 302, 400)] == [300, 300, 300, 400]
    assert len(links) < 20 * 300  # 19 parts: a member meets each of them once


# Ranked search


def terms(text):
    return [lower(t) for t in re.findall(TERM, text or "")]


def ranked(texts, items, top=10):
    held = [Counter(terms(t)) for t in texts]
    whole, words = sum(map(bool, held)), sum(sum(h.values()) for h in held)
    found = []
    for item, text in items:
        scores = []
        for doc, h in enumerate(held):
            score, n = 0, sum(h.values())
            for term, times in Counter(terms(text)).items():
                df = sum(term in x for x in held)
                if h[term]:
                    w = math.floor(1000 * math.log((2 * whole + 2) / (2 * df + 1)))
                    m = 100 - 75 + (75 * n * whole) // words
                    score += times * w * ((1_000_000_000 * h[term]) // (1000 * h[term] + 8 * m))
            scores.append((-score, doc))
        found += [(item, k + 1, doc, -s) for k, (s, doc) in enumerate(sorted(x for x in scores if x[0] < 0)[:top])]
    return sorted(found)


@pytest.mark.parametrize("cells", [1 << 22, 300])
def test_ranks(spark, monkeypatch, cells):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    monkeypatch.setattr(ranked_search, "FIRST", 20)
    texts = sentences(11, 400, 30, vocabulary=300) + [None, "", "...", "ONE two", "one TWO", "one two", "é漢 one"]
    texts += [texts[0]] * 15 + ["only " + texts[1] * 200]
    queries = [t[:60] for t in texts[:12]] + ["one", "Two two one", None, "", "absent", "only é漢", texts[2] * 30]
    items = spark.createDataFrame([(f"i{k}", t, "x") for k, t in enumerate(queries)], "item_id string, text string, term string")
    found = ranked_search.search(docs(spark, texts), items).collect()
    assert sorted(tuple(r) for r in found) == ranked(texts, [(f"i{k}", t) for k, t in enumerate(queries)])


def test_bounds_leave_documents_out():
    texts = ["rare " * 3 + "common"] * 12 + [f"common w{k}" for k in range(3000)] + ["other"] * 9000
    hashes = ranked_search.Words(*flat(pa.array(["rare common"])), ALPHANUMERIC).hash
    query = SimpleNamespace(terms=np.sort(hashes).tobytes(), times=np.ones(2, np.int64).tobytes())
    q = ranked_search.Queries([query])
    n, at, times = ranked_search.counted(pa.array(texts), q.terms)
    q.weigh(len(texts), int(n.sum()), np.bincount(np.concatenate(at), minlength=2))

    def bucket(rows):
        cells = {"terms": [x.tobytes() for x in at[rows]], "times": [x.tobytes() for x in times[rows]]}
        return ranked_search.Bucket(pa.RecordBatch.from_pydict({"n": n[rows], **cells}), q)

    head, tail = bucket(slice(0, 12)), bucket(slice(12, 400))
    scores = head.scores(q, *head.survivors(q, np.zeros(1)))
    assert len(scores) == 12
    assert len(tail.survivors(q, scores[:1].astype(float))[0]) == 0
    assert len(tail.survivors(q, np.zeros(1))[0]) == 388


def test_nothing_to_rank(spark):
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert ranked_search.search(docs(spark, []), items).collect() == []
    assert ranked_search.search(docs(spark, ["a", "b"], ids=[None, 3]), items.where("false")).collect() == []
    assert [tuple(r) for r in ranked_search.search(docs(spark, ["a"] * 2 + ["b"] * 3, ids=[None, 4, 1, 1, 1]), items).collect()] == [
        (1, 1, 4, ranked(["a", "b", "b", "b", "a"], [(1, "a")])[0][3]),
        (1, 2, None, ranked(["a", "b", "b", "b", "a"], [(1, "a")])[0][3]),
    ]
    assert ranked_search.search(docs(spark, [None, "", "--"]), items).collect() == []


# Vector codes


@pytest.mark.parametrize("kind", ["random", "clusters", "equal", "few"])
def test_nearest_entries_are_exact(kind):
    r = np.random.default_rng(4)
    entries = r.integers(-1000, 1000, (256, 6))
    if kind == "clusters":
        entries = r.integers(-1000, 1000, (9, 6))[r.integers(0, 9, 256)] + r.integers(-3, 3, (256, 6))
    elif kind == "equal":
        entries = entries[:1].repeat(256, 0)
    elif kind == "few":
        entries = entries[:5] // 500
    points = np.concatenate([r.integers(-1200, 1200, (500, 6)), entries, (entries[:-1] + entries[1:]) // 2])
    which, least = vector_codes.Gnat(entries).nearest(points)
    apart = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert (which == apart.argmin(1)).all() and (least == apart.min(1)).all()


def test_whole_children_are_left_out(monkeypatch):
    r = np.random.default_rng(5)
    centres = r.integers(-30_000, 30_000, (12, 6))
    entries = centres[np.arange(256) % 12] + r.integers(-40, 40, (256, 6))
    points, seen, plain = entries[r.integers(0, 256, 1000)] + r.integers(-9, 9, (1000, 6)), [], vector_codes.squares
    tree = vector_codes.Gnat(entries)
    monkeypatch.setattr(vector_codes, "squares", lambda p, e: seen.append(len(p) * len(e)) or plain(p, e))
    tree.nearest(points)
    assert sum(seen) < 0.3 * 1000 * 256


def coded(rows):
    """Codes, errors and codebooks of (id, label, vector), in plain Python."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    whole = [[math.floor(1024 * x) for x in v] for _, _, v in rows]
    width = len(whole[0]) // 4
    parts = [[tuple(v[k * width : (k + 1) * width]) for v in whole] for k in range(4)]
    books = [p[:256] for p in parts]
    near = lambda p, book: min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(book))
    for _ in range(4):
        for k in range(4):
            own = [near(p, books[k])[1] for p in parts[k]]
            books[k] = [
                tuple(sum(x) // len(x) for x in zip(*held)) if (held := [p for p, o in zip(parts[k], own) if o == e]) else book
                for e, book in enumerate(books[k])
            ]
    found = [[near(parts[k][i], books[k]) for k in range(4)] for i in range(len(rows))]
    return [(r[0], [x[1] for x in f], sum(x[0] for x in f)) for r, f in zip(rows, found)], books


def test_codes(spark):
    r = random.Random(6)
    rows = [(k, k % 3 or None, [round(r.gauss(0, 0.3), 3) for _ in range(8)]) for k in range(330)]
    rows += [(k, 1, rows[0][2]) for k in range(330, 340)]
    bad = [(-1, 1, None), (-2, 1, [0.1] * 7 + [None]), (-3, 1, [math.nan] * 8), (-4, 2, [math.inf] * 8), (-5, 2, [])]
    bad += [(400, 2, [0.5] * 12), (401, 2, [0.5] * 7)]
    frame = spark.createDataFrame(rows + bad, "vec_id int, code int, n array<double>").repartition(3)
    found, books = vector_codes.codes(frame, vector="n", label="code")
    expected, expected_books = coded(rows)
    assert [[tuple(e) for e in b.tolist()] for b in books] == expected_books
    whole = vector_codes.with_label_errors(found).collect()
    assert sorted((x.vec_id, x.code, x.error) for x in whole) == expected
    errors = Counter()
    for (_, label, _), (_, _, error) in zip(sorted(rows, key=lambda x: x[0]), expected):
        errors[label] += error
    assert {(x.label, x.label_error) for x in whole} == set(errors.items())


def test_codes_of_few_and_of_huge_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    found, books = vector_codes.codes(frame)
    assert books == [] and vector_codes.with_label_errors(found).collect() == []
    rows = [("b", [3e38] * 4, 1), ("a", [-3e38] * 4, 1), (None, [0.0] * 4, None), ("a", [-3e38] * 4, 2)]
    found, books = vector_codes.codes(spark.createDataFrame(rows, "vec_id string, embedding array<float>, label int"))
    assert [len(b) for b in books] == [4] * 4
    assert sorted((x.vec_id or "", x.code, x.error) for x in found.collect()) == [
        ("", [3] * 4, 0), ("a", [0] * 4, 0), ("a", [0] * 4, 0), ("b", [2] * 4, 0)
    ]
