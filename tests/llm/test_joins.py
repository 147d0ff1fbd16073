"""Links between similar texts, and packing, against plain Python."""

import random
import zlib

import numpy as np
import pytest
from helpers import changed, components, docs, sentences, spaced

from fleetlens.llm import ngram_join, packing
from fleetlens.llm.common import configure
from fleetlens.llm.queries import QUERIES, RANKS, VOCABULARY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    configure(spark)


def shingles(text, n=3):
    w = spaced(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def similar(texts, percent=90):
    sets = [shingles(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return sets, links


def check(spark, texts, percent=90):
    sets, links = similar(texts, percent)
    root = components(range(len(texts)), links)
    found = ngram_join.similar(docs(spark, texts), percent=percent).collect()
    assert len(found) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(sets[i]), root[i]) for i in range(len(texts))}


@pytest.mark.parametrize("percent", [90, 60])
def test_near_copies(spark, percent):
    r = random.Random(5)
    texts = sentences(5, 12, 90, vocabulary=3000)
    common = " ".join(texts[0].split(" ")[:30])
    for t in texts[:12]:
        texts += [changed(t, r, r.randint(1, 4)) for _ in range(6)]
    chain = texts[3]
    for _ in range(25):  # each close to the last, the ends far apart
        chain = changed(chain, r, 1)
        texts.append(chain)
    texts += [common + " " + t for t in sentences(6, 25, 60, vocabulary=3000)]
    texts += [None, "", " \t ", "one", "One", "one two", "ONE  two", "one two three", "x", None, texts[0], texts[0]]
    texts += ["a b c d " * 4000, "a b c d " * 4001]
    check(spark, texts, percent)


@pytest.mark.parametrize("part", [8, 512])
def test_many_near_copies(spark, part, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART", part)
    monkeypatch.setattr(ngram_join, "CELLS", 4 * part)
    r = random.Random(8)
    start = sentences(7, 1, 100, vocabulary=3000)[0]
    check(spark, [changed(start, r, r.randint(0, 5)) for _ in range(100)] + sentences(8, 20, 100))


def test_links_at_the_threshold(spark):
    words = [f"w{i}" for i in range(22)]
    # 20 and 19 of 19 + 1 shingles; 19 of 21 in the second pair.
    check(spark, [" ".join(words), " ".join(words[:-1]), " ".join(words[:-1] + ["x"]), " ".join(words[:-2])])


def test_empty_and_null_ids(spark):
    assert ngram_join.similar(docs(spark, [])).collect() == []
    rows = ngram_join.similar(docs(spark, ["a b c d", "a b c d", "q"], ids=[None, 4, None])).collect()
    assert sorted([(r.doc_id, r.component_id) for r in rows], key=str) == [(4, 4), (None, 4), (None, None)]


def test_components_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    sets, links = similar([r.text for r in table])
    ids = [r.doc_id for r in table]
    root = components(ids, [(ids[a], ids[b]) for a, b in links])
    found = QUERIES["op8_ngram_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), root[i]) for i, s in zip(ids, sets)}
    assert len(set(root.values())) < len(ids)


def windows(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(VOCABULARY)
    texts = sentences(1, 40, 300) + [None, "", "x", "it's   <|endoftext|> \n\n 12 ünï", "word " * 30000, "same", "same", "👍 " * 50]
    table = packing.tokenize(docs(spark, texts), VOCABULARY, RANKS)
    rows = packing.pack(table, group=64).collect()
    windows(rows, 2048)
    whole = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        whole.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    for i, text in enumerate(texts):
        ids = np.frombuffer(b"".join(x[1] for x in sorted(whole[i])), "<u4").tolist()
        assert ids == [*reference.encode(text or "", add_special_tokens=False).ids, 1]
        assert {x[2] for x in whole[i]} == {len(ids)}


def test_packing_of_the_table(spark):
    rows = QUERIES["op7_packing"](spark, SF).collect()
    by = windows(rows, 2048)
    total = sum(r.length for r in rows)
    assert sum(r.doc_tokens for r in rows if r.start == 0) == total
    assert total / (2048 * len(by)) > 0.97


def test_packed_ids_are_what_the_query_sums(spark, monkeypatch):
    own = packing.pack
    reverse = packing.F.reverse(packing.F.hex("ids"))
    monkeypatch.setattr(packing, "pack", lambda t: own(t).withColumn("ids", packing.F.unhex(reverse)))
    changed_ids = {(r.doc_id, r.start): r.ids_crc32 for r in QUERIES["op7_packing"](spark, SF).collect()}
    monkeypatch.setattr(packing, "pack", own)
    found = {(r.doc_id, r.start): r.ids_crc32 for r in QUERIES["op7_packing"](spark, SF).collect()}
    assert found.keys() == changed_ids.keys() and found != changed_ids
    pieces = packing.tokenize(spark.read.parquet(f"{SF}/documents.parquet"), VOCABULARY, RANKS, with_ids=False).collect()
    assert found == {(r.doc_id, r.start): r.ids_crc32 for r in pieces}


def test_full_pieces_stay_where_they_lie(spark):
    rows = [(i, s, n, 0, 8 * 2048 + 9, i * 10 + s // 2048) for i in range(40) for s, n in packing.cut(8 * 2048 + 9, 2048, 512)]
    table = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, unit long")
    found = packing.pack(table.repartition(4)).withColumn("task", packing.F.spark_partition_id()).collect()
    full = [r for r in found if r.length == 2048]
    assert len(full) == 320 == len({r.sequence_id for r in full}) and {r.offset for r in full} == {0}
    assert len({r.task for r in full}) > 1  # there is but one group of rests
    assert {r.task for r in full}.isdisjoint({r.task for r in found if r.length < 2048})
    windows(found, 2048)
    assert sorted((r.doc_id, r.start, r.length) for r in found) == sorted(r[:3] for r in rows)


def test_packing_of_nothing(spark):
    assert packing.pack(packing.tokenize(docs(spark, []), VOCABULARY, RANKS)).collect() == []


def test_differencing_is_even_and_complete():
    r = np.random.default_rng(2)
    for n, k in ((1, 3), (5, 5), (40, 7), (300, 60)):
        sizes = np.sort(r.integers(1, 513, n))[::-1]
        found = packing.differencing(sizes, k)
        assert found.min() >= 0 and found.max() < k
        sums = np.bincount(found, sizes, minlength=k)
        if n >= 5 * k:
            assert sums.max() - sums.min() < 60
    sums = np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])
    assert sorted(sums) == [14, 16]  # what differencing gives for these numbers


def test_window_count_rises_when_capacity_is_exceeded():
    found = packing.assign(np.array([6, 6, 6]), 9)  # 18 tokens would need two windows
    assert len(set(found.tolist())) == 3
