"""Stages on the awkward rows, and the whole against its parts in plain Python."""

import random

import corpus_pipeline
import pytest
from helpers import changed, components, docs, sentences
from test_filters import base, occurrences
from test_joins import similar, windows

from fleetlens.llm import langid, ngram_join
from fleetlens.llm.common import configure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    configure(spark)


def test_one_row_of_each_component_stays(spark):
    r = random.Random(1)
    texts = sentences(1, 5, 90, vocabulary=2000)
    texts += [changed(t, r, 1) for t in texts] + [None, None, "", texts[0], texts[1], texts[1]]
    ids = [*range(10), 10, 10, 11, 0, None, 1]
    frame = docs(spark, texts, ids=ids)
    kept = ngram_join.one_of_each(frame)
    assert kept.columns == frame.columns
    found = sorted(kept.collect(), key=lambda x: (x.doc_id, x.text or ""))
    assert [(x.doc_id, x.text) for x in found] == [*zip(range(5), texts[:5]), (10, None), (10, None), (11, "")]


def test_short_clean_texts_have_a_language(spark):
    texts = ["abcde fghij", "klmno pqrst", "uvwxy zuvwx", "Ωδη", None, "", "12 !"]
    frame = docs(spark, texts, langs=["a", "b", "c", "a", "a", "a", "a"])
    model = langid.fit(frame.where("doc_id < 3"))
    assert {r.doc_id: r.score for r in langid.predict(frame, model).collect()}[3] < 0.5
    assert sorted(r.doc_id for r in langid.recognized(frame, model).collect()) == [0, 1, 2, 3]


def test_language_stage_uses_its_model(spark):
    texts = ["abab baba abba", "cdcd dcdc cddc"] * 6 + ["abba abab", "dccd cdcd", "...", None]
    labels = ["a", "c"] * 6 + [None, "a", "c", "a"]
    found = corpus_pipeline.language(spark, docs(spark, texts, langs=labels), SF)
    assert {r.doc_id: r.lang for r in found.collect()} == {i: "ac"[i % 2] for i in range(14)}
    unknown = corpus_pipeline.language(spark, docs(spark, texts, langs=[None] * 16), SF)
    assert {r.doc_id: r.lang for r in unknown.collect()} == dict.fromkeys(range(14))


def test_staged_tables_go(spark):
    from fleetlens.llm.common import stage, temporary

    frame = stage(docs(spark, ["a"]), "kept")
    with temporary(spark):
        lost = stage(docs(spark, ["b"]), "lost")
        assert lost.count() == 1
    assert frame.count() == 1
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST|PATH_NOT_FOUND"):
        lost.count()


def test_every_stage_takes_awkward_rows(spark):
    texts = [None, "", "...", "a", "the house " * 3000, "user: bob", *sentences(4, 4), None]
    frame = docs(spark, texts, ids=[None, 1, 1, *range(3, len(texts))])
    for table in (frame, frame.where("false")):
        for name, function in corpus_pipeline.STAGES[:-1]:
            assert function(spark, table, SF).columns == frame.columns, name
            assert function(spark, table, SF).count() <= table.count()
        corpus_pipeline.STAGES[-1][1](spark, table, SF).count()


def test_whole(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r.text or "")]  # all languages of this table are told apart
    _, links = similar([r.text for r in rows])
    root = components(range(len(rows)), links)
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    rows = [r for r in rows if not occurrences(r.text, items)[1]]
    found = corpus_pipeline.run(spark, SF).collect()
    windows(found, 2048)
    assert {x.doc_id for x in found} == {r.doc_id for r in rows}
    secret = {r.doc_id for r in rows if base(r.text)}
    total = {x.doc_id: x.doc_tokens for x in found}
    from tokenizers import Tokenizer

    from fleetlens.llm.queries import VOCABULARY

    encode = Tokenizer.from_file(VOCABULARY)
    for r in rows:
        tokens = len(encode.encode(r.text, add_special_tokens=False).ids) + 1
        assert (total[r.doc_id] == tokens) or r.doc_id in secret
