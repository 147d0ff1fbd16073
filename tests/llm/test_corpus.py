"""Language-model scores and repeated passages against plain Python."""

import math
import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from helpers import alnum, changed, crc, docs, sentences, spaced

from fleetlens.llm import exchange, lm, suffixes
from fleetlens.llm.common import configure, shuffles_deleted, stage
from fleetlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", "   ", "a", "A a\ta", "ünï x\x00y", "the same line", "the same line", "w " * 30000]


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    configure(spark)


def reference_base(texts, training):
    counts = Counter(t for i in training for t in [*spaced(texts[i]), None])
    total, words = sum(counts.values()), len(counts)
    chance = lambda t: math.log10((counts[t] + 0.1) / (total + 0.1 * (words + 1)))
    tokens = [[*spaced(t), None] for t in texts]
    return [(len(x), sum(t in counts for t in x), total, sum(map(chance, x))) for x in tokens]


@pytest.mark.parametrize("block", [400, 1 << 20])
def test_unigram_base(spark, block):
    texts = TEXTS + sentences(4, 40, 30, vocabulary=60)
    found = lm.score(docs(spark, texts), "doc_id % 4 <> 0", "doc_id % 4 = 1", block=block).collect()
    expected = reference_base(texts, [i for i in range(len(texts)) if i % 4])
    assert len(found) == len(texts)
    for r in found:
        n, known, total, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def interpolated(texts, estimate, weigh, rounds=100):
    """The model with exact estimates in the place of counted cells."""

    def counted(ids):
        one, two = Counter(), Counter()
        for i in ids:
            tokens = [*spaced(texts[i]), None]
            one.update(tokens)
            two.update(zip([None, *tokens], tokens))
        return one, two

    bucket = lambda c: c.bit_length()
    one, two = counted(estimate)
    rows = []
    for i in weigh:
        tokens = [*spaced(texts[i]), None]
        for h, t in zip([None, *tokens], tokens):
            c = one[h]
            rows.append((bucket(c), [two[h, t] / c if c else 0, one[t] / sum(one.values()), 1 / (len(one) + 1)]))
    weights = defaultdict(lambda: np.full(3, 1 / 3))
    for b in {b for b, _ in rows}:
        own = np.array([p for x, p in rows if x == b])
        w = np.array([0, 0.5, 0.5]) if b == 0 else np.full(3, 1 / 3)
        for _ in range(rounds):
            part = own * w
            w = (part / part.sum(1, keepdims=True)).mean(0)
        weights[b] = w
    for b in range(max(weights) + 1, 30):
        weights[b] = weights[b - 1]
    one, two = counted([*estimate, *weigh])
    scores = []
    for text in texts:
        tokens = [*spaced(text), None]
        p = [
            weights[bucket(one[h])] @ [two[h, t] / one[h] if one[h] else 0, one[t] / sum(one.values()), 1 / (len(one) + 1)]
            for h, t in zip([None, *tokens], tokens)
        ]
        scores.append(sum(map(math.log10, p)))
    return scores


def test_interpolation(spark):
    r = random.Random(1)
    texts = [" ".join(r.choices(["a", "b", "c", "d e", "f g h"], [8, 4, 2, 1, 1], k=40)) for _ in range(60)]
    found = {x.doc_id: x.score for x in lm.score(docs(spark, texts), "doc_id % 3 <> 0", "doc_id % 3 = 1", block=900).collect()}
    expected = interpolated(texts, range(2, 60, 3), range(1, 60, 3))
    for i in range(60):
        assert found[i] == pytest.approx(expected[i], rel=0.01)


def interpolated_by_length(texts, estimate, weigh, order, rounds=100):
    """Exact estimates of n-grams up to ``order``, weights by the buckets of all contexts."""

    def counted(ids):
        found = [Counter() for _ in range(order + 1)]
        for i in ids:
            tokens = [*spaced(texts[i]), None]
            padded = [None] * (order - 1) + tokens
            for k in range(len(tokens)):
                for n in range(1, order + 1):
                    found[n][tuple(padded[k + order - n : k + order])] += 1
        return found

    def rows(text, counts):
        total, starts = sum(counts[1].values()), counts[1][(None,)]
        tokens = [*spaced(text), None]
        padded = [None] * (order - 1) + tokens
        for k in range(len(tokens)):
            p, seen = [counts[1][(tokens[k],)] / total, 1 / (len(counts[1]) + 1)], []
            for n in range(2, order + 1):
                h = tuple(padded[k + order - n : k + order - 1])
                c = starts if k == 0 else counts[n - 1][h]
                p.insert(0, counts[n][(*h, tokens[k])] / c if c else 0)
                seen.insert(0, c.bit_length())
            yield tuple(seen), p

    EVERY = (-1,) * (order - 1)
    counts = counted(estimate)
    cells = [row for i in weigh for row in rows(texts[i], counts)]
    weights = {}
    for b in {b for b, _ in cells} | {EVERY}:
        own = np.array([p for x, p in cells if b in (x, EVERY)])
        w = np.array([*(float(x != 0) for x in b), 1, 1])
        w /= w.sum()
        for _ in range(rounds):
            part = own * w
            w = (part / part.sum(1, keepdims=True)).mean(0)
        weights[b] = w
    counts = counted([*estimate, *weigh])

    def chance(b, p):
        able = np.array([*(float(x != 0) for x in b), 1, 1])
        while b not in weights:
            at = next((k for k, x in enumerate(b) if x > 1), None)
            b = EVERY if at is None else (*b[:at], b[at] - 1, *b[at + 1 :])
        w = np.maximum(weights[b], 1e-9) * able
        return float(w @ p / w.sum())

    return [sum(math.log10(chance(b, p)) for b, p in rows(text, counts)) for text in texts]


@pytest.mark.parametrize("order", [2, 3])
def test_longer_contexts(spark, order):
    r = random.Random(5)
    texts = []
    for _ in range(90):
        words = r.choices("abc", k=2)
        while len(words) < 40:
            words.append({"aa": "b", "ab": "c", "bc": "a"}.get(words[-2] + words[-1]) if r.random() < 0.7 and words[-2] + words[-1] in ("aa", "ab", "bc") else r.choice("abc"))
        texts.append(" ".join(words))
    table = docs(spark, texts)
    found = {x.doc_id: x.score for x in lm.score(table, "doc_id % 3 <> 0", "doc_id % 3 = 1", block=900, order=order).collect()}
    truth = interpolated_by_length(texts, range(2, 90, 3), range(1, 90, 3), order)
    for i in range(90):
        assert found[i] == pytest.approx(truth[i], rel=0.03 if order > 2 else 0.01)
    if order == 3:
        plain = {x.doc_id: x.score for x in lm.score(table, "doc_id % 3 <> 0", "doc_id % 3 = 1", block=900).collect()}
        assert sum(found[i] for i in range(0, 90, 3)) > sum(plain[i] for i in range(0, 90, 3))


def test_longer_contexts_of_awkward_texts(spark):
    order = 3
    found = lm.score(docs(spark, TEXTS), "doc_id % 4 <> 0", "doc_id % 4 = 1", order=order).collect()
    assert len(found) == len(TEXTS) and all(np.isfinite(r.score) and r.score <= 0 for r in found)
    same = {r.doc_id: r.score for r in found}
    assert same[6] == same[7] and same[0] == same[1] == same[2]
    assert {r.score for r in lm.score(docs(spark, [None, "", "a"]), "false", "true", order=order).collect()} == {0.0}  # V = 0
    assert lm.score(docs(spark, []), "true", "false", order=order).collect() == []
    with pytest.raises(ValueError):
        lm.score(docs(spark, TEXTS), "true", "false", order=4)


def test_only_trigrams_that_may_occur_in_other_blocks_move(spark):
    texts = ["a b c d", "x a b c", "b c d a b c", "q r s", "q r s q r s", None, "", "c d"]
    rows = docs(spark, texts).selectExpr("case when doc_id < 6 then doc_id % 2 else 2 end as flag", "doc_id", "text")
    table = exchange.blocks(rows.repartition(1), "flag", 8)
    parts = {r.block: (r.flag, exchange.rows_of(r.content).column("text").to_pylist()) for r in table.collect()}
    assert len(parts) > 4
    answers = exchange.answer(exchange.ask(table, lm.asked, 2), [np.add] * 3, "counts", lm.word_counts)
    asked = {b: set() for b in parts}
    for r in lm.next_requests(table, answers, 3, 2).collect():
        asked[r.block] |= set(np.cumsum(exchange.unplanes(r["keys"], np.uint64), dtype=np.uint64).tolist())
    held = {b: [["<s>", *spaced(t), "</s>"] for t in own] for b, (_, own) in parts.items()}
    grams = {b: [tuple(w[k : k + n]) for w in own for n in (2, 3) for k in range(len(w) - n + 1)] for b, own in held.items()}
    for b in parts:
        elsewhere = {g for o, own in grams.items() for g in own if o != b}
        longer = {g for g in grams[b] if len(g) == 3} | {("", *g) for g in grams[b] if g[0] == "<s>" and len(g) == 2}
        may = {g for g in longer if g[1:] in elsewhere and (g[0] == "" or g[:2] in elsewhere)}
        assert len(asked[b]) == len(may)
    assert 0 < sum(map(len, asked.values())) < sum(len({g for g in own if len(g) == 3}) for own in grams.values())


def test_trigrams_of_one_training_block_count_for_held_out_texts(spark):
    texts = sentences(9, 12, 40, vocabulary=2000)
    table = docs(spark, [*texts, texts[0], texts[1]])  # copies of an estimating and of a weighing text, held out
    rows = lambda **o: {r.doc_id: r.score for r in lm.score(table, "doc_id < 12", "doc_id % 3 = 1", order=3, **o).collect()}
    own = rows(block=200)
    assert own[12] == pytest.approx(own[0], rel=1e-9) and own[13] == pytest.approx(own[1], rel=1e-9)
    assert own == pytest.approx(rows(), rel=1e-9)


def shuffle_bytes(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.stat().st_size for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data"))


def test_requests_do_not_stay_on_disk(spark, monkeypatch):
    def grown():
        for _ in range(50):
            if shuffle_bytes(spark) <= before + 10_000:  # counts of blocks and the like
                break
            time.sleep(0.1)
        return shuffle_bytes(spark) - before

    setting, kept, learn = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], lm.learn
    monkeypatch.setattr(lm, "learn", lambda *a, **o: (kept.append(grown()), learn(*a, **o))[1])
    was = spark.conf.get(setting, None)
    with shuffles_deleted(spark):
        rows = stage(docs(spark, sentences(4, 150)), "rows")
    before = shuffle_bytes(spark)
    found = lm.score(rows, "doc_id % 3 <> 0", "doc_id % 3 = 1", order=3)
    # Undeleted, 18,508 bytes were measured.
    assert len(kept) == 1 and kept[0] <= 10_000
    assert found.count() == 150 and spark.conf.get(setting, None) == was


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in QUERIES["op6_lm"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(rows) > 50 and all(crc(r.doc_id, 10) == 0 for r in rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_base_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    ids = [r.doc_id for r in table]
    expected = reference_base([r.text for r in table], [k for k, i in enumerate(ids) if crc(i, 10)])
    for r in QUERIES["op6_lm"](spark, SF).collect():
        n, known, total, base = expected[ids.index(r.doc_id)]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_nothing_to_learn_from(spark):
    frame = docs(spark, ["a b", None, "c"], ids=[1, None, 1])
    found = lm.score(frame, "false", "true").collect()
    assert sorted((r.doc_id is None, r.n_tokens, r.n_known, r.score) for r in found) == [(False, 2, 0, 0), (False, 3, 0, 0), (True, 1, 0, 0)]
    assert lm.score(frame.where("false"), "true", "false").collect() == []


def stretches(texts, length):
    words = [alnum(t) for t in texts]
    holders = defaultdict(set)
    for i, w in enumerate(words):
        for k in range(len(w) - length + 1):
            holders[tuple(w[k : k + length])].add(i)
    found = set()
    for i, w in enumerate(words):
        runs = []
        for k in range(len(w) - length + 1):
            own = holders[tuple(w[k : k + length])]
            if len(own) > 1:
                if not runs or k > runs[-1][1]:
                    runs.append([k, k + length, 0, len(texts)])
                runs[-1][1:] = [k + length, max(runs[-1][2], len(own)), min(runs[-1][3], min(own))]
        found |= {(i, *r) for r in runs}
    return found


@pytest.mark.parametrize("length,gram,among,block", [(50, 8, 16, 3000), (50, 8, 16, 1 << 20), (20, 5, 9, 5000)])
def test_repeated_passages(spark, length, gram, among, block):
    r = random.Random(2)
    texts = sentences(11, 25, 260, vocabulary=5000)
    for _ in range(60):
        source = texts[r.randrange(25)].split(" ")
        a, n = r.randrange(150), r.choice([length - 1, length, length + 1, length + 10, 3 * length])
        target = r.randrange(25)
        words = texts[target].split(" ")
        at = r.randrange(len(words))
        texts[target] = " ".join(words[:at]) + " ; " + " , ".join(source[a : a + n]).upper() + ". " + " ".join(words[at:])
    texts += [None, "", "x", texts[0], texts[0], changed(texts[1], r, 3), "la " * 500, "la " * 400, "only here " * 200]
    found = suffixes.repeated(docs(spark, texts), length=length, gram=gram, among=among, block=block).collect()
    assert {tuple(x) for x in found} == stretches(texts, length)
    assert len(found) > 10


def test_passages_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert [r.doc_id for r in table] == list(range(len(table)))
    found = QUERIES["op10_suffixes"](spark, SF).collect()
    assert {tuple(x) for x in found} == stretches([r.text for r in table], 50) and found


def test_passages_of_awkward_tables(spark):
    assert suffixes.repeated(docs(spark, [])).collect() == []
    assert suffixes.repeated(docs(spark, ["short", None])).collect() == []
    text = sentences(1, 1, 70)[0]
    found = suffixes.repeated(docs(spark, [text, text], ids=[None, 5])).collect()
    assert sorted([(x.doc_id, x.n_docs, x.first_doc) for x in found], key=str) == [(5, 2, 5), (None, 2, 5)]


def test_passages_of_documents_with_text_ids(spark):
    text = sentences(3, 1, 80)[0]
    frame = docs(spark, [text, "x " + text, text, "short"]).selectExpr(
        "case doc_id when 0 then 'b' when 1 then 'a' when 3 then 'c' end as number", "text", "lang as doc_id"
    )
    found = suffixes.repeated(frame, "number").collect()
    assert sorted((r.doc_id or "", r.start, r.end, r.n_docs, r.first_doc) for r in found) == [
        ("", 0, 80, 3, "a"), ("a", 1, 81, 3, "a"), ("b", 0, 80, 3, "a")
    ]


def test_kept_suffixes_depend_on_content_only():
    words = " ".join(sentences(5, 1, 400, vocabulary=4000))
    one = suffixes.Passages(pa.record_batch({"text": pa.array([words])}), 50, 8, 16)
    two = suffixes.Passages(pa.record_batch({"text": pa.array(["extra words first " + words])}), 50, 8, 16)
    assert set(one.suffix.tolist()) <= set(two.suffix.tolist()) | set(one.suffix[:2].tolist())
    assert len(one.suffix) < 400 / 4


def shared_passages(seed, count):
    """Texts of which most hold one passage, with equal or different words around it."""
    r = random.Random(seed)
    own, passage = sentences(seed, count, 70, vocabulary=3000), sentences(seed + 1, 1, 66, vocabulary=3000)[0]
    texts = [f"{t} {passage} {r.choice(own)}" if i % 4 else t for i, t in enumerate(own)]
    return [*texts, texts[1], f"{passage} {passage} {passage}", "la " * 300, "la " * 200, "x" * 200 + " " + passage, None, ""]


def test_a_hot_passage_over_many_tasks(spark):
    texts = shared_passages(21, 160)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        found = suffixes.repeated(docs(spark, texts), block=4000, cell=1).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {tuple(x) for x in found} == stretches(texts, 50)
    assert max(x.n_docs for x in found) > 100


@pytest.mark.parametrize("rows,size", [(1, 1), (7, 1), (50, 4000), (10**6, 1 << 30)])
def test_words_decide_and_cells_agree(rows, size):
    """All suffixes are compared, as if all their hashes were the same; cells of any size give the same passages."""
    texts = shared_passages(23, 24)
    p = suffixes.Passages(pa.record_batch({"text": pa.array(texts)}), 50, 8, 16)
    numbers = np.arange(len(texts))
    table = pa.Table.from_batches(p.cut(np.arange(len(p.begins)), numbers, numbers), schema=suffixes.SUFFIX)
    table = table.sort_by([("run", "ascending"), ("row", "ascending")]).combine_chunks()
    found = [x for b in suffixes.cells(table.to_batches(max_chunksize=rows), 16, size) for x in b.to_pylist()]
    kind = lambda k: [x for x in found if x["kind"] == k]
    total, low, held, around = Counter(), {}, {}, defaultdict(list)
    for x in kind(suffixes.COUNTED):
        total[x["words"]] += x["n_docs"]
        low[x["words"]] = min(x["low"], low.get(x["words"], x["low"]))
        held[x["cell"], x["passage"]] = x["words"]
    for x in kind(suffixes.AROUND):
        around[x["cell"], x["context"]].append((x["far"], held[x["cell"], x["passage"]]))
    places = lambda x: zip(x["row"], x["at"])
    got = {(row, at - x["far"], at - x["near"], x["n_docs"], x["low"]) for x in kind(suffixes.DONE) for row, at in places(x)}
    for x in kind(suffixes.OPEN):
        for back, words in around[x["cell"], x["context"]]:
            for row, at in places(x):
                first = at - back
                assert "\x01" in words or alnum(texts[row])[first : first + 50] == words.split(" ")
                if total[words] > 1:
                    got.add((row, first, first, total[words], low[words]))
    merged = defaultdict(list)
    for row, first, last, n, least in sorted(got):
        if merged[row] and first <= merged[row][-1][1] + 50:
            a, b, m, k = merged[row][-1]
            merged[row][-1] = a, max(b, last), max(m, n), min(k, least)
        else:
            merged[row].append((first, last, n, least))
    assert {(r, a, b + 50, n, k) for r, all_of in merged.items() for a, b, n, k in all_of} == stretches(texts, 50)


def test_equal_hashes_of_different_words_are_told_apart(spark, monkeypatch):
    """Suffix hashes that are all the same set nothing aside, and make nothing equal."""

    class Same(suffixes.Passages):
        def __init__(self, *options):
            super().__init__(*options)
            self.suffix = np.full(len(self.begins), 7, np.uint64)

    monkeypatch.setattr(suffixes, "Passages", Same)
    texts = shared_passages(25, 30)
    found = suffixes.repeated(docs(spark, texts), block=5000).collect()
    assert {tuple(x) for x in found} == stretches(texts, 50)


def test_weights_by_bucket(spark):
    """Weights of every bucket, and of those without cells, against a plain loop over all cells."""
    r = random.Random(9)
    cells = [(b, -r.randrange(200) if b else 1, -r.randrange(300), r.randrange(1, 50)) for b in (0, 2, 5) for _ in range(40)]
    cells = list({c[:3]: c for c in cells}.values())

    def plain(own, w):
        for _ in range(100):
            total = np.zeros(3)
            for _, two, one, n in own:
                part = w * np.array([*(2 ** (x / lm.STEPS) if x <= 0 else 0 for x in (two, one)), 1 / 101])
                total += n * part / part.sum()
            w = total / total.sum()
        return w

    names = "bucket long, bigram long, unigram long, n long"
    found = lm.learn(spark.createDataFrame(cells, names), lm.Sizes(1000, 100))
    own = {b: plain([c for c in cells if c[0] == b], np.array([0, 0.5, 0.5]) if b == 0 else np.full(3, 1 / 3)) for b in (0, 2, 5)}
    every = plain(cells, np.full(3, 1 / 3))
    for k, expected in {0: own[0], 1: every, 2: own[2], 4: own[2], 5: own[5], 64: own[5]}.items():
        assert found[k] == pytest.approx(expected, rel=1e-6, abs=1e-8)
    nothing = lm.learn(spark.createDataFrame([], names), lm.Sizes(0, 0))
    assert nothing.sum(1) == pytest.approx(1) and nothing[0, 0] == 0 and nothing[1] == pytest.approx(1 / 3)
