"""Log-probability of texts under an n-gram model smoothed by deleted interpolation.

Maximum-likelihood estimates of n-grams of every length up to ``order`` and a uniform
distribution are mixed; the weights depend on how often the contexts (one bucket per length) occurred,
and are learned by expectation-maximisation on texts that the estimates have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import exchange
from fleetlens.llm.common import flat, record, shuffles_deleted, stage
from fleetlens.llm.words import A, NOT_SPACE, Words, mix

#: Hash of the end of a text, which is a token and the context of the first word.
END = mix(np.array([3], np.uint64))[0]
#: Flags of blocks: texts that estimates come from, those that weights come from, all others.
ESTIMATE, WEIGH, OTHER = PARTS = 0, 1, 2
#: Steps per octave in which probabilities are told apart while weights are learned, by order: fewer for more estimates.
STEPS = 16
STEPS_OF = {2: STEPS, 3: 4}


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token and context hash of every token, and where each text's begin."""
    w = Words(*flat(texts), NOT_SPACE)
    count = np.diff(w.first) + 1
    first = np.append(0, np.cumsum(count))
    token = np.full(first[-1], END, np.uint64)
    token[np.arange(len(w.hash)) + w.doc] = w.hash
    context = np.full(len(token), END, np.uint64)
    context[1:] = token[:-1]
    context[first[:-1]] = END
    return token, context, first


def grams(token: np.ndarray, context: np.ndarray, starts: np.ndarray | None = None, order: int = 2) -> list[np.ndarray]:
    """Keys of unigrams (even numbers) and of n-grams up to ``order`` (odd numbers), shortest first.

    ``starts`` are the places where texts begin, before which there are as many ends as a context needs.
    """
    one = np.uint64(1)
    last = context * A + token + one
    found = [mix(token) & ~one, mix(last) | one]
    for n in range(3, order + 1):
        before = np.full(len(token), END, np.uint64)
        before[1:] = last[:-1]
        before[starts] = END
        last = mix(before) * A + token + np.uint64(n)
        found.append(mix(last) | one)
    return found


def distinct(made: list[np.ndarray], flag: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of a block, the place of every key among them, and how often texts of each part hold them."""
    keys, place, times = np.unique(np.concatenate(made), return_inverse=True, return_counts=True)
    nothing = np.zeros(len(keys), np.int64)
    return keys, place, [times if flag == part else nothing for part in PARTS]


def asked(rows: pa.RecordBatch) -> exchange.Asked:
    """Words and bigrams of a block."""
    token, context, _ = tokens(rows.column("text"))
    keys, _, own = distinct(grams(token, context), rows.column("flag")[0].as_py())
    return keys, own


def asked_next(rows: pa.RecordBatch, answers: pa.Table, order: int) -> exchange.Asked:
    """N-grams of length ``order`` that may occur in other blocks, given ``answers`` on all shorter ones."""
    return Counted(rows, answers, 2, order, answered=order - 1).open


def word_counts(keys: np.ndarray, totals: list[np.ndarray]) -> list[int]:
    """Tokens and distinct tokens among ``keys``, of the estimating part and of all training texts."""
    words = keys & np.uint64(1) == 0
    return [int(x) for t in (totals[0][words], (totals[0] + totals[1])[words]) for x in (t.sum(), (t > 0).sum())]


@dataclass
class Sizes:
    """Tokens and distinct tokens of a training corpus."""

    tokens: int
    words: int


@dataclass
class Model:
    """``weights`` of the estimates from the longest n-gram to the uniform (last axis) by context buckets, longest first."""

    sizes: Sizes
    weights: np.ndarray


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, then one bucket per octave of the count."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.int64)


class Counted:
    """Counts of every token of a block: of the n-grams that end with it and of their contexts, shortest first.

    An n-gram of three tokens or more occurs in another block, of whichever part, only if the two n-grams in it that are
    a token shorter do.
    ``answers`` cover those that may, all others are counted in this block.  ``open`` are those of the length after
    ``answered``, if that is not ``order``.
    """

    def __init__(self, rows: pa.RecordBatch, answers: pa.Table, parts: int, order: int = 2, answered: int | None = None):
        token, context, self.first = tokens(rows.column("text"))
        flag, starts = rows.column("flag")[0].as_py(), self.first[:-1]
        made = grams(token, context, starts, order)
        found = exchange.totals_of(answers, len(PARTS))
        keys, place, own = distinct(made[:2], flag)
        totals, found = [f[: len(keys)] for f in found], [f[len(keys) :] for f in found]
        total = sum(totals[:parts])
        self.counts = [total[x] for x in np.split(place, 2)]
        # The end of a text is counted as often as a text begins.
        at_end = total[np.searchsorted(keys, grams(np.array([END]), np.array([END]))[0][0])] if len(token) else 0
        elsewhere = (sum(totals) > sum(own))[place[len(token) :]]
        for n in range(3, order + 1):
            before = np.ones(len(token), bool)
            before[1:] = elsewhere[:-1]
            before[starts] = True
            keys, place, totals = distinct([made[n - 1]], flag)
            ask = np.zeros(len(keys), bool)
            ask[place[elsewhere & before]] = True
            if n - 1 == answered:
                self.open = keys[ask], [t[ask] for t in totals]
                return
            count, here = int(ask.sum()), sum(totals)
            totals = [t.copy() for t in totals]
            for t, f in zip(totals, found):
                t[ask] = f[:count]
            found = [f[count:] for f in found]
            self.counts.append(sum(totals[:parts])[place])
            elsewhere = (sum(totals) > here)[place]
        self.own = self.counts[0]
        self.before = []
        for count in self.counts[:-1]:
            before = np.empty_like(count)
            before[1:] = count[:-1]
            before[starts] = at_end
            self.before.append(before)

    def buckets(self) -> list[np.ndarray]:
        """Buckets of the contexts, longest first."""
        return [bucket(x) for x in reversed(self.before)]

    def estimates(self, sizes: Sizes) -> list[np.ndarray]:
        """Maximum-likelihood estimates, longest n-gram first."""
        longer = [c / np.maximum(b, 1) for c, b in zip(self.counts[1:], self.before)]
        return [*reversed(longer), self.own / max(1, sizes.tokens)]


def cell_names(order: int) -> list[str]:
    """Columns of cells: context buckets, estimates in steps (longest first), and how many tokens have them."""
    longer = range(order, 2, -1)
    return [*(f"bucket{n}" for n in longer), "bucket", *(f"gram{n}" for n in longer), "bigram", "unigram", "n"]


def cell_schema(order: int) -> pa.Schema:
    return pa.schema([(n, pa.int64()) for n in cell_names(order)])


def histogram(rows: pa.RecordBatch, answers: pa.Table, sizes: Sizes, order: int = 2) -> pa.RecordBatch:
    """How many tokens have which context buckets and (in steps) which estimates."""
    c, steps = Counted(rows, answers, 1, order), STEPS_OF[order]
    step = lambda p: np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300)) * steps), 1).astype(np.int64)
    cells, times = np.unique(np.stack([*c.buckets(), *map(step, c.estimates(sizes))], 1), axis=0, return_counts=True)
    return record(cell_schema(order), *cells.T, times)


#: Bucket under which the cells of all buckets are counted together.
EVERY = -1


def expected(cells: pa.Table, words: int, rounds: int, order: int = 2) -> np.ndarray:
    """Mixture weights of one group of buckets: expectation-maximisation over its counted cells."""
    names, steps = cell_names(order), STEPS_OF[order]
    *steps_of, n = (cells.column(c).to_numpy().astype(np.float64) for c in names[order - 1 :])
    chance = [np.where(x == 1, 0.0, np.exp2(np.minimum(x, 0) / steps)) for x in steps_of]
    chance = np.stack([*chance, np.full(len(n), 1 / (words + 1))], 1)
    # After an unseen context no n-gram has an estimate.
    weights = possible([cells.column(c)[0].as_py() for c in names[: order - 1]])
    weights = weights / weights.sum()
    for _ in range(rounds):
        part = chance * weights
        weights = (part * (n / part.sum(1))[:, None]).sum(0) / n.sum()
    return weights


def possible(buckets: list[int] | tuple[int, ...]) -> np.ndarray:
    """1 for estimates that may have a weight, 0 for those of contexts which did not occur."""
    return np.array([*(float(b != 0) for b in buckets), 1.0, 1.0])


def learn(cells: DataFrame, sizes: Sizes, rounds: int = 100, order: int = 2) -> np.ndarray:
    """Mixture weights by context buckets, from ``cells`` (``cell_names``, once each).

    A task learns those of a group of buckets; at most 66 rows reach the driver for bigrams, and 65 times as many with
    each length more.  A bucket of contexts that occur c times has up to 16 log2(c)
    bigram and 16 log2(tokens) unigram estimates, so half a million cells (20 MB) for a corpus of 10^14 tokens; with
    trigrams, told apart in 4 steps an octave, up to some millions.
    Groups without any cell take the weights of the next lower bucket, or else of all cells
    together; no weight is quite zero but those of n-grams after an unseen context.
    """
    names = cell_names(order)
    groups, grades = names[: order - 1], names[order - 1 : -1]
    every = cells.groupBy(*grades).agg(F.sum("n").alias("n"))
    every = every.select(*[F.lit(EVERY).cast("long").alias(g) for g in groups], *grades, "n")
    out = pa.schema([("buckets", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))])

    def run(key, own):
        return pa.Table.from_batches([record(out, [[k.as_py() for k in key]], [expected(own, sizes.words, rounds, order).tolist()])])

    made = cells.select(*names).unionByName(every).groupBy(*groups).applyInArrow(run, "buckets array<long>, weights array<double>")
    found = {tuple(r.buckets): np.array(r.weights) for r in made.collect()}
    all_cells = found.get((EVERY,) * len(groups))
    weights = np.zeros((65,) * len(groups) + (order + 1,))
    for at in np.ndindex(weights.shape[:-1]):
        lower = next((k for k, b in enumerate(at) if b > 1), None)
        if at in found:
            weights[at] = found[at]
        elif lower is not None:
            weights[at] = weights[(*at[:lower], at[lower] - 1, *at[lower + 1 :])]
        else:
            weights[at] = possible(at) / possible(at).sum() if all_cells is None else all_cells
        weights[at] = np.maximum(weights[at], 1e-9) * possible(at)
        weights[at] /= weights[at].sum()
    return weights


def score(
    docs: DataFrame,
    train: str,
    weigh: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = exchange.BLOCK,
    order: int = 2,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` for every row.

    ``train`` and ``weigh`` are SQL conditions on a row: whether the model learns from it, and
    whether (being so) it is kept apart while the weights are learned.  After that
    estimates come from all training rows.  ``base_score`` is that of the unigram with 0.1
    added to each count.  Null and empty texts are one token, the end.  With nothing to
    learn from, every token is as likely as any.  ``order`` (2 or 3) is the length of the longest n-grams.
    """
    if order not in STEPS_OF:
        raise ValueError(f"order {order} is none of {sorted(STEPS_OF)}")
    trained = F.coalesce(F.expr(train), F.lit(False))
    flag = F.when(trained & F.coalesce(F.expr(weigh), F.lit(False)), WEIGH).when(trained, ESTIMATE).otherwise(OTHER)
    rows = docs.select(flag.alias("flag"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = exchange.blocks(rows, "flag", block)
    how = [np.add] * len(PARTS)
    bits, spark = exchange.bucket_bits(exchange.count_blocks(table)), docs.sparkSession
    with shuffles_deleted(spark):
        answers = exchange.answer(exchange.ask(table, asked, bits), how, "ngram-counts", word_counts)
        sizes = corpus_sizes(answers)
        for n in range(3, order + 1):
            longer = exchange.answer(next_requests(table, answers, n, bits), how, f"ngram{n}-counts")
            # Answers on longer n-grams follow those on shorter ones.
            answers = answers.unionByName(longer.withColumn("bucket", F.col("bucket") + ((n - 2) << 32)))

    def cells(number: int, own: pa.RecordBatch, found: pa.Table) -> Iterator[pa.RecordBatch]:
        yield histogram(own, found, sizes[0], order)

    held_out = table.where(F.col("flag") == WEIGH)
    known = answers.join(held_out.select("block"), "block", "left_semi")
    names = cell_names(order)
    counted = exchange.meet(held_out, known, cells, ", ".join(f"{n} long" for n in names), cell_schema(order))
    with shuffles_deleted(spark):
        cells_of_all = stage(counted.groupBy(*names[:-1]).agg(F.sum("n").alias("n")), "ngram-cells")
    shared = spark.sparkContext.broadcast(Model(sizes[1], learn(cells_of_all, sizes[0], order=order)))

    numbers = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    out = pa.schema([pa.field("doc_id", pa.int64() if kind == "bigint" else pa.string()), *numbers])

    def scored(number: int, own: pa.RecordBatch, found: pa.Table) -> Iterator[pa.RecordBatch]:
        m, c = shared.value, Counted(own, found, 2, order)
        n, v = m.sizes.tokens, m.sizes.words
        w = m.weights[tuple(c.buckets())] if n else np.eye(order + 1)[[order] * len(c.own)]
        p = sum(w[:, k] * x for k, x in enumerate(c.estimates(m.sizes))) + w[:, order] / (v + 1)
        base = np.log10((c.own + 0.1) / (n + 0.1 * (v + 1)))
        start = c.first[:-1]
        total = lambda x: np.add.reduceat(x, start)
        ids = own.column("doc_id").cast(out.field("doc_id").type)
        yield record(
            out, ids, np.diff(c.first), total((c.own > 0).astype(np.int64)), np.full(len(start), n), total(base),
            total(np.log10(p)),
        )

    schema = "doc_id {}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    result = exchange.meet(table, answers, scored, schema.format("long" if kind == "bigint" else "string"), out)
    return result.withColumn("doc_id", F.col("doc_id").cast(kind))


def next_requests(table: DataFrame, answers: DataFrame, order: int, bits: int) -> DataFrame:
    """Requests of all blocks for n-grams of length ``order``, given ``answers`` on all shorter ones."""

    def run(number: int, own: pa.RecordBatch, found: pa.Table) -> Iterator[pa.RecordBatch]:
        yield exchange.requests_of(number, asked_next(own, found, order), bits)

    return exchange.meet(table, answers, run, exchange.REQUESTS, exchange.REQUEST)


def corpus_sizes(answers: DataFrame) -> tuple[Sizes, Sizes]:
    """Sizes of the estimating part and of all training texts: kept beside the counts of each bucket."""
    total = answers.agg(*[F.sum(F.col("summary")[k]) for k in range(4)]).first()
    a, b, c, d = (int(x or 0) for x in total)
    return Sizes(a, b), Sizes(c, d)
