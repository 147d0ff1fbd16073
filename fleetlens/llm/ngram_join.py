"""Documents whose sets of word n-grams are nearly equal: grouped prefix join.

Equal sets are one class.  Classes of equal size and equal prefix (their rarest
n-grams, in one global order) are one group.  Only groups that share a prefix
n-gram can hold linked members; group pairs are filtered by size and by
position, then expanded to members, whose whole sets are compared.

Groups of very many near copies would give all their pairs.  Here the pairs of
each list's smallest group come first.  Of what is left in two components, tasks
return spanning forests: of the members that no filter tells apart (families), then
of those whose whole sets, brought together family by family, are similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import exchange, forest
from fleetlens.llm.common import components, few, flat, pieces, record, stage
from fleetlens.llm.words import NOT_SPACE, STEP, Words, mix, runs

#: Members of a list that are compared at once, cells that a task compares, members of a group in a row.
PART, CELLS, CHUNK = 512, 2000, 64
#: Bytes of sets in a part of a family.
FAMILY_BYTES = 8 << 20


def shingle_sets(batch_text, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of the texts, sorted within each, and where each text's begin."""
    data, offsets = flat(batch_text)
    w = Words(data, offsets, NOT_SPACE)
    count = np.diff(w.first)
    grams = runs(w.hash, n)
    at = np.arange(len(grams))
    inside = w.doc[: len(grams)] == w.doc[n - 1 :][: len(grams)] if len(grams) else np.zeros(0, bool)
    keys, docs = grams[at[inside]], w.doc[: len(grams)][inside]
    short = np.flatnonzero((count > 0) & (count < n))  # the whole text is one n-gram
    if len(short):
        whole = [mix(runs(w.hash[w.first[i] : w.first[i + 1]], int(count[i])) + np.uint64(7)) for i in short]
        keys, docs = np.concatenate([keys, *whole]), np.concatenate([docs, short])
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys, docs = keys[fresh], docs[fresh]
    return keys, np.searchsorted(docs, np.arange(len(count) + 1))


def names_of(keys: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128-bit name of each set; none for empty ones."""
    halves = []
    for salt in (1, 2):
        total = np.zeros(len(keys) + 1, np.uint64)
        np.cumsum(mix(keys + np.uint64(salt * 0x9E3779B97F4A7C15 & (2**64 - 1))), out=total[1:])
        halves.append(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))
    both = np.stack(halves, 1)
    return [both[i].tobytes() if first[i + 1] > first[i] else None for i in range(len(first) - 1)]


def bitmap(keys: np.ndarray) -> bytes:
    """Parity of the number of n-grams at each hash position, in about one bit for two n-grams."""
    size = max(256, 1 << (max(1, len(keys) // 2) - 1).bit_length())
    odd = np.bincount((keys & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """Least number of n-grams that only one of two sets has, by their bitmaps; the longer one is folded."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), 0) ^ x).sum())


def counted(rows: pa.RecordBatch, n: int) -> exchange.Asked:
    """Distinct n-grams of a block, and how many of its texts hold each."""
    keys, times = np.unique(shingle_sets(rows.column("text"), n)[0], return_counts=True)
    return keys, [times]


def signatures(rows: DataFrame, n: int, percent: int, block: int = exchange.BLOCK) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node`` (name of the set), ``grp``, ``prefix``, ``bits``.

    The global order of n-grams is by the number of texts that hold them, rare
    ones first.  ``prefix`` has place and hash of the prefix n-grams that other texts hold
    too; ``grp`` is equal for equal sizes and whole prefixes, up to a hash.
    """
    table = exchange.blocks(rows.withColumn("flag", F.lit(0)), "flag", block)
    bits = exchange.bucket_bits(exchange.count_blocks(table))
    answers = exchange.answer(exchange.ask(table, lambda r: counted(r, n), bits), [np.add], "shingle-counts")
    posting = pa.struct([("pos", pa.int32()), ("gram", pa.int64())])
    made = [
        ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("grp", pa.int64()),
        ("prefix", pa.list_(posting)), ("bits", pa.binary()),
    ]
    schema = pa.schema([rows.select("doc_id").limit(0).toArrow().schema.field(0), *made])

    def sign(number: int, own: pa.RecordBatch, found: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, first = shingle_sets(own.column("text"), n)
        distinct, place = np.unique(keys, return_inverse=True)
        texts = exchange.totals_of(found, 1)[0][place]
        size = np.diff(first)
        docs = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((keys, texts, docs))
        length = np.where(size > 0, size - -(-size * percent // 100) + 1, 0)
        nth = np.arange(len(keys)) - np.repeat(first[:-1], size)
        inside = nth < np.repeat(length, size)
        prefix, pos, texts, docs = keys[order][inside], nth[inside], texts[order][inside], docs[inside]
        total = np.append(np.uint64(0), np.cumsum(mix(prefix + pos.astype(np.uint64) * STEP)))
        ends = np.cumsum(length)
        group = mix(total[ends] - total[ends - length] + size.astype(np.uint64) * STEP).view(np.int64)
        shared = texts > 1
        lists = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(docs[shared], np.arange(len(size) + 1)), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(pos[shared].astype(np.int32)), pa.array(prefix[shared].view(np.int64))], fields=list(posting)
            ),
        )
        maps = [bitmap(keys[a:b]) for a, b in zip(first[:-1], first[1:])]
        yield record(schema, own.column("doc_id"), own.column("text_hash"), size, names_of(keys, first), group, lists, maps)

    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = (
        f"doc_id {kind}, text_hash long, n_shingles long, node binary, grp long, "
        "prefix array<struct<pos: int, gram: long>>, bits binary"
    )
    return exchange.meet(table, answers, sign, columns, schema)


def folded(maps: list[np.ndarray], width: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows have bitmaps that similar sets may have."""
    good, least = np.zeros(len(i), bool), np.minimum(width[i], width[j])
    for w in np.unique(least):
        at = np.flatnonzero(least == w)
        rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        own = np.stack([np.bitwise_xor.reduce(maps[r].reshape(-1, w), 0) for r in rows])
        for k in range(0, len(at), 100_000):
            part = slice(k, k + 100_000)
            far = np.bitwise_count(own[place[: len(at)][part]] ^ own[place[len(at) :][part]]).sum(1)
            x, y = i[at[part]], j[at[part]]
            good[at[part]] = far * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
    return good


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    near = np.searchsorted(y, x)
    near[near == len(y)] = 0
    return int((y[near] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = common(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def sifted(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose sizes and bitmaps similar sets may have."""
    sides = [classes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "bits")]) for x in "ab"]
    both = pairs.join(sides[0], pairs["a"] == F.col("id_a")).join(sides[1], pairs["b"] == F.col("id_b"))
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            far = [
                apart(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8))
                for x, y in zip(batch.column("bits_a"), batch.column("bits_b"))
            ]
            keep = pa.array(np.array(far, np.int64) * (100 + percent) <= size * (100 - percent))
            yield record(out, batch.column("a").filter(keep), batch.column("b").filter(keep))

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def sets_of(nodes: DataFrame, classes: DataFrame, rows: DataFrame, n: int, name: str) -> DataFrame:
    """``id``, ``grams`` (sorted hashes) of the classes in ``nodes`` (``id``), from one of their texts; staged."""
    wanted = classes.join(nodes, "id", "left_semi").select("text_hash", "id")
    schema = pa.schema([("id", pa.int64()), ("grams", pa.binary())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            keys, first = shingle_sets(batch.column("text"), n)
            yield record(schema, batch.column("id"), [keys[a:b].tobytes() for a, b in zip(first[:-1], first[1:])])

    texts = rows.select("text", "text_hash").join(few(wanted), "text_hash").select("id", "text")
    held = stage(texts.mapInArrow(run, "id long, grams binary"), f"{name}-sets")
    return held.groupBy("id").agg(F.first("grams").alias("grams"))


def star_links(pairs: DataFrame, classes: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough; a list gives fewer pairs than it has groups."""
    pairs = stage(sifted(pairs, classes, percent), "star-pairs")
    nodes = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    held = sets_of(nodes, classes, rows, n, "star")
    joined = pairs.join(held.select(F.col("id").alias("a"), F.col("grams").alias("left")), "a").join(
        held.select(F.col("id").alias("b"), F.col("grams").alias("right")), "b"
    )
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column("left"), batch.column("right"))
            ]
            keep = pa.array(good, pa.bool_())
            yield record(out, batch.column("a").filter(keep), batch.column("b").filter(keep))

    return stage(joined.mapInArrow(compare, "a long, b long"), "star-links")


def candidates(spread: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``: pairs of classes that connect all classes which no filter tells apart, if their roots differ.

    ``spread`` has ``gram``, ``band``, ``pos``, ``grp``, ``n``, ``chunk`` and ``members`` (some classes of the group: ``id``,
    ``root``, ``bits``).  A list is a gram and a size band, together with the next band.  Pairs of groups
    are filtered by size and position; the members of those left are compared by their bitmaps, and a bucket of cells
    returns a spanning forest of what it finds.  A long list is cut into parts, and each two of them
    meet in a cell of bounded size.
    """
    own = F.struct(F.col("band"), F.lit(False).alias("above"))
    below = F.struct((F.col("band") - 1).alias("band"), F.lit(True).alias("above"))
    roots = F.transform("members", lambda m: m["root"])
    listed = spread.withColumns({"x": F.array_min(roots), "y": F.array_max(roots), "many": F.size("members")})
    listed = listed.withColumn("list", F.explode(F.array(own, below))).drop("band").select("*", "list.*").drop("list")
    listed = stage(listed, "spread")
    lists = listed.groupBy("gram", "band").agg(
        F.ceil(F.sum("many") / float(PART)).cast("int").alias("parts"), F.min("x").alias("x"), F.max("y").alias("y")
    )
    lists = stage(lists.where("x <> y").select("gram", "band", "parts"), "lists")
    dealt = listed.drop("x", "y", "many").join(lists, ["gram", "band"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("grp", "chunk"), "parts").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # Equal cells by chance do no harm: more is compared, and filters hold for any pair.
    cell = F.xxhash64("gram", "band", F.least("part", "other"), F.greatest("part", "other"))
    total = lists.agg(F.sum(F.col("parts") * F.col("parts"))).first()[0] or 0
    dealt = dealt.select(
        F.pmod(cell, F.lit(max(1, int(total) // CELLS))).alias("bucket"), cell.alias("cell"), (F.col("part") - F.col("other")).alias("side"),
        (F.col("gram") == F.col("grp")).alias("within"), "above", "pos", "n", "grp", "members",
    )
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key, table):
        cells, side, within, above, pos, n, grp = (
            table.column(c).to_numpy() for c in ("cell", "side", "within", "above", "pos", "n", "grp")
        )
        members = table.column("members").combine_chunks()
        first = members.offsets.to_numpy().astype(np.int64)
        first, flat_members = first - first[0], members.flatten()
        node, root = (flat_members.field(c).to_numpy() for c in ("id", "root"))
        maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in flat_members.field("bits")]
        width, many = np.array([len(x) for x in maps]), np.diff(first)
        size = np.repeat(n, many)
        ids, member = np.unique(node, return_inverse=True)
        union, found = forest.Union(np.arange(len(ids))), []
        for i, j in forest.pairs_of(cells):
            # Two parts meet once; two of the next band meet in its own list, two of one group in the group's.
            keep = ~(above[i] & above[j]) & ((side[i] == 0) | (np.sign(side[i]) != np.sign(side[j])))
            keep &= (grp[i] != grp[j]) | within[i]
            keep &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            most = np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j])
            keep &= most * (100 + percent) >= percent * (n[i] + n[j])
            for x, y in expanded(i[keep], j[keep], first, many):
                label = union.labels()
                other = (root[x] != root[y]) & (label[member[x]] != label[member[y]])
                x, y = x[other], y[other]
                good = folded(maps, width, size, x, y, percent)
                x, y = x[good], y[good]
                chosen = union.joined(member[x], member[y])
                found += zip(node[x[chosen]].tolist(), node[y[chosen]].tolist())
        return pa.Table.from_batches([record(out, [a for a, _ in found], [b for _, b in found])])

    return dealt.groupBy("bucket").applyInArrow(run, "a long, b long")


def expanded(i: np.ndarray, j: np.ndarray, first: np.ndarray, many: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of the pairs of groups, some at a time."""
    count = many[i] * many[j]
    reach, at = np.cumsum(count), 0
    while at < len(i):
        last = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + forest.PAIRS, "right")))
        part, own = count[at:last], np.repeat(np.arange(at, last), count[at:last])
        nth = np.arange(len(own)) - np.repeat(np.cumsum(part) - part, part)
        yield first[i[own]] + nth // many[j[own]], first[j[own]] + nth % many[j[own]]
        at = last


def family_links(members: DataFrame, edges: DataFrame, classes: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Links that connect all linked classes of different roots within each component of ``edges``.

    Whole sets are moved to the cells of their component, parts of bounded bytes of which each two meet,
    and are compared there; a bucket returns a spanning forest of its links.
    """
    families = components(edges, "families").select(F.col("node").alias("id"), F.col("root").alias("family"))
    families = stage(families.join(members.select("id", "n", "root", "bits"), "id"), "family-members")
    parts = families.groupBy("family").agg(F.ceil(F.sum(8 * F.col("n") + 64) / float(FAMILY_BYTES)).cast("int").alias("parts"))
    parts = stage(parts, "family-parts")
    held = families.join(sets_of(families.select("id"), classes, rows, n, "family"), "id").join(parts, "family")
    held = held.withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("family", F.least("part", "other"), F.greatest("part", "other"))
    total = parts.agg(F.sum(F.col("parts") * F.col("parts"))).first()[0] or 0
    whole = families.agg(F.sum(8 * F.col("n") + 64)).first()[0] or 0
    buckets = max(1, int(total) // 64, int(whole) // (2 * FAMILY_BYTES))
    held = held.select(
        F.pmod(cell, F.lit(buckets)).alias("bucket"), cell.alias("cell"), (F.col("part") - F.col("other")).alias("side"),
        "id", "root", "n", "bits", "grams",
    )
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key, table):
        cells, side, node, root, size = (table.column(c).to_numpy() for c in ("cell", "side", "id", "root", "n"))
        maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("bits")]
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")]
        width, number = np.array([len(x) for x in maps]), np.unique(root, return_inverse=True)[1]
        union, found = forest.Union(np.arange(number.max() + 1)), []
        for i, j in forest.pairs_of(cells):
            label = union.labels()[number]
            keep = (label[i] != label[j]) & ((side[i] == 0) | (np.sign(side[i]) != np.sign(side[j])))
            keep &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            i, j = i[keep], j[keep]
            good = folded(maps, width, size, i, j, percent)
            for x, y in zip(i[good].tolist(), j[good].tolist()):
                if union.find(number[x]) != union.find(number[y]) and linked(sets[x], sets[y], percent):
                    union.joined(number[[x]], number[[y]])
                    found.append((int(node[x]), int(node[y])))
        return pa.Table.from_batches([record(out, [a for a, _ in found], [b for _, b in found])])

    return stage(held.groupBy("bucket").applyInArrow(run, "a long, b long"), "family-links")


def similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90, block: int = exchange.BLOCK
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``text_hash``, ``root`` for every row.

    Two rows link when 100 * intersection >= ``percent`` * union of their sets of
    distinct word n-grams (a text of fewer words is one n-gram; an empty or
    null text has none and no link).  ``component_id`` is the smallest ``doc_id``
    that links lead to, its own included; ``root`` names the component, null
    for rows without n-grams.  Repeated rows are kept and linked; a null id counts only where all are null.
    ``block``: bytes of text that ask for n-gram counts together.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = stage(signatures(rows, n, percent, block), "signatures")

    classes = (
        signed.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("low"),
            F.min("text_hash").alias("text_hash"),
            F.min("n_shingles").alias("n"),
            F.min("prefix").alias("prefix"),
            F.min("grp").alias("grp"),
            F.min("bits").alias("bits"),
        )
    )
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    groups = classes.groupBy("grp", "n").agg(F.min("id").alias("rep"), F.min("prefix").alias("prefix"))
    postings = groups.select("grp", "n", F.inline("prefix"))
    shared = postings.groupBy("gram").agg(F.count("*").alias("lists")).where("lists > 1").select("gram")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    lists = stage(postings.join(shared, "gram").withColumn("band", band), "postings")

    # First the smallest group of each list and size band, with the others of this band and the next smaller ones.
    heads = lists.groupBy("gram", "band").agg(F.min("grp").alias("head"))
    reps = groups.select("grp", "rep")
    firsts = (
        lists.select("grp", "gram", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"))
        .join(heads, ["gram", "band"])
        .where("grp <> head")
        .select(F.col("head").alias("g"), F.col("grp").alias("h"))
        .distinct()
        .join(reps.select(F.col("grp").alias("g"), F.col("rep").alias("a")), "g")
        .join(reps.select(F.col("grp").alias("h"), F.col("rep").alias("b")), "h")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    inner = classes.join(reps, "grp").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    stars = star_links(firsts.union(inner).distinct(), classes, rows, n, percent)
    roots = stage(components(stars, "star-components"), "star-roots").withColumnRenamed("node", "id")

    # Then what is left: groups of a list that lie in two components, and groups with members of two.
    members = classes.join(roots, "id", "left").select("grp", "n", "id", "bits", F.coalesce("root", "id").alias("root"))
    members = stage(members, "members")
    sizes = members.groupBy("grp").agg(F.count("*").alias("size"), F.min("root").alias("x"), F.max("root").alias("y"))
    member = F.struct("id", "root", "bits")
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / float(CHUNK))).alias("chunk")
    chunks = members.join(sizes, "grp").select("grp", chunk, member.alias("member"))
    chunks = chunks.groupBy("grp", "chunk").agg(F.collect_list("member").alias("members"))
    spread = lists.join(chunks, "grp").select("gram", "band", "pos", "grp", "n", "chunk", "members")
    mixed = members.join(sizes.where("x <> y").select("grp"), "grp")
    spread = spread.unionByName(
        mixed.select(
            F.col("grp").alias("gram"), band.alias("band"), F.lit(0).alias("pos"), "grp", "n", F.col("id").alias("chunk"),
            F.array(member).alias("members"),
        )
    )
    others = family_links(members, candidates(spread, percent), classes, rows, n, percent)

    final = components(stars.union(others), "components")
    low = classes.select(F.col("id").alias("node"), "low").join(final, "node").groupBy("root").agg(F.min("low").alias("component_id"))
    named = final.join(low, "root").select(F.col("node").alias("id"), "root", "component_id")
    named = classes.select("node", "id", "low").join(named, "id", "left").select(
        "node", F.coalesce("root", "id").alias("root"), F.coalesce("component_id", "low").alias("low")
    )
    return signed.drop("prefix", "bits", "grp").join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"), "text_hash", "root"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """The rows and columns of ``docs``, one row of each component: that of the smallest ``doc_id``.

    Ties (rows of one id) go to the smaller hash of the text, and one of equal rows
    stays.  Texts without words belong to no component and stay.
    """
    found = similar(docs, doc_id, text, n, percent).where("root is not null")
    found = stage(found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "root"), "rows")
    key = F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__hash")
    best = found.groupBy("root").agg(F.min(key).alias("best"))
    lost = found.join(best, "root").where(~key.eqNullSafe(F.col("best"))).select("__id", "__hash").distinct()
    rows = docs.withColumn("__row_hash", F.xxhash64(F.col(text)))
    lost = few(lost)
    kept = rows.join(
        lost, rows[doc_id].eqNullSafe(lost["__id"]) & (rows["__row_hash"] == lost["__hash"]), "left_anti"
    )
    again = found.groupBy("__id", "__hash").agg(F.count("*").alias("times")).where("times > 1")
    if not again.isEmpty():
        again = few(again.select("__id", "__hash"))
        twice = rows[doc_id].eqNullSafe(again["__id"]) & (rows["__row_hash"] == again["__hash"])
        repeated = kept.join(again, twice, "left_semi").dropDuplicates([doc_id, "__row_hash"])
        kept = kept.join(again, twice, "left_anti").unionByName(repeated)
    return kept.drop("__row_hash")
