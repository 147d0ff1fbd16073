"""Small tables with the awkward rows, and plain Python forms of shared rules."""

import random
import re
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, node int, spans string"


def docs(spark, texts, ids=None, langs=None):
    """Documents with further columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, x, "s", len(t or ""), "x", 1, "y") for i, t, x in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sentences(seed, count, words=60, vocabulary=400):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéio") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    return [" ".join(r.choice(vocab) for _ in range(words)) for _ in range(count)]


def changed(text, r, times):
    words = text.split(" ")
    for _ in range(times):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def crc(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}
