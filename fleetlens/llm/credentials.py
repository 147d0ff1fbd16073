"""Secrets in texts, and weak parts of credentials that occur together.

Strong patterns stand by themselves.  Weak ones (an account name, a random-looking
key, a service address) mean little alone: they are joined by distance within
a scope (a paragraph), and are reported only next to their complement.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import apart, pieces, record

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Weak parts: an account by name, a key by its look, an address of a service.
ACCOUNT = re.compile(r"""(?ai:\b(?:user(?:name)?|login|account|client_?id|access_?id))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}""")
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"(?a:\b[A-Za-z][A-Za-z0-9+.-]{1,20}://[A-Za-z0-9_.@:-]+(?:/[A-Za-z0-9_./-]*)?)")
SCOPE = re.compile(r"\n[\x20\t\r]*\n")

#: Kinds in the order that breaks ties; the first three are the strong ones.
KINDS = ("assign", "access", "hex", "account", "key", "endpoint")
#: What a weak kind needs within reach: one kind of each set.
NEEDS = {
    "account": ({"assign", "hex", "key"},),
    "key": ({"access", "account"},),
    "endpoint": ({"access", "account"}, {"assign", "hex", "key"}),
}
#: Characters between two parts of one credential, at most.
REACH = 200

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Strong spans (start, end, kind) in code points."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if "=" in text or ":" in text else []
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def weak_spans(text: str, strong: list[Span]) -> list[Span]:
    """Weak candidates that no strong span overlaps."""
    found = [(m.start(), m.end(), "account") for m in ACCOUNT.finditer(text)] if "=" in text or ":" in text else []
    found += [(m.start(), m.end(), "key") for m in KEY.finditer(text) if mixed(m[0])]
    if "://" in text:
        found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    if not found:
        return found
    starts = sorted(s for s, _, _ in strong)
    reached = list(accumulate((e for _, e in sorted((s, e) for s, e, _ in strong)), max))

    def free(s: int, e: int) -> bool:
        k = bisect_left(starts, e)
        return k == 0 or reached[k - 1] <= s

    return [x for x in found if free(x[0], x[1])]


def mixed(key: str) -> bool:
    """Random-looking: digits, and both cases of letters."""
    return any(c.isdigit() for c in key) and key.lower() != key and key.upper() != key


def linked(text: str, strong: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """Weak spans whose complementary parts lie within ``reach`` in the same scope.

    A sort-merge interval join: parts in order of their start are looked up by
    bisection, so a long text costs n log n.
    """
    if not weak:
        return []
    cuts = [m.start() for m in SCOPE.finditer(text)]
    parts: dict[str, dict[int, list[tuple[int, int]]]] = {}
    scope = lambda s: bisect_left(cuts, s + 1)
    for s, e, kind in sorted(strong + weak):
        parts.setdefault(kind, {}).setdefault(scope(s), []).append((s, e))

    def near(kinds: set[str], s: int, e: int) -> bool:
        for kind in kinds:
            rows = parts.get(kind, {}).get(scope(s), [])
            k = bisect_left(rows, (s, e))  # spans of a kind are disjoint: only the next on either side can be nearest
            for a, b in rows[max(0, k - 1) : k + 2]:
                if (a, b) != (s, e) and a - e <= reach and s - b <= reach:
                    return True
        return False

    return [x for x in weak if all(near(kinds, x[0], x[1]) for kinds in NEEDS[x[2]])]


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def found(text: str | None, reach: int = REACH) -> list[Span]:
    """All secrets of a text, in order."""
    strong = base_spans(text or "")
    return ordered(strong + linked(text or "", strong, weak_spans(text or "", strong), reach))


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), reach: int = REACH) -> DataFrame:
    """The ``keep`` columns of every row with ``secrets``: array of (kind, start, end, linked).

    Code points, end exclusive, by start and then kind.  ``linked`` marks the
    weak spans that were kept for their neighbours.  Rows are kept one for one, a
    column to keep that is named ``secrets`` is refused;
    null and empty texts have no secrets.  Whole texts are scanned.
    """
    apart(keep, ("secrets", "__text"))
    rows = docs.select(F.col(text).alias("__text"), *keep)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("linked", pa.bool_())])
    schema = pa.schema([("secrets", pa.list_(kind))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text"):
            secrets = [
                [{"kind": k, "start": s, "end": e, "linked": k in NEEDS} for s, e, k in found(t, reach)]
                for t in batch.column("__text").to_pylist()
            ]
            made = record(schema, secrets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + made.columns, names=[*keep, "secrets"]
            )

    columns = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(
        run, f"{columns}, secrets array<struct<kind: string, start: long, end: long, linked: boolean>>"
    )


def redact(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """The same rows and columns, every stretch of ``text`` that secrets cover replaced by ``[kind]`` of its first."""
    schema = docs.schema

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = [cleaned(t, found(t, reach)) for t in batch.column(text).to_pylist()]
            columns = [pa.array(texts, batch.column(c).type) if c == text else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def cleaned(text: str | None, secrets: list[Span]) -> str | None:
    if not secrets:
        return text
    out, at = [], 0
    for start, end, kind in secrets:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
