"""Archives: written, read back, and looked up."""

import hashlib

import pytest
import zstandard

from fleetlens.llm import warc
from fleetlens.llm.common import configure
from fleetlens.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, digest string, payload int, last int"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    configure(spark)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, 2) for i, u, h in rows], SCHEMA).repartition(2)


LONG = "é<p>long payload</p>\r\n\r\n" * 60
ROWS = [
    (1, "http://a/ b\r\nX: y", LONG),
    (2, None, LONG),
    (9, "http://c", LONG),
    (9, "http://c", LONG),
    (3, "http://short", "same"),
    (4, "http://short", "same"),
    (5, "u", None),
    (6, "u", ""),
    (None, "u", LONG),
    (None, "v", "x" * 2000),
    (None, "v", "x" * 2000),
    (7, "big", "WARC/1.1\r\n\r\n" * 100_000),
]


def expected(rows):
    last = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = last.get(h, -1) if last.get(h, -1) >= 0 else None
        to = None if to == i else to
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("frame,bundle", [(warc.FRAME, warc.BUNDLE), (500, 300)])
def test_round_trip(spark, frame, bundle):
    folder = warc.folder(spark)
    index = warc.write(warc.with_originals(pages(spark, ROWS)), folder, frame=frame, bundle=bundle)
    found = warc.read(index).collect()
    number = lambda s: None if s in (None, "<urn:page:>") else int(s[len("<urn:page:") : -1])
    got = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found]
    assert sorted(got, key=str) == expected(ROWS)
    html = {i: (h or "").encode() for i, _, h in ROWS if i is not None}
    assert all(r.payload == html[number(r.record_id)] for r in found if r.payload is not None and number(r.record_id))
    # Each bundle is an ordinary Zstandard file of WARC records.
    paths = {r.bundle for r in index.collect()}
    whole = b""
    for path in paths:
        with open(path.removeprefix("file:"), "rb") as f:
            whole += zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole.count(b"WARC-Record-ID: ") == len(ROWS)
    assert (len(paths) > 2) == (bundle == 300)


def test_lookup_reads_single_records(spark):
    index = warc.write(warc.with_originals(pages(spark, ROWS)), warc.folder(spark), frame=4000)
    wanted = spark.createDataFrame([("<urn:page:3>",), ("<urn:page:2>",), ("<urn:page:404>",)], "record_id string")
    found = {r.record_id: r for r in warc.lookup(index, wanted).collect()}
    assert set(found) == {"<urn:page:3>", "<urn:page:2>"}
    assert found["<urn:page:3>"].payload == b"same" and found["<urn:page:2>"].refers_to == "<urn:page:9>"


def test_no_pages(spark):
    index = warc.write(warc.with_originals(pages(spark, [])), warc.folder(spark))
    assert warc.read(index).collect() == []


def test_pages_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    found = QUERIES["op5_warc"](spark, sf).collect()
    assert sorted([tuple(r) for r in found], key=str) == expected(rows)
    assert "response" in {r.record_type for r in found}
