"""Web pages as WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, some records in each, and a
seek table in a skippable frame at its end.  The index maps record identifiers to
their frame and their place within it, so that one record costs one frame.
Files go to the shared folder under names of their own; the index, written by
Spark, is what makes them count, so files of lost or repeated tasks are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import few, pieces, record, stage
from fleetlens.session import scratch_path

#: Fixed values of the seekable format and of the WARC standard.
SEEK_FRAME, SEEK_FOOTER = 0x184D2A5E, 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes of records in a frame, and of frames in a bundle.
FRAME, BUNDLE = 1 << 18, 64 << 20
#: Payloads from this size on are stored once.
LEAST_SHARED = 1000


def with_originals(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str | None = "url") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` (SHA-1), ``original`` for every row.

    ``original`` is set for rows that repeat a payload of at least ``LEAST_SHARED``
    bytes: the largest id among its rows, whose row is the response.  Null html
    is an empty payload; rows of the same largest id are all responses.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        (F.col(url).cast("string") if url else F.lit(None).cast("string")).alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("check", F.xxhash64("payload"))
    repeated = (
        rows.where(F.octet_length("payload") >= LEAST_SHARED)
        .groupBy("digest", "check")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("times"))
        .where("times > 1 and last is not null")
        .select("digest", "check", "last")
    )
    repeated = few(stage(repeated, "repeated-payloads"))
    original = F.when(~F.col("page_id").eqNullSafe(F.col("last")) & F.col("last").isNotNull(), F.col("last"))
    return rows.join(repeated, ["digest", "check"], "left").select(
        "page_id", "url", "payload", "digest", original.alias("original")
    )


def name_of(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def warc_record(page, url: str | None, payload: bytes, digest: str, original, date: str) -> bytes:
    """One record; a revisit holds the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {name_of(page)}"]
    head += [f"WARC-Date: {date}"] + ([] if url is None else [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"])
    head += [f"WARC-Payload-Digest: sha1:{digest}"]
    head += [] if original is None else [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name_of(original)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


class Bundle:
    """A file that is being written, frame by frame."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, place = fs.FileSystem.from_uri(self.path)
        store.create_dir(place.rsplit("/", 1)[0])
        self.out, self.frames, self.size = store.open_output_stream(place, compression=None), [], 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Number, offset and length of the new frame."""
        packed = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(data)
        self.out.write(packed)
        place = len(self.frames), self.size, len(packed)
        self.frames.append((len(packed), len(data)))
        self.size += len(packed)
        return place

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *x) for x in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(table) + len(footer)) + table + footer)
        self.out.close()


INDEX = (
    "record_id string, bundle string, frame long, frame_offset long, frame_length long, record_offset long, record_length long"
)


def write(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", frame: int = FRAME, bundle: int = BUNDLE
) -> DataFrame:
    """Writes a table of ``with_originals`` to bundles below ``folder``; returns their index, staged."""
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (f.split() for f in INDEX.split(", "))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        out, data, waiting = None, [], []

        def flush() -> pa.RecordBatch:
            nonlocal out, data, waiting
            out = out or Bundle(folder)
            number, offset, length = out.add(b"".join(data))
            n = len(waiting)
            rows = record(
                schema, [w[0] for w in waiting], [out.path] * n, [number] * n, [offset] * n, [length] * n,
                [w[1] for w in waiting], [w[2] for w in waiting],
            )
            data, waiting = [], []
            if out.size >= bundle:
                out.close()
                out = None
            return rows

        size = 0
        for batch in pieces(batches, "payload"):
            for row in batch.to_pylist():
                made = warc_record(row["page_id"], row["url"], row["payload"], row["digest"], row["original"], date)
                if data and size + len(made) > frame:
                    yield flush()
                    size = 0
                waiting.append((name_of(row["page_id"]), size, len(made)))
                data.append(made)
                size += len(made)
        if data:
            yield flush()
        if out:
            out.close()

    return stage(pages.mapInArrow(run, INDEX), "warc-index")


def seek_table(file) -> list[tuple[int, int, int]]:
    """Offset, length and unpacked length of each frame, from the end of an open bundle."""
    size = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEK_FOOTER:
        raise ValueError("no seek table")
    table = file.read_at(8 * count, size - 9 - 8 * count)
    frames, at = [], 0
    for packed, plain in struct.iter_unpack("<II", table):
        frames.append((at, packed, plain))
        at += packed
    return frames


def parse(data: bytes, at: int = 0) -> Iterator[dict]:
    """The records of an unpacked frame from ``at`` on."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        after = begin + int(head["Content-Length"])
        body = data.index(b"\r\n\r\n", begin) + 4
        http = dict(x.split(": ", 1) for x in data[begin : body - 4].decode().split("\r\n")[1:])
        yield {
            "record_id": head["WARC-Record-ID"],
            "record_type": head["WARC-Type"],
            "url": head.get("WARC-Target-URI"),
            "payload": data[body:after] if head["WARC-Type"] == "response" else None,
            "payload_bytes": int(http["Content-Length"]),
            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
            "refers_to": head.get("WARC-Refers-To"),
        }
        at = after + 4


RECORDS = "record_id string, record_type string, url string, payload binary, payload_bytes long, payload_digest string, refers_to string"
_kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}


def _records(found: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([(n, _kinds[k]) for n, k in (f.split() for f in RECORDS.split(", "))])
    for x in found:
        if x["payload"] is not None:
            if hashlib.sha1(x["payload"]).hexdigest() != x["payload_digest"] or len(x["payload"]) != x["payload_bytes"]:
                raise ValueError(f"payload of {x['record_id']} differs from its digest")
    return record(schema, *[[x[n] for x in found] for n in schema.names])


def read(index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` names, payloads checked against their digests."""
    bundles = index.select("bundle").distinct()
    count = max(1, bundles.count())

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("bundle").to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    for offset, length, plain in seek_table(file):
                        data = zstandard.ZstdDecompressor().decompress(file.read_at(length, offset), max_output_size=plain)
                        yield _records(list(parse(data)))

    return bundles.repartition(count).mapInArrow(run, RECORDS)


def lookup(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records named in the column ``record_id``: each costs the frame it lies in."""
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, place = fs.FileSystem.from_uri(row["bundle"])
                with store.open_input_file(place) as file:
                    packed = file.read_at(row["frame_length"], row["frame_offset"])
                data = zstandard.ZstdDecompressor().decompress(packed)
                yield _records([next(parse(data, row["record_offset"]))])

    return wanted.mapInArrow(run, RECORDS)


def folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
