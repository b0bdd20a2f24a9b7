"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a skippable frame that holds the seek table of the
public seekable format (sizes of each frame, then count, descriptor and magic number). The index maps record identifiers to
bundle, frame and the offset inside the decompressed frame, so one record costs one seek and one frame.

Tasks write bundles to the shared folder under names of their own, and the index is kept there as a table; a task that runs
again after a loss writes new bundles and its index rows name those. Reading never depends on an executor's disk.

Defined results: a null payload is empty; of equal payloads of at least min_bytes the one with the largest page_id is the
response (rows that repeat that page_id are responses too), the others revisit it; a null page_id never beats another. A
null or odd URL is percent-encoded or left out. An empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_path, stash

# Fixed values of the seekable format.
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 256 << 10, 64 << 20, 3
MIN_BYTES = 1000
SALTS = 16
INDEX = "page_id long, record_id string, bundle string, frame int, frame_at long, frame_bytes int, at int, bytes int"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_id(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def page_of(record: str) -> int | None:
    tail = record.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def make_record(page_id, url, payload: bytes, digest: str, n: int, refers_to) -> bytes:
    """One WARC/1.1 record; payload is not stored for a revisit (refers_to is set)."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id)}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~-._"))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <{record_id(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload or None); a response's digest is computed."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = page_of(h["WARC-Record-ID"])
    if h["WARC-Type"] == "revisit":
        n = int(re.search(rb"Content-Length: (\d+)", http)[1])
        return page, n, h["WARC-Payload-Digest"].removeprefix("sha1:"), "revisit", page_of(h["WARC-Refers-To"]), None
    return page, len(payload), hashlib.sha1(payload).hexdigest(), "response", None, payload


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, raw bytes) of each frame of an open bundle."""
    size = f.size()
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    pairs, out, at = struct.unpack(f"<{2 * n}I", f.read(8 * n)), [], 0
    for c, d in zip(pairs[::2], pairs[1::2], strict=True):
        out.append((at, c, d))
        at += c
    return out


class _Bundle:
    """A bundle being written: yields the index rows of a frame once the frame is complete."""

    def __init__(self, fs, folder: str, level: int):
        import zstandard

        self.name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.f, self.z = fs.open_output_stream(self.name, compression=None), zstandard.ZstdCompressor(level=level)
        self.frames, self.at, self.raw, self.rows = [], 0, bytearray(), []

    def add(self, page_id, record: bytes):
        self.rows.append((page_id, len(self.raw), len(record)))
        self.raw += record

    def frame(self) -> list[tuple]:
        if not self.rows:
            return []
        data = self.z.compress(bytes(self.raw))
        self.f.write(data)
        out = [(p, record_id(p), self.name, len(self.frames), self.at, len(data), at, n) for p, at, n in self.rows]
        self.frames.append((len(data), len(self.raw)))
        self.at, self.raw, self.rows = self.at + len(data), bytearray(), []
        return out

    def close(self) -> list[tuple]:
        out = self.frame()
        self.f.write(seek_table(self.frames))
        self.f.close()
        return out


def _open_store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def with_heads(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, digest, n, head: head is the page_id of the response among equal payloads, or null if the row is it.

    Only digests that occur twice are joined, first with the ids of pages that have them, salted, then with the pages by id and digest;
    so neither empty pages nor a payload of many pages meet in one task with their html.
    """
    p = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("html"))
    p = p.withColumn("digest", F.sha1("html")).withColumn("n", F.octet_length("html"))
    ids = p.where(F.col("n") >= min_bytes).select("page_id", "digest")
    heads = ids.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("k")).where("k > 1 and last is not null").drop("k")
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    revisits = ids.distinct().withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(heads, ["digest", "salt"])
    revisits = revisits.where(~F.col("page_id").eqNullSafe(F.col("last"))).select(F.col("page_id").alias("own"), F.col("digest").alias("same"), F.col("last").alias("head"))
    return p.join(revisits, F.col("page_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("same")), "left").drop("own", "same")


def write_warc(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes the archives into folder (a URI that all executors reach) and returns their index, kept as a table there."""
    schema = _schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]):
        fs, base = _open_store(folder)
        fs.create_dir(base, recursive=True)
        bundle, written = None, 0
        for b in batches:
            rows: list[tuple] = []
            for page_id, url, html, digest, n, head in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "n", "head")], strict=True):
                if bundle is None:
                    bundle, written = _Bundle(fs, base, level), 0
                bundle.add(page_id, make_record(page_id, url, html, digest, n, head))
                if len(bundle.raw) >= frame_bytes:
                    rows += bundle.frame()
                    if bundle.at >= bundle_bytes:
                        rows += bundle.close()
                        bundle = None
            yield _arrow(rows, schema)
        if bundle is not None:
            yield _arrow(bundle.close(), schema)

    ready = with_heads(pages).select("page_id", "url", "html", "digest", "n", "head")
    return stash(ready.mapInArrow(run, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index rows name, read from the archives by seeking to their frames."""
    schema = _schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]):
        import zstandard

        fs, _ = _open_store(folder)
        d, now, raw, f, name = zstandard.ZstdDecompressor(), None, b"", None, None
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for bundle, frame_at, frame_bytes, at, n in zip(*[b.column(c).to_pylist() for c in ("bundle", "frame_at", "frame_bytes", "at", "bytes")], strict=True):
                if bundle != name:
                    f, name = fs.open_input_file(bundle), bundle
                if (bundle, frame_at) != now:
                    f.seek(frame_at)
                    raw, now = d.decompress(f.read(frame_bytes)), (bundle, frame_at)
                rows.append(parse_record(raw[at : at + n]))
                held += n
                if held > 8 << 20:
                    yield _arrow(rows, schema)
                    rows, held = [], 0
            yield _arrow(rows, schema)

    near = index.select("bundle", "frame_at", "frame_bytes", "at", "bytes")
    return near.repartition("bundle", "frame_at").sortWithinPartitions("bundle", "frame_at", "at").mapInArrow(run, RECORD)


def lookup(index: DataFrame, folder: str, page_ids: list[int]) -> DataFrame:
    return read_records(index.where(F.col("page_id").isin(page_ids)), folder)


def round_trip(pages: DataFrame) -> DataFrame:
    folder = shared_path(pages.sparkSession, "warc")
    return read_records(write_warc(pages, folder), folder).drop("payload")


SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, octet_length(encode(h)) as n, sha1(h) as d from p),
r as (select *, max(page_id) over (partition by d) as last from q)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 1000 and page_id <> last then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> last then last end as refers_to from r
"""
