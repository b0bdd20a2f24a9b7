"""Shards: rows packed into compressed Arrow batches of bounded size, and an exchange of sorted keys between them.

A shard is a few megabytes of rows with all their columns, kept as one row (sid, blob) of a table in the shared folder, so a
task that runs again finds the same shards. `exchange` sends each shard's sorted unique keys, cut by key range into buckets and
coded as differences, to the task that owns the bucket, and returns one answer for each key in the shard's own order. A key
costs a shard one entry however many of its rows hold it, so hot keys arrive pre-aggregated.
"""

from __future__ import annotations

import pickle
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import partitions, stash

SHARD_BYTES = 4 << 20
ROWS = 1 << 20  # of one shard at most
KEYS_A_BUCKET = 1 << 20
PLAIN = 64
U = np.uint64


def _zstd(level: int = 1):
    import zstandard

    return zstandard.ZstdCompressor(level=level)


def squeeze(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes; a few bytes stay as they are, so that small runs cost no frame."""
    a = np.ascontiguousarray(a)
    width = a.dtype.itemsize
    planes = np.frombuffer(a.tobytes(), np.uint8).reshape(-1, width).T
    top = width
    while top > 1 and not planes[top - 1].any():
        top -= 1
    raw = np.ascontiguousarray(planes[:top]).tobytes()
    plain = len(raw) < PLAIN
    return struct.pack("<IBB", len(a), width, top | (128 if plain else 0)) + (raw if plain else _zstd().compress(raw))


def expand(b: bytes, dtype) -> np.ndarray:
    import zstandard

    n, width, top = struct.unpack("<IBB", b[:6])
    plain, top = top & 128, top & 127
    planes = np.zeros((width, n), np.uint8)
    if n:
        raw = b[6:] if plain else zstandard.ZstdDecompressor().decompress(b[6:], max_output_size=max(1, n * top))
        planes[:top] = np.frombuffer(raw, np.uint8).reshape(top, n)
    return np.frombuffer(np.ascontiguousarray(planes.T).tobytes(), dtype)


def pack(docs: DataFrame, text_col: str = "text", size: int = SHARD_BYTES) -> DataFrame:
    """(sid, rows, bytes, blob), stashed. Every column of docs is inside the blob."""

    def run(batches: Iterator[pa.RecordBatch]):
        task, k, held, n = TaskContext.get().partitionId(), 0, [], 0
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))

        def out():
            nonlocal k, held, n
            t = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=options) as w:
                w.write_table(t)
            k += 1
            r = pa.RecordBatch.from_arrays([pa.array([f"{task}-{k}"]), pa.array([t.num_rows], pa.int32()), pa.array([n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["sid", "rows", "bytes", "blob"])
            held, n = [], 0
            return r

        from .vec import strings

        for b in batches:
            if not len(b):
                continue
            _, offs = strings(b.column(text_col))
            i = 0
            while i < len(b):
                j = max(i + 1, int(np.searchsorted(offs, offs[i] + size - n, side="right")) - 1)
                j = min(j, i + ROWS - sum(map(len, held)))
                held.append(b.slice(i, j - i))
                n += int(offs[j] - offs[i])
                i = j
                if n >= size or i < len(b) or sum(map(len, held)) >= ROWS:
                    yield out()
        if held:
            yield out()

    return stash(docs.mapInArrow(vec.released(run), "sid string, rows int, bytes long, blob binary"), "shards")


def unpack(blob: bytes) -> pa.RecordBatch:
    t = pa.ipc.open_stream(pa.py_buffer(blob)).read_all().combine_chunks()
    return t.to_batches()[0] if t.num_rows else pa.RecordBatch.from_pylist([], schema=t.schema)


def n_buckets(shards: DataFrame, keys_a_byte: float) -> int:
    """From the bytes of all shards, so that a bucket holds about KEYS_A_BUCKET keys."""
    total = shards.agg(F.sum("bytes")).first()[0] or 0
    return int(max(4 * partitions(shards.sparkSession), total * keys_a_byte / KEYS_A_BUCKET))


def key_bits(total_keys: float, spare: int) -> int:
    """Bits that keep the chance of a collision of one key near 2^-spare at every size of the corpus."""
    return int(min(64, max(32, np.ceil(np.log2(max(total_keys, 2))) + spare)))


KEYS = "bucket int, sid string, keys binary, vals binary"


def key_rows(sid: str, keys: np.ndarray, vals: np.ndarray, bits: int, buckets: int) -> pa.RecordBatch:
    """The rows (bucket, sid, keys, vals) of one shard's sorted unique keys below 2^bits."""
    span = span_of(bits, buckets)
    which = (keys // span).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1, [len(which)]]) if len(which) else np.zeros(1, np.int64)
    out = ([], [], [], [])
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        base = U(which[a]) * span
        out[0].append(int(which[a]))
        out[1].append(sid)
        out[2].append(squeeze(np.diff(keys[a:z], prepend=base)))
        out[3].append(squeeze(vals[a:z]))
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], ["bucket", "sid", "keys", "vals"])


def block_rows(sid: str, rows: np.ndarray, vals: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """The same for rows of bytes, in order of their buckets."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()), pa.array([sid] * len(spans), pa.string()), pa.array([squeeze(rows[a:z].ravel()) for a, z in spans], pa.binary()), pa.array([squeeze(vals[a:z]) for a, z in spans], pa.binary())],
        ["bucket", "sid", "keys", "vals"],
    )


def own_row(sid: str, arrays) -> pa.RecordBatch:
    """A row that the exchange gives back to its shard unread, under a bucket below 0."""
    blob = pickle.dumps([squeeze(x) for x in arrays])
    return pa.RecordBatch.from_arrays([pa.array([-1 - zlib.crc32(sid.encode()) % (1 << 30)], pa.int32()), pa.array([sid]), pa.array([blob], pa.binary()), pa.array([b""], pa.binary())], ["bucket", "sid", "keys", "vals"])


def own_of(found, *types) -> list[np.ndarray]:
    """The arrays of own_row."""
    return [expand(x, t) for x, t in zip(pickle.loads(next(x["blob"] for x in found if x["bucket"] < 0)), types, strict=True)]


def exchange(rows: DataFrame, val_type, answer: Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]], row_type=None) -> DataFrame:
    """(sid, answers): answers holds (bucket, blob) with `answer`'s array for the shard's keys in that bucket.

    answer gets the sorted key runs (as offsets in the bucket; as they are, where row_type says what they are made of) and the value
    arrays of all shards in one bucket.
    """
    name, row_name = np.dtype(val_type).str, row_type and np.dtype(row_type).str

    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        if bucket < 0:
            return pa.table({"sid": t.column("sid"), "bucket": t.column("bucket"), "blob": t.column("keys")})
        keys = [expand(x, np.dtype(row_name)) if row_name else np.cumsum(expand(x, U), dtype=U) for x in t.column("keys").to_pylist()]
        vals = [expand(x, np.dtype(name)) for x in t.column("vals").to_pylist()]
        got = [squeeze(x) for x in answer(keys, vals)]
        return pa.table({"sid": t.column("sid"), "bucket": pa.array([bucket] * t.num_rows, pa.int32()), "blob": pa.array(got, pa.binary())})

    answers = rows.groupBy("bucket").applyInArrow(run, "sid string, bucket int, blob binary")
    return answers.groupBy("sid").agg(F.collect_list(F.struct("bucket", "blob")).alias("answers"))


def merged(keys: list[np.ndarray]) -> np.ndarray:
    """The sorted unique keys of sorted runs."""
    a = np.sort(np.concatenate(keys))
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def sums(keys: list[np.ndarray], vals: list[np.ndarray]) -> list[np.ndarray]:
    """For each run, the sum of each key's values over all runs, found by binary search in the merged run."""
    u = merged(keys)
    at = [np.searchsorted(u, k) for k in keys]
    total = np.zeros(len(u), np.int64)
    for i, v in zip(at, vals, strict=True):
        total[i] += v
    return [total[i].astype(np.uint32) for i in at]


def span_of(bits: int, buckets: int):
    """Keys in a bucket."""
    return U(max(1, -(-(1 << bits) // buckets)))


def _parts(found) -> list[tuple[int, bytes]]:
    return sorted(((x["bucket"], x["blob"]) for x in found or [] if x["bucket"] >= 0), key=lambda x: x[0])


def answers_of(found, dtype) -> np.ndarray:
    """The answers to one shard's keys, in the order of the keys."""
    parts = _parts(found)
    return np.concatenate([expand(b, dtype) for _, b in parts]) if parts else np.zeros(0, dtype)


def coded_keys_of(found, bits: int, buckets: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, codes) of answers that are differences of keys with a code in their `low` lowest bits."""
    parts = [(np.cumsum(expand(b, U), dtype=U), U(k) * span_of(bits, buckets)) for k, b in _parts(found)]
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.uint8)
    return np.concatenate([(x >> U(low)) + base for x, base in parts]), np.concatenate([(x & U((1 << low) - 1)).astype(np.uint8) for x, _ in parts])
