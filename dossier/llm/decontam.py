"""Benchmark decontamination by winnowing.

Of the 5-word hashes in each window of 6 the minimum is kept, so any 10 words that a document shares with an item share a
kept hash. Documents' and items' fingerprints meet in an equi-join; each hit is extended to every window of 10 words round it (of all
words for a shorter item, which is fingerprinted whole) that the item has, found by hash and compared as bytes. A hit is a place in the
document only, so work is the document's places plus the item's, not their product, however repetitive both are.

A fixed-size bit table of the items' fingerprints spares most document fingerprints the join; it never decides a hit.

Defined results: a null or empty text has no words; an item without words matches nothing; an item without id marks words but
isn't counted; repeated rows stay repeated; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from . import vec
from .common import stash

SPAN, GRAM = 10, 5
BITS = 1 << 22
BROADCAST_ROWS = 50_000  # fingerprints of items; 60 bytes each at most

_c = np.arange(256)
LOWER = np.where((_c >= 65) & (_c <= 90), _c + 32, _c).astype(np.uint8)
WORD = ((_c >= 48) & (_c <= 57)) | ((_c >= 97) & (_c <= 122)) | (_c >= 128)  # after lower-casing


def tokens(data: np.ndarray, offs: np.ndarray):
    """(lower-cased bytes, word starts, word ends, word hashes, row bounds among the words)."""
    low = LOWER[data]
    s, e = vec.runs(WORD[low], offs)
    return low, s, e, vec.span_hash(vec.prefix(low), s, e), np.searchsorted(s, offs, side="left")


def fingerprints(h: np.ndarray, bounds: np.ndarray, short: list[int]):
    """(word positions, fingerprints): winnowed for long items, and every n-word hash for each n in short."""
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, fp = [], []
    w = SPAN - GRAM + 1
    g = vec.gram_hash(h, GRAM)
    if len(g) >= w:
        # the minimum is taken over windows inside one row; a position kept by a window across rows does no harm
        p = vec.winnowed(g, w)
        at.append(p[row_of[p] == row_of[p + GRAM - 1]])
        fp.append(g[at[-1]])
    for n in short:
        x = vec.gram_hash(h, n)
        p = np.arange(len(x))
        at.append(p[row_of[p] == row_of[p + n - 1]])
        fp.append(vec.mix(x[at[-1]] + vec.U(n * 77)))
    return (np.concatenate(at), np.concatenate(fp)) if at else (np.zeros(0, np.int64), np.zeros(0, vec.U))


def _item_fingerprints(items: DataFrame) -> DataFrame:
    """(item, fp, n), each fingerprint of an item once; n: its words."""

    def run(batches):
        for b in batches:
            out = {"item": [], "fp": [], "n": []}
            for i, j, data, offs in vec.chunks(b, "text"):
                ids = b.column("item").slice(i, j - i).to_numpy(zero_copy_only=False)
                _, _, _, h, bounds = tokens(data, offs)
                for r in range(j - i):
                    own = h[bounds[r] : bounds[r + 1]]
                    n = len(own)
                    if not n:
                        continue
                    if n < SPAN:
                        f = vec.mix(vec.gram_hash(own, n) + vec.U(n * 77))
                    else:
                        f = np.unique(fingerprints(own, np.array([0, n]), [])[1])
                    out["item"] += [ids[r]] * len(f)
                    out["fp"] += f.view(np.int64).tolist()
                    out["n"] += [n] * len(f)
            yield pa.RecordBatch.from_arrays([pa.array(out["item"], pa.int64()), pa.array(out["fp"], pa.int64()), pa.array(out["n"], pa.int32())], ["item", "fp", "n"])

    return items.select("item", "text").mapInArrow(vec.released(run), "item long, fp long, n int")


def _document_fingerprints(docs: DataFrame, table: bytes, short: list[int]) -> DataFrame:
    def run(batches):
        bits = np.frombuffer(table, np.uint8)
        for b in batches:
            for i, j, data, offs in vec.chunks(b, "t"):
                _, _, _, h, bounds = tokens(data, offs)
                at, fp = fingerprints(h, bounds, short)
                slot = (fp & vec.U(BITS - 1)).astype(np.int64)
                ok = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
                at, fp = at[ok], fp[ok]
                r = np.searchsorted(bounds, at, side="right") - 1
                keys = b.column("k").slice(i, j - i).to_numpy()[r]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fp.view(np.int64)), pa.array((at - bounds[r]).astype(np.int32))], ["k", "dfp", "pos"])

    return docs.select("k", "t").mapInArrow(vec.released(run), "k long, dfp long, pos int")


def _hit_words(dh, ih, hits, same) -> np.ndarray:
    """Which words are in a window of min(SPAN, words of the item) words that the item has; windows round the hits are tried.

    same(p, i, n): whether the n words from p in the document are those from i in the item."""
    need = min(SPAN, len(ih))
    gram = min(GRAM, need)
    hit = np.zeros(len(dh), bool)
    first = np.unique((np.asarray(hits)[:, None] - np.arange(need - gram + 1)).ravel())
    first = first[(first >= 0) & (first + need <= len(dh))]
    if not len(first):
        return hit
    of_item, where = np.unique(vec.gram_hash(ih, need), return_index=True)
    d = vec.gram_hash(dh, need)[first]
    at = np.minimum(np.searchsorted(of_item, d), len(of_item) - 1)
    for p, i in zip(first[of_item[at] == d], where[at][of_item[at] == d], strict=True):
        if same(p, i, need):
            hit[p : p + need] = True
    return hit


def match_words(docs: DataFrame, benchmark: DataFrame, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs as `row` with their text `t` and `found`, the items met by a fingerprint and where."""
    # texts of items are met once each; their ids are named at the end
    items = (
        benchmark.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text"))
        .where("text is not null").groupBy("text").agg(F.array_sort(F.collect_set("id")).alias("ids"))
        .select(F.xxhash64("text").alias("item"), "text", "ids")
    )
    items = stash(items, "bench-items")
    fps = stash(_item_fingerprints(items), "bench-fps")
    short = [r[0] for r in fps.where(F.col("n") < SPAN).select("n").distinct().collect()]
    slots = fps.select(F.col("fp").bitwiseAND(F.lit(BITS - 1)).cast("int").alias("s")).distinct().toPandas()["s"].to_numpy()
    n_fps = fps.count()
    bits = np.zeros(BITS, np.uint8)
    bits[slots] = 1
    bits = np.packbits(bits, bitorder="little").tobytes()

    # a key for each row, so that copies of one text part; rows that repeat whole share theirs
    plain = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (MapType, VariantType))]
    d = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{doc_text}`"), F.lit("")).alias("t"), F.xxhash64(*plain).alias("k"))
    near = F.broadcast if n_fps <= BROADCAST_ROWS else (lambda x: x)
    met = _document_fingerprints(d, bits, short).join(near(fps), F.col("dfp") == F.col("fp"))
    by_item = met.groupBy("k", "item").agg(F.collect_set("pos").alias("hits"))
    by_item = by_item.join(F.broadcast(items) if n_fps <= BROADCAST_ROWS else items, "item")
    by_text = by_item.groupBy("k").agg(F.collect_list(F.struct("text", "ids", "hits")).alias("found"))
    return d.join(by_text, "k", "left").select("row", "t", "found")


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs."""
    met = match_words(docs.select(id_col, F.col(f"`{names.get('doc_text', 'text')}`")), benchmark, **names).select(F.col(f"row.{id_col}").alias("id"), "t", "found")
    kind = dict(met.dtypes)["id"]
    out = f"id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return met.mapInArrow(vec.released(lambda batches: _judged(batches, "id")), out).withColumnRenamed("id", id_col)


def _judged(batches, id_col: str):
    for b in batches:
        n_words, n_hit, n_items, sha = [], [], [], []
        for i, j, data, offs in vec.chunks(b, "t"):
            low, s, e, h, bounds = tokens(data, offs)
            found = b.column("found").slice(i, j - i)
            n_words += np.diff(bounds).tolist()
            valid = found.is_valid().to_numpy(zero_copy_only=False)
            for r in range(j - i):
                if not valid[r]:
                    n_hit.append(0), n_items.append(0), sha.append(hashlib.sha256(b"").hexdigest())
                    continue
                a, z = bounds[r], bounds[r + 1]
                hit, ids = np.zeros(z - a, bool), set()
                for f in found[r].as_py():
                    raw = np.frombuffer(f["text"].encode(), np.uint8)
                    ilow, ist, ien, ih, _ = tokens(raw, np.array([0, len(raw)]))

                    def same(p, i, n, a=a, ilow=ilow, ist=ist, ien=ien):
                        return all(low[s[a + p + x] : e[a + p + x]].tobytes() == ilow[ist[i + x] : ien[i + x]].tobytes() for x in range(n))

                    mine = _hit_words(h[a:z], ih, f["hits"], same)
                    if mine.any():
                        hit |= mine
                        ids.update(f["ids"])
                n_hit.append(int(hit.sum())), n_items.append(len(ids))
                sha.append(hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(id_col), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())],
            [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def clean_only(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a hit, with all their columns."""
    met = match_words(docs, benchmark)
    kind = met.schema["row"].dataType.simpleString()
    out = "row " + kind + ", n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    flagged = met.mapInArrow(vec.released(lambda batches: _judged(batches, "row")), out)
    return flagged.where("not contaminated").select("row.*")
