"""Near-duplicate classes by consistent weighted sampling.

A document is the bag of its 5-word shingles (words of ASCII-lower-cased letters and digits; one shingle for a text of fewer
words). A shingle weighs tf * (1 + DAMP * ln(N / df) / ln N): the inverse document frequency is damped so that a few rare
shingles made by edits don't outweigh all that two copies share. Two documents are linked if their weighted Jaccard similarity
is 0.8 or more; classes are the connected components.

1. Document frequencies come from a key exchange between shards.
2. A document can only be linked if 0.8 of its weight lies in shingles that another document has; the others are done (this
   bound loses nothing). The rest get 64 improved consistent weighted samples in 16 bands of 4.
3. Equal texts are one node. A bucket of up to ALL_PAIRS members is compared in all pairs. A larger one is dealt into parts of about
   PART members; members are compared with their part's leader and the leaders with one another's, the bucket's. Leaders are drawn
   anew in every fourth band, so a member meets several.
4. Where a bucket of more than PART members still holds several components, members meet leaders drawn anew in ROUNDS rounds.
5. In buckets that hold several components after that, all members outside the largest one are compared with all members, in
   blocks of about BLOCK by BLOCK, so that every pair of a bucket is compared or already connected. The work of this step grows with
   the members times those outside the largest component. Every compared pair is verified on its whole bags.

No step brings a whole bucket together: buckets beyond BIG members (and a share of all rows; 50,000 buckets at most) are joined by
broadcast, and parts, blocks and leaders' stars are bounded.

Defined results: texts without words (null and empty too) are classes of their own; the class id is its smallest doc_id (null
ids last); repeated rows are copies of one class; an empty table gives an empty result. A pair of similarity s is found
in one bucket with probability 1 - (1 - s^4)^16: 0.9998 at 0.8.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shards, vec
from .common import stash
from .decontam import tokens

SHINGLE, SIMILAR, DAMP = 5, 0.8, 0.1
BANDS, IN_BAND = 16, 4
ALL_PAIRS, LEADERS, ROUNDS = 6, 4, 2
BLOCK, PART = 128, 256
BIG, BIG_KEYS = 256, 50_000
U = np.uint64


def _shingles(data, offs, bits: int):
    """(rows, shingle keys, counts), sorted by row and key, one for each shingle of each row."""
    rows, keys = [], []
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + vec.CHUNK, side="right")) - 1)
        _, _, _, h, bounds = tokens(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        size = np.diff(bounds)
        row = np.repeat(np.arange(i, j), size)
        g = vec.gram_hash(h, SHINGLE)
        if len(g):
            ok = row[: len(g)] == row[SHINGLE - 1 :]
            rows.append(row[: len(g)][ok])
            keys.append(g[ok])
        few = np.flatnonzero((size > 0) & (size < SHINGLE))
        for r in few:
            rows.append(np.array([i + r]))
            keys.append(vec.gram_hash(h[bounds[r] : bounds[r + 1]], int(size[r])))
        i = j
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    row, key = np.concatenate(rows), np.concatenate(keys) >> U(64 - bits)
    own = max(1, int(n).bit_length())
    if own + bits <= 64:
        x = np.sort((row.astype(U) << U(bits)) | key)
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        return (x[at] >> U(bits)).astype(np.int64), x[at] & U((1 << bits) - 1), np.diff(np.append(at, len(x)))
    o = np.lexsort((key, row))
    row, key = row[o], key[o]
    at = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])]))
    return row[at], key[at], np.diff(np.append(at, len(key)))


def _frequencies(key: np.ndarray):
    k = np.sort(key)
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[at], np.diff(np.append(at, len(k))).astype(np.uint32)


def weights(tf: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    return tf * (1 + DAMP * np.log(max(n, 2) / np.maximum(df, 1)) / math.log(max(n, 2)))


def samples(key: np.ndarray, w: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The k-th consistent weighted sample of each bag (starts: where the bags begin), hashed."""
    h = vec.mix(key * U(2 * k + 1) + U(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF))
    low = U((1 << 24) - 1)
    unit = np.float32(1 / (1 << 24))
    part = lambda x, s: ((x >> U(s)) & low).astype(np.float32) * unit + unit / 2
    r = -np.log(part(h, 0) * part(h, 24))
    beta = (h >> U(48)).astype(np.float32) * np.float32(1 / (1 << 16))
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    c = np.log(-np.log(part(h, 0) * part(h, 24)))
    t = np.floor(np.log(w) / r + beta)
    a = c - r * (t - beta + 1)
    least = np.minimum.reduceat(a, starts)
    size = np.diff(np.append(starts, len(a)))
    hit = np.flatnonzero(a == np.repeat(least, size))
    bag = np.searchsorted(starts, hit, side="right") - 1
    first = hit[np.concatenate([[True], bag[1:] != bag[:-1]])]
    return vec.mix(key[first] * vec.P + t[first].astype(np.int64).astype(U))


def band_values(key, w, starts) -> np.ndarray:
    """A row for each bag, a column for each band."""
    out = np.zeros((len(starts), BANDS), U)
    w = w.astype(np.float32)
    step = 1 << 16  # entries at a time
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + step, side="right")) - 1)
        j = len(starts) if j >= len(starts) - 1 and (len(key) - starts[i]) <= step else min(j, len(starts))
        a, z = starts[i], starts[j] if j < len(starts) else len(key)
        for b in range(BANDS):
            v = np.full(j - i, U(b), U)
            for x in range(IN_BAND):
                v = vec.mix(v * vec.P + samples(key[a:z], w[a:z], starts[i:j] - a, b * IN_BAND + x))
            out[i:j, b] = v
        i = j
    return out


NODES = "node long, id long, first long, same binary, total double, bands array<long>, keys binary, weights binary"


def _nodes(docs: DataFrame, id_col: str, text_col: str):
    """(shards, a row for each document: its node number, and for those that may be linked what they are compared by)."""
    packed = shards.pack(docs, text_col)
    total = packed.agg(F.sum("bytes"), F.sum("rows")).first()
    n_docs, bits = total[1] or 0, shards.key_bits((total[0] or 0) / 4, 14)
    buckets = shards.n_buckets(packed, 0.16)
    s = packed.select("sid", "blob")

    def first(batches):
        for b in batches:
            for sid, blob in zip(b.column("sid").to_pylist(), b.column("blob"), strict=True):
                data, offs = vec.strings(shards.unpack(blob.as_py()).column(text_col))
                yield shards.key_rows(sid, *_frequencies(_shingles(data, offs, bits)[1]), bits, buckets)

    def second(batches):
        for b in batches:
            for sid, blob, answers in zip(b.column("sid").to_pylist(), b.column("blob"), b.column("answers"), strict=True):
                batch = shards.unpack(blob.as_py())
                yield _described(sid, batch, batch.column(id_col), batch.column(text_col), shards.answers_of(answers.as_py(), np.uint32), bits, n_docs)

    answers = shards.exchange(s.mapInArrow(vec.released(first), shards.KEYS), np.uint32, shards.sums)
    return packed, stash(s.join(answers, "sid", "left").mapInArrow(vec.released(second), NODES), "near-nodes")


def _described(sid, batch, ids, texts, df, bits, n_docs):
    data, offs = vec.strings(texts)
    row, key, tf = _shingles(data, offs, bits)
    at = np.searchsorted(_frequencies(key)[0], key) if len(key) else np.zeros(0, np.int64)
    f = df[at] if len(key) else np.zeros(0)
    w = weights(tf, f, n_docs)
    n = batch.num_rows
    total = np.bincount(row, w, n)
    shared = np.bincount(row, w * (f >= 2), n)
    may = (total > 0) & (shared >= SIMILAR * total * (1 - 1e-9))
    task, k = map(int, sid.split("-"))
    base = (task << 40) | (k << 20)
    seen: dict[bytes, int] = {}
    same, lead = [None] * n, [None] * n
    for r in np.flatnonzero(may):
        d = hashlib.blake2b(data[offs[r] : offs[r + 1]].tobytes(), digest_size=16).digest()
        same[r], lead[r] = d, base | seen.setdefault(d, int(r))
    firsts = np.array(sorted(seen.values()), np.int64)
    pick = np.isin(row, firsts)
    row, key, w = row[pick], key[pick], w[pick].astype(np.float32)
    starts = np.searchsorted(row, firsts)
    ends = np.append(starts[1:], len(row))[: len(firsts)]
    bands = band_values(key, w, starts) if len(firsts) else np.zeros((0, BANDS), U)
    cols = {x: [None] * n for x in ("bands", "keys", "weights")}
    for r, a, z, v in zip(firsts, starts, ends, bands, strict=True):
        cols["bands"][r] = v.view(np.int64).tolist()
        cols["keys"][r] = shards.squeeze(np.diff(key[a:z], prepend=U(0)))
        cols["weights"][r] = shards.squeeze(w[a:z].view(np.uint32))
    return pa.RecordBatch.from_arrays(
        [pa.array(base | np.arange(n)), ids.cast(pa.int64()), pa.array(lead, pa.int64()), pa.array(same, pa.binary()), pa.array(total), pa.array(cols["bands"], pa.list_(pa.int64())), pa.array(cols["keys"], pa.binary()), pa.array(cols["weights"], pa.binary())],
        ["node", "id", "first", "same", "total", "bands", "keys", "weights"],
    )


def similarity(ka, wa, kb, wb) -> float:
    both, i, j = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[i], wb[j]).sum(dtype=float)
    return shared / (wa.sum(dtype=float) + wb.sum(dtype=float) - shared)


def _bag(keys: bytes, weights: bytes):
    return np.cumsum(shards.expand(keys, U), dtype=U), shards.expand(weights, np.uint32).view(np.float32)


def _joining(band: int, left: list[dict], right: list[dict]):
    """The pairs of components that a similar pair of a left and a right member of a bucket joins, each joined once.
    A pair that shares an earlier band is left to that band's bucket."""
    bags = [_bag(x["keys"], x["weights"]) for x in left + right]
    at = np.unique(np.concatenate([k for k, _ in bags]), return_inverse=True)[1]
    size = np.array([len(k) for k, _ in bags])
    ends, n = np.cumsum(size), len(left)
    first = ends[n - 1]
    starts = (ends - size)[n:] - first
    mass = np.array([w.sum(dtype=float) for _, w in bags])
    at_r, w_r = at[first:], np.concatenate([w for _, w in bags[n:]])
    node, comp, total = (np.array([x[c] for x in left + right]) for c in ("node", "comp", "total"))
    own = comp.copy()
    earlier = np.array([x["bands"][:band] for x in left + right], np.int64).reshape(len(bags), band)
    outside = np.array([y["outside"] for y in right])
    held = np.zeros(at.max() + 1, np.float32)
    for i in range(n):
        can = (comp[n:] != comp[i]) & ~(outside & (node[n:] > node[i]))
        can &= np.minimum(total[n:], total[i]) >= SIMILAR * (1 - 1e-6) * np.maximum(total[n:], total[i])
        can &= ~(earlier[n:] == earlier[i]).any(axis=1)
        if not can.any():
            continue
        mine = at[ends[i] - size[i] : ends[i]]
        held[mine] = bags[i][1]
        shared = np.add.reduceat(np.minimum(held[at_r], w_r), starts, dtype=float)
        held[mine] = 0
        for j in np.flatnonzero(can & (shared >= (SIMILAR - 1e-6) * (mass[i] + mass[n:] - shared))) + n:
            if comp[j] != comp[i]:
                yield int(own[i]), int(own[j])
                comp[comp == comp[j]] = comp[i]


def with_keys(rows: DataFrame, info: DataFrame, by: list[str], limit: int, how: str = "inner") -> DataFrame:
    """rows joined with info on `by`. info's `n` says how many rows have its key; keys of more than `limit` rows, of which there are
    rows / limit at most, are broadcast and their rows aren't shuffled, so no task gets more than `limit` rows of one key."""
    big, rest = info.where(F.col("n") > limit), info.where(F.col("n") <= limit)
    return rows.join(F.broadcast(big), by).unionByName(rows.join(F.broadcast(big.select(*by)), by, "left_anti").join(rest, by, how))


def _across(members: DataFrame, bags: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) of all components that a similar pair in a bucket joins. members: band, value, node, comp."""
    by = ["band", "value"]
    parts = members.groupBy(*by, "comp").agg(F.count(F.lit(1)).alias("k"))
    parts = parts.groupBy(*by).agg(F.sum("k").alias("n"), F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    split = lambda c: F.ceil(c / BLOCK)
    parts = stash(parts.select(*by, "n", F.col("top.comp").alias("most"), split(F.col("n")).alias("rights"), split(F.col("n") - F.col("top.k")).alias("lefts")), "near-open")
    m = with_keys(members, parts, by, limit).drop("n")
    m = stash(m.withColumn("outside", F.col("comp") != F.col("most")), "near-open")
    block = lambda n: F.pmod(F.xxhash64("node", F.lit("block")), n)
    held = F.collect_list(F.struct("node", "comp", "outside", "total", "bands", "keys", "weights"))
    right = m.withColumn("block", block(F.col("rights"))).join(bags, "node").groupBy(*by, "block").agg(held.alias("right"))
    left = m.where("outside").withColumn("part", block(F.col("lefts"))).join(bags, "node").groupBy(*by, "part", "rights").agg(held.alias("left"))
    left = left.select(*by, "left", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)).alias("block"))

    def run(batches):
        for batch in batches:
            for band, left, right in zip(*[batch.column(c) for c in ("band", "left", "right")], strict=True):
                out = list(_joining(band.as_py(), left.as_py(), right.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return left.join(right, [*by, "block"]).select("band", "left", "right").mapInArrow(vec.released(run), "a long, b long")


def _verified(pairs: DataFrame, bags: DataFrame, *more: str) -> DataFrame:
    """The pairs (a, b) of similarity SIMILAR or more, with the columns `more`."""
    cols = ["a", "b", *more]

    def run(batches):
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            held, bag = None, None
            for i, (b, ka, wa, kb, wb) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("b", "ka", "wa", "kb", "wb")], strict=True)):
                if b != held:
                    held, bag = b, _bag(kb, wb)
                keep[i] = similarity(*_bag(ka, wa), *bag) >= SIMILAR - 1e-6
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in cols], cols).filter(pa.array(keep))

    left = bags.select(F.col("node").alias("a"), F.col("keys").alias("ka"), F.col("weights").alias("wa"))
    right = bags.select(F.col("node").alias("b"), F.col("keys").alias("kb"), F.col("weights").alias("wb"))
    return pairs.select(*cols).join(left, "a").join(right, "b").select(*cols, "ka", "wa", "kb", "wb").mapInArrow(vec.released(run), ", ".join(f"{c} long" for c in cols))


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links: comp is the smallest node of its component. Labels jump to their labels' labels."""
    edges = stash(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "near-edges")
    lab = stash(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "near-labels")
    while True:
        seen = edges.join(lab.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = lab.join(seen, "node").select("node", "comp", F.least("comp", "m").alias("next"))
        jump = step.join(lab.select(F.col("node").alias("next"), F.col("comp").alias("far")), "next", "left")
        new = stash(jump.select("node", F.coalesce("far", "next").alias("comp"), (F.coalesce("far", "next") < F.col("comp")).alias("moved")), "near-labels")
        if new.where("moved").isEmpty():
            return lab
        lab = new.select("node", "comp")


def _relabelled(label: DataFrame, links: DataFrame, limit: int) -> DataFrame:
    """label (node, comp) after links between components."""
    step = components(links).select(F.col("node").alias("comp"), F.col("comp").alias("far"))
    size = label.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    step = step.join(size, "comp")
    return stash(with_keys(label, step, ["comp"], limit, "left").select("node", F.coalesce("far", "comp").alias("comp")), "near-labels")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(shards, a row (node, id, class_node, class_id) for each row of docs)."""
    packed, nodes = _nodes(docs, id_col, text_col)
    some = nodes.where("same is not null")
    heads = stash(some.where("first = node").groupBy("same").agg(F.min("node").alias("rep")), "near-heads")
    bags = stash(some.select("node", "total", "bands", "keys", "weights").join(heads.select(F.col("rep").alias("node")), "node", "left_semi"), "near-bags")
    by = ["band", "value"]
    close = F.least("total", "total2") >= SIMILAR * (1 - 1e-6) * F.greatest("total", "total2")
    draw = lambda *salt: F.min(F.struct(F.xxhash64("node", *salt), "node", "total"))
    limit = max(BIG, BANDS * bags.count() // BIG_KEYS)
    members = bags.select("node", "total", F.posexplode("bands").alias("band", "value"))
    full = stash(members.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), draw(F.col("band") % LEADERS).alias("leader")).where("n > 1"), "near-buckets")
    members = stash(with_keys(members, full, by, limit), "near-members")
    small = members.where(F.col("n") <= ALL_PAIRS).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("node", "total"))).alias("m"))
    small = small.select(F.posexplode("m").alias("i", "x"), "m").select("x", F.explode(F.expr("slice(m, i + 2, size(m))")).alias("y"))
    wide = members.where(F.col("n") > ALL_PAIRS).withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), F.ceil(F.col("n") / PART)))
    parts = wide.groupBy(*by, "part").agg(draw(F.col("band") % LEADERS).alias("own"), F.first("leader").alias("leader"))
    pair = lambda df, x, y: df.select(F.col(f"{x}node").alias("a"), F.col(f"{y}node").alias("b"), F.col(f"{x}total").alias("total"), F.col(f"{y}total").alias("total2"))
    found = pair(small, "y.", "x.").union(pair(wide.drop("leader").join(parts.drop("leader"), [*by, "part"]), "", "own.")).union(pair(parts, "own.", "leader."))
    ordered = lambda df: df.where(close & (F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stash(_verified(stash(ordered(found), "near-pairs"), bags), "near-links")
    label = bags.select("node").join(components(links), "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))
    wide = wide.select(*by, "node", "total", "n")
    if not wide.isEmpty():
        label = stash(label, "near-labels")
        for turn in range(ROUNDS + 1):
            m = stash(wide.join(label, "node"), "near-wide")
            top = m.groupBy(*by).agg(F.first("n").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "total", "comp")).alias("leader"))
            top = stash(top.where("lo < hi").select(*by, "n", F.col("leader.node").alias("b"), F.col("leader.total").alias("total2"), F.col("leader.comp").alias("comp2")), "near-leaders")
            if top.isEmpty():  # no bucket holds several components
                break
            m = with_keys(m.drop("n"), top, by, limit)
            if turn == ROUNDS:
                across = stash(_across(m.select(*by, "node", "comp"), bags, limit), "near-links")
                label = label if across.isEmpty() else _relabelled(label, across, limit)
                break
            wide = m.select(*by, "node", "total", "n")  # the other buckets are done
            more = m.where((F.col("n") > PART) & (F.col("comp") != F.col("comp2")) & close).select(F.col("node").alias("a"), "b", "comp", "comp2").distinct()
            new = stash(_verified(more, bags, "comp", "comp2"), "near-links")
            label = label if new.isEmpty() else _relabelled(label, new.select(F.col("comp").alias("a"), F.col("comp2").alias("b")).distinct(), limit)
    # copies take their head's component
    of = some.where("first = node").select("node", "same").join(heads, "same").select(F.col("node").alias("first"), "rep")
    of = of.join(label.withColumnRenamed("node", "rep"), "rep").select("first", "comp")
    labelled = stash(nodes.select("node", "id", "first").join(of, "first", "left").select("node", "id", F.coalesce("comp", "node").alias("comp")), "near-classes")
    # only components of two or more are met again
    order = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    best = stash(labelled.groupBy("comp").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1"), "near-best")
    out = with_keys(labelled, best, ["comp"], max(BIG, labelled.count() // BIG_KEYS), "left").select(
        "node", "id", F.coalesce("best.node", "node").alias("class_node"), F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("class_id")
    )
    return packed, out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and class_id for each row of docs."""
    return classes(docs.select(id_col, text_col), id_col, text_col)[1].select(F.col("id").alias(id_col), "class_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each class, with all its columns."""
    packed, out = classes(docs, id_col, text_col)
    gone = out.where("node <> class_node").select(
        F.concat_ws("-", F.shiftright("node", 40), F.shiftright("node", 20).bitwiseAND(F.lit((1 << 20) - 1))).alias("sid"), F.col("node").bitwiseAND(F.lit((1 << 20) - 1)).cast("int").alias("r")
    )
    drop = gone.groupBy("sid").agg(F.collect_list("r").alias("gone"))

    def run(batches):
        for b in batches:
            for blob, gone in zip(b.column("blob"), b.column("gone").to_pylist(), strict=True):
                rows = shards.unpack(blob.as_py())
                keep = np.ones(rows.num_rows, bool)
                keep[gone or []] = False
                yield rows.filter(pa.array(keep))

    return packed.select("sid", "blob").join(drop, "sid", "left").mapInArrow(vec.released(run), docs.schema)
