"""Removal of repeated passages with suffix arrays.

Bytes of a 50-byte string that also starts in a document with a smaller id are removed.

0. A row whose whole text is in a document with a smaller id (equal length and 128-bit digest) goes whole and takes no further part.
1. Shards pick sparse anchors: the minimum hash of the 26-byte strings in each 50-byte string. Equal 50-byte strings have equal
   minima, so a string whose minimum occurs in one document only can't repeat; the rest are candidates. The shards' minima
   meet in a key exchange that counts documents and tells whether another shard has the key. This only saves work.
2. Each shard builds the suffix array of its candidate text by Larsson-Sadakane refinement (only groups still tied are sorted
   again, by the rank at the doubled distance) and the common prefixes by Kasai's rule, in its permuted form: prefixes are
   measured where the preceding bytes differ and fall by one from there on. Runs of 50 or more are the shard's classes of
   equal strings. A start whose class has a smaller document id is removed; the other classes of the shard have to be merged.
3. Strings that share an anchor overlap, so up to 25 of them go as one context: the text around the anchor, once for each pair of
   classes at its ends. A shard sends its contexts in suffix order; the runs of all shards are merged by binary search of strings,
   and each context learns which of its strings are in another context with a smaller id. Bytes are compared, not hashes.

A hash of the anchor picks the task that merges it. An anchor at HOT places or more may have as many contexts as there are places, so its
strings go one by one and are dealt by a hash of the whole string: a task then gets one entry of a string from each shard at most.

Defined results: null text is empty; a null id counts as larger than any other; rows of equal id don't remove from one another;
an empty table gives an empty result; texts of a shard may be of any length; columns besides id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shards, vec

SPAN, GRAM = 50, 26
WIDE = SPAN - GRAM + 1  # strings that an anchor may serve
BACK, WIDTH = WIDE - 1, WIDE - 1 + SPAN
HOT, MANY = 1024, 127
SHARD, PIECE = 2 << 20, 1 << 18  # bytes of a shard; bytes or places worked on at once
LAST = np.iinfo(np.int64).max
U = np.uint64


# --- suffix arrays ------------------------------------------------------------------------------------------------------


def _order(high: np.ndarray, bits: int) -> np.ndarray:
    """argsort of integers below 2^bits, by sorting them with their positions packed below if there is room."""
    own = max(1, int(len(high) - 1).bit_length())
    if bits + own <= 64:
        x = (high.astype(U) << U(own)) | np.arange(len(high), dtype=U)
        x.sort()
        return (x & U((1 << own) - 1)).astype(np.int64)
    return np.argsort(high, kind="stable")


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each suffix) by Larsson-Sadakane refinement."""
    n = len(data)
    kind = np.int32 if n < 1 << 30 else np.int64
    if not n:
        return np.zeros(0, kind), np.zeros(0, kind)
    present = np.flatnonzero(np.bincount(data, minlength=256))
    code = np.zeros(256, np.uint8 if len(present) < 256 else np.uint16)
    code[present] = np.arange(1, len(present) + 1)
    bits = int(len(present)).bit_length()
    h = max(1, (64 - max(1, (n - 1).bit_length())) // bits)
    x = np.concatenate([code[data], np.zeros(h, code.dtype)])
    key = np.zeros(n, U)
    for j in range(h):
        key <<= U(bits)
        key |= x[j : j + n]
    del x
    sa = _order(key, bits * h).astype(kind)
    key = key[sa]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    del key
    head = np.maximum.accumulate(np.where(new, np.arange(n, dtype=kind), kind(0)))
    rank = np.empty(n, kind)
    rank[sa] = head
    tied = np.flatnonzero(~(new & np.concatenate([new[1:], [True]]))).astype(kind)  # places in sa that are in groups of two or more
    rbits = max(1, int(n + 1).bit_length())
    while len(tied):
        s = sa[tied]
        group = np.concatenate([[0], np.cumsum(head[tied][1:] != head[tied][:-1], dtype=kind)]).astype(kind)
        far = s + kind(h) if h < n else np.full(len(s), n, kind)
        second = np.where(far < n, rank[np.minimum(far, n - 1)] + 1, 0).astype(kind)
        del far
        gbits = max(1, int(group[-1]).bit_length())
        if gbits + rbits <= 64:
            o = _order((group.astype(U) << U(rbits)) | second.astype(U), gbits + rbits)
        else:
            o = np.lexsort((second, group))
        s, group, second = s[o], group[o], second[o]
        del o
        sa[tied] = s
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(tied), dtype=kind), kind(0)))
        head[tied] = tied[first]
        rank[s] = head[tied]
        tied = tied[~(new & np.concatenate([new[1:], [True]]))]
        h *= 2
    return sa, rank


def common_prefixes(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """lcp[i] of the suffixes sa[i - 1] and sa[i] (0 for i = 0)."""
    n = len(sa)
    if n < 2:
        return np.zeros(n, sa.dtype)
    before = np.empty(n, sa.dtype)  # the suffix just before, by position
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    fresh = before <= 0
    fresh[0] = True
    i = np.flatnonzero(~fresh)
    fresh[i] = data[i - 1] != data[before[i] - 1]
    del i
    fresh[1:] |= before[:-1] < 0
    wide = np.zeros(n + 8, np.uint8)
    wide[:n] = data
    eight = np.lib.stride_tricks.sliding_window_view(wide, 8)
    word = lambda at: np.ascontiguousarray(eight[at]).view(U).ravel()
    plcp = np.zeros(n, sa.dtype)
    every = np.flatnonzero(fresh & (before >= 0))
    for k in range(0, len(every), PIECE):  # some at a time
        start = every[k : k + PIECE]
        size = np.zeros(len(start), np.int64)
        live, a, b = np.arange(len(start)), start.copy(), before[start].astype(np.int64)
        while len(live):
            room = n - np.maximum(a, b)
            ok = room > 0
            live, a, b, room = live[ok], a[ok], b[ok], room[ok]
            if not len(live):
                break
            diff = word(a) ^ word(b)
            low = diff & (~diff + U(1))
            same = np.where(diff == 0, 8, (np.log2(np.maximum(low, U(1)).astype(float)).astype(np.int64)) >> 3)
            same = np.minimum(same, room)
            size[live] += same
            ok = same == 8
            live, a, b = live[ok], a[ok] + 8, b[ok] + 8
        plcp[start] = size
    pos = np.arange(n, dtype=sa.dtype)
    anchor = np.maximum.accumulate(np.where(fresh, pos, sa.dtype.type(0)))
    plcp = np.maximum(plcp[anchor] - (pos - anchor), 0)
    plcp[before < 0] = 0
    return plcp[sa]


# --- work on a shard ----------------------------------------------------------------------------------------------------


def _minima(data: np.ndarray, offs: np.ndarray):
    """(hash of the GRAM bytes from each position, all ones across rows' ends; its minimum for each SPAN bytes)."""
    n = len(data)
    if n < SPAN:
        return np.zeros(0, U), np.zeros(0, U)
    c = vec.prefix(data)
    m = n - GRAM + 1
    h = vec.mix((c[GRAM:] - c[:m]) * vec.inverse_powers(np.arange(m)))
    for e in offs[1:-1]:
        h[max(0, e - GRAM + 1) : e] = ~U(0)
    return h, vec.sliding_min(h, WIDE)


def _is_anchor(h: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Which positions hold the minimum of some SPAN bytes."""
    wide = np.concatenate([np.zeros(WIDE - 1, U), m, np.zeros(WIDE - 1, U)])
    return (vec.sliding_max(wide, WIDE)[: len(h)] == h) & (h != ~U(0))


def _pieces(data: np.ndarray, offs: np.ndarray):
    """Runs of rows of about PIECE bytes, for hashing; one long row is cut into pieces that overlap by SPAN - 1."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + PIECE, side="right")) - 1)
        a, z = int(offs[i]), int(offs[j])
        if z - a <= 2 * PIECE:
            yield a, data[a:z], offs[i : j + 1] - a
        else:
            for p in range(a, z, PIECE):
                q = min(z, p + PIECE + SPAN - 1)
                yield p, data[p:q], np.array([0, q - p])
        i = j


def _inside(offs: np.ndarray, a: int, n: int) -> np.ndarray:
    """Which of the n positions from a start SPAN bytes inside one row."""
    ok = np.ones(n, bool)
    k = np.searchsorted(offs, a, side="right")
    while k < len(offs) and offs[k] - SPAN + 1 < a + n:
        ok[max(0, offs[k] - SPAN + 1 - a) : max(0, min(n, offs[k] - a))] = False
        k += 1
    return ok


def anchor_keys(data, offs, bits: int):
    """(sorted unique minima, for each twice its places in this shard, MANY at most, and one more if several documents have it)."""
    keys, rows = [], []
    for a, part, po in _pieces(data, offs):
        h, m = _minima(part, po)
        if not len(m):
            continue
        p = np.flatnonzero(_is_anchor(h, m))
        keys.append(vec.mix(h[p]) >> U(64 - bits))  # minima are small numbers; mixed, they fill the range
        rows.append(np.searchsorted(offs, p + a, side="right"))
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.uint8)
    k, r = np.concatenate(keys), np.concatenate(rows)
    o = _order(k, bits)
    k, r = k[o], r[o]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    low, high = np.minimum.reduceat(r, at), np.maximum.reduceat(r, at)
    places = np.minimum(np.diff(np.append(at, len(k))), MANY)
    return k[at], (2 * places + (low != high)).astype(np.uint8)


def met_anchors(keys: list[np.ndarray], vals: list[np.ndarray]) -> list[np.ndarray]:
    """For each run, as differences, four times its keys that several documents have, and: 0 no other run has the key, 1 one has,
    2 one has and the key has HOT places or more."""
    u = shards.merged(keys)
    at = [np.searchsorted(u, k) for k in keys]
    docs, places, runs = (np.zeros(len(u), np.int64) for _ in range(3))
    for i, v in zip(at, vals, strict=True):
        docs[i] += 1 + (v & 1)
        places[i] += v >> 1
        runs[i] += 1
    code = np.where(runs < 2, 0, np.where(places < HOT, 1, 2)).astype(U)
    return [np.diff(((k << U(2)) | code[i])[docs[i] > 1], prepend=U(0)) for k, i in zip(keys, at, strict=True)]


def candidates(data, offs, bits: int, shared: np.ndarray, code: np.ndarray, gone: np.ndarray):
    """(starts of the SPAN-byte strings of rows not gone whose minimum is a shared key, where each has it first, 32 bits of its hash, code)."""
    out = []
    kind = np.int32 if len(data) < 1 << 30 else np.int64
    for a, part, po in _pieces(data, offs):
        h, m = _minima(part, po)
        if not len(m) or not len(shared):
            continue
        at = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        k = vec.mix(m[at]) >> U(64 - bits)
        i = np.minimum(np.searchsorted(shared, k), len(shared) - 1)
        size = np.diff(np.append(at, len(m)))
        ok = np.repeat(shared[i] == k, size) & _inside(offs, a, len(m))
        ok[ok] = ~gone[np.searchsorted(offs, np.flatnonzero(ok) + a, side="right") - 1]
        p = np.flatnonzero(ok)
        anchors = np.flatnonzero(_is_anchor(h, m))
        nth = np.searchsorted(anchors, p)
        live = np.flatnonzero(h[anchors[nth]] != m[p])
        while len(live):
            nth[live] += 1
            live = live[h[anchors[nth[live]]] != m[p[live]]]
        out.append(((p + a).astype(kind), (anchors[nth] + a).astype(kind), (vec.mix(m[p]) >> U(32)).astype(np.uint32), np.repeat(code[i], size)[p]))
    if not out:
        return np.zeros(0, kind), np.zeros(0, kind), np.zeros(0, np.uint32), np.zeros(0, np.uint8)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def classes(data, starts, doc):
    """(class of each start by suffix array: equal numbers for equal SPAN-byte strings; smallest doc of each class; a function that
    gives the suffix rank of positions inside the strings)."""
    text_at = np.flatnonzero(_spread(starts, len(data))).astype(starts.dtype)
    text = data[text_at]
    sa, rank = suffix_array(text)
    number = np.empty(len(text), sa.dtype)
    number[sa] = np.cumsum(common_prefixes(text, sa) < SPAN, dtype=sa.dtype)
    del sa
    of = number[np.searchsorted(text_at, starts)]
    least = np.full(int(of.max()) + 1, LAST)
    np.minimum.at(least, of, doc)
    return of, least, lambda p: rank[np.searchsorted(text_at, p)]


def contexts(data, anchor, low, high):
    """A row for each context: BACK bytes before the anchor and SPAN from it on, each plus one (UTF-8 has no byte 255), 0 outside."""
    out = np.zeros((len(anchor), WIDTH), np.uint8)
    for k in range(0, len(anchor), 1 << 15):
        s = slice(k, k + (1 << 15))
        p = anchor[s, None] + np.arange(-BACK, SPAN)
        ok = (p >= low[s, None]) & (p < high[s, None] + SPAN)
        out[s][ok] = data[p[ok]] + np.uint8(1)
    return out


def _spread(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of n bytes are in a SPAN-byte string from one of the starts."""
    edge = np.zeros(n + 1, np.int32)
    edge[starts] = 1
    ends = np.bincount(starts + SPAN, minlength=n + 1)[: n + 1].astype(np.int32)
    return np.cumsum(edge - ends)[:n] > 0


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """The sorted unique strings of sorted runs, merged two by two: each string of one is placed in the other by binary search."""
    while len(runs) > 1:
        out = [runs[-1]] if len(runs) % 2 else []
        for a, b in zip(runs[:-1:2], runs[1::2], strict=True):
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            at = np.searchsorted(a, b)
            new = (at == len(a)) | (a[np.minimum(at, len(a) - 1)] != b)
            out.append(np.insert(a, at[new], b[new]))
        runs = out
    return runs[0]


def _by_depth(part: np.ndarray, g: np.ndarray):
    """depth -> a number for each row, equal for rows of one g whose first depth bytes are equal."""
    words = np.ascontiguousarray(part).view(">u8")
    o = np.lexsort((words[:, 2], words[:, 1], words[:, 0], g))
    differ = part[o[1:]] != part[o[:-1]]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), BACK)
    lcp[g[o[1:]] != g[o[:-1]]] = -1

    def at(depth: int) -> np.ndarray:
        out = np.empty(len(o), np.int64)
        out[o] = np.concatenate([[0], np.cumsum(lcp < depth)])
        return out

    return at


def _by_string(c: np.ndarray, g: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For contexts with the anchor strings g: a bit for each string of a context that another has with a smaller doc."""
    out = np.zeros(len(c), np.uint32)
    left, right = _by_depth(c[:, :BACK][:, ::-1], g), _by_depth(c[:, BACK + GRAM :], g)
    for j in range(WIDE):
        ok = np.flatnonzero((c[:, j] > 0) & (c[:, j + SPAN - 1] > 0))
        if len(ok) < 2:
            continue
        key = left(BACK - j)[ok] * len(c) + right(j)[ok]
        o = np.argsort(key)
        at = np.flatnonzero(np.concatenate([[True], key[o[1:]] != key[o[:-1]]]))
        least = np.repeat(np.minimum.reduceat(doc[ok[o]], at), np.diff(np.append(at, len(o))))
        hit = ok[o[least < doc[ok[o]]]]
        out[hit] |= np.uint32(1 << j)
    return out


def smaller_elsewhere(rows: list[np.ndarray], ids: list[np.ndarray]) -> list[np.ndarray]:
    """For each run of contexts in suffix order: a bit for each string of a context that another context has with a smaller id."""
    runs = [x.reshape(-1, WIDTH) for x in rows]
    grams = [np.ascontiguousarray(x[:, BACK : BACK + GRAM]).view(f"S{GRAM}").ravel() for x in runs]
    u = merged([x[np.concatenate([[True], x[1:] != x[:-1]])] for x in grams])
    g = np.concatenate([np.searchsorted(u, x) for x in grams])
    c, doc = np.concatenate(runs), np.concatenate(ids)
    o = np.argsort(g, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], g[o[1:]] != g[o[:-1]]]))
    size = np.diff(np.append(at, len(o)))
    least, one = np.minimum.reduceat(doc[o], at), np.ones(len(at), bool)
    of = np.repeat(np.arange(len(at)), size)
    for k in range(0, len(o), 1 << 15):
        s = slice(k, k + (1 << 15))
        one[of[s][(c[o[s]] != c[o[at[of[s]]]]).any(axis=1)]] = False
    out = np.zeros(len(c), np.uint32)
    out[o] = np.where(one[of] & (least[of] < doc[o]), np.uint32((1 << WIDE) - 1), np.uint32(0))  # an anchor with one context
    rest = o[~one[of]]
    if len(rest):
        out[rest] = _by_string(c[rest], g[rest], doc[rest])
    return np.split(out, np.cumsum([len(x) for x in ids])[:-1])


def _string_hash(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the SPAN bytes from each start."""
    h = np.zeros(len(starts), U)
    for j in range(SPAN):
        h = h * vec.P + data[starts + j] + U(1)
    return vec.mix(h)


def judged(data, offs, ids, gone, found, buckets: int):
    """(what the last pass needs of this shard, contexts in order of bucket and suffix, their smallest ids, their buckets).

    found: what candidates() gives."""
    starts, anchor, h, code = found
    doc = ids[np.searchsorted(offs, starts, side="right") - 1]
    none = np.zeros(0, np.int64)
    if not len(starts):
        return (np.packbits(gone), none, none, none, none), np.zeros((0, WIDTH), np.uint8), none, none
    of, least, rank = classes(data, starts, doc)
    removed = starts[least[of] < doc]
    out = code > 0
    del least
    if not out.all():
        starts, anchor, h, code, of, doc = (x[out] for x in (starts, anchor, h, code, of, doc))
    if not len(starts):
        return (np.packbits(gone), removed, none, none, none), np.zeros((0, WIDTH), np.uint8), none, none
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (code[1:] == 2)]))
    last = np.append(first[1:], len(starts)) - 1
    low, high, a = starts[first], starts[last], anchor[first]
    shape = ((a - low) * WIDE + high - low).astype(np.int64)
    o = np.lexsort((of[last], of[first], shape))
    x, y, z = of[first][o], of[last][o], shape[o]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])])
    at = np.flatnonzero(new)
    pick, least = o[at], np.minimum.reduceat(doc[first][o], at)
    key = h[first][pick].astype(U)
    hot = np.flatnonzero(code[first][pick] == 2)
    if len(hot):
        key[hot] = _string_hash(data, low[pick[hot]].astype(np.int64)) >> U(32)
    bucket = ((key * U(buckets)) >> U(32)).astype(np.int64)
    order = np.lexsort((rank(a[pick]), bucket))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    number = np.empty(len(o), np.int64)
    number[o] = place[np.cumsum(new) - 1]
    pick = pick[order]
    return (np.packbits(gone), removed, low, shape, number), contexts(data, a[pick], low[pick], high[pick]), least[order], bucket[order]


def cut_of(n: int, offs, local, bits: np.ndarray) -> np.ndarray:
    """Which of n bytes go. local: judged()'s first; bits: smaller_elsewhere()'s answers for the shard's contexts."""
    gone, starts, low, shape, number = local
    gone = np.unpackbits(gone)[: len(offs) - 1].astype(bool)
    if len(number):
        size = shape % WIDE + 1
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(BACK - shape // WIDE, size) + step
        hit = np.repeat(bits[number], size) >> at.astype(np.uint32) & 1 > 0
        starts = np.unique(np.concatenate([starts, (np.repeat(low, size) + step)[hit]]))
    return _spread(starts, n) | np.repeat(gone & (np.diff(offs) >= SPAN), np.diff(offs))


# --- Spark --------------------------------------------------------------------------------------------------------------


def _read(blob: bytes, id_col: str, text_col: str):
    b = shards.unpack(blob)
    data, offs = vec.strings(b.column(text_col))
    ids = b.column(id_col).cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)
    return b, data, offs, ids


def _digests(data, offs) -> list[bytes | None]:
    """128-bit digests of the rows' texts, none for those too short to lose a byte."""
    return [hashlib.blake2b(data[a:z].tobytes(), digest_size=16).digest() if z - a >= SPAN else None for a, z in zip(offs[:-1], offs[1:], strict=True)]


def _marked(docs: DataFrame, id_col: str, text_col: str):
    """(shards with all answers, a function of their batches that yields (batch, data, offs, removed byte mask))."""
    packed = shards.pack(docs, text_col, SHARD)
    b1 = shards.key_bits(packed.agg(F.sum("bytes")).first()[0] or 0, 14)
    n1, n2 = shards.n_buckets(packed, 0.08), shards.n_buckets(packed, 0.08)
    s = packed.select("sid", "blob")

    def each(batches, *names):
        for b in batches:
            for row in zip(*[b.column(n) for n in ("sid", "blob", *names)], strict=True):
                yield [x.as_py() for x in row]

    def whole(batches):
        """A row for each text of a shard: its smallest id there."""
        for sid, blob in each(batches):
            _, data, offs, ids = _read(blob, id_col, text_col)
            least: dict[bytes, list] = {}
            for d, n, i in zip(_digests(data, offs), np.diff(offs).tolist(), ids.tolist(), strict=True):
                if d is not None and i < least.get(d, (0, LAST + 1))[1]:
                    least[d] = (n, i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([sid] * len(least), pa.string()), pa.array(list(least), pa.binary()), pa.array([x[0] for x in least.values()], pa.int64()), pa.array([x[1] for x in least.values()], pa.int64())],
                ["sid", "digest", "size", "least"],
            )

    def rest(blob, copies):
        """A shard, and which rows' whole text is in a document with a smaller id."""
        batch, data, offs, ids = _read(blob, id_col, text_col)
        elsewhere, least, gone = set(copies or []), {}, np.zeros(len(ids), bool)
        ds = _digests(data, offs)
        for d, i in zip(ds, ids.tolist(), strict=True):
            least[d] = min(i, least.get(d, i))
        for r, (d, i) in enumerate(zip(ds, ids.tolist(), strict=True)):
            gone[r] = d is not None and (d in elsewhere or least[d] < i)
        return batch, data, offs, ids, gone

    def first(batches):
        for sid, blob, copies in each(batches, "copies"):
            _, data, offs, _, gone = rest(blob, copies)
            left = ~np.repeat(gone, np.diff(offs))
            yield shards.key_rows(sid, *anchor_keys(data[left], np.concatenate([[0], np.cumsum(np.where(gone, 0, np.diff(offs)))]), b1), b1, n1)

    def second(batches):
        for sid, blob, copies, met in each(batches, "copies", "met"):
            _, data, offs, ids, gone = rest(blob, copies)
            key, code = shards.coded_keys_of(met, b1, n1, 2)
            local, rows, least, bucket = judged(data, offs, ids, gone, candidates(data, offs, b1, key, code, gone), n2)
            gone, removed, low, *more = local
            yield shards.own_row(sid, (gone, np.diff(removed, prepend=0), np.diff(low, prepend=0), *more))
            yield shards.block_rows(sid, rows, least, bucket)

    def third(batches):
        for _, blob, there in each(batches, "there"):
            batch, data, offs, _ = _read(blob, id_col, text_col)
            gone, removed, low, *more = shards.own_of(there, np.uint8, *[np.int64] * 4)
            yield batch, data, offs, cut_of(len(data), offs, (gone, np.cumsum(removed), np.cumsum(low), *more), shards.answers_of(there, np.uint32))

    same = W.partitionBy("digest", "size")
    copies = s.mapInArrow(vec.released(whole), "sid string, digest binary, size long, least long").withColumn("first", F.min("least").over(same)).where("least > first")
    met = s.join(copies.groupBy("sid").agg(F.collect_list("digest").alias("copies")), "sid", "left")
    keys = shards.exchange(met.mapInArrow(vec.released(first), shards.KEYS), np.uint8, met_anchors)
    met = met.join(keys.withColumnRenamed("answers", "met"), "sid", "left")
    there = shards.exchange(met.mapInArrow(vec.released(second), shards.KEYS), np.int64, smaller_elsewhere, np.uint8)
    return s.join(there.withColumnRenamed("answers", "there"), "sid", "left"), third


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs."""
    ready, third = _marked(docs.select(id_col, text_col), id_col, text_col)

    def run(batches):
        for batch, data, offs, cut in third(batches):
            held = np.concatenate([[0], np.cumsum(cut)])
            s, _ = vec.runs(cut, offs)
            keep = ~cut
            sha = [hashlib.sha256(data[a:z][keep[a:z]].tobytes()).hexdigest() for a, z in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).cast(pa.int64()), pa.array(np.diff(offs)), pa.array(held[offs[1:]] - held[offs[:-1]]), pa.array(vec.counts(s, offs).astype(np.int64)), pa.array(sha)],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return ready.mapInArrow(vec.released(run), f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of docs with the repeated bytes cut from their texts; characters that a cut splits go as well."""
    ready, third = _marked(docs, id_col, text_col)
    schema = docs.schema

    def run(batches):
        for batch, data, offs, cut in third(batches):
            keep = ~cut
            texts = [data[a:z][keep[a:z]].tobytes().decode("utf-8", "ignore") for a, z in zip(offs[:-1], offs[1:], strict=True)]
            touched = {text_col: texts}
            if chars_col in batch.schema.names:
                touched[chars_col] = [len(x) for x in texts]
            changed = np.add.reduceat(np.append(cut, False), offs[:-1]) * (np.diff(offs) > 0) > 0 if len(offs) > 1 else []
            cols = []
            for name in batch.schema.names:
                c = batch.column(name)
                if name in touched:
                    old = c.to_pylist()
                    c = pa.array([n if ch else o for o, n, ch in zip(old, touched[name], changed, strict=True)], c.type)
                cols.append(c)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return ready.mapInArrow(vec.released(run), schema)
