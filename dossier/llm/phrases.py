"""Phrases of 2 to 5 words that stick together, by Rabin-Karp fingerprints and one pass over the texts for each level.

Inside a task the words of a text are hashed by prefix polynomials over its bytes, and every n-gram by prefix polynomials over the
words' hashes, so no phrase is built as a string. The shuffle sums counts by fingerprint and keeps a pointer (33 bits of the row's key, byte offset) to
one occurrence. An n-gram is only counted where its shorter n-grams are frequent: those go to the tasks as a bit table of at
most BITS bits, which may let an n-gram through that is not frequent, but never stops one that is. So each level is exact, and a corpus
that fills the table costs a larger shuffle, not a wrong count.

A second fingerprint, from other values for the bytes, goes along as its least and greatest value, with the size. Where the two differ, texts of several phrases met in
one fingerprint: the occurrences of those fingerprints alone are counted again by their text. Frequent phrases, and no others, are
then cut out of the texts by their pointers.

Defined results: a null text is empty, a null lang is `und`. Repeated rows count as often as they occur. Ids are not read; a table without rows has no phrases.
Words are never cut, whatever their length, and pieces never cross texts. Columns besides text and lang don't matter.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vec
from .common import stash

LONGEST, LEAST, TOP = 5, 100, 2000
BITS = 1 << 27  # of the table of frequent n-grams, at most
HELD = 1 << 20  # n-grams that a task holds before it sums them
U = vec.U

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_PIECE = np.zeros(256, bool)
_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_CUT = _PIECE.copy()
_CUT[list(b" \t")] = True
_WORD = rb"[^\x20\x09.,;:!?\x0A-\x0D]+"
_OTHER = vec.mix(np.arange(1, 257, dtype=U) * U(0xD1B54A32D192ED03))  # values of the bytes in the second fingerprint


def words(data: np.ndarray, offs: np.ndarray):
    """(starts, first and second hashes, number of the piece) of all words."""
    low = _LOW[data]
    s, e = vec.runs(~_CUT[low], offs)
    h = vec.span_hash(vec.prefix(low), s, e)
    g = vec.span_hash(vec.prefix(_OTHER[low]), s, e)
    piece = np.cumsum(_PIECE[low])[s] + np.searchsorted(offs, s, side="right")
    return s, h, g, piece


def _in(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    slot = fp & U(len(bits) * 8 - 1)
    return (bits[(slot >> U(3)).astype(np.int64)] >> (slot & U(7)).astype(np.uint8)) & 1 > 0


class Grams:
    """The n-grams of a chunk; fp(n) has a fingerprint for every word, fits(n) whether an n-gram of one piece starts there."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, seeds: np.ndarray, width: int):
        self.s, h, g, piece = words(data, offs)
        self.row = np.searchsorted(offs, self.s, side="right") - 1
        self.size, self.mask = len(h), U((1 << width) - 1)
        self.h, self.g = vec.prefix(h), vec.prefix(g)
        self.piece, self.seed = piece, seeds[self.row] if len(h) else np.zeros(0, U)

    def _of(self, c: np.ndarray, n: int) -> np.ndarray:
        i = np.arange(max(self.size - n + 1, 0))
        return vec.mix(vec.span_hash(c, i, i + n) + self.seed[: len(i)] * vec.P + U(n))

    def fp(self, n: int) -> np.ndarray:
        return self._of(self.h, n) & self.mask

    def second(self, n: int) -> np.ndarray:
        return self._of(self.g, n)

    def fits(self, n: int) -> np.ndarray:
        m = max(self.size - n + 1, 0)
        return self.piece[:m] == self.piece[n - 1 : n - 1 + m]

    def kept(self, n: int, below: int, bits: np.ndarray | None) -> np.ndarray:
        """Starts of n-grams whose n-grams of `below` words may all be frequent."""
        ok = self.fits(n)
        if bits is not None:
            may = _in(bits, self.fp(below))
            for k in range(n - below + 1):
                ok = ok & may[k : k + len(ok)]
        return np.flatnonzero(ok)


def _summed(cols: list[np.ndarray]) -> list[np.ndarray]:
    """(fingerprint, second one with the size, count, pointer), summed where both are equal and neighbours in the fingerprints' order."""
    fp, tag, c, at = cols
    order = np.argsort(fp, kind="stable")
    fp, tag = fp[order], tag[order]
    new = np.flatnonzero(np.concatenate([[True], (fp[1:] != fp[:-1]) | (tag[1:] != tag[:-1])]))
    return [fp[new], tag[new], np.add.reduceat(c[order], new, dtype=np.int64), at[order][new]]


def _rows(cols: list[np.ndarray]):
    """Three numbers a row: a fingerprint, a pointer, and in one the second fingerprint (23 bits), the count (36) and the size (4)."""
    fp, tag, c, at = cols
    told = (tag >> U(4) << U(40)) | (c.astype(U) << U(4)) | (tag & U(15))
    for i in range(0, len(fp), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)].view(np.int64)) for x in (fp, at, told)], ["fp", "at", "told"])


def _seeds(b: pa.RecordBatch, i: int, j: int) -> np.ndarray:
    return b.column("seed").slice(i, j - i).to_numpy().view(U)


def _counts(docs: DataFrame, sizes: list[int], below: int, table: bytes | None, width: int) -> DataFrame:
    """n-grams of the given sizes, summed in their tasks; with size 0, the words of each lang under its seed."""
    held = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        bits = np.frombuffer(held.value, np.uint8) if held.value else None
        raw, done, n_raw, n_done, total = [], [], 0, 0, {}
        for b in batches:
            for i, j, data, offs in vec.chunks(b, "t"):
                seeds = _seeds(b, i, j)
                g = Grams(data, offs, seeds, width)
                keys = b.column("k").slice(i, j - i).to_numpy().view(U)
                if 0 in sizes:
                    for seed, n in zip(*np.unique(g.seed, return_counts=True), strict=True):
                        total[int(seed)] = total.get(int(seed), 0) + int(n)
                for n in sizes:
                    if not n:
                        continue
                    p = g.kept(n, below, bits)
                    if len(p):
                        tag = (g.second(n)[p] >> U(41) << U(4)) | U(n)
                        raw.append([g.fp(n)[p], tag, np.ones(len(p), np.int32), (keys[g.row[p]] >> U(31) << U(31)) | (g.s[p] - offs[g.row[p]]).astype(U)])
                        n_raw += len(p)
                if n_raw >= HELD:
                    done.append(_summed([np.concatenate(x) for x in zip(*raw, strict=True)]))
                    raw, n_raw, n_done = [], 0, n_done + len(done[-1][0])
                    if n_done >= 2 * HELD:
                        done = [_summed([np.concatenate(x) for x in zip(*done, strict=True)])]
                        if len(done[0][0]) >= HELD:
                            yield from _rows(done.pop())
                        n_done = sum(len(x[0]) for x in done)
        if raw or done:
            yield from _rows(_summed([np.concatenate(x) for x in zip(*raw, *done, strict=True)]))
        if total:
            yield from _rows([np.array(list(total), U), np.zeros(len(total), U), np.array(list(total.values()), np.int64), np.zeros(len(total), U)])

    return docs.select("k", "seed", "t").mapInArrow(run, "fp long, at long, told long")


def _total(counts: DataFrame) -> DataFrame:
    """(fp, n, a, lo, hi, at) of each fingerprint. The rows are dealt as they are, as their tasks have summed them; any pointer may stand for all."""
    d = counts.repartition("fp")
    size, second = F.col("told").bitwiseAND(F.lit(15)), F.shiftright("told", 40)
    g = d.groupBy("fp", (size == 0).alias("words")).agg(F.sum(F.shiftright("told", 4).bitwiseAND(F.lit((1 << 36) - 1))).alias("a"), F.min(second).alias("lo"), F.max(second).alias("hi"), F.min(size).cast("int").alias("n"), F.max(size).cast("int").alias("_n"), F.first("at").alias("at"))
    return g.select("fp", "n", "a", (F.col("lo") * 16 + F.col("n")).alias("lo"), (F.col("hi") * 16 + F.col("_n")).alias("hi"), "at")


def _bit_table(frequent: DataFrame, bits: int) -> bytes:
    """The bits of all fingerprints; rows of 64 bits are put together by Spark, and the driver gets `bits` / 64 of them at most."""
    size = min(bits, 1 << max(10, (32 * frequent.count()).bit_length()))
    slot = F.col("fp").bitwiseAND(F.lit(size - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    rows = frequent.select(F.shiftright(slot, 6).cast("int").alias("w"), one.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(size // 64, np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.tobytes()


def _recounted(docs: DataFrame, mixed: DataFrame, sizes: list[int], width: int, bits: int) -> DataFrame:
    """(lang, size, phrase, a): occurrences of the fingerprints in which several phrases met, by their text."""
    held = docs.sparkSession.sparkContext.broadcast(_bit_table(mixed, bits))

    def run(batches):
        table = np.frombuffer(held.value, np.uint8)
        for b in batches:
            for i, j, data, offs in vec.chunks(b, "t"):
                g = Grams(data, offs, _seeds(b, i, j), width)
                text, langs, seen = _LOW[data].tobytes(), b.column("lang").slice(i, j - i).to_pylist(), Counter()
                for n in sizes:
                    fp = g.fp(n).view(np.int64)
                    for p in np.flatnonzero(g.fits(n) & _in(table, g.fp(n))):
                        seen[langs[g.row[p]], n, int(fp[p]), _cut(text, int(g.s[p]), n)] += 1
                cols = [*(list(zip(*seen, strict=True)) or [()] * 4), list(seen.values())]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["lang", "size", "fp", "phrase", "c"])

    found = docs.select("lang", "seed", "t").mapInArrow(run, "lang string, size int, fp long, phrase string, c long")
    return found.groupBy("lang", "size", "fp", "phrase").agg(F.sum("c").alias("a")).join(mixed.select("fp"), "fp", "left_semi").select("lang", "size", "phrase", "a")


_PHRASES = {n: re.compile(_WORD + rb"(?:[ \t]+" + _WORD + rb"){%d}" % (n - 1)) for n in range(1, LONGEST + 1)}


def _cut(low: bytes, at: int, n: int) -> str | None:
    pattern = _PHRASES.setdefault(n, re.compile(_WORD + rb"(?:[ \t]+" + _WORD + rb"){%d}" % (n - 1)))
    found = pattern.match(low, at) if at < len(low) else None
    return b" ".join(found.group().split()).decode("utf-8", "replace") if found else None


def _cut_out(docs: DataFrame, frequent: DataFrame, small: bool, width: int) -> DataFrame:
    """(lang, size, phrase, a) of the frequent n-grams, cut out of the texts at their pointers. A pointer holds 33 bits of its row's key: other rows with
    these bits don't have the fingerprint at its offset."""
    key, offset = F.shiftrightunsigned("at", 31), F.col("at").bitwiseAND(F.lit((1 << 31) - 1))
    by_text = frequent.select(key.alias("key"), F.struct("n", "fp", "a", offset.alias("at")).alias("g")).groupBy("key").agg(F.collect_list("g").alias("gs"))
    met = docs.select(F.shiftrightunsigned("k", 31).alias("key"), "lang", "seed", "t").join(F.broadcast(by_text) if small else by_text, "key")

    def run(batches):
        for b in batches:
            out = []
            texts, lists, langs, seeds = b.column("t"), b.column("gs"), b.column("lang"), b.column("seed").to_numpy().view(U)
            for r in range(b.num_rows):
                low = texts[r].as_py().encode().translate(_LOW.tobytes())
                for x in lists[r].as_py():
                    phrase = _cut(low, x["at"], x["n"])
                    if phrase is None:
                        continue
                    own = np.frombuffer(phrase.encode(), np.uint8)
                    if Grams(own, np.array([0, len(own)]), seeds[r : r + 1], width).fp(x["n"]).view(np.int64)[0] == x["fp"]:
                        out.append((langs[r].as_py(), x["n"], x["fp"], x["a"], phrase))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["lang", "size", "fp", "a", "phrase"])

    rows = met.mapInArrow(run, "lang string, size int, fp long, a long, phrase string")
    return rows.groupBy("fp").agg(F.min(F.struct("phrase", "lang", "size", "a")).alias("x")).select("x.lang", "x.size", "x.phrase", "x.a")  # rows that repeat whole


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, width: int = 64, bits: int = BITS, broadcast_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """((lang, n) with all word occurrences, (lang, size, phrase, a) with every phrase of 1 to `longest` words that occurs `least` times).

    width: bits of a fingerprint."""
    lang, text = F.coalesce("lang", F.lit("und")), F.coalesce("text", F.lit(""))
    key = [text, lang, *(["doc_id"] if "doc_id" in docs.columns else [])]  # with an id, copies of one text get keys of their own
    d = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("seed"), text.alias("t"), F.xxhash64(*key).alias("k"))
    one = stash(_total(_counts(d, [0, 1], 1, None, width)), "phrase-words")
    names = d.select("lang", "seed").distinct()
    totals = one.where("n = 0").select(F.col("fp").alias("seed"), F.col("a").alias("n")).join(names, "seed").select("lang", "n")
    levels = [one.where((F.col("a") >= least) & (F.col("n") > 0))]
    done = 1
    while done < longest:
        sizes = [done + 1] if done < 3 else list(range(done + 1, longest + 1))
        table = _bit_table(levels[-1].where((F.col("n") == done) | (F.col("lo") != F.col("hi"))), bits)
        levels.append(stash(_total(_counts(d, sizes, done, table, width)).where(F.col("a") >= least), f"phrase-{sizes[0]}"))
        done = sizes[-1]
    every = levels[0]
    for x in levels[1:]:
        every = every.unionByName(x)
    # in a narrow fingerprint n-grams of several levels may meet: then all of them are counted again
    every = every.groupBy("fp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("n").alias("n"), F.max("a").alias("a"), F.first("at").alias("at"))
    every = stash(every, "phrase-all")
    clean, mixed = every.where("lo = hi"), every.where("lo <> hi")
    n_clean = clean.count()
    out = _cut_out(d, clean, n_clean <= broadcast_rows, width)
    if mixed.limit(1).count():
        out = out.withColumn("again", F.lit(False)).unionByName(_recounted(d, mixed, list(range(1, longest + 1)), width, bits).where(F.col("a") >= least).withColumn("again", F.lit(True)))
    else:
        out = out.withColumn("again", F.lit(False))
    phrases = stash(out, "phrases")
    if phrases.where("not again").count() != n_clean:
        raise ValueError("a pointer doesn't lead to its fingerprint")
    return totals, phrases.drop("again")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, **more) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's first `top` phrases that no longer one of the same count holds."""
    totals, phrases = frequent_phrases(docs, least, longest, **more)
    counts = phrases.select("lang", "phrase", "a")
    c = phrases.where("size >= 2").withColumn("w", F.split("phrase", " "))
    # each phrase of two words or more inside a candidate, with the candidate's count
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    held = c.where("size > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = c.join(held, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    cuts = free.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"), "w", "size")
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("rest"))
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("rest", "r"), ["lang", "rest"]).join(F.broadcast(totals), "lang")
    score = F.expr("(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(14, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    rows = best.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
with d as (select coalesce(lang, 'und') as lang, row_number() over () as d, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps from documents),
p as (select lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') as ws from d),
g as (select lang, m, array_to_string(ws[i:i + m - 1], ' ') as phrase
      from (select lang, ws, m, unnest(range(1, len(ws) - m + 2)) as i from p, (select unnest(range(1, 6)) as m) where len(ws) >= m)),
f as (select lang, m, phrase, count(*) as a from g group by all having count(*) >= 100),
t as (select lang, sum(len(ws))::bigint as n from p group by lang),
c as (select lang, m, phrase, string_split(phrase, ' ') as w, a from f where m >= 2),
h as (select lang, phrase, max(a) as longer from (select lang, a, array_to_string(w[i:i + k - 1], ' ') as phrase
        from (select lang, w, a, k, unnest(range(1, m - k + 2)) as i from c, (select unnest(range(2, 5)) as k) where k < m)) group by lang, phrase),
u as (select lang, phrase, a, k, array_to_string(w[1:k], ' ') as lp, array_to_string(w[k + 1:], ' ') as rp from (select *, unnest(range(1, m)) as k from c)),
s as (select u.lang, u.phrase, u.a, k, l.a as l, r.a as r, t.n, ((1000::hugeint * u.a * t.n) // (l.a::hugeint * r.a))::bigint as score
      from u join f l on l.lang = u.lang and l.phrase = lp join f r on r.lang = u.lang and r.phrase = rp join t on t.lang = u.lang),
b as (select *, row_number() over (partition by lang, phrase order by score, k) as o from s),
z as (select b.* from b left join h using (lang, phrase) where o = 1 and (longer is null or 100 * longer < 100 * b.a)),
q as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from z)
select lang, rank::int as rank, phrase, a, l, r, n, score from q where rank <= 2000
"""
