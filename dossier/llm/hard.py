"""Hard negatives for embeddings, by coordinate pruning over length buckets.

Vectors become whole numbers, floor(256 x), so a score is an exact integer inner product. Rows fall into buckets of similar length (quarter powers of two of
the squared length) and these into blocks of about BLOCK rows. In a block each coordinate of the unit vectors is a sorted list. For an anchor
that needs a score, the least cosine that can reach it in the block gives, for each of its FOCUS largest coordinates, the range of values
that a row may have there; the ranges are slices of the sorted lists, and the rows in all of them are the candidates, whose exact scores are then taken. What is needed rises
as better rows are found. So rows are skipped only if their score can't count, and no row is lost.

Anchors meet the blocks in two equi-joins by block number: first the blocks of their label (positives), then all blocks whose length can reach half the
least positive score (negatives). Each group holds a block of rows and a block of anchors, whatever the sizes of labels or groups of equal vectors.

Defined results: rows with a null id, label or vector, with a null or non-finite component, with a component beyond
LARGEST (scores would not fit 64 bits) or without components take no part. Vectors of different length don't meet. Each row counts: rows that repeat an id are anchors, positives and
negatives of their own, and an anchor's other rows are all rows but itself. Ties are decided by the smaller id, then by an unnamed order of rows. An anchor without positives, or without
negatives in range, has no rows. Columns of other names don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
LEAST, MOST = 50, 95  # per cent of the positive's score
BLOCK, ANCHORS, FOCUS, BUCKET = 2048, 1024, 4, 256
LABELS = 16  # groups of labels that share blocks
LARGEST = 1 << 20
MARGIN = 1e-9  # of cosines, for rounding
NONE = np.iinfo(np.int64).min


def whole_numbers(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(r, id, label, v, dim, len2) of the rows that take part; r numbers the rows."""
    d = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    d = d.where("id is not null and label is not null and size(x) > 0").where(F.coalesce(fine, F.lit(False)))
    v = F.transform("x", lambda c: F.floor(c * SCALE).cast("int"))
    d = d.select(F.monotonically_increasing_id().alias("r"), "id", "label", v.alias("v"), F.size("x").alias("dim"))
    return d.withColumn("len2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))


class Block:
    """Rows of one length bucket with a sorted list of values for each coordinate."""

    def __init__(self, rid, ids, labels, v):
        self.rid, self.ids, self.labels, self.v = rid, ids, labels, v.astype(np.float64)
        size = np.sqrt((self.v * self.v).sum(axis=1))
        self.longest, self.shortest = float(size.max()), float(size.min())
        unit = self.v / np.maximum(size, 1)[:, None]
        self.order = np.argsort(unit, axis=0).T  # rows by their value, for each coordinate
        self.values = np.take_along_axis(unit, self.order.T, axis=0).T
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(size))[None, :], axis=1)

    def candidates(self, q: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Which rows may score `need` or more with each vector of q; a row for each vector."""
        size = np.sqrt((q * q).sum(axis=1))
        need = need.astype(np.float64)
        need = need - np.abs(need) * 1e-15  # whole numbers above 2^53 are rounded
        out = np.zeros((len(q), len(self.ids)), bool)
        far = np.where(need > 0, self.longest, self.shortest)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = need / (size * far) - MARGIN
        free = ~(cosine > -1)  # zero vectors and thresholds that every row meets
        out[free & ~((size * self.longest == 0) & (need > 0))] = True
        live = np.flatnonzero(~free & (cosine <= 1))
        if not len(live):
            return out
        unit = q[live] / size[live, None]
        focus = np.argsort(-np.abs(unit), axis=1)[:, : min(FOCUS, q.shape[1])]
        angle = np.arccos(np.clip(cosine[live], -1, 1))[:, None]
        own = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        low, high = np.cos(np.minimum(np.pi, own + angle)) - MARGIN, np.cos(np.maximum(0, own - angle)) + MARGIN
        first, last = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            first[at] = np.searchsorted(self.values[f], low[at], side="left")
            last[at] = np.searchsorted(self.values[f], high[at], side="right")
        # the shortest slice of a vector's sorted lists, cut with its other slices
        short = np.argmin(last - first, axis=1)
        pick = np.arange(len(live))
        n = np.maximum((last - first)[pick, short], 0)
        who = np.repeat(pick, n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first[who, short[who]]
        rows = self.order[focus[who, short[who]], at]
        for k in range(focus.shape[1]):
            p = self.place[focus[who, k], rows]
            ok = (p >= first[who, k]) & (p < last[who, k])
            who, rows = who[ok], rows[ok]
        out[live[who], rows] = True
        return out

    def scores(self, q: np.ndarray, may: np.ndarray) -> np.ndarray:
        """Exact scores of the candidates; the other cells hold the least number."""
        out = np.full(may.shape, NONE)
        a, b = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
        if len(a) and len(b):
            x, y = q[a], self.v[b]
            if np.abs(x).max() * np.abs(y).max() * x.shape[1] < 2**53:
                s = (x @ y.T).astype(np.int64)  # sums of whole numbers below 2^53 are exact
            else:
                s = x.astype(np.int64) @ y.astype(np.int64).T
            cells = np.ix_(a, b)
            out[cells] = np.where(may[cells], s, NONE)
        return out


class Best:
    """The best `k` rows of each of n lists, and the score that a new one needs."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.need = k, floor.astype(np.int64)
        self.found = [np.zeros(0, np.int64)] * 2  # list, score
        self.ids, self.rid = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, rid: np.ndarray) -> None:
        lists, scores, ids, rid = (np.concatenate(x) for x in ((self.found[0], lists), (self.found[1], scores), (self.ids, ids), (self.rid, rid)))
        order = np.lexsort((rid, ids, -scores, lists))
        lists, scores, ids, rid = lists[order], scores[order], ids[order], rid[order]
        start = np.concatenate([[True], lists[1:] != lists[:-1]]) if len(lists) else np.zeros(0, bool)
        nth = np.arange(len(lists)) - np.maximum.accumulate(np.where(start, np.arange(len(lists)), 0))
        full = nth == self.k - 1
        self.need[lists[full]] = np.maximum(self.need[lists[full]], scores[full])
        keep = nth < self.k
        self.found, self.ids, self.rid = [lists[keep], scores[keep]], ids[keep], rid[keep]


def _vectors(t: pa.Table) -> np.ndarray:
    return t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)


def _buckets(t: pa.Table):
    """Blocks of at most BUCKET rows by length, longest first."""
    v = _vectors(t)
    order = np.argsort(-(v.astype(float) ** 2).sum(axis=1), kind="stable")
    cols = [t.column(c).to_numpy()[order] for c in ("r", "id", "label")]
    v = v[order]
    for i in range(0, len(v), BUCKET):
        yield Block(*[c[i : i + BUCKET] for c in cols], v[i : i + BUCKET])


def _topped(s: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of each row, or the least value."""
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(s), NONE)


def _nearest(k: int):
    """The k best rows of the anchor's label but itself, for a group of anchors and one of rows."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        best = Best(k, np.full(anchors.num_rows, NONE))
        if anchors.num_rows and rows.num_rows:
            q, me, label = _vectors(anchors).astype(np.float64), anchors.column("r").to_numpy(), anchors.column("label").to_numpy()
            for b in _buckets(rows):
                may = b.candidates(q, best.need) & (label[:, None] == b.labels) & (me[:, None] != b.rid)
                s = b.scores(q, may)
                a, c = np.nonzero((s >= np.maximum(_topped(s, k), best.need)[:, None]) & may)
                best.add(a, s[a, c], b.ids[c], b.rid[c])
        a = best.found[0]
        cols = [anchors.column("r").to_numpy()[a] if len(a) else a, best.found[1], best.ids, best.rid]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("r", "score", "other", "other_r"), cols, strict=True)})

    return run


def _ranged(k: int):
    """For each positive of each anchor the k best rows of other labels whose score is in its range."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 5
        if anchors.num_rows and rows.num_rows:
            q, label = _vectors(anchors).astype(np.float64), anchors.column("label").to_numpy()
            lists = anchors.column("positives").combine_chunks()
            owner = np.repeat(np.arange(anchors.num_rows), np.diff(lists.offsets.to_numpy()))
            p = lists.flatten()
            low, high = p.field("low").to_numpy(), p.field("high").to_numpy()
            best = Best(k, low)
            for b in _buckets(rows):
                need = np.full(anchors.num_rows, np.iinfo(np.int64).max)
                np.minimum.at(need, owner, best.need)
                may = b.candidates(q, need) & (label[:, None] != b.labels)
                s = b.scores(q, may)
                for i in range(0, len(owner), 512):
                    o = owner[i : i + 512]
                    mine = np.where(may[o] & (s[o] <= high[i : i + 512, None]) & (s[o] >= best.need[i : i + 512, None]), s[o], NONE)
                    x, c = np.nonzero((mine >= _topped(mine, k)[:, None]) & (mine > NONE))
                    best.add(x + i, mine[x, c], b.ids[c], b.rid[c])
            a = best.found[0]
            out = [anchors.column("r").to_numpy()[owner[a]], p.field("other_r").to_numpy()[a], best.found[1], best.ids, best.rid]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("r", "other_r", "score", "negative_id", "negative_r"), out, strict=True)})

    return run


def _own(*names: str) -> list:
    """The columns as columns of their own, so that both sides of a group may come from one table."""
    return [F.col(n).alias(n) for n in names]


def _first(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, block: int = BLOCK, anchor_block: int = ANCHORS, **names) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a condition on id) and each of its `positives`
    best rows of the same label, the `negatives` best rows of other labels between least and most per cent of the positive's score."""
    d = whole_numbers(rows, **names)
    bucket = F.when(F.col("len2") > 0, F.floor(4 * F.log2("len2"))).otherwise(-1).cast("int")
    d = stash(d.withColumn("group", F.pmod(F.xxhash64("label"), F.lit(LABELS)).cast("int")).withColumn("bucket", bucket), "hard-rows")
    # how many blocks each label group and length bucket takes; a few thousand rows, whatever the table's size
    sizes = d.groupBy("dim", "group", "bucket").agg(F.count("*").alias("n"), F.max("len2").alias("longest"))
    n_anchors = d.where(is_anchor).groupBy("dim", "group").agg(F.count("*").alias("anchors"))
    parts = F.ceil(F.col("n") / block).cast("int")
    sizes = F.broadcast(stash(sizes.withColumn("parts", parts), "hard-sizes"))
    salt = lambda n: F.pmod(F.xxhash64("r"), n).cast("int")
    rows_in = d.join(sizes.select("dim", "group", "bucket", "parts"), ["dim", "group", "bucket"]).withColumn("part", salt(F.col("parts")))

    mine = d.where(is_anchor).join(F.broadcast(n_anchors), ["dim", "group"])
    mine = mine.withColumn("a_parts", F.ceil(F.col("anchors") / anchor_block).cast("int")).withColumn("a", salt(F.col("a_parts"))).drop("bucket", "anchors")
    key = ["dim", "group", "bucket", "part", "a"]
    left = mine.join(sizes, ["dim", "group"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*_own(*key, "r", "label", "v"))
    blocks_of = F.broadcast(mine.select("dim", "group", "a_parts").distinct())
    right = rows_in.join(blocks_of, ["dim", "group"]).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("a_parts") - 1))).select(*key, "r", "id", "label", "v")
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_nearest(positives), "r long, score long, other long, other_r long")
    near = stash(_first(near, ["r"], [F.desc("score"), "other", "other_r"], positives).drop("rank"), "hard-positives")

    # negatives: anchors with the ranges of their positives, against all blocks that are long enough
    rest = F.pmod("score", F.lit(100))  # scores are near 64 bits where components are large: no product of the score itself
    whole = F.expr("(score - pmod(score, 100L)) div 100L")
    low, high = whole * least + F.floor((rest * least + 99) / 100), whole * most + F.floor(rest * most / 100)
    ranged = near.withColumn("low", low).withColumn("high", high).where("low <= high")
    wanted = ranged.groupBy("r").agg(F.min("low").alias("least"), F.sort_array(F.collect_list(F.struct("low", "high", "other_r"))).alias("positives"))
    n_anchors = d.where(is_anchor).groupBy("dim").agg(F.count("*").alias("anchors"))
    seek = d.where(is_anchor).drop("bucket", "group").join(wanted, "r").join(F.broadcast(n_anchors), "dim")
    seek = seek.withColumn("a", salt(F.ceil(F.col("anchors") / anchor_block)))
    reach = (F.col("least") <= 0) | (F.col("least").cast("double") * F.col("least") <= F.col("len2") * F.col("longest") * (1 + MARGIN))
    left = seek.join(sizes, "dim").where(reach).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*_own(*key, "r", "label", "v", "positives"))
    every = F.broadcast(n_anchors.withColumn("a_parts", F.ceil(F.col("anchors") / anchor_block).cast("int")))
    right = rows_in.join(every, "dim").withColumn("a", F.explode(F.sequence(F.lit(0), F.col("a_parts") - 1))).select(*key, "r", "id", "label", "v")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_ranged(negatives), "r long, other_r long, score long, negative_id long, negative_r long")
    found = _first(found, ["r", "other_r"], [F.desc("score"), "negative_id", "negative_r"], negatives)
    named = near.join(d.where(is_anchor).select("r", F.col("id").alias("anchor_id")), "r").select("r", "other_r", "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["r", "other_r"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))


SQL = r"""
with e as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.r as ar, a.vec_id as anchor_id, a.label as al, b.r as br, b.vec_id as id, b.label as bl, list_inner_product(a.v, b.v)::bigint as score
      from e a join e b on a.vec_id % 50 = 0 and a.r <> b.r and len(a.v) = len(b.v)),
p as (select ar, br, anchor_id, id as positive_id, score as positive_score from s where al = bl qualify row_number() over (partition by ar order by score desc, id, br) <= 5),
n as (select p.ar, p.br, p.anchor_id, positive_id, positive_score, s.id as negative_id, s.score as negative_score,
        row_number() over (partition by p.ar, p.br order by s.score desc, s.id, s.br)::int as rank
      from p join s on p.ar = s.ar and s.al <> s.bl and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
