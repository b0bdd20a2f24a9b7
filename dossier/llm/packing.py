"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

A bin holds at most one document of a source and one of a duplicate cluster. Bins are kept in order of what is left in them;
for a piece the successor search starts at the smallest sufficient bin and goes up until a compatible one is found, which is
then the tightest. Each bin carries 64-bit maps of its sources and clusters; a clear bit settles compatibility, a set one is
confirmed in the bin's sets. Pieces come largest first.

Documents are dealt by hash into groups of about GROUP rows that are packed apart, so tasks stay small at any size and a hot
source is spread over all groups. Equal rows are counted, numbered in runs of RUN and dealt by their number too, so that they spread as
well. A document above the capacity is cut into full bins of its own and a rest; no token is lost.

Defined results: a document without words takes no bin (bin_id null, one row); a null source or cluster conflicts with nothing;
ties in size go by id, then cluster, then source; of bins with equal room the older wins; repeated rows are packed like any other
rows; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY, GROUP, RUN = 2048, 1024, 4096
OUT = "doc_id long, piece int, start long, n_tokens int, bin_id long, bin_offset int"


def pack_group(items: list[tuple], capacity: int) -> list[tuple]:
    """items: (id, tokens, source, cluster). Rows (id, piece, start, tokens, bin, offset); bin is None without tokens."""
    out, rests, n_bins = [], [], 0
    low = lambda x: (x is not None, x or 0)
    for doc, n, source, cluster in sorted(items, key=lambda x: (low(x[0]), low(x[3]), low(x[2]))):
        full, rest = divmod(n, capacity)
        if not n:
            out.append((doc, 0, 0, 0, None, None))
        for k in range(full):
            out.append((doc, k, k * capacity, capacity, n_bins, 0))
            n_bins += 1
        if rest:
            rests.append((rest, doc, full, source, cluster))
    rests.sort(key=lambda x: -x[0])  # stable: ties stay in the order above
    room: list[tuple[int, int]] = []  # (what is left, bin), ascending
    bits: dict[int, list] = {}  # bin: source bits, cluster bits, sources, clusters
    for n, doc, piece, source, cluster in rests:
        sb = 0 if source is None else 1 << (source & 63)
        cb = 0 if cluster is None else 1 << (cluster & 63)
        at = bisect_left(room, (n, -1))
        while at < len(room):
            b = bits[room[at][1]]
            if not (b[0] & sb and source in b[2]) and not (b[1] & cb and cluster in b[3]):
                break
            at += 1
        if at < len(room):
            left, k = room.pop(at)
        else:
            left, k = capacity, n_bins
            n_bins += 1
            b = bits[k] = [0, 0, set(), set()]
        b[0] |= sb
        b[1] |= cb
        b[2].add(source)
        b[3].add(cluster)
        out.append((doc, piece, piece * capacity, n, k, capacity - left))
        if left > n:
            insort(room, (left - n, k))
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster: Column | None = None) -> DataFrame:
    """A row for each piece: doc_id, piece, its first token in the document, its tokens, its bin and its place in the bin.

    cluster: a column of duplicate clusters; equal texts by default.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), word_count(text).alias("n"),
        F.when(F.col(f"`{source_col}`").isNotNull(), F.xxhash64(F.col(f"`{source_col}`"))).alias("source"),
        (F.when(text.isNotNull(), F.xxhash64(text)) if cluster is None else F.when(cluster.isNotNull(), F.xxhash64(cluster))).alias("cluster"),
    )
    groups = max(1, -(-docs.count() // group))
    row = ["id", "n", "source", "cluster"]
    equal = rows.groupBy(*row).agg(F.count(F.lit(1)).alias("copies"))
    runs = equal.select(*row, "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN))).alias("run"))
    runs = runs.repartition(*row, "run").withColumn("size", F.least(F.lit(RUN), F.col("copies") - F.col("run") * RUN).cast("int"))
    rows = runs.select(*row, "run", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("copy"))
    rows = rows.select(*row, F.pmod(F.xxhash64("id", "cluster", "source", F.col("run") * RUN + F.col("copy")), F.lit(groups)).alias("grp"))

    def run(t: pa.Table) -> pa.Table:
        g = t.column("grp")[0].as_py()
        got = pack_group(list(zip(*[t.column(c).to_pylist() for c in ("id", "n", "source", "cluster")], strict=True)), capacity)
        cols = list(zip(*got, strict=True))
        bins = [None if b is None else g << 32 | b for b in cols[4]]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
        return pa.table([pa.array(c, k) for c, k in zip([*cols[:4], bins, cols[5]], types, strict=True)], names=["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_offset"])

    return rows.groupBy("grp").applyInArrow(run, OUT)
