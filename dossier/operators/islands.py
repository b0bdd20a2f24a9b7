"""Gaps and islands, and nearest rows, and ordered passes (shared by inventory rows C4, D9, D10, E8-E10, G2, G3, G6, G7, G14, G16, G20, G21)."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string


def islands(df: DataFrame, keys: list[str], order: list[str], start: Column | str, end: Column | str, gap: int, name: str = "island") -> DataFrame:
    """Numbers runs in which a row starts at most `gap` after the end of the row before."""
    w = W.partitionBy(*keys).orderBy(*order)
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    new = F.coalesce((start - F.lag(end).over(w) > gap).cast("int"), F.lit(1))
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w).cast("int")).drop("_new")


def parent(keys: list[str], order: list[str], level: str, value: Column, levels: range = range(7)) -> Column:
    """Value of the nearest earlier row with a smaller level, or with none; null for a row without a level."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = F.lit(None)
    for k in levels:
        last = F.last(F.when(F.col(level).isNull() | (F.col(level) < k), value), ignorenulls=True).over(w)
        out = F.when(F.col(level) == k, last).otherwise(out)
    return out


def section_end(keys: list[str], order: list[str], level: str, page: str, last_page: Column, levels: range = range(7)) -> Column:
    """The page before the next row of the same or a smaller level (without a level: the next row), not before the own page.

    Rows are met backwards, so that each frame grows by a row and nothing is read twice."""
    w = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]).rowsBetween(W.unboundedPreceding, -1)
    nxt = F.last(F.col(page)).over(w)
    for k in levels:
        nxt = F.when(F.col(level) == k, F.last(F.when(F.col(level) <= k, F.col(page)), ignorenulls=True).over(w)).otherwise(nxt)
    return F.greatest(F.col(page), F.coalesce(nxt - 1, last_page))  # greatest() skips nulls


def span_runs(df: DataFrame, keys: list[str], order: list[str], start: Column, end: Column, gap: int, name: str = "run") -> DataFrame:
    """Numbers runs of rows: a new one where a row starts more than `gap` after the end of every row before."""
    w = W.partitionBy(*keys).orderBy(*order)
    new = F.coalesce((start - F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1)) > gap).cast("int"), F.lit(1))
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w).cast("int")).drop("_new")


def fold(df: DataFrame, keys: list[str], order: list[str], begin: Callable[[], Any], step: Callable[[Any, dict], dict | None], out: str) -> DataFrame:
    """An ordered pass over the rows of each group: step(state, row) changes the state and gives a row of `out` or None.

    For rules whose verdict on a row depends on the verdicts before; callers cut groups into runs that don't touch. Rows come sorted and are passed one by one, a new state where
    the group changes: most groups are a few rows, and a call for each of them would cost far more than its rows."""
    schema = _parse_datatype_string(", ".join([*[f"{k} {df.schema[k].dataType.simpleString()}" for k in keys], out]))

    def run(batches):
        at, state, kinds = None, None, to_arrow_schema(schema)
        for t in batches:
            rows = []
            for r in t.to_pylist():
                of = tuple(r[k] for k in keys)
                if of != at:
                    at, state = of, begin()
                got = step(state, r)
                if got is not None:
                    rows.append(dict(zip(keys, of, strict=True)) | got)
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(parts, *keys).sortWithinPartitions(*keys, *[F.asc_nulls_last(c) for c in order])
    return dealt.mapInArrow(run, schema)


def overlaps(a_start: str, a_end: str, b_start: str, b_end: str) -> Column:
    """G14."""
    return (F.col(a_start) <= F.col(b_end)) & (F.col(b_start) <= F.col(a_end))


def cover(points: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, how: str = "left_semi", bucket: int = 64) -> DataFrame:
    """Points inside (left_semi) or outside (left_anti) of any span of the same key.

    Spans are laid out over buckets of positions, so the range test stays within an equi-join however many spans a key has.
    """
    s = spans.select(F.col(key).alias("_k"), F.col(start).alias("_s"), F.col(end).alias("_e"), F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket))).alias("_b"))
    p = points.withColumn("_b0", F.floor(F.col(at) / bucket))
    return p.join(s, (p[key] == s["_k"]) & (p["_b0"] == s["_b"]) & p[at].between(s["_s"], s["_e"]), how).drop("_b0")
