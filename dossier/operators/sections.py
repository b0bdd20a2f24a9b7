"""Event sections from annotated units (inventory G1-G22)."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, _parse_datatype_string

from dossier.functions.rules import EVENT_RULES, EventRules
from dossier.functions.text import any_of, norm

from . import pairs
from . import units as u
from .headings import EVENT_NUMBERING, level_of
from .holders import alike, matcher
from .islands import cover, fold, section_end, span_runs
from .narrative import procedural, wrapper_heading

CAP, ROOT_PAGES = 260, 3
SUMMARY_AFTER, FALLBACK_BEFORE, FALLBACK_AFTER = 4, 2, 18
TIMELINE_SIMILARITY = 0.72


def annotated(units: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """units (company_id, global_index, page, line) with every predicate that sections ask, each computed once a unit."""
    c = F.col("line")
    d = units.withColumn("t", u.typed(c, rules)).select("*", F.col("t.types").alias("types"), F.col("t.combined").alias("combined")).drop("t")
    d = u.with_context(d, "after", 0, u.HISTORY_UNITS, same_page=True)
    d = d.select(
        *units.columns, "types", "combined", level_of(c, EVENT_NUMBERING, 9).alias("level"), u.dates_of(c).alias("dates"), u.ordinals(c).alias("ordinals"), u.heading_like(c, rules).alias("heading"),
        u.timeline_row(c, rules).alias("timeline"), u.aggregate_statement(c, rules).alias("aggregate"), u.metadata_date(c, rules).alias("metadata"), wrapper_heading(c, rules).alias("wrapper"),
        (u.generic_summary(c, rules) | u.background_heading(c, rules)).alias("background"), u.reference_only(c, rules).alias("reference"), u.provider_only(c, rules).alias("provider_only"),
        procedural(c, rules).alias("procedural"), u.provider_history(F.col("after"), rules).alias("history"), u.negative_reason(c, rules).alias("negative"),
    )
    typed = F.size("types") > 0
    dated = norm(c).rlike(r"^(?:19|20)\d{2}年")
    boundary = F.col("heading") & ~F.col("timeline") & ~F.col("metadata") & ~F.col("aggregate") & ~(typed & F.col("procedural")) & (~dated | (typed & ~F.col("provider_only")))
    return d.withColumn("boundary", boundary)


def section_extent(units: DataFrame, cap: int = CAP) -> DataFrame:
    """Boundary headings with the index where their section ends: before the next boundary of the same or a smaller level, `cap`
    units at most. units: company_id, global_index, line, level, boundary, and the company's last index as last."""
    hd = units.where("boundary")
    end = section_end(["company_id"], ["global_index"], "level", "global_index", F.col("last"), range(1, 10))
    return hd.withColumn("end_index", F.least(end, F.col("global_index") + cap - 1))


def with_last(units: DataFrame) -> DataFrame:
    return units.withColumn("last", F.max("global_index").over(W.partitionBy("company_id")))


def uncovered(units: DataFrame, sections: DataFrame) -> DataFrame:
    """Units outside all sections."""
    return cover(units, sections.select("company_id", "global_index", "end_index"), "company_id", "global_index", "global_index", "end_index", "left_anti")


def accepted_roots(headings: DataFrame, pages: int = ROOT_PAGES) -> DataFrame:
    """In order, a dateless bare heading is dropped if a root of its type was accepted at most `pages` before.

    headings: company_id, seq, page, type, dateless. A type's headings are cut into runs without a wider gap, which don't touch."""
    keys = ["company_id", "type", "run"]
    runs = span_runs(headings, keys[:2], ["seq"], F.col("page"), F.col("page"), pages)

    def step(last: dict, r: dict):
        if r["dateless"] and last and r["page"] - last["page"] <= pages:
            return None
        last["page"] = r["page"]
        return {"seq": r["seq"]}

    kind = headings.schema["seq"].dataType.simpleString()
    return fold(runs, keys, ["seq"], dict, step, f"seq {kind}").select("company_id", "type", "seq")


def root_headings(units: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """Annotated units that head an event, with end_index of their sections."""
    reject = ["background", "timeline", "metadata", "aggregate", "wrapper", "reference", "procedural", "provider_only"]
    d = with_last(units)
    ends = d.where("boundary or heading")
    end = section_end(["company_id"], ["global_index"], "level", "global_index", F.col("last"), range(1, 10))
    roots = ends.withColumn("end_index", F.least(end, F.col("global_index") + CAP - 1)).where(F.col("heading") & (F.size("types") > 0))
    for name in reject:
        roots = roots.where(~F.col(name))
    bare = F.regexp_replace(norm(F.col("line")), r"^[1234567890、.（）()一二三四五六七八九十]+", "")
    words = F.array(*[F.lit(t) for ts in rules.terms.values() for t in ts])
    roots = roots.withColumn("dateless", (F.size("dates") == 0) & F.array_contains(words, bare)).withColumn("type", F.get("types", F.lit(0))).withColumn("seq", F.col("global_index"))
    kept = accepted_roots(roots.select("company_id", "seq", "page", "type", "dateless"))
    return roots.join(kept.select("company_id", F.col("seq")), ["company_id", "seq"], "left_semi").drop("seq", "last")


def heading_sections(roots: DataFrame) -> DataFrame:
    """Roots with `accepted`: a root inside an accepted section goes if that is a merger, combines its type, or is of its type.

    roots: company_id, global_index, end_index, types, combined, negative. The outermost accepted section round a root counts; a negative root is
    no parent. Sections that don't overlap don't touch, so a company is passed run by run."""
    keys = ["company_id", "run"]
    runs = span_runs(roots, keys[:1], ["global_index"], F.col("global_index"), F.col("end_index"), 0)

    def step(open_: list, r: dict):
        open_[:] = [s for s in open_ if s["end_index"] >= r["global_index"]]
        inside = next((s for s in open_ if s["global_index"] < r["global_index"]), None)
        kind = r["types"][0]
        ok = inside is None or not (inside["types"][0] == "ABSORPTION_MERGER" or (inside["combined"] and kind in inside["types"]) or kind == inside["types"][0])
        if ok and not r["negative"]:
            open_.append(r)
        return {"global_index": r["global_index"], "accepted": ok}

    cols = ["company_id", "run", "global_index", "end_index", "types", "combined", "negative"]
    kind = roots.schema["global_index"].dataType.simpleString()
    got = fold(runs.select(*cols), keys, ["global_index"], list, step, f"global_index {kind}, accepted boolean")
    return roots.join(got.drop("run"), ["company_id", "global_index"])


def section_confidence(period: Column, n_units: Column) -> Column:
    """0.76, and 0.08 for a period, and 0.06 for three units or more."""
    return F.round(F.least(F.lit(0.98), F.lit(0.76) + F.when(period.isNotNull(), 0.08).otherwise(0.0) + F.when(n_units >= 3, 0.06).otherwise(0.0)), 3)


def section_negatives(units: DataFrame, sections: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """Sections (company_id, global_index, end_index) with `negative`, the reason found in their first NEGATIVE_UNITS units."""
    at = sections.select("company_id", "global_index", "end_index", F.explode(F.sequence("global_index", F.least("end_index", F.col("global_index") + u.NEGATIVE_UNITS - 1))).alias("i"))
    lines = at.join(units.select("company_id", F.col("global_index").alias("i"), "line"), ["company_id", "i"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), "")
    return lines.groupBy("company_id", "global_index", "end_index").agg(text.alias("text")).select("company_id", "global_index", "end_index", u.negative_reason(F.col("text"), rules).alias("negative"))


def summary_disclosures(units: DataFrame) -> DataFrame:
    """Annotated units that sum events up, by the first kind that fits, once for each (kind, page, text), with the text of the next units."""
    kind = (
        F.when(F.col("history"), "SERVICE_PROVIDER_AGGREGATE_HISTORY").when(F.col("aggregate"), "AGGREGATE_EVENT_SUMMARY").when(F.col("timeline"), "TIMELINE_SUMMARY_ROW").when(F.col("metadata"), "METADATA_DATE_FIELD")
        .when(F.col("reference"), "CROSS_REFERENCE_ONLY").when(F.col("provider_only"), "SERVICE_PROVIDER_PROCEDURE").when(F.col("wrapper"), "CLASSIFICATION_WRAPPER")
    )
    d = u.with_context(units, "evidence_text", 0, SUMMARY_AFTER, sep="\n").withColumn("summary_kind", kind).where("size(types) > 0 and summary_kind is not null")
    first = F.min(F.struct("global_index", "types", "line", "evidence_text")).alias("x")
    return d.groupBy("company_id", "summary_kind", "page", norm(F.col("line")).alias("_t")).agg(first).select("company_id", "summary_kind", "page", "x.*")


def fallback_windows(units: DataFrame, sections: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """Annotated units outside all sections that tell an event, with `suppressed_by` (null: kept) and the window of a kept one.

    sections: company_id, global_index, end_index, type, ordinals, period. Kept: 2 units before, 18 after; a timeline row only if no section has its event."""
    d = uncovered(with_last(units), sections).where("size(types) > 0 and negative is null").withColumn("type", F.get("types", F.lit(0)))
    cause = (
        F.when(F.col("aggregate"), "aggregate_summary").when(F.col("metadata"), "metadata_date").when(F.col("reference"), "cross_reference").when(F.col("wrapper"), "classification_wrapper")
        .when(F.col("history") | F.col("procedural"), "procedural_line")
    )
    d = d.withColumn("suppressed_by", cause)
    told = represented(d.where("timeline and suppressed_by is null"), sections, rules)
    d = d.join(told.select("company_id", "global_index", F.lit(True).alias("told")), ["company_id", "global_index"], "left")
    venue = norm(F.col("line")).rlike(any_of(rules.venues)) & (F.col("type") == "EQUITY_TRANSFER")
    d = d.withColumn("suppressed_by", F.coalesce("suppressed_by", F.when(F.col("told"), "timeline_row"))).where((F.size("dates") > 0) | F.col("suppressed_by").isNotNull())
    d = d.withColumn("suppressed_by", F.coalesce("suppressed_by", F.when(F.col("provider_only") | venue, "excluded_context")))
    kept = F.col("suppressed_by").isNull()
    return d.select(
        "company_id", "global_index", "page", "line", "type", "suppressed_by", F.when(F.col("timeline"), "TIMELINE_ONLY").otherwise("DATED_FALLBACK").alias("source_kind"),
        F.when(kept, F.greatest(F.lit(0), F.col("global_index") - FALLBACK_BEFORE)).alias("first"), F.when(kept, F.least("last", F.col("global_index") + FALLBACK_AFTER)).alias("final"),
    )


def represented(rows: DataFrame, sections: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """Annotated timeline rows whose event a section of an equivalent type has: by an ordinal where both have any, else by a period where both
    have one, else (a row without dates) by a title alike."""
    from dossier.functions.text import date_key

    s = sections.select("company_id", canonical(F.col("type"), rules).alias("c"), F.col("ordinals").alias("o2"), F.col("period").alias("p2"), F.col("title").alias("t2"))
    r = rows.select("company_id", "global_index", "line", "ordinals", F.transform("dates", date_key).alias("periods"), canonical(F.col("type"), rules).alias("c"))
    # rows and sections meet by an ordinal or by the year of a period; titles are compared only for rows without a date, with sections whose ordinals don't decide
    titled = F.when(F.size("periods") == 0, F.array_compact(F.array(F.lit("title"), F.when(F.size("ordinals") == 0, "title+")))).otherwise(F.array().cast("array<string>"))
    year = lambda x: F.concat(F.lit("y"), F.substring(x, 1, 4))
    r = r.withColumn("key", F.explode(F.concat("ordinals", F.when(F.size("periods") > 0, F.array_distinct(F.transform("periods", year))).otherwise(F.array().cast("array<string>")), titled)))
    s = s.withColumn("key", F.explode(F.concat("o2", F.when(F.col("p2").isNotNull(), F.array(year(F.col("p2")))).otherwise(F.array().cast("array<string>")), F.array(F.when(F.size("o2") > 0, "title+").otherwise("title")))))
    j = r.join(s, ["company_id", "c", "key"])
    alike = F.when((F.size("periods") == 0) & ~((F.size("ordinals") > 0) & (F.size("o2") > 0)), text_similarity(norm(F.col("line")), norm(F.col("t2"))))
    j = j.withColumn("alike", alike)
    fits = (
        F.when((F.size("ordinals") > 0) & (F.size("o2") > 0), F.arrays_overlap("ordinals", "o2"))
        .when((F.size("periods") > 0) & F.col("p2").isNotNull(), F.exists("periods", lambda p: period_compatible(p, F.col("p2"))))
        .otherwise(F.coalesce(F.col("alike") >= TIMELINE_SIMILARITY, F.lit(False)))
    )
    return j.where(fits).select("company_id", "global_index").distinct()


def period_compatible(a: Column, b: Column) -> Column:
    """G12."""
    ok = (a == b) | a.startswith(b) | b.startswith(a) | (F.substring(a, 1, 7) == F.substring(b, 1, 7))
    return F.coalesce(ok & (a != "") & (b != ""), F.lit(False))


def canonical(kind: Column, rules: EventRules = EVENT_RULES) -> Column:
    """Equivalent types as one."""
    out = kind
    for g in rules.equivalent:
        out = F.when(kind.isin(g["types"]), g["canonical"]).otherwise(out)
    return out


def canonical_type(types: Column, first: Column, text: Column, rules: EventRules = EVENT_RULES) -> Column:
    """A cluster's type: that of a group of which it holds two, else by a term of its text, else its first section's."""
    out = first
    for kind, (to, terms) in rules.canonical_terms.items():
        out = F.when((first == kind) & norm(text).rlike(any_of(terms)), to).otherwise(out)
    for g in reversed(rules.equivalent):
        out = F.when(F.size(F.array_intersect(types, F.array(*[F.lit(x) for x in g["types"]]))) >= 2, g["canonical"]).otherwise(out)
    return out


@F.pandas_udf(DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """The matching-blocks ratio of the first 1000 characters; no built-in function measures the same. Pairs that repeat within a batch are measured once."""
    from difflib import SequenceMatcher

    pairs = [None if x is None or y is None else (x[:1000], y[:1000]) for x, y in zip(a, b, strict=True)]
    ratios = {p: SequenceMatcher(None, *p).ratio() for p in set(pairs) if p is not None}
    return pd.Series([ratios.get(p) for p in pairs], dtype="float64")


def _paired(sections: DataFrame, rules: EventRules) -> DataFrame:
    """Sections as the passes over pairs read them, with the family of their type."""
    of = pairs.families(rules)
    family = F.coalesce(*[F.when(F.col("type").isin([t for t in of if of[t] == f]), F.lit(f)) for f in sorted(set(of.values()))], F.col("type"))
    return sections.select("company_id", *pairs.COLUMNS).withColumn("title", norm(F.col("title"))).withColumn("family", family)


def merge_edges(sections: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """Pairs of sections of one company that belong to one event (a later, b earlier, by page and number), the first rule that applies deciding.

    sections: company_id, section_no, page, type, period, ordinals, title, start, end, provider, timeline (booleans). Sections are dealt by bands of pages, once more to the next
    band, and by blocks of units for pairs further apart; a group's pairs are judged as matrices, so a pair that is no edge is never a row."""
    width, block, parts = pairs.reach(rules) + 1, 64, int(sections.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spot = lambda far, at, own: F.struct(F.lit(far).alias("far"), at.cast("long").alias("at"), F.lit(own).alias("own"))
    band = F.floor(F.col("page") / width)
    blocks = F.transform(F.sequence(F.floor(F.col("start") / block), F.floor(F.col("end") / block)), lambda x: spot(True, x, True))
    spots = F.concat(F.array(spot(False, band, True), spot(False, band + 1, False)), F.coalesce(blocks, F.array().cast("array<struct<far:boolean,at:bigint,own:boolean>>")))
    s = _paired(sections, rules).where("company_id is not null and type is not null and page is not null and section_no is not null")
    # what a later row can reach: in a band pages alone tell, in a block every row stays
    s = s.select("*", F.inline(spots)).withColumn("low", F.when(F.col("far"), F.lit(-pairs.FAR)))
    keys, kind = ["company_id", "family", "far", "at"], sections.schema["section_no"].dataType.simpleString()
    dealt = s.repartition(parts, *keys).sortWithinPartitions(*keys, "page", "section_no")
    schema = _parse_datatype_string(f"company_id {sections.schema['company_id'].dataType.simpleString()}, a {kind}, b {kind}")
    return dealt.mapInArrow(lambda batches: pairs.edges(batches, keys, rules, to_arrow_schema(schema), block), schema)


def clustered(sections: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """(company_id, section_no, cluster): what first_fit() gives for merge_edges(), without the edges, which grow with the square of a company's sections.

    Families of types never meet, and a family is cut into runs where neither pages nor units touch; a run is passed in order, with the sections within reach in memory."""
    keys = ["company_id", "family"]
    parts, w = int(sections.sparkSession.conf.get("spark.sql.shuffle.partitions")), W.partitionBy(*keys).orderBy(F.asc_nulls_last("page"), F.asc_nulls_last("section_no"))
    s = _paired(sections, rules).withColumn("own", F.lit(True))
    back = W.partitionBy(*keys).orderBy(F.desc_nulls_first("page"), F.desc_nulls_first("section_no"))
    s = s.withColumn("low", F.min("start").over(back.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("long"))
    touch = (F.col("page") - F.lag("page").over(w) <= pairs.reach(rules)) | (F.col("low") <= F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)))
    s = s.withColumn("_new", (~F.coalesce(touch, F.lit(False))).cast("int")).withColumn("run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_new")
    keys = [*keys, "run"]
    dealt = s.repartition(parts, *keys).sortWithinPartitions(*keys, F.asc_nulls_last("page"), F.asc_nulls_last("section_no"))
    kind = lambda c: sections.schema[c].dataType.simpleString()
    schema = _parse_datatype_string(f"company_id {kind('company_id')}, section_no {kind('section_no')}, head_page {kind('page')}, head {kind('section_no')}")
    got = dealt.mapInArrow(lambda batches: pairs.heads(batches, keys, rules, to_arrow_schema(schema)), schema)
    return _ranked(got)


def _ranked(heads: DataFrame) -> DataFrame:
    """Sections with the number of their cluster: by the page and number of its first section."""
    rank = F.dense_rank().over(W.partitionBy("company_id").orderBy("head_page", "head"))
    return heads.select("company_id", "section_no", rank.alias("cluster"))


def first_fit(sections: DataFrame, edges: DataFrame, pages: int = 20) -> DataFrame:
    """Clusters by first fit in section order: a section joins the first cluster that holds a neighbour, else opens one.

    Not connected components: a section with neighbours in two clusters joins the earlier only. sections: company_id, section_no, page, start, end; those
    more than `pages` apart and without overlap have no edge, so a company is passed run by run, over numbers only."""
    kind = sections.schema["section_no"].dataType.simpleString()
    near = edges.groupBy("company_id", F.col("a").alias("section_no")).agg(F.collect_set("b").alias("near"))
    s = sections.select("company_id", "section_no", "page", "start", "end")
    s = span_runs(s, ["company_id"], ["page", "section_no"], F.col("page"), F.col("page"), pages, "by_page")
    s = span_runs(s, ["company_id"], ["page", "section_no"], F.col("start"), F.col("end"), 0, "by_unit")
    # a new run only where both break: number the breaks that the two share
    w = W.partitionBy("company_id").orderBy("page", "section_no")
    both = (F.col("by_page") != F.lag("by_page").over(w)) & (F.col("by_unit") != F.lag("by_unit").over(w))
    s = s.withColumn("_b", F.coalesce(both.cast("int"), F.lit(0))).withColumn("run", F.sum("_b").over(w)).join(near, ["company_id", "section_no"], "left")

    def step(state: dict, r: dict):
        found = [state[b] for b in r["near"] or [] if b in state]
        state[r["section_no"]] = min(found) if found else (r["page"], r["section_no"])
        page, no = state[r["section_no"]]
        return {"section_no": r["section_no"], "head_page": page, "head": no}

    page = sections.schema["page"].dataType.simpleString()
    got = fold(s.select("company_id", "run", "section_no", "page", "near"), ["company_id", "run"], ["page", "section_no"], dict, step, f"section_no {kind}, head_page {page}, head {kind}")
    return _ranked(got)


def other_entity_groups(sections: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """Sections of other entities (company_id, section_no, page, last_page, type, start, end) in groups: first fit by equivalent type and pages that
    touch. Such sections are disclosures, not candidates."""
    s = sections.withColumn("kind", canonical(F.col("type"), rules))
    block = 16
    blocks = lambda df, x: df.withColumn("at", F.explode(F.sequence(F.floor(F.col(f"{x}page") / block), F.floor((F.col(f"{x}last_page") + 1) / block))))
    a = blocks(s.select("company_id", "kind", F.col("section_no").alias("a"), "page", "last_page"), "")
    b = blocks(s.select("company_id", "kind", F.col("section_no").alias("b"), F.col("page").alias("b_page"), F.col("last_page").alias("b_last_page")), "b_")
    later = (F.col("b_page") < F.col("page")) | ((F.col("b_page") == F.col("page")) & (F.col("b") < F.col("a")))
    touch = (F.col("page") <= F.col("b_last_page") + 1) & (F.col("b_page") <= F.col("last_page") + 1)
    edges = a.join(b, ["company_id", "kind", "at"]).where(later & touch).select("company_id", "a", "b").distinct()
    return first_fit(s.withColumn("start", F.col("page")).withColumn("end", F.col("last_page") + 1), edges, 1)


def near_copies_dropped(evidence: DataFrame, similar: float = 0.76, keep: int = 2) -> DataFrame:
    """In order, evidence of a category like one kept before is dropped; two a category at most.

    evidence: company_id, category, seq, text. The first is kept; the next is the smallest later seq unlike all kept so far. Rows come sorted and are passed one by one
    with the kept texts of their category only; once those are complete, no text of the category is read any more."""
    key = ["company_id", "category"]
    parts = int(evidence.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        at, last, kept = None, None, []
        for t in batches:
            rows = []
            for i, (of, seq) in enumerate(zip(zip(*[t.column(c).to_pylist() for c in key], strict=True), t.column("seq").to_pylist(), strict=True)):
                if of != at:
                    at, kept = of, []
                elif len(kept) >= keep or seq is None or last is None or seq <= last:
                    continue
                text = t.column("text")[i].as_py()
                if any(alike(m, text, similar) for m in kept):
                    continue
                kept, last = [*kept, matcher(text)], seq
                rows.append(i)
            yield t.select([*key, "seq"]).take(pa.array(rows, pa.int64()))

    e = evidence.select(*key, "seq", "text").repartition(parts, *key).sortWithinPartitions(*key, "seq", "text")
    return e.mapInArrow(run, e.select(*key, "seq").schema)


def cluster_members(sections: DataFrame, clusters: DataFrame) -> DataFrame:
    """Each cluster's first section, types, page range, period and labels in first-seen order.

    Members with the same ordinals are put together first, so that no row ever holds a cluster's members."""
    j = sections.join(clusters, ["company_id", "section_no"])
    first = F.min(F.struct("page", "section_no", "title", "type")).alias("first")
    dated = F.min(F.when(F.col("period").isNotNull(), F.struct("page", "section_no", "period"))).alias("dated")
    same = j.groupBy("company_id", "cluster", F.coalesce("ordinals", F.array().cast("array<string>")).alias("ordinals")).agg(
        first, dated, F.collect_set("type").alias("types"), F.min("page").alias("low"), F.max("page").alias("high"), F.count(F.lit(1)).alias("n")
    )
    seen = F.transform(F.array_sort(F.collect_list(F.struct("first.page", "first.section_no", "ordinals"))), lambda x: x["ordinals"])
    return same.groupBy("company_id", "cluster").agg(
        F.min("first")["title"].alias("title"), F.min("first")["type"].alias("type"), F.array_distinct(F.flatten(F.collect_list("types"))).alias("types"), F.min("low").alias("first_page"), F.max("high").alias("last_page"),
        F.min("dated")["period"].alias("period"), F.array_distinct(F.flatten(seen)).alias("labels"), F.sum("n").alias("members"),
    )


REFERENCE_WORDS = "参见|详见|具体见|公开转让说明书|申报文件"  # fixed value
COUNTED = ["AGGREGATE_EVENT_SUMMARY", "TIMELINE_SUMMARY_ROW", "SERVICE_PROVIDER_AGGREGATE_HISTORY"]


def coverage_gaps(summaries: DataFrame, found: DataFrame) -> DataFrame:
    """(company_id, seq, gap_type, type, disclosed, found, missing) for summaries that disclose more events than were found.

    summaries: company_id, seq, summary_kind, counts (map), text; the first of each set of counts stands for all. found: company_id, type, n."""
    s = summaries.where(F.col("summary_kind").isin(COUNTED) & (F.size("counts") > 0))
    s = s.withColumn("signature", F.to_json(F.array_sort(F.map_entries("counts"))))
    limited = F.when(norm(F.col("text")).rlike(REFERENCE_WORDS), "REFERENCE_LIMITED_AGGREGATE_HISTORY").otherwise("AGGREGATE_MULTI_EVENT_NOT_EXPANDED")
    first = s.groupBy("company_id", "signature").agg(F.min(F.struct("seq", limited.alias("gap_type"), F.map_entries("counts").alias("counts"))).alias("x"))
    d = first.select("company_id", "x.seq", "x.gap_type", F.explode("x.counts").alias("c")).select("company_id", "seq", "gap_type", F.col("c.key").alias("type"), F.col("c.value").alias("disclosed"))
    j = d.join(found.select("company_id", "type", F.col("n").alias("found")), ["company_id", "type"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return j.where("disclosed > found").select("company_id", "seq", "gap_type", "type", "disclosed", "found", (F.col("disclosed") - F.col("found")).alias("missing"))


def shareholder_clusters(hits: DataFrame, page_gap: int = 1, unit_gap: int = 24) -> DataFrame:
    """Runs of hits with a page gap of one and a unit gap of 24 at most."""
    w = W.partitionBy("company_id", "category").orderBy("global_index")
    new = F.coalesce(((F.col("pdf_page") - F.lag("pdf_page").over(w) > page_gap) | (F.col("global_index") - F.lag("global_index").over(w) > unit_gap)).cast("int"), F.lit(1))
    r = hits.withColumn("_n", new).withColumn("run", F.sum("_n").over(w))
    return r.groupBy("company_id", "category", "run").agg(F.min("global_index").alias("first"), F.max("global_index").alias("last"), F.count(F.lit(1)).alias("hits"))


