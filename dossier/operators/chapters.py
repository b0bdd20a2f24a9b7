"""Chapter ranges (inventory rows E1, E3-E5, E7-E11, E13, E15): the issuer's section, what its pages tell, candidates of five sources, their choice, a batch's figures.

Texts are read once, page by page: a page's event categories, dates and excluded words are small arrays, and every range is judged by the union of its pages' arrays, met
by an equi-join on the page number. A word or date that runs over a page break isn't seen.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.rules import CHAPTERS, CHOICE, EVENT_HEADINGS, MASTER, NOT_SHAREHOLDERS, REQUIRED_CHAPTERS, SOURCES, WINDOW
from dossier.functions.text import any_of, fixed, norm, page_norm
from dossier.sources.stages import kept

from .headings import clip, required_pages
from .islands import islands
from .units import dates_in

SECTION = r"第[一二三四五六七八九十百\d]+节.*$"  # fixed value: a major section's title in a line
NO_SECTION, NO_END, WEAK = "未找到“第X节 发行人基本情况”正文大章节", "未找到下一个大章节标题，结束页按最大跨度截断", "大章节标题已找到，但相邻页上下文支持较弱"


def _told_of_sections(pages: DataFrame, rules: dict) -> DataFrame:
    """(company_id, pdf_page, own, others, words, edge) of each page: the first line that names the section by an alias, the titles of other major sections, the context's
    words as bits, and the text's ends, long enough for a word that runs over a page break. Contents name no section; a page without a section's last character isn't looked at."""
    text, reach = page_norm(F.col("lines")), max(len(x) for x in rules["context"]) - 1
    t = fixed(pages.select("company_id", "pdf_page", "is_toc", "lines"), t=text)
    named = F.filter(F.transform(F.slice("lines", 1, rules["scan"]), lambda x, i: F.struct(i.alias("line_index"), x.alias("line"), F.regexp_extract(norm(x), SECTION, 0).alias("tail"))), lambda x: x["tail"] != "")
    t = fixed(t, named=F.when(~F.col("is_toc") & F.col("t").contains("节"), named))
    alias = lambda x: x["tail"].rlike(any_of(rules["aliases"]))
    words = F.lit(0)
    for i, x in enumerate(rules["context"]):
        words = words + F.when(F.col("t").contains(x), 1 << i).otherwise(0)
    edge = F.when(F.length("t") <= 2 * reach, F.col("t")).otherwise(F.concat(F.left("t", F.lit(reach)), F.lit("\u0000"), F.right("t", F.lit(reach))))
    return t.select("company_id", "pdf_page", F.get(F.filter("named", alias), F.lit(0)).alias("own"), F.array_distinct(F.transform(F.filter("named", lambda x: ~alias(x)), lambda x: x["tail"])).alias("others"), words.alias("words"), edge.alias("edge"))


def _supported(told: DataFrame, rules: dict, block: int = 512) -> DataFrame:
    """(company_id, pdf_page, own, support) of the pages that name the section: how many of the context's words they and the `ahead` pages after them hold. Pages meet those
    after them in blocks, of which each holds the first pages of the next."""
    ahead, at = rules["ahead"], F.floor(F.col("pdf_page") / block)
    d = told.select("company_id", "pdf_page", "own", "words", "edge", F.explode(F.when(F.col("pdf_page") - at * block < ahead, F.array(at, at - 1)).otherwise(F.array(at))).alias("block"))
    w = W.partitionBy("company_id", "block").orderBy("pdf_page")
    near = [F.lead(F.struct("pdf_page", "words", "edge"), i).over(w) for i in range(1, ahead + 1)]
    d = d.withColumn("near", F.array(F.struct("pdf_page", "words", "edge"), *near)).where((F.col("block") == at) & F.col("own").isNotNull())
    d = d.withColumn("near", F.filter("near", lambda x: x["pdf_page"] <= F.col("pdf_page") + ahead))
    d = fixed(d, bits=F.aggregate("near", F.lit(0), lambda a, x: a.bitwiseOR(x["words"])), joined=F.array_join(F.transform("near", lambda x: x["edge"]), ""))
    support = F.lit(0)
    for i, x in enumerate(rules["context"]):
        support = support + ((F.col("bits").bitwiseAND(1 << i) > 0) | F.col("joined").contains(x)).cast("int")
    return d.select("company_id", "pdf_page", "own", support.alias("support"))


def master_sections(pages: DataFrame, page_counts: DataFrame, rules: dict = MASTER) -> DataFrame:
    """Each company's own major section: status, start_page, end_page, title, evidence_line, context_support, confidence, review_reason.

    Every line that names the section by an alias counts, with the words of its page and the three pages after it; the best score wins, then the first page and
    line. The section ends before the first later page that names a section of another title and no alias. pages: company_id, pdf_page, lines, is_toc.
    Texts are read once; what they tell of sections is a few bytes a page."""
    told = kept(_told_of_sections(pages, rules), "sections-told", None)
    # of the pages with equal support the first has the best score
    first = F.min(F.struct("pdf_page", F.col("own.line_index").alias("line_index"), F.col("own.tail").alias("tail"), F.col("own.line").alias("line"))).alias("x")
    own = _supported(told, rules).groupBy("company_id", "support").agg(first).select("company_id", "support", "x.*").join(page_counts, "company_id")
    score = (
        F.lit(0.70) + F.least(F.col("support"), F.lit(5)) * F.lit(0.05) + F.when(F.col("support") >= rules["minimum"], 0.05).otherwise(0.0)
        + F.when(F.col("pdf_page") <= F.floor(F.col("page_count") * 0.5), 0.05).otherwise(0.0)
    )
    best = own.withColumn("score", F.round(F.least(score, F.lit(1.0)), 6)).groupBy("company_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "pdf_page", "line_index", "tail", "line", "support")).alias("b"))
    best = best.select("company_id", (-F.col("b.s")).alias("score"), F.col("b.pdf_page").alias("start_page"), F.col("b.tail").alias("title"), F.col("b.line").alias("evidence_line"), F.col("b.support").alias("support"))
    other = told.select("company_id", "pdf_page", F.explode("others").alias("tail")).join(best.select("company_id", "start_page", "title"), "company_id")
    ends = other.where("pdf_page > start_page and tail <> title").groupBy("company_id").agg(F.min("pdf_page").alias("next_page"))
    m = page_counts.join(best, "company_id", "left").join(ends, "company_id", "left")
    found, closed = F.col("start_page").isNotNull(), F.col("next_page").isNotNull()
    end = F.when(closed, F.greatest(F.col("start_page"), F.col("next_page") - 1)).otherwise(F.least(F.col("page_count"), F.col("start_page") + rules["cap"] - 1))
    return m.select(
        "company_id", F.when(~found, "NOT_FOUND").when(closed, "CONFIRMED_BY_NEXT_MAJOR_SECTION").otherwise("CAPPED_BY_MAX_SPAN").alias("status"), "start_page", F.when(found, end).alias("end_page"), "title", "evidence_line",
        F.coalesce("support", F.lit(0)).alias("context_support"), F.coalesce(F.round("score", 3), F.lit(0.0)).alias("confidence"),
        F.when(~found, NO_SECTION).when(F.col("support") < rules["minimum"], WEAK).when(~closed, NO_END).alias("review_reason"),
    )


def found_sections(master: DataFrame) -> DataFrame:
    return master.where("start_page is not null")


def master_candidates(master: DataFrame) -> DataFrame:
    """A company's section as a candidate range of its overview."""
    return found_sections(master).select("company_id", F.lit("issuer_overview").alias("type"), F.lit("ISSUER_MASTER_SECTION").alias("source"), "start_page", "end_page", F.col("confidence").alias("score"), "title")


# --- what pages tell ---------------------------------------------------------------------------------------------------


def page_signals(pages: DataFrame, rules: dict = WINDOW) -> DataFrame:
    """(company_id, pdf_page, categories, dates, excluded) of each page's lines: event categories, distinct dates, words that rule a range out."""
    t = fixed(pages.select("company_id", "pdf_page", "lines"), t=page_norm(F.col("lines")))
    holds = lambda ts: reduce(or_, [F.col("t").contains(x) for x in ts], F.lit(False))
    kinds = F.array_compact(F.array(*[F.when(holds(ts), F.lit(k)) for k, ts in sorted(rules["categories"].items())]))
    barred = F.array_compact(F.array(*[F.when(F.col("t").contains(x), F.lit(x)) for x in rules["exclude"]]))
    return t.select("company_id", "pdf_page", kinds.alias("categories"), F.array_sort(dates_in(F.col("t"))).alias("dates"), barred.alias("excluded"))


def with_profile(ranges: DataFrame, signals: DataFrame, rules: dict = WINDOW) -> DataFrame:
    """Ranges with the distinct categories, dates and excluded words of their first `cap` pages."""
    key = ["company_id", "start_page", "end_page"]
    pages = ranges.select(*key).distinct().withColumn("pdf_page", F.explode(F.sequence("start_page", F.least("end_page", F.col("start_page") + rules["cap"] - 1))))
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    told = pages.join(signals, ["company_id", "pdf_page"]).groupBy(*key).agg(every("categories"), every("dates"), every("excluded"))
    return ranges.join(told, key, "left")


def enough(rules: dict = WINDOW) -> Column:
    """E5: of a profile, enough categories and dates and no excluded word."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return (size("categories") >= rules["least_categories"]) & (size("dates") >= rules["least_dates"]) & (size("excluded") <= 0)


def valid_equity(ranges: DataFrame, signals: DataFrame, rules: dict = WINDOW) -> DataFrame:
    """E5: ranges of equity history whose title (column `title`) isn't a fixed table's and whose pages tell enough events."""
    titled = ranges.where(~F.coalesce(norm(F.col("title")).rlike(any_of(rules["static"])), F.lit(False)))
    return with_profile(titled, signals, rules).where(enough(rules)).drop("categories", "dates", "excluded")


def valid_shareholders(ranges: DataFrame) -> DataFrame:
    """E5: ranges of shareholders whose title tells no changes."""
    return ranges.where(~F.coalesce(norm(F.col("title")).rlike(any_of(NOT_SHAREHOLDERS)), F.lit(False)))


# --- sources -----------------------------------------------------------------------------------------------------------


def grouped(members: DataFrame, gap: int, bonus: float, source: str) -> DataFrame:
    """Runs of two members or more under one parent (without one: of one level) and type, each starting `gap` pages at most after the end before it.

    members: company_id, type, start_page, end_page, score, heading_no, title, parent_no, parent_title, level, toc_support, context_support. A run keeps its members' numbers and
    titles in their order."""
    m = members.withColumn("parent_key", F.coalesce(F.concat(F.lit("p"), "parent_no"), F.concat(F.lit("l"), "level"), F.lit("-")))
    keys = ["company_id", "type", "parent_key"]
    i = islands(m, keys, ["start_page", "heading_no"], "start_page", "end_page", gap)
    row = F.struct("start_page", "heading_no", "title", "parent_title")
    g = i.groupBy(*keys, "island").agg(
        F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"), F.max("score").alias("best"), F.count(F.lit(1)).alias("members"), F.array_sort(F.collect_list(row)).alias("rows"),
        F.min("level").alias("level"), F.min("parent_no").alias("parent_no"), F.sum("toc_support").alias("toc_support"), F.max("context_support").alias("context_support"),
    ).where("members >= 2")
    parent = F.get(F.filter("rows", lambda x: x["parent_title"].isNotNull()), F.lit(0))["parent_title"]
    titles = F.transform("rows", lambda x: x["title"])
    return g.select(
        "company_id", "type", F.lit(source).alias("source"), "start_page", "end_page", F.round(F.least(F.lit(1.0), F.col("best") + bonus), 3).alias("score"), F.coalesce(parent, F.array_join(F.slice(titles, 1, 3), "；")).alias("title"),
        F.transform("rows", lambda x: x["heading_no"]).alias("supporting_headings"), titles.alias("supporting_titles"), "members", "level", "parent_no", "toc_support", "context_support", "parent_key",
    )


def with_parent_titles(members: DataFrame, headings: DataFrame) -> DataFrame:
    """members with the title of their parent heading. headings: company_id, heading_no, raw."""
    names = headings.select("company_id", F.col("heading_no").alias("parent_no"), F.col("raw").alias("parent_title"))
    return members.join(names, ["company_id", "parent_no"], "left")


def event_members(tree: DataFrame, chapters: dict = CHAPTERS) -> DataFrame:
    """Enriched headings that name an event and have two words of equity history in their section, as members of a group."""
    rule = chapters["equity_history"]
    hits = F.coalesce(F.col("context")["equity_history"], F.lit(0))
    e = tree.where(F.col("core").rlike(any_of(EVENT_HEADINGS)) & ~F.col("core").rlike(any_of(rule["exclude"])) & (hits >= 2))
    score = F.round(F.least(F.lit(0.78), F.lit(0.52) + F.least(hits, F.lit(6)) * 0.04), 3)
    return e.select(
        "company_id", F.lit("equity_history").alias("type"), F.col("pdf_page").alias("start_page"), "end_page", score.alias("score"), "heading_no", F.col("raw").alias("title"), "parent_no", "level", F.lit(0).alias("toc_support"), hits.alias("context_support")
    )


def event_windows(signals: DataFrame, master: DataFrame, rules: dict = WINDOW) -> DataFrame:
    """Runs of the issuer's pages that tell an event and a date, a page longer, capped, with their confidence; kept if their pages tell enough.

    A window's categories and dates are the union of its pages', those between the seeds included."""
    m = found_sections(master).select("company_id", F.col("start_page").alias("ms"), F.col("end_page").alias("me"), F.col("title").alias("parent_title"))
    seeds = signals.where("size(categories) > 0 and size(dates) > 0").join(m, "company_id").where("pdf_page between ms and me")
    i = islands(seeds.select("company_id", "pdf_page", "ms", "me", "parent_title"), ["company_id"], ["pdf_page"], "pdf_page", "pdf_page", rules["gap"])
    w = i.groupBy("company_id", "island", "ms", "me", "parent_title").agg(F.min("pdf_page").alias("first"), F.max("pdf_page").alias("last"))
    w = w.withColumn("start_page", F.greatest(F.col("ms"), F.col("first") - rules["before"])).withColumn("end_page", F.least(F.col("me"), F.col("last") + rules["after"], F.col("start_page") + rules["cap"] - 1))
    w = with_profile(w, signals, rules).where(enough(rules))
    late = (F.col("start_page") - F.col("ms")) / F.greatest(F.col("me") - F.col("ms") + 1, F.lit(1))
    score = F.lit(0.61) + F.lit(0.05) * F.size("categories") + F.lit(0.012) * F.least(F.size("dates"), F.lit(10)) + F.greatest(F.lit(0.0), F.lit(0.06) - late * F.lit(0.08))
    return w.select(
        "company_id", F.lit("equity_history").alias("type"), F.lit("EVENT_WINDOW").alias("source"), "start_page", "end_page", F.round(F.least(score, F.lit(0.90)), 3).alias("score"), F.lit("发行人基本情况内正文事件窗口").alias("title"), "island", "categories", "dates",
        F.size("categories").alias("context_support"), "parent_title",
    )


def all_candidates(direct: DataFrame, tree: DataFrame, signals: DataFrame, master: DataFrame, headings: DataFrame) -> DataFrame:
    """Candidates of all five sources in one table, by the rules of their type.

    Ranges of the two required types are cut to the issuer's section before they are judged and grouped, and again after; those of other types stand as they
    are. direct: what direct_candidates() gives; tree: what enriched() gives."""
    own = found_sections(master)
    direct = with_parent_titles(direct, headings)
    free = direct.where(~F.col("type").isin(REQUIRED_CHAPTERS))
    cut = lambda df: clip(df, own)
    equity, holders = (cut(direct.where(F.col("type") == k)) for k in ("equity_history", "shareholders"))
    equity, holders = valid_equity(equity, signals), valid_shareholders(holders)
    groups = lambda df: cut(grouped(df, CHOICE["sibling_gap"], CHOICE["sibling"], "SIBLING_GROUP"))
    clusters = cut(grouped(with_parent_titles(event_members(tree), headings), CHOICE["cluster_gap"], CHOICE["cluster"], "EVENT_CLUSTER"))
    one = lambda df: df.withColumn("supporting_headings", F.array("heading_no")).withColumn("supporting_titles", F.array("title"))
    parts = [one(free), one(equity), one(holders), master_candidates(master), valid_equity(groups(equity), signals), valid_shareholders(groups(holders)), valid_equity(clusters, signals), event_windows(signals, master).drop("categories", "dates", "island")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select("company_id", "type", "source", "start_page", "end_page", "score", "title", "supporting_headings", "supporting_titles", F.coalesce("toc_support", F.lit(0)).alias("toc_support"), F.coalesce("context_support", F.lit(0)).alias("context_support"))


def source_rank(source: Column) -> Column:
    """The place of a source in the order of trust."""
    return F.array_position(F.array(*[F.lit(x) for x in SOURCES]), source)


def top_candidates(candidates: DataFrame, k: int = 3) -> DataFrame:
    """The most trusted of equal (start, end, type), then the first k of a type by source, score, length and start; the first is primary."""
    w = W.partitionBy("company_id", "type", "start_page", "end_page").orderBy("source_rank", F.desc("score"))
    one = candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    w = W.partitionBy("company_id", "type").orderBy("source_rank", F.desc("score"), F.desc(F.col("end_page") - F.col("start_page")), "start_page")
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn("is_primary", F.col("rank") == 1)


# --- figures of a batch ------------------------------------------------------------------------------------------------


def company_figures(numbers: DataFrame, headings: DataFrame, chosen: DataFrame, reviews: DataFrame, master: DataFrame, required: list[str] = REQUIRED_CHAPTERS) -> DataFrame:
    """A row for each company of the batch: pages by status, headings, chosen ranges, required pages, reviews and its status."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    out = numbers.groupBy("company_id").agg(F.count(F.lit(1)).alias("pages"), is_("CONFIRMED").alias("confirmed"), is_("INFERRED").alias("inferred"), is_("MISSING").alias("missing"), is_("CONFLICT").alias("conflicts"))
    target = (F.col("heading_class") == "BODY_HEADING") & (F.size("types") > 0)
    parts = [
        headings.groupBy("company_id").agg(F.count(F.lit(1)).alias("headings"), F.count_if(target).alias("target_headings")),
        chosen.groupBy("company_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if("is_primary").alias("primaries"), F.count_if(F.col("is_primary") & F.col("type").isin(required)).alias("required_primaries")),
        required_pages(chosen.where("is_primary"), required).join(numbers.select("company_id", "pdf_page", F.col("status").isin("CONFIRMED", "INFERRED").alias("ok")), ["company_id", "pdf_page"], "left")
        .groupBy("company_id").agg(F.count(F.lit(1)).alias("required_pages"), F.count_if("ok").alias("required_mapped")),
        reviews.groupBy("company_id").agg(F.count(F.lit(1)).alias("reviews")), found_sections(master).select("company_id", F.lit(1).alias("master")),
    ]
    for p in parts:
        out = out.join(p, "company_id", "left")
    out = out.na.fill(0)
    return out.withColumn("coverage", F.round((F.col("confirmed") + F.col("inferred")) / F.greatest("pages", F.lit(1)), 4)).withColumn("company_status", F.when(F.col("reviews") > 0, "REVIEW_REQUIRED").otherwise("READY"))


def batch_figures(companies: DataFrame, required: list[str] = REQUIRED_CHAPTERS, expected: int | None = None, failures: int = 0) -> DataFrame:
    """One row for the batch: totals, rates and its status. expected: how many companies there should be; failures: how many failed before."""
    names = ["pages", "confirmed", "inferred", "missing", "conflicts", "headings", "target_headings", "candidates", "primaries", "required_primaries", "required_pages", "required_mapped", "reviews", "master"]
    t = companies.agg(F.count(F.lit(1)).alias("companies"), F.count_if(F.col("company_status") == "REVIEW_REQUIRED").alias("companies_to_review"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    rate = lambda a, b: F.round(a / F.greatest(b, F.lit(1)), 4)
    off = F.lit(False) if expected is None else F.col("companies") + failures != expected
    status = F.when(F.lit(failures > 0), "PARTIAL_FAILURE").when(off, "BLOCKED").when(F.col("reviews") > 0, "READY_WITH_REVIEW").otherwise("READY")
    want = (F.col("companies") + failures) * len(required)
    return t.select(
        status.alias("batch_status"), "*", F.lit(failures).alias("failures"), rate(F.col("confirmed") + F.col("inferred"), F.col("pages")).alias("coverage"), rate(F.col("required_mapped"), F.col("required_pages")).alias("required_coverage"),
        rate(F.col("required_primaries"), want).alias("required_primary_rate"),
    )
