"""Headings and their hierarchy (inventory rows D1-D14), and of the chapter ranges clipping, printed numbers, direct candidates, bands and reviews.

The issuer's section, the other sources of candidates, their choice and a batch's figures are in chapters.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.rules import CHAPTERS, CHOICE
from dossier.functions.text import any_of, fixed, norm

from .islands import parent, section_end

# Numbering of headings by level.
_N = "一二三四五六七八九十百"
NUMBERING = [(0, f"^第[{_N}\\d]+节"), (1, f"^[{_N}]+、"), (2, f"^[（(][{_N}]+[）)]"), (3, r"^\d+[\.、]"), (4, r"^[（(]\d+[）)]")]
# The second scheme, for event texts; no numbering is 9.
EVENT_NUMBERING = [(1, f"^第[{_N}\\d]+节"), (2, f"^[{_N}]+、"), (3, f"^[（(][{_N}]+[）)]"), (4, r"^\d+[、.]"), (5, r"^[（(]\d+[）)]"), (4, r"^(?:19|20)\d{2}年")]
TOC_WORDS, DOT_LEADER, TOC_LINES = ["目录", "目錄"], r"[\.·…]{2,}", 5
CROSS_REFERENCE = "详见|参见|请见|见本招股说明书"
MAX_CHARS, PAGE_TOP, BODY_SCAN, REPEATED = 64, 6, 18, 3


def toc_flags(pages: DataFrame) -> DataFrame:
    """Pages (with their lines) with is_toc and toc_signals: a contents title in the first 20 lines, or five lines with dot leaders that end in digits. Read off
    each page's array of lines, so nothing is shuffled."""
    # a page without a word's first character, or without a leader, needs no look at its lines
    text = F.array_join("lines", "\n")
    title = text.rlike(any_of(sorted({x[0] for x in TOC_WORDS}))) & F.exists(F.slice("lines", 1, 20), lambda x: norm(x).rlike(any_of(TOC_WORDS)))
    dense = text.rlike(DOT_LEADER) & (F.size(F.filter("lines", lambda x: x.rlike(DOT_LEADER) & norm(x).rlike(r"\d{1,4}$"))) >= TOC_LINES)
    p = pages.withColumn("_a", title).withColumn("_b", dense)
    return p.withColumn("is_toc", F.col("_a") | F.col("_b")).withColumn("toc_signals", F.array_compact(F.array(F.when(F.col("_a"), "toc_title_keyword"), F.when(F.col("_b"), "toc_dense_dot_leaders")))).drop("_a", "_b")


def level_of(flat: Column, table=NUMBERING, none=None) -> Column:
    """The level of the first numbering that fits."""
    out = None
    for k, p in table:
        out = F.when(flat.rlike(p), k) if out is None else out.when(flat.rlike(p), k)
    # most texts have no numbering: one pattern tells those apart
    return F.when(flat.rlike(_any_numbering(table)), out).otherwise(F.lit(none).cast("int"))


def _any_numbering(table=NUMBERING) -> str:
    return "^(?:" + "|".join(p.removeprefix("^") for _, p in table) + ")"


def _by_first(terms: list[str]) -> str:
    """Like any_of(), with the terms of one first character together: few branches are tried at each place of a text."""
    rest: dict[str, set[str]] = {}
    for t in terms:
        rest.setdefault(t[0], set()).add(t[1:])
    return "|".join(any_of([k]) + ("" if "" in v else f"(?:{any_of(v)})") for k, v in sorted(rest.items()))


def only_number(flat: Column) -> Column:
    return flat.rlike(_any_numbering() + "$")


def strip_numbering(flat: Column) -> Column:
    """Each numbering once, in order, then outer colons."""
    for _, p in NUMBERING:
        flat = F.regexp_replace(flat, p, "")
    return F.regexp_replace(flat, "^[：:]+|[：:]+$", "")


def strip_toc(flat: Column) -> Column:
    v = F.regexp_replace(F.regexp_replace(flat, r"[\.·…]{2,}\d{1,4}$", ""), r"\d{1,4}$", "")
    return F.regexp_replace(v, "^[：:]+|[：:]+$", "")


def title_like(core: Column, chars: int = MAX_CHARS) -> Column:
    """D5."""
    commas = F.length(core) - F.length(F.replace(core, F.lit("，"), F.lit("")))
    return F.length(core).between(3, chars) & ~core.rlike(f"[。；！？]|^(?:注|说明)[：:]|{CROSS_REFERENCE}") & (commas < 3)


def heading_units(lines: DataFrame, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """Short lines, and a bare number merged with the next line; lines below the scan limit count on contents pages only.

    Where lines come with `next` (page_lines()), nothing is shuffled for it. only: a test of the line without white space; lines that fail it leave first."""
    j, columns = lines, [c for c in lines.columns if c != "next"]
    if "next" not in lines.columns:
        j = j.withColumn("next", F.lead("line").over(W.partitionBy("company_id", "pdf_page").orderBy("line_index")))
    j = j.where((F.col("line_index") < BODY_SCAN) | F.col("is_toc"))
    unit = lambda raw, flat, merged: F.struct(raw.alias("raw"), flat.alias("flat"), F.lit(merged).alias("merged"))
    j = j.select(*columns, "next", F.explode(F.array(norm(F.col("line")))).alias("own"))
    if only is not None:
        j = j.where(only(F.col("own")))
    short, bare = F.length("own") <= MAX_CHARS, only_number(F.col("own")) & F.col("next").isNotNull()
    single, both = unit(F.col("line"), F.col("own"), False), unit(F.concat("line", "next"), F.concat("own", norm(F.col("next"))), True)
    units = F.when(short & bare, F.array(single, both)).when(short, F.array(single)).when(bare, F.array(both))
    return j.select(*columns, "own", F.explode(units).alias("u")).select(*columns, "own", "u.raw", "u.flat", "u.merged")


def page_lines(pages: DataFrame) -> DataFrame:
    """A row for each line of pages (with their lines and is_toc): company_id, pdf_page, is_toc, line_index, line, next (the line after it on the page, or null)."""
    each = F.arrays_zip(F.col("lines").alias("line"), F.slice("lines", 2, F.size("lines")).alias("next"))
    return pages.select("company_id", "pdf_page", "is_toc", F.posexplode(each).alias("line_index", "_l")).select("company_id", "pdf_page", "is_toc", "line_index", "_l.line", "_l.next")


def match_types(core: Column, chapters: dict = CHAPTERS) -> Column:
    """An array of (type, by alias, by group); an excluded word blocks a type."""
    parts = []
    for kind, r in sorted(chapters.items()):
        alias = F.lit(False)
        for a in r["aliases"]:
            alias = alias | (core.contains(a) & (F.length(core) - len(a) <= 8))
        group = F.lit(False)
        for g in r["groups"]:
            one = F.lit(True)
            for t in g:
                one = one & core.contains(t)
            group = group | one
        ok = (alias | group) & (~core.rlike(any_of(r["exclude"])) if r["exclude"] else F.lit(True))
        parts.append(F.when(ok, F.struct(F.lit(kind).alias("type"), alias.alias("alias"), group.alias("trigger"))))
    return F.array_compact(F.array(*parts))


def headings(lines: DataFrame, repeated: DataFrame, chapters: dict = CHAPTERS) -> DataFrame:
    """Kept headings with class, matched types and score. lines: company_id, pdf_page, line_index, line, is_toc."""
    # a heading has a numbering or a chapter's words: other lines leave first, then those that repeat as page headers, before titles are worked out
    named = [a for r in chapters.values() for a in r["aliases"]]
    words = named + [g[0] if g else "" for r in chapters.values() for g in r["groups"]]  # a group without words fits any line
    can_be = lambda own, terms: F.lit(True) if "" in terms else own.rlike(_any_numbering()) | (own.rlike(_by_first(terms)) if terms else F.lit(False))
    # a line below the top of a page that isn't contents can't be kept, whatever it says
    lines = lines.where((F.col("line_index") < PAGE_TOP) | F.col("is_toc"))
    u = heading_units(lines, lambda own: can_be(own, words)).withColumn("top", F.col("line_index") < PAGE_TOP)
    # of the lines that repeat, only those that a heading can be: the rest isn't counted, as this is pushed below the count
    again = repeated.where(can_be(F.col("line"), named)).where(F.col("pages") >= REPEATED)
    u = u.join(again.select("company_id", F.col("line").alias("own"), F.col("pages").alias("repeats")), ["company_id", "own"], "left")
    u = u.where(~(~F.col("is_toc") & F.col("repeats").isNotNull() & (F.col("line_index") <= 2)))
    core = strip_numbering(F.when(F.col("is_toc"), strip_toc(F.col("flat"))).otherwise(F.col("flat")))
    # generators, as a filter would be pushed below the projection and hold the title's expression once for each of its mentions
    u = fixed(u, level=level_of(F.col("flat")), core=core).where(title_like(F.col("core"))).drop("flat")
    u = fixed(u, types=match_types(F.col("core"), chapters))
    alias = F.exists("types", lambda t: t["alias"])
    trigger = F.exists("types", lambda t: t["trigger"])
    u = u.where((F.col("level").isNotNull() | (F.size("types") > 0)) & (F.col("is_toc") | F.col("level").isNotNull() | alias))
    u = u.withColumn("heading_class", F.when(F.col("is_toc"), "TOC_ENTRY").otherwise("BODY_HEADING"))
    score = (
        F.when(F.col("heading_class") == "BODY_HEADING", 0.18).otherwise(0.06) + F.when(alias, 0.5).when(trigger, 0.3).otherwise(0.0)
        + F.when(F.col("top"), 0.08).otherwise(0.0) + F.when(F.col("level").isNotNull(), 0.08).otherwise(0.0) + F.when(F.col("merged"), 0.02).otherwise(0.0)
    )
    u = u.withColumn("score", F.round(F.least(score, F.lit(1.0)), 3)).withColumn("types", F.transform("types", lambda t: t["type"]))
    # equal rows stand side by side in the company's order, so the pass that numbers the headings drops them too
    same = ["pdf_page", "line_index", "merged", "core"]
    w = W.partitionBy("company_id").orderBy(*same)
    u = u.withColumn("_new", (~F.struct(*same).eqNullSafe(F.lag(F.struct(*same)).over(w))).cast("int"))
    u = u.withColumn("heading_no", F.sum("_new").over(w).cast("int")).where("_new = 1")
    return u.select("company_id", "pdf_page", "line_index", "merged", "raw", "core", "level", "heading_class", "score", "types", "heading_no")


def matched_aliases(core: Column, chapters: dict = CHAPTERS) -> Column:
    """The aliases that a title holds with at most eight characters besides."""
    every = F.array(*[F.lit(a) for r in chapters.values() for a in r["aliases"]])
    return F.array_distinct(F.filter(every, lambda a: core.contains(a) & (F.length(core) - F.length(a) <= 8)))


def hierarchy(h: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Parent number and last page of each body heading."""
    b = h.where("heading_class = 'BODY_HEADING'").join(page_counts, "company_id")
    order = ["pdf_page", "line_index", "merged"]
    return b.withColumn("parent_no", parent(["company_id"], order, "level", F.col("heading_no"), range(5))).withColumn("end_page", section_end(["company_id"], order, "level", "pdf_page", F.col("page_count"), range(5))).drop("page_count")


def toc_support(h: DataFrame, chapters: dict = CHAPTERS) -> DataFrame:
    """For each body heading and type, how many contents entries of the type carry an equal title or share an alias.

    Equal titles share all aliases, so a title with aliases is met by those alone, and one without by itself. Contents entries are counted by their aliases (or title)
    before anything meets, so headings meet counts, and sets of aliases are as few as the rules give: nothing grows with headings times entries."""
    aliases = F.array_sort(matched_aliases(F.col("core"), chapters))
    keys = F.when(F.size(aliases) > 0, aliases).otherwise(F.array("core")).alias("keys")
    side = lambda kind: h.where(F.col("heading_class") == kind).select("company_id", "heading_no", F.explode("types").alias("type"), keys).distinct()
    b, t = side("BODY_HEADING"), side("TOC_ENTRY").groupBy("company_id", "type", "keys").agg(F.count(F.lit(1)).alias("n"))
    at = ["company_id", "type"]
    mine = b.select(*at, "keys").distinct().select(*at, "keys", F.explode("keys").alias("key"))
    theirs = t.select(*at, F.col("keys").alias("t_keys"), "n", F.explode("keys").alias("key"))
    # sets that share several aliases meet once for each of them, and count once
    met = mine.join(theirs, [*at, "key"]).groupBy(*at, "keys", "t_keys").agg(F.first("n").alias("n")).groupBy(*at, "keys").agg(F.sum("n").alias("toc_support"))
    return b.join(met, [*at, "keys"], "left").select("company_id", "heading_no", "type", F.coalesce("toc_support", F.lit(0)).alias("toc_support"))


def words_ahead(pages: DataFrame, words: list[str]) -> DataFrame:
    """(company_id, pdf_page, ahead): for each word, the first page from this one on that holds it, or null. One backward pass over a filing, so a section of any
    length needs its first page only."""
    flat = pages.select("company_id", "pdf_page", norm(F.col("text")).alias("_t"))
    flat = flat.select("company_id", "pdf_page", *[F.col("_t").contains(x).alias(f"_w{i}") for i, x in enumerate(words)])
    w = W.partitionBy("company_id").orderBy(F.desc("pdf_page")).rowsBetween(W.unboundedPreceding, W.currentRow)
    ahead = F.array(*[F.last(F.when(F.col(f"_w{i}"), F.col("pdf_page")), ignorenulls=True).over(w) for i in range(len(words))])
    return flat.select("company_id", "pdf_page", ahead.alias("ahead"))


def context_words(chapters: dict = CHAPTERS) -> list[str]:
    return sorted({x for r in chapters.values() for x in r["context"]})


def context_support(ahead: Column, words: list[str], wanted: list[str], stop: Column) -> Column:
    """How many of the wanted words a section holds up to the page `stop`."""
    out = F.lit(0)
    for x in wanted:
        out = out + F.coalesce((F.get(ahead, F.lit(words.index(x))) <= stop).cast("int"), F.lit(0))
    return out


def enriched(tree: DataFrame, pages: DataFrame, chapters: dict = CHAPTERS) -> DataFrame:
    """Body headings with `context` (a count for each type), types by the words of their section (a title word and enough context; 0.24 each) and without types
    that the title excludes. tree: what hierarchy() gives."""
    words = context_words(chapters)
    stop = F.least(F.col("end_page"), F.col("pdf_page") + CHOICE["pages"] - 1)
    j = tree.join(words_ahead(pages, words), ["company_id", "pdf_page"])
    j = j.withColumn("context", F.create_map(*[x for k, r in sorted(chapters.items()) for x in (F.lit(k), context_support(F.col("ahead"), words, r["context"], stop))]))
    holds = lambda terms: F.col("core").rlike(any_of(terms)) if terms else F.lit(False)
    added, barred = [], []
    for k, r in sorted(chapters.items()):
        added.append(F.when(holds(r["anchors"]) & ~holds(r["exclude"]) & (F.col("context")[k] >= r["minimum"]), F.lit(k)))
        barred.append(F.when(holds(r["exclude"]), F.lit(k)))
    j = j.withColumn("_more", F.array_compact(F.array(*added))).withColumn("_less", F.array_compact(F.array(*barred)))
    types = F.array_sort(F.array_except(F.array_union("types", "_more"), "_less"))
    return j.withColumn("types", types).withColumn("score", F.least(F.lit(1.0), F.col("score") + CHOICE["section"] * F.size("_more"))).drop("_more", "_less", "ahead")


def scope_adjustment(core: Column, kind: Column, span: Column, page: Column, pages: Column, chapters: dict = CHAPTERS) -> Column:
    """Broad titles gain 0.10; narrow ones lose 0.18, one-page spans 0.08, the last quarter 0.12."""
    part = lambda key: F.coalesce(*[F.when(kind == k, core.rlike(any_of(r[key]))) for k, r in chapters.items() if r[key]], F.lit(False))
    return (
        F.when(part("broad"), CHOICE["broad"]).otherwise(0.0) - F.when(part("narrow"), CHOICE["narrow"]).otherwise(0.0)
        - F.when(span <= 1, CHOICE["single"]).otherwise(0.0) - F.when(page > F.floor(pages * 0.75), CHOICE["late"]).otherwise(0.0)
    )


# --- ranges ------------------------------------------------------------------------------------------------------------


def clip(ranges: DataFrame, master: DataFrame) -> DataFrame:
    """Ranges that start in the master section, cut at its end."""
    m = master.select("company_id", F.col("start_page").alias("ms"), F.col("end_page").alias("me"))
    return ranges.join(m, "company_id").where(F.col("start_page").between(F.col("ms"), F.col("me"))).withColumn("end_page", F.least("end_page", "me")).drop("ms", "me")


def with_printed(ranges: DataFrame, numbers: DataFrame) -> DataFrame:
    """Ranges with the printed numbers of both ends and why they have to be reviewed. numbers: company_id, pdf_page, prefix, number, status."""
    n = numbers.select("company_id", F.col("pdf_page").alias("_p"), F.struct("prefix", "number").alias("_n"), F.col("status").isin("CONFIRMED", "INFERRED").alias("_ok"))
    out = ranges
    for end in ("start", "end"):
        own = n.select("company_id", F.col("_p").alias(f"{end}_page"), F.col("_n").alias(f"{end}_printed"), F.col("_ok").alias(f"_{end}_ok"))
        out = out.join(own, ["company_id", f"{end}_page"], "left")
    why = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(f"_{end}_ok"), F.lit(False)), F.lit(text)) for end, text in (("start", "起始页正文页码未确认"), ("end", "结束页正文页码未确认"))]))
    return out.withColumn("review_reasons", why).drop("_start_ok", "_end_ok")


def direct_candidates(tree: DataFrame, support: DataFrame, page_counts: DataFrame, chapters: dict = CHAPTERS) -> DataFrame:
    """Each enriched body heading as a candidate of each of its types: its score with bonuses for contents entries, context and scope, within 0 and 1."""
    d = tree.select("*", F.explode("types").alias("type")).join(support, ["company_id", "heading_no", "type"], "left").join(page_counts, "company_id")
    toc, context = F.coalesce("toc_support", F.lit(0)), F.coalesce(F.col("context")[F.col("type")], F.lit(0))
    adjust = scope_adjustment(F.col("core"), F.col("type"), F.col("end_page") - F.col("pdf_page") + 1, F.col("pdf_page"), F.col("page_count"), chapters)
    score = F.col("score") + F.when(toc > 0, CHOICE["toc"]).otherwise(0.0) + F.when(context > 0, CHOICE["context"]).otherwise(0.0) + adjust
    return d.select(
        "company_id", "type", F.lit("HEADING_SECTION").alias("source"), F.col("pdf_page").alias("start_page"), "end_page", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 3).alias("score"), "heading_no",
        toc.alias("toc_support"), context.alias("context_support"), "parent_no", "level", F.col("raw").alias("title"),
    )


def confidence_band(score: Column) -> Column:
    """E12."""
    return F.when(score >= 0.85, "HIGH").when(score >= 0.65, "MEDIUM").otherwise("LOW")


def review_ranges(top: DataFrame, companies: DataFrame, required: list[str], margin: float = 0.08, numbers: DataFrame | None = None) -> DataFrame:
    """Required types that a company lacks, primaries whose rival is within the margin, and companies with unnumbered pages in a required primary range."""
    need = companies.select("company_id", F.explode(F.array(*[F.lit(t) for t in required])).alias("type"))
    missing = need.join(top.select("company_id", "type").distinct(), ["company_id", "type"], "left_anti").withColumn("reason", F.lit("missing_required_type"))
    nxt = F.lead("score").over(W.partitionBy("company_id", "type").orderBy("rank"))
    close = top.withColumn("rival", nxt).where(F.col("is_primary") & (F.col("score") - F.col("rival") <= margin)).select("company_id", "type", F.lit("ambiguous_margin").alias("reason"))
    out = missing.unionByName(close)
    if numbers is not None:
        lost = required_pages(top.where("is_primary"), required).join(numbers.where(~F.col("status").isin("CONFIRMED", "INFERRED")), ["company_id", "pdf_page"], "left_semi")
        out = out.unionByName(lost.select("company_id", F.lit(None).cast("string").alias("type"), F.lit("pagination_problem").alias("reason")).distinct())
    return out


def required_pages(ranges: DataFrame, required: list[str]) -> DataFrame:
    """The distinct pages of ranges of the required types."""
    r = ranges.where(F.col("type").isin(required))
    return r.select("company_id", F.explode(F.sequence("start_page", "end_page")).alias("pdf_page")).distinct()


def required_coverage(ranges: DataFrame, numbers: DataFrame, required: list[str]) -> DataFrame:
    """Pages of required ranges, those with a number, and their share, by company."""
    j = required_pages(ranges, required).join(numbers.select("company_id", "pdf_page", F.col("status").isin("CONFIRMED", "INFERRED").alias("mapped")), ["company_id", "pdf_page"], "left")
    ok = F.coalesce("mapped", F.lit(False))
    return j.groupBy("company_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(ok).alias("mapped"), F.avg(ok.cast("double")).alias("rate"))
