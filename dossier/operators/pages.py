"""Page tables: readiness, features and printed page numbers (inventory rows A2-A6, A12, A13, B3, B6, B8, B9, B12, C1-C8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.text import fixed, lines_of, norm, squash

EDGE, HEADER_SCAN, FOOTER_SCAN, DIGITS, MARGIN, YEARS = 8, 4, 3, 4, 40, (1900, 2099)
HEADER_WORD = "招股说明书"
# Pattern, its priority, its confidence, whether it is strong; in order of detection.
PATTERNS = [
    ("EXACT_PREFIXED", 5, 1.00, True), ("EXACT_CHINESE", 2, 0.98, True), ("PROSPECTUS_HEADER_PREFIXED", 4, 0.99, True),
    ("PROSPECTUS_HEADER_BARE", 3, 0.97, True), ("EXACT_BARE", 1, 0.64, False),
]


def parse_name(c: Column, pattern: str = r"^(\d{6})[_-]?(.*?)(?:\.pdf)?$") -> Column:
    """A2: struct(code, name, status) of a file name."""
    code = F.regexp_extract(c, pattern, 1)
    return F.struct(F.when(code != "", code).alias("code"), F.when(code != "", F.regexp_extract(c, pattern, 2)).alias("name"), F.when(code != "", "MATCHED").otherwise("UNMATCHED").alias("status"))


def sample_pages(count: Column) -> Column:
    """A3: the first three, quarter, half, three quarters and last three pages that exist, each once, in order."""
    n = count
    all_ = F.array(F.lit(1), F.lit(2), F.lit(3), F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int"), F.floor(n * 3 / 4).cast("int"), n - 2, n - 1, n)
    return F.array_sort(F.array_distinct(F.filter(all_, lambda p: (p >= 1) & (p <= n))))


def text_layer_status(sampled: DataFrame, keys=("company_id",), least: int = 40) -> DataFrame:
    """A4: whether all, none or some of a document's sampled pages carry `least` non-space characters."""
    full = F.count_if(F.length(squash(F.col("text"))) >= least)
    g = sampled.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("sampled"), full.cast("int").alias("with_text"))
    return g.withColumn("text_layer", F.when(F.col("sampled") == 0, "UNCHECKED").when(F.col("with_text") == F.col("sampled"), "TEXT").when(F.col("with_text") == 0, "NO_TEXT").otherwise("MIXED"))


def document_readiness(docs: DataFrame) -> DataFrame:
    """A5: FAILED, REVIEW_REQUIRED or READY, with the warnings that say why. Reads pages, text_layer and name_status."""
    w = F.array_compact(F.array(
        F.when(F.coalesce(F.col("pages"), F.lit(0)) == 0, "no_pages"), F.when(F.col("name_status") == "UNMATCHED", "file_name_unmatched"),
        F.when(F.col("text_layer") == "NO_TEXT", "no_text_layer"), F.when(F.col("text_layer") == "MIXED", "partial_text_layer"),
    ))
    return docs.withColumn("warnings", w).withColumn("readiness", F.when(F.array_contains("warnings", "no_pages"), "FAILED").when(F.size("warnings") > 0, "REVIEW_REQUIRED").otherwise("READY"))


def registry(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched companies, unmatched files)."""
    return docs.where("name_status = 'MATCHED'"), docs.where("name_status <> 'MATCHED'")


def load_pages(pages: DataFrame) -> DataFrame:
    """Page rows with status, character count and hash filled in where they are missing."""
    text = F.coalesce("text", F.lit(""))
    have = set(pages.columns)
    old = lambda n, t: F.col(n) if n in have else F.lit(None).cast(t)
    chars = F.length(squash(text))
    return pages.select(
        "company_id", "pdf_page", text.alias("text"), F.coalesce(old("text_status", "string"), F.when(chars > 0, "EXTRACTED").otherwise("EMPTY")).alias("text_status"),
        chars.alias("text_char_count"), F.coalesce(old("page_text_sha256", "string"), F.sha2(text, 256)).alias("page_text_sha256"),
    )


def page_features(pages: DataFrame) -> DataFrame:
    """Lines with the first and last twelve of them."""
    return pages.withColumn("lines", lines_of(F.col("text"))).select("*", F.size("lines").alias("line_count"), F.slice("lines", 1, 12).alias("first_lines"), F.expr("slice(lines, greatest(1, size(lines) - 11), 12)").alias("last_lines"))


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raises if a key occurs twice."""
    bad = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if bad:
        raise ValueError(f"duplicate keys {keys}: {[tuple(r)[:-1] for r in bad]}")


def repeated_edge_lines(pages: DataFrame, edge: int = 3, chars=(2, 70)) -> DataFrame:
    """On how many pages a line is among the first or last three, counted once a page."""
    # line by line, as a function over an array is interpreted; a line among the first and the last is worked out once
    last = [F.size("lines") - k for k in range(edge, 0, -1)]
    e = F.array_distinct(F.array(*[norm(F.get("lines", F.lit(i))) for i in range(edge)], *[norm(F.when(i >= edge, F.get("lines", i))) for i in last]))
    x = pages.select("company_id", "pdf_page", F.explode(e).alias("line")).where(F.length("line").between(*chars))
    return x.groupBy("company_id", "line").agg(F.count(F.lit(1)).alias("pages"))


def text_units(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines inside a company's ranges, with a dense index that starts at 0 in each range."""
    r = ranges.select(F.col("company_id"), "range_id", "start_page", "end_page")
    j = lines.join(r, "company_id").where(F.col("pdf_page").between(F.col("start_page"), F.col("end_page")))
    w = W.partitionBy("company_id", "range_id").orderBy("pdf_page", "line_index")
    return j.withColumn("global_index", F.row_number().over(w) - 1)


def following(units: DataFrame, keys: list[str], order: str, k: int, text: str = "line", page: str = "pdf_page") -> DataFrame:
    """The texts of the next k units of the same page, joined."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(1, k)
    ahead = F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t"))).over(w)
    return units.withColumn("_a", ahead).withColumn("context", F.array_join(F.transform(F.filter("_a", lambda x: x["p"] == F.col(page)), lambda x: x["t"]), "\n")).drop("_a")


def section_text(pages: DataFrame, sections: DataFrame, max_pages: int) -> DataFrame:
    """Text of a section's first max_pages pages and its excerpt of 480 characters from two pages."""
    s = sections.select("company_id", "section_id", "start_page", F.least("end_page", F.col("start_page") + max_pages - 1).alias("stop"))
    j = pages.join(s, "company_id").where(F.col("pdf_page").between(F.col("start_page"), F.col("stop")))
    g = j.groupBy("company_id", "section_id", "start_page").agg(F.array_sort(F.collect_list(F.struct("pdf_page", "text"))).alias("p"))
    join = lambda a: F.array_join(F.transform(a, lambda x: x["text"]), "\n")
    return g.select("company_id", "section_id", join(F.col("p")).alias("section_text"), F.substring(join(F.slice("p", 1, 2)), 1, 480).alias("excerpt"))


# --- printed page numbers ----------------------------------------------------------------------------------------------


def page_number_candidates(pages: DataFrame) -> DataFrame:
    """Page-number candidates in the edge lines of pages (company_id, pdf_page, lines, page_count), ranked.

    Most lines hold no number in any of the forms, and leave before anything is worked out of them. No line fits two forms."""
    n, d = F.size("lines"), f"\\d{{1,{DIGITS}}}"
    at = pages.select("company_id", "pdf_page", "page_count", n.alias("n"), F.posexplode("lines").alias("line_index", "line"))
    head, foot = F.col("line_index") < EDGE, F.col("line_index") >= F.col("n") - EDGE
    at = fixed(at.where((head | foot) & F.col("line").rlike(r"\d")), flat=norm(F.col("line")))
    at = at.where(F.col("flat").rlike(rf"^(?:\d+-)*{d}$|^第{d}页$|{HEADER_WORD}"))
    at = fixed(at, tail=F.regexp_replace(F.regexp_extract("flat", HEADER_WORD + "(.*)$", 1), "^[：:]+", ""))
    place = lambda *x: F.array(*[F.lit(v) for v in x])
    at = at.select("*", F.explode(F.when(head & foot, place("HEADER", "FOOTER")).when(head, place("HEADER")).otherwise(place("FOOTER"))).alias("position"))
    tail = F.col("tail")
    header = (F.col("position") == "HEADER") & (F.col("line_index") < HEADER_SCAN)
    footer = (F.col("position") == "FOOTER") & (F.col("n") - 1 - F.col("line_index") < FOOTER_SCAN)
    long_, bare = rf"^(\d+(?:-\d+)+)-({d})(?:\D.*)?$", rf"^({d})(?:\D.*)?$"
    prefixed = F.regexp_extract(tail, long_, 2) != ""
    found = {
        "EXACT_PREFIXED": (F.lit(True), F.regexp_extract("flat", rf"^(\d+(?:-\d+)+)-({d})$", 1), F.regexp_extract("flat", rf"^(\d+(?:-\d+)+)-({d})$", 2)),
        "EXACT_CHINESE": (F.lit(True), F.lit(""), F.regexp_extract("flat", f"^第({d})页$", 1)),
        "PROSPECTUS_HEADER_PREFIXED": (header, F.regexp_extract(tail, long_, 1), F.regexp_extract(tail, long_, 2)),
        "PROSPECTUS_HEADER_BARE": (header & ~prefixed, F.lit(""), F.regexp_extract(tail, bare, 1)),
        "EXACT_BARE": (footer, F.lit(""), F.regexp_extract("flat", f"^({d})$", 1)),
    }
    items = [
        F.when(ok & (num != ""), F.struct(F.when(pre != "", pre).alias("prefix"), num.cast("int").alias("number"), F.lit(p).alias("pattern"), F.lit(prio).alias("priority"), F.lit(conf).alias("confidence"), F.lit(strong).alias("strong")))
        for (p, prio, conf, strong), (ok, pre, num) in ((row, found[row[0]]) for row in PATTERNS)
    ]
    c = fixed(at.select("company_id", "pdf_page", "page_count", "line_index", "line", "position", "n", "flat", "tail"), c=F.coalesce(*items)).where("c is not null")
    c = c.select("company_id", "pdf_page", "page_count", "line_index", "line", "position", "c.*")
    c = c.where((F.col("number") > 0) & (F.col("number") <= F.col("page_count") + MARGIN) & ~(F.col("prefix").isNull() & F.col("number").between(*YEARS)))
    w = W.partitionBy("company_id", "pdf_page").orderBy(F.desc("strong"), F.desc("priority"), F.desc("confidence"), F.desc("position"), "line_index")
    return c.drop("page_count").withColumn("rank", F.row_number().over(w))


def initial_numbers(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """A page's first choice and its status: CONFIRMED, CONFLICT, CANDIDATE or MISSING. The candidates are read once: a page's rivals are a short array."""
    key = ["company_id", "pdf_page"]
    top = F.min_by(F.struct("prefix", "number", "pattern", "confidence", "strong"), "rank").alias("top")
    rivals = F.collect_list(F.when(F.col("strong") & (F.col("rank") > 1), F.struct("number", "pattern", "confidence"))).alias("rivals")
    c = candidates.groupBy(*key).agg(top, rivals)
    same = lambda r: (r["number"] != F.col("top.number")) & (r["pattern"] == F.col("top.pattern")) & (F.abs(r["confidence"] - F.col("top.confidence")) <= 0.01)
    c = c.select(*key, "top.prefix", "top.number", "top.confidence", "top.strong", (F.col("top.strong") & F.exists("rivals", same)).alias("clash"))
    j = pages.select(*key).join(c, key, "left")
    status = F.when(F.col("number").isNull(), "MISSING").when(F.col("clash"), "CONFLICT").when(F.col("strong"), "CONFIRMED").otherwise("CANDIDATE")
    return j.select(*key, "prefix", "number", status.alias("status"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def confirm_weak(numbers: DataFrame, run: int = 3, anchors: int = 3) -> DataFrame:
    """Weak numbers in runs of three pages, or with an offset that three confirmed pages share, are confirmed; others go."""
    # one deal serves all three windows; pages without a number are in no group, so each stands by itself instead of all of a company's in one task
    off = numbers.withColumn("offset", F.col("pdf_page") - F.col("number")).withColumn("_pre", F.coalesce("prefix", F.lit(""))).withColumn("_by", F.when(F.col("number").isNull(), F.col("pdf_page")))
    group = ["company_id", "_pre", "offset", "_by"]
    off = off.repartition(*group)
    weak = F.col("status") == "CANDIDATE"
    w = W.partitionBy(*group, "status").orderBy("pdf_page")
    off = off.withColumn("isl", F.when(weak, F.col("pdf_page") - F.row_number().over(w)))
    off = off.withColumn("in_run", F.when(weak, F.count(F.lit(1)).over(W.partitionBy(*group, "status", "isl"))))
    off = off.withColumn("state", F.when(weak & (F.col("in_run") >= run), "CONFIRMED").otherwise(F.col("status")))
    off = off.withColumn("held", F.count_if(F.col("state") == "CONFIRMED").over(W.partitionBy(*group)))
    state = F.when((F.col("state") == "CANDIDATE") & (F.col("held") >= anchors), "CONFIRMED").when(F.col("state") == "CANDIDATE", "MISSING").otherwise(F.col("state"))
    return off.withColumn("status", state).select("company_id", "pdf_page", F.when(state != "MISSING", F.col("prefix")).alias("prefix"), F.when(state != "MISSING", F.col("number")).alias("number"), state.alias("status"))


def page_segments(numbers: DataFrame, anchors: int = 3, share: float = 0.6) -> DataFrame:
    """Offsets that hold for three confirmed pages and 60 % of their prefix, from first to last anchor, larger first."""
    a = numbers.where("status = 'CONFIRMED'").withColumn("offset", F.col("pdf_page") - F.col("number"))
    g = a.groupBy("company_id", "prefix", "offset").agg(F.count(F.lit(1)).alias("anchors"), F.min("pdf_page").alias("start_page"), F.max("pdf_page").alias("end_page"))
    g = g.withColumn("share", F.col("anchors") / F.sum("anchors").over(W.partitionBy("company_id", F.coalesce("prefix", F.lit("")))))
    g = g.where((F.col("anchors") >= anchors) & (F.col("share") >= share))
    return g.withColumn("rank", F.row_number().over(W.partitionBy("company_id").orderBy(F.desc("anchors"), "start_page")))


def fill_numbers(numbers: DataFrame, segments: DataFrame) -> DataFrame:
    """Missing pages inside a segment take its number; the first segment decides."""
    # a company's segments are a few at most (each has 60 % of its prefix), so they come as one array and pages are read once
    s = segments.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("prefix").alias("p2"), "offset", "start_page", "end_page"))).alias("_s"))
    inside = lambda x: F.col("pdf_page").between(x["start_page"], x["end_page"]) & (F.col("pdf_page") - x["offset"] > 0)
    j = numbers.join(s, "company_id", "left").withColumn("h", F.when(F.col("status") == "MISSING", F.get(F.filter("_s", inside), F.lit(0))))
    inferred = F.col("h").isNotNull()
    return j.select("company_id", "pdf_page", F.when(inferred, F.col("h.p2")).otherwise(F.col("prefix")).alias("prefix"), F.when(inferred, F.col("pdf_page") - F.col("h.offset")).otherwise(F.col("number")).alias("number"), F.when(inferred, "INFERRED").otherwise(F.col("status")).alias("status"))


def resolve_printed(ranges: DataFrame, patch: DataFrame) -> DataFrame:
    """Printed start and end of a range by the patch's offset, else by the range's own start, else unknown."""
    j = ranges.join(patch.select("company_id", F.col("offset").alias("patch_offset")), "company_id", "left")
    off = F.coalesce("patch_offset", F.col("start_page") - F.col("start_printed"))
    return j.select(*ranges.columns, (F.col("start_page") - off).alias("printed_start"), (F.col("end_page") - off).alias("printed_end"))


def coverage(numbers: DataFrame, keys=("company_id",)) -> DataFrame:
    """Mapped pages and their share."""
    mapped = F.col("status").isin("CONFIRMED", "INFERRED")
    return numbers.groupBy(*keys).agg(F.count(F.lit(1)).alias("pages"), F.count_if(mapped).alias("mapped"), F.avg(mapped.cast("double")).alias("rate"))
