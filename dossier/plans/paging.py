"""Queries over pages, page numbers, headings and ranges (inventory A-E), with their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions import rules as h_rules
from dossier.functions.text import clean_title, date_key, dense_split, format_printed, lines_of, match_context, norm, printed_page
from dossier.operators import chapters as c
from dossier.operators import headings as h
from dossier.operators import pages as p

from .views import PAGES, plain, stage, view

# A page for each order line: headers, headings, dated rows, printed numbers in five styles.
FILING = """
select company_id, pdf_page, concat(
    case when pdf_page % 5 = 0 then concat('某某股份有限公司招股说明书 ', cast(pdf_page - 2 as string), ' 第四节') when pdf_page % 5 = 3 then concat('第', cast(pdf_page - 2 as string), '页') else '某某股份有限公司' end, chr(10),
    case k % 7 when 0 then concat('第', cast(1 + k % 5 as string), '节 公司基本情况') when 1 then '一、股本演变情况' when 2 then '（一）历次股权转让情况' when 3 then '3、历次增资情况' when 4 then '（4）其他股东情况' when 5 then '目录' else '一般内容，详见公司公告。' end, case when k % 7 < 5 then cast(pdf_page as string) else '' end, chr(10),
    cast(y as string), '年', cast(1 + k % 12 as string), '月，第', cast(1 + k % 3 as string), '次股权转让。', chr(10), '  ', chr(10), '公司共进行了', cast(1 + k % 4 as string), '次增资和三次股权转让。',
    case when pdf_page % 5 = 1 then concat(chr(10), '1-1-', cast(pdf_page - 2 as string)) when pdf_page % 5 = 2 then concat(chr(10), cast(pdf_page - 2 as string)) else '' end) as text
from (select lpad(cast(l_suppkey % 50 as string), 6, '0') as company_id, cast(row_number() over (partition by l_suppkey % 50 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as int) as pdf_page,
  cast(l_partkey % 97 as int) as k, year(l_shipdate) as y from {lineitem}) q
"""
# A page for each order line of many short filings: contents, the issuer's section and the next one every forty pages, headings and events between.
FILED = """
select company_id, pdf_page, concat(
    case pdf_page % 40 when 2 then concat('目录', chr(10), '第五节 发行人基本情况', '........', '2', chr(10), '一、发行人的设立及历次股本变化....3') when 4 then '第五节 发行人基本情况' when 33 then '第六节 业务与技术' else '某某股份有限公司' end, chr(10),
    case k % 9 when 0 then '一、发行人的设立及历次股本变化' when 1 then '（一）历次股权转让情况' when 2 then '3、历次增资情况' when 3 then '（二）发行人股东情况' when 4 then '二、发行人的股权结构' when 5 then '（三）整体变更情况' when 6 then '2、主要股东情况' when 7 then '一般内容' else '（四）发行人股本情况' end, chr(10),
    case when k % 6 = 5 then '' else concat(cast(y as string), '年', cast(1 + k % 12 as string), '月，') end, case k % 5 when 0 then '公司增加注册资本' when 1 then '股权转让' when 2 then '整体变更为股份有限公司' when 3 then '董事会审议' else '减资' end, '。', chr(10),
    case k % 4 when 0 then '注册资本与法定代表人，成立时间' when 1 then '持股数量、持股比例、股东名称、控股股东' when 2 then '验资报告，工商变更，股份转让，增资' else '其他' end, case when k % 53 = 7 then '，补充法律意见书' else '' end,
    case when pdf_page % 4 > 0 then concat(chr(10), '1-1-', cast(pdf_page - 1 as string)) else '' end) as text
from (select lpad(cast(l_orderkey % 1500 as string), 6, '0') as company_id, cast(row_number() over (partition by l_orderkey % 1500 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as int) as pdf_page,
  cast(l_partkey % 997 as int) as k, year(l_shipdate) as y from {lineitem}) q
"""
LINES = f"""pg as ({plain(FILING)}), raw as (select company_id, pdf_page, unnest(string_split(text, chr(10))) as l0, unnest(range(len(string_split(text, chr(10))))) as i0 from pg),
ln as (select company_id, pdf_page, trim(l0) as line, (row_number() over (partition by company_id, pdf_page order by i0) - 1)::int as line_index from raw where trim(l0) <> ''),
pc as (select company_id, count(*)::int as page_count from pg group by company_id),
fl as (select ln.*, regexp_replace(line, '[\\s　]+', '', 'g') as flat, count(*) over (partition by company_id, pdf_page) as n, page_count from ln join pc using (company_id))"""


def _pages(spark, d):
    return view(spark, d, FILING)


def _counts(spark, d):
    return _pages(spark, d).groupBy("company_id").agg(F.count(F.lit(1)).cast("int").alias("page_count"))


def _with_lines(spark, d):
    return p.page_features(_pages(spark, d)).join(_counts(spark, d), "company_id")


def _candidates(spark, d):
    return p.page_number_candidates(_with_lines(spark, d))


def _numbers(spark, d):
    def build():
        pages = _with_lines(spark, d)
        return p.confirm_weak(p.initial_numbers(pages, p.page_number_candidates(pages)))

    return stage(spark, d, "page-numbers", build)  # segments and what they fill both read it


def _flagged(spark, d):
    return h.toc_flags(_pages(spark, d).select("company_id", "pdf_page", lines_of(F.col("text")).alias("lines")))


def _lines(spark, d):
    return h.page_lines(_flagged(spark, d)).drop("next")


def _headings(spark, d):
    pages = _flagged(spark, d)
    return h.headings(h.page_lines(pages), p.repeated_edge_lines(pages))


def _tree(spark, d):
    return h.hierarchy(_headings(spark, d), _counts(spark, d))


# --- stages of the filings of FILED: each is written once for a data set and session, and read by the queries after it ------


def _staged(spark, d, name, build):
    return stage(spark, d, f"chapters-{name}", build)


def _filed_pages(spark, d):
    def build():
        # a filing's pages are counted by themselves, one row a filing: a window over the pages would sort their texts
        pages = view(spark, d, FILED)
        counts = pages.groupBy("company_id").agg(F.count(F.lit(1)).cast("int").alias("page_count"))
        return h.toc_flags(pages.withColumn("lines", lines_of(F.col("text")))).join(F.broadcast(counts), "company_id")

    return _staged(spark, d, "pages", build)


def _filed_counts(spark, d):
    return _filed_pages(spark, d).groupBy("company_id").agg(F.max("page_count").alias("page_count"))


def _filed_confirmed(spark, d):
    def build():
        pages = _filed_pages(spark, d).select("company_id", "pdf_page", "page_count", "lines")
        return p.confirm_weak(p.initial_numbers(pages, p.page_number_candidates(pages)))

    return _staged(spark, d, "confirmed", build)


def _filed_numbers(spark, d):
    def build():
        n = _filed_confirmed(spark, d)
        return p.fill_numbers(n, p.page_segments(n))

    return _staged(spark, d, "numbers", build)


def _filed_headings(spark, d):
    def build():
        pages = _filed_pages(spark, d)
        return h.headings(h.page_lines(pages), p.repeated_edge_lines(pages))

    return _staged(spark, d, "headings", build)


def _filed_tree(spark, d):
    def build():
        return h.enriched(h.hierarchy(_filed_headings(spark, d), _filed_counts(spark, d)), _filed_pages(spark, d))

    return _staged(spark, d, "tree", build)


def _filed_master(spark, d):
    return _staged(spark, d, "master", lambda: c.master_sections(_filed_pages(spark, d), _filed_counts(spark, d)))


def _filed_signals(spark, d):
    return _staged(spark, d, "signals", lambda: c.page_signals(_filed_pages(spark, d)))


def _filed_candidates(spark, d):
    def build():
        hs, tree = _filed_headings(spark, d), _filed_tree(spark, d)
        direct = h.direct_candidates(tree, h.toc_support(hs), _filed_counts(spark, d))
        return c.all_candidates(direct, tree, _filed_signals(spark, d), _filed_master(spark, d), hs)

    return _staged(spark, d, "candidates", build)


def _filed_chosen(spark, d):
    return _staged(spark, d, "chosen", lambda: c.top_candidates(_filed_candidates(spark, d).withColumn("source_rank", c.source_rank(F.col("source")))))


def document_readiness(spark, d):
    pages = view(spark, d, PAGES)
    n = pages.groupBy("company_id").agg(F.max("pdf_page").alias("pages"))
    picked = n.select("company_id", F.explode(p.sample_pages(F.col("pages"))).alias("pdf_page"))
    status = p.text_layer_status(pages.join(picked, ["company_id", "pdf_page"], "left_semi"))
    docs = n.join(status, "company_id").withColumn("name", p.parse_name(F.concat(F.lpad(F.regexp_extract("company_id", r"(\d+)", 1), 6, "0"), F.lit("_"), F.col("company_id"), F.lit(".pdf"))))
    r = p.document_readiness(docs.withColumn("name_status", F.col("name.status")))
    good, bad = p.registry(r)
    return good.select("company_id", F.col("name.code").alias("code"), "pages", "sampled", "with_text", "text_layer", F.array_join("warnings", ",").alias("warnings"), "readiness").unionByName(
        bad.select("company_id", F.col("name.code").alias("code"), "pages", "sampled", "with_text", "text_layer", F.array_join("warnings", ",").alias("warnings"), "readiness")
    )


def loaded_pages(spark, d):
    return p.load_pages(view(spark, d, PAGES)).drop("text")


def page_lines(spark, d):
    f = p.page_features(_pages(spark, d))
    return f.select("company_id", "pdf_page", "line_count", F.array_join("first_lines", "|").alias("first_lines"), F.array_join("last_lines", "|").alias("last_lines"))


def text_shapes(spark, d):
    t = view(spark, d, PAGES).select("doc_id", "text")
    return t.select("doc_id", F.length(norm(F.col("text"))).alias("chars"), clean_title(F.col("text")).alias("title"), match_context(F.col("text"), F.lit("the")).alias("context"))


def dense_lines(spark, d):
    t = view(spark, d, "select o_orderkey, concat(repeat('x', 60), cast(year(o_orderdate) as string), '年', cast(month(o_orderdate) as string), '月设立', repeat('y', 60), '2001年5月增资', case when o_orderkey % 2 = 0 then '' else '，完成' end) as line from {orders}")
    s = t.select("o_orderkey", F.posexplode(dense_split(F.col("line"))).alias("segment", "part"))
    return s.select("o_orderkey", "segment", "part")


def printed_pages(spark, d):
    t = view(spark, d, "select l_orderkey, l_linenumber, concat(case when l_partkey % 2 = 0 then '1-1-' else '' end, cast(l_partkey as string)) as raw from {lineitem}")
    x = t.withColumn("p", printed_page(F.col("raw")))
    return x.select("l_orderkey", "raw", F.col("p.prefix").alias("prefix"), F.col("p.number").alias("number"), format_printed(F.col("p.prefix"), F.col("p.number")).alias("again"))


def partial_dates(spark, d):
    t = view(spark, d, "select o_orderkey, concat(cast(year(o_orderdate) as string), case when o_orderkey % 3 = 0 then '年' when o_orderkey % 3 = 1 then concat('年', cast(month(o_orderdate) as string), '月') else concat('.', cast(month(o_orderdate) as string), '.', cast(day(o_orderdate) as string)) end) as d from {orders}")
    return t.select("o_orderkey", date_key(F.col("d")).alias("date_key"))


def repeated_lines(spark, d):
    return p.repeated_edge_lines(p.page_features(_pages(spark, d))).where("pages > 1")


def page_number_candidates(spark, d):
    return _candidates(spark, d).select("company_id", "pdf_page", "prefix", "number", "pattern", "position", "line_index", "confidence", "strong", "rank")


def initial_numbers(spark, d):
    pages = _with_lines(spark, d)
    return p.initial_numbers(pages, p.page_number_candidates(pages))


def confirmed_numbers(spark, d):
    return _numbers(spark, d)


def page_segments(spark, d):
    return p.page_segments(_numbers(spark, d)).select("company_id", "prefix", "offset", "anchors", "start_page", "end_page", "rank")


def filled_numbers(spark, d):
    n = _numbers(spark, d)
    return p.fill_numbers(n, p.page_segments(n))


def number_coverage(spark, d):
    n = _numbers(spark, d)
    return p.coverage(p.fill_numbers(n, p.page_segments(n)))


def toc_pages(spark, d):
    return _flagged(spark, d).select("company_id", "pdf_page", "is_toc", F.array_join("toc_signals", ",").alias("signals"))


def headings(spark, d):
    return _headings(spark, d).select("company_id", "pdf_page", "line_index", "merged", "raw", "core", "level", "heading_class", "score", F.array_join("types", ",").alias("types"), "heading_no")


def heading_tree(spark, d):
    return _tree(spark, d).select("company_id", "heading_no", "pdf_page", "level", "parent_no", "end_page")


def master_sections(spark, d):
    m = c.master_sections(_flagged(spark, d), _counts(spark, d))
    return m.select("company_id", "status", "start_page", "end_page", "title", "context_support", "confidence", "review_reason")


def issuer_sections(spark, d):
    return _filed_master(spark, d).select("company_id", "status", "start_page", "end_page", "title", "evidence_line", "context_support", "confidence", "review_reason")


def clipped_ranges(spark, d):
    t = _filed_tree(spark, d).select("company_id", "heading_no", F.col("pdf_page").alias("start_page"), "end_page")
    return h.clip(t, c.found_sections(_filed_master(spark, d))).select("company_id", "heading_no", "start_page", "end_page")


def _as_members(tree):
    return tree.select("company_id", F.lit("any").alias("type"), F.col("pdf_page").alias("start_page"), "end_page", "score", "heading_no", F.col("raw").alias("title"), "parent_no", F.lit(None).cast("string").alias("parent_title"), "level", F.lit(0).alias("toc_support"), F.lit(0).alias("context_support"))


def sibling_clusters(spark, d):
    return c.grouped(_as_members(_tree(spark, d)), 15, 0.12, "SIBLING_GROUP").select("company_id", "parent_key", "start_page", "end_page", "members")


def page_signals(spark, d):
    x = _filed_signals(spark, d)
    return x.select("company_id", "pdf_page", F.array_join("categories", ",").alias("categories"), F.array_join("dates", ",").alias("dates"), F.array_join("excluded", ",").alias("excluded"))


def event_windows(spark, d):
    w = c.event_windows(_filed_signals(spark, d), _filed_master(spark, d))
    return w.select("company_id", "start_page", "end_page", "score", F.array_join("categories", ",").alias("categories"), F.size("dates").alias("dates"))


def top_ranges(spark, d):
    x = _tree(spark, d).select("company_id", F.explode("types").alias("type"), F.col("pdf_page").alias("start_page"), "end_page", F.lit(1).alias("source_rank"), "score")
    t = c.top_candidates(x)
    return t.select("company_id", "type", "start_page", "end_page", "score", "rank", "is_primary", h.confidence_band(F.col("score")).alias("band"))


def _enriched(spark, d):
    return h.enriched(_tree(spark, d), _pages(spark, d))


def enriched_headings(spark, d):
    e = _enriched(spark, d)
    return e.select("company_id", "heading_no", F.array_join("types", ",").alias("types"), F.round("score", 3).alias("score"), F.col("context")["equity_history"].alias("context"))


def toc_support(spark, d):
    return h.toc_support(_headings(spark, d))


def _direct(spark, d):
    return h.direct_candidates(_enriched(spark, d), toc_support(spark, d), _counts(spark, d))


def direct_candidates(spark, d):
    return _direct(spark, d).select("company_id", "type", "start_page", "end_page", "score", "heading_no", "toc_support", "context_support")


def event_heading_clusters(spark, d):
    m = c.event_members(_enriched(spark, d)).withColumn("parent_title", F.lit(None).cast("string"))
    return c.grouped(m, 2, 0.14, "EVENT_CLUSTER").select("company_id", "parent_key", "start_page", "end_page", "score", "members")


def chapter_candidates(spark, d):
    x = _filed_candidates(spark, d)
    return x.select("company_id", "type", "source", "start_page", "end_page", "score", "title", F.array_join("supporting_headings", ",").alias("supporting"), "toc_support", "context_support")


def chosen_ranges(spark, d):
    x = h.with_printed(_filed_chosen(spark, d), _filed_numbers(spark, d))
    return x.select("company_id", "type", "source", "start_page", "end_page", "score", "rank", F.col("start_printed.number").alias("start_number"), F.col("end_printed.number").alias("end_number"), F.size("review_reasons").alias("reasons"))


def _filed_reviews(spark, d):
    return h.review_ranges(_filed_chosen(spark, d), _filed_counts(spark, d), h_rules.REQUIRED_CHAPTERS, 0.08, _filed_numbers(spark, d))


def range_reviews(spark, d):
    return _filed_reviews(spark, d)


def required_coverage(spark, d):
    return h.required_coverage(_filed_chosen(spark, d).where("is_primary"), _filed_numbers(spark, d), h_rules.REQUIRED_CHAPTERS)


def _filed_figures(spark, d):
    return c.company_figures(_filed_numbers(spark, d), _filed_headings(spark, d), _filed_chosen(spark, d), _filed_reviews(spark, d), _filed_master(spark, d))


def chapter_figures(spark, d):
    return _filed_figures(spark, d)


def chapter_batch(spark, d):
    return c.batch_figures(_filed_figures(spark, d), expected=1500)


RANGES = "select distinct lpad(cast(l_suppkey % 50 as string), 6, '0') as company_id, cast(l_suppkey % 3 as int) as range_id, cast(1 + l_suppkey % 3 * 7 as int) as start_page, cast(4 + l_suppkey % 3 * 7 as int) as end_page from {lineitem}"


def text_units(spark, d):
    return p.text_units(_lines(spark, d), view(spark, d, RANGES)).select("company_id", "range_id", "pdf_page", "line_index", "global_index")


def following_lines(spark, d):
    w = W.partitionBy("company_id").orderBy("pdf_page", "line_index")
    u = _lines(spark, d).where("pdf_page <= 40").withColumn("global_index", F.row_number().over(w))
    return p.following(u, ["company_id"], "global_index", 3).select("company_id", "global_index", F.md5("context").alias("digest"))


def section_texts(spark, d):
    s = view(spark, d, RANGES).withColumnRenamed("range_id", "section_id")
    return p.section_text(_pages(spark, d), s, 3).select("company_id", "section_id", F.md5("section_text").alias("digest"), "excerpt")


def resolved_pages(spark, d):
    r = view(spark, d, RANGES).withColumn("start_printed", F.when(F.col("range_id") == 1, F.col("start_page") - 2))
    patch = view(spark, d, RANGES).select("company_id").distinct().where("cast(company_id as int) % 4 = 0").withColumn("offset", F.lit(3))
    return p.resolve_printed(r, patch).select("company_id", "range_id", "printed_start", "printed_end")


_D = "\\d{1,4}"
CAND = f"""{LINES}, ed as (select *, unnest(list_filter([case when line_index < 8 then 'HEADER' end, case when line_index >= n - 8 then 'FOOTER' end], lambda z: z is not null)) as position from fl),
tl as (select *, regexp_replace(regexp_extract(flat, '招股说明书(.*)$', 1), '^[：:]+', '') as tail from ed),
ca as (select company_id, pdf_page, line_index, position, page_count, nullif(regexp_extract(flat, '^(\\d+(?:-\\d+)+)-({_D})$', 1), '') as prefix, nullif(regexp_extract(flat, '^(\\d+(?:-\\d+)+)-({_D})$', 2), '')::int as number, 'EXACT_PREFIXED' as pattern, 5 as priority, 1.0::double as confidence, true as strong from tl
  union all select company_id, pdf_page, line_index, position, page_count, null, nullif(regexp_extract(flat, '^第({_D})页$', 1), '')::int, 'EXACT_CHINESE', 2, 0.98, true from tl
  union all select company_id, pdf_page, line_index, position, page_count, null, nullif(regexp_extract(tail, '^({_D})(?:\\D.*)?$', 1), '')::int, 'PROSPECTUS_HEADER_BARE', 3, 0.97, true from tl where position = 'HEADER' and line_index < 4
  union all select company_id, pdf_page, line_index, position, page_count, null, nullif(regexp_extract(flat, '^({_D})$', 1), '')::int, 'EXACT_BARE', 1, 0.64, false from tl where position = 'FOOTER' and n - 1 - line_index < 3),
cd as (select *, row_number() over (partition by company_id, pdf_page order by strong desc, priority desc, confidence desc, position desc, line_index)::int as rank from ca where number > 0 and number <= page_count + 40 and not (prefix is null and number between 1900 and 2099))"""
NUMS = CAND + """, i1 as (select pg.company_id, pg.pdf_page, c.prefix, c.number, case when c.number is null then 'MISSING'
    when c.strong and exists (select 1 from cd r where r.company_id = c.company_id and r.pdf_page = c.pdf_page and r.rank > 1 and r.strong and r.pattern = c.pattern and r.number <> c.number and abs(r.confidence - c.confidence) <= 0.01) then 'CONFLICT'
    when c.strong then 'CONFIRMED' else 'CANDIDATE' end as status, coalesce(c.confidence, 0) as confidence from pg left join (select * from cd where rank = 1) c using (company_id, pdf_page)),
o1 as (select *, pdf_page - number as off, pdf_page - row_number() over (partition by company_id, status, coalesce(prefix, ''), pdf_page - number order by pdf_page) as isl from i1),
o2 as (select *, case when status = 'CANDIDATE' and count(*) over (partition by company_id, status, coalesce(prefix, ''), off, isl) >= 3 then 'CONFIRMED' else status end as state from o1),
o3 as (select *, count(*) filter (state = 'CONFIRMED') over (partition by company_id, coalesce(prefix, ''), off) as held from o2),
nb as (select company_id, pdf_page, case when s <> 'MISSING' then prefix end as prefix, case when s <> 'MISSING' then number end as number, s as status from (select *, case when state = 'CANDIDATE' and held >= 3 then 'CONFIRMED' when state = 'CANDIDATE' then 'MISSING' else state end as s from o3)),
sg0 as (select company_id, prefix, pdf_page - number as "offset", count(*) as anchors, min(pdf_page) as start_page, max(pdf_page) as end_page from nb where status = 'CONFIRMED' group by all),
sg1 as (select *, anchors / sum(anchors) over (partition by company_id, coalesce(prefix, '')) as share from sg0),
sg as (select *, row_number() over (partition by company_id order by anchors desc, start_page)::int as rank from sg1 where anchors >= 3 and share >= 0.6),
ft as (select nb.company_id, nb.pdf_page, arg_min(struct_pack(p := sg.prefix, o := sg."offset"), sg.rank) as h from nb join sg on nb.company_id = sg.company_id and nb.pdf_page between start_page and end_page and nb.pdf_page - sg."offset" > 0 where status = 'MISSING' group by all),
fn as (select nb.company_id, nb.pdf_page, case when h is not null then h.p else prefix end as prefix, case when h is not null then nb.pdf_page - h.o else number end as number, case when h is not null then 'INFERRED' else status end as status from nb left join ft using (company_id, pdf_page))"""  # fmt: skip
_STRIP = lambda c: "regexp_replace(" * 6 + c + "".join(f", '{pt}', '')" for _, pt in h.NUMBERING) + ", '^[：:]+|[：:]+$', '', 'g')"
_LEVEL = lambda c: "case " + " ".join(f"when regexp_matches({c}, '{pt}') then {k}" for k, pt in h.NUMBERING) + " end"


def _types_sql(core: str) -> str:
    out = []
    for kind, r in sorted(h_rules.CHAPTERS.items()):
        alias = " or ".join(f"(contains({core}, '{a}') and length({core}) - {len(a)} <= 8)" for a in r["aliases"])
        group = " or ".join("(" + " and ".join(f"contains({core}, '{t}')" for t in g) + ")" for g in r["groups"]) or "false"
        block = " or ".join(f"contains({core}, '{t}')" for t in r["exclude"]) or "false"
        out.append(f"case when not ({block}) and (({alias}) or ({group})) then struct_pack(k := '{kind}', a := ({alias}), g := ({group})) end")
    return f"list_filter([{', '.join(out)}], lambda z: z is not null)"


HEAD = f"""{LINES}, tc as (select company_id, pdf_page, bool_or(line_index < 20 and regexp_matches(flat, '目录|目錄')) as t1, count(*) filter (regexp_matches(line, '[\\.·…]{{2,}}') and regexp_matches(flat, '\\d{{1,4}}$')) >= 5 as t2 from fl group by all),
rp as (select company_id, line, count(*) as pages from (select distinct company_id, pdf_page, flat as line from fl where (line_index < 3 or line_index >= n - 3) and length(flat) between 2 and 70) group by all),
hn as (select fl.*, t1 or t2 as is_toc, lead(line) over (partition by company_id, pdf_page order by line_index) as nxt, {' or '.join(f"regexp_matches(flat, '{pt}$')" for _, pt in h.NUMBERING)} as bare from fl join tc using (company_id, pdf_page)),
hu as (select *, line as raw, false as merged from hn where (line_index < 18 or is_toc) and length(flat) <= 64 union all select *, line || nxt, true from hn where (line_index < 18 or is_toc) and bare and nxt is not null),
hf as (select *, regexp_replace(raw, '[\\s　]+', '', 'g') as f2 from hu),
hc as (select *, {_LEVEL('f2')} as level, {_STRIP("case when is_toc then regexp_replace(regexp_replace(regexp_replace(f2, '[\\.·…]{2,}\\d{1,4}$', ''), '\\d{1,4}$', ''), '^[：:]+|[：:]+$', '', 'g') else f2 end")} as core from hf),
ht as (select hc.*, coalesce(rp.pages, 0) as repeats, line_index < 6 as top, {_types_sql('core')} as types from hc left join rp on hc.company_id = rp.company_id and hc.flat = rp.line
  where length(core) between 3 and 64 and not regexp_matches(core, '[。；！？]') and length(core) - length(replace(core, '，', '')) < 3 and not regexp_matches(core, '^(?:注|说明)[：:]') and not regexp_matches(core, '详见|参见|请见|见本招股说明书')),
hk as (select *, len(list_filter(types, lambda z: z.a)) > 0 as al, len(list_filter(types, lambda z: z.g)) > 0 as tr from ht),
hg as (select *, case when not is_toc and repeats >= 3 and line_index <= 2 then 'PAGE_HEADER' when is_toc then 'TOC_ENTRY' when top and level is not null then 'BODY_HEADING' when top and al then 'BODY_HEADING' else 'UNKNOWN' end as heading_class from hk),
hd as (select company_id, pdf_page, line_index, merged, raw, core, level, heading_class, round(least(1.0, case when heading_class = 'BODY_HEADING' then 0.18 else 0.06 end + case when al then 0.5 when tr then 0.3 else 0 end + case when top then 0.08 else 0 end + case when level is not null then 0.08 else 0 end + case when merged then 0.02 else 0 end), 3)::double as score,
  list_transform(types, lambda z: z.k) as types, row_number() over (partition by company_id order by pdf_page, line_index, merged)::int as heading_no from hg where heading_class in ('BODY_HEADING', 'TOC_ENTRY') and (level is not null or len(types) > 0)),
bd as (select hd.*, page_count from hd join pc using (company_id) where heading_class = 'BODY_HEADING'),
tree as (select b.company_id, b.heading_no, b.core, b.page_count, b.pdf_page, b.line_index, b.level, b.types, b.score, (select max(c.heading_no) from bd c where c.company_id = b.company_id and c.heading_no < b.heading_no and b.level is not null and (c.level is null or c.level < b.level)) as parent_no,
  greatest(b.pdf_page, coalesce((select arg_min(c.pdf_page, c.heading_no) from bd c where c.company_id = b.company_id and c.heading_no > b.heading_no and (b.level is null or c.level <= b.level)) - 1, b.page_count)) as end_page from bd b),
ml as (select company_id, pdf_page, line_index, line, regexp_extract(translate(flat, '—–－﹣', '----'), '第[一二三四五六七八九十百\\d]+节.*$', 0) as tail from fl join tc using (company_id, pdf_page) where line_index < 24 and not (t1 or t2)),
ml1 as (select *, regexp_matches(tail, '发行人基本情况|公司基本情况|发行人情况') as own from ml where tail <> ''),
pt as (select company_id, pdf_page, string_agg(translate(flat, '—–－﹣', '----'), '' order by line_index) as t from fl group by all),
sp as (select o.company_id, o.pdf_page, string_agg(t, '' order by pt.pdf_page) as t from (select distinct company_id, pdf_page from ml1 where own) o join pt on pt.company_id = o.company_id and pt.pdf_page between o.pdf_page and o.pdf_page + 3 group by all),
sc as (select ml1.*, page_count, contains(t, '注册资本')::int + contains(t, '法定代表人')::int + contains(t, '成立时间')::int + contains(t, '发行人的设立')::int + contains(t, '股本')::int + contains(t, '股东')::int as support from ml1 join pc using (company_id) join sp using (company_id, pdf_page) where own),
s1 as (select *, round(least(1.0, 0.70 + least(support, 5) * 0.05 + case when support >= 2 then 0.05 else 0 end + case when pdf_page <= floor(page_count * 0.5) then 0.05 else 0 end), 3)::double as score from sc),
s2 as (select * from s1 qualify row_number() over (partition by company_id order by score desc, pdf_page, line_index) = 1),
nx as (select s2.company_id, min(ml1.pdf_page) as np from s2 join ml1 on ml1.company_id = s2.company_id and ml1.pdf_page > s2.pdf_page and not ml1.own and ml1.tail <> s2.tail group by 1),
ms as (select pc.company_id, case when s2.pdf_page is null then 'NOT_FOUND' when np is null then 'CAPPED_BY_MAX_SPAN' else 'CONFIRMED_BY_NEXT_MAJOR_SECTION' end as status, s2.pdf_page as start_page,
  case when s2.pdf_page is null then null when np is null then least(pc.page_count, s2.pdf_page + 119) else greatest(s2.pdf_page, np - 1) end as end_page, tail as title, line as evidence_line, coalesce(support, 0) as context_support, coalesce(score, 0)::double as confidence,
  case when s2.pdf_page is null then '未找到“第X节 发行人基本情况”正文大章节' when support < 2 then '大章节标题已找到，但相邻页上下文支持较弱' when np is null then '未找到下一个大章节标题，结束页按最大跨度截断' end as review_reason
  from pc left join s2 using (company_id) left join nx using (company_id))"""  # fmt: skip

_KW = ", ".join(f"('{k}', '{x}', {r['minimum']})" for k, r in h_rules.CHAPTERS.items() for x in r["context"])
_CH = ", ".join(f"('{k}', '{'|'.join(r['anchors']) or '#'}', '{'|'.join(r['exclude']) or '#'}', '{'|'.join(r['broad']) or '#'}', '{'|'.join(r['narrow']) or '#'}', {r['minimum']})" for k, r in h_rules.CHAPTERS.items())
_AL = ", ".join(f"('{a}')" for a in sorted({a for r in h_rules.CHAPTERS.values() for a in r["aliases"]}))
RICH = f"""{HEAD}, kw as (select * from (values {_KW}) as q(type, word, least)), ch as (select * from (values {_CH}) as q(type, anchor, bar, broad, narrow, least)), al as (select * from (values {_AL}) as q(alias)),
pw as (select company_id, pdf_page, word from (select company_id, pdf_page, regexp_replace(text, '[\\s　]+', '', 'g') as s from pg), (select distinct word from kw) where contains(s, word)),
cx as (select t.company_id, t.heading_no, kw.type, count(distinct kw.word) as n from tree t join pw on pw.company_id = t.company_id and pw.pdf_page between t.pdf_page and least(t.end_page, t.pdf_page + 44) join kw on kw.word = pw.word group by all),
tc0 as (select tree.*, ch.*, coalesce(cx.n, 0) as n, list_contains(types, ch.type) as had, regexp_matches(core, anchor) and not regexp_matches(core, bar) and coalesce(cx.n, 0) >= ch.least as won, regexp_matches(core, bar) as barred from tree cross join ch left join cx on cx.company_id = tree.company_id and cx.heading_no = tree.heading_no and cx.type = ch.type),
en as (select *, least(1.0, score + 0.24 * count(*) filter (won) over (partition by company_id, heading_no)) as rich from tc0),
ks as (select company_id, heading_no, heading_class, unnest(types) as type, core, core as key from hd union all select company_id, heading_no, heading_class, unnest(types), core, alias from hd, al where contains(core, alias) and length(core) - length(alias) <= 8),
tk as (select b.company_id, b.heading_no, b.type, count(distinct t.heading_no) as toc_support from ks b left join ks t on t.company_id = b.company_id and t.type = b.type and t.key = b.key and t.heading_class = 'TOC_ENTRY' where b.heading_class = 'BODY_HEADING' group by all),
dc as (select en.company_id, en.type, pdf_page as start_page, end_page, heading_no, coalesce(toc_support, 0) as toc_support, n as context_support, round(least(1.0, greatest(0.0, rich + case when toc_support > 0 then 0.06 else 0 end + case when n > 0 then 0.08 else 0 end + case when regexp_matches(core, broad) then 0.1 else 0 end - case when regexp_matches(core, narrow) then 0.18 else 0 end
  - case when end_page - pdf_page < 1 then 0.08 else 0 end - case when pdf_page > floor(page_count * 0.75) then 0.12 else 0 end)), 3)::double as score from en left join tk using (company_id, heading_no, type) where (had or won) and not barred)"""
# Candidates of five sources, from the tables of RICH. Values of their own: gaps of 15 and 10 pages, bonuses of 0.12 and 0.14, windows of 20 pages.
_CLIP = lambda x: f"select x.* replace (least(x.end_page, ms.end_page) as end_page) from {x} x join ms on ms.company_id = x.company_id and x.start_page between ms.start_page and ms.end_page"
_VALID = lambda x: f"""select * from {x} x where not coalesce(regexp_matches(title, '发行人股本情况|本次发行前后的股本结构|本次发行前后股本结构|本次发行前后的股本情况|发行前后股本结构'), false)
  and exists (select 1 from (select count(distinct kind) as k, count(distinct day) as n, bool_or(barred) as b from sg1x where sg1x.company_id = x.company_id and sg1x.pdf_page between x.start_page and least(x.end_page, x.start_page + 19)) where k >= 2 and n >= 2 and not b)"""  # noqa: E731
_HOLD = lambda x: f"select * from {x} where not coalesce(regexp_matches(title, '股本和股东变化|股东变化|股本变化|股本演变|股权演变|历史沿革|设立以来'), false)"


def _group_sql(name: str, source: str, gap: int, bonus: float, label: str) -> str:
    return f"""{name}0 as (select *, coalesce('p' || parent_no, 'l' || level, '-') as pk from {source}),
{name}1 as (select *, coalesce((start_page - lag(end_page) over (partition by company_id, type, pk order by start_page, heading_no) > {gap})::int, 1) as nw from {name}0),
{name}2 as (select *, sum(nw) over (partition by company_id, type, pk order by start_page, heading_no rows unbounded preceding) as isl from {name}1),
{name} as (select company_id, type, '{label}' as source, min(start_page) as start_page, max(end_page) as end_page, round(least(1.0::double, max(score) + {bonus}::double), 3) as score,
  coalesce(arg_min(parent_title, (start_page, heading_no)) filter (parent_title is not null), array_to_string((list(title order by start_page, heading_no))[1:3], '；')) as title, string_agg(heading_no::varchar, ',' order by start_page, heading_no) as supporting,
  sum(toc_support)::bigint as toc_support, max(context_support) as context_support from {name}2 group by company_id, type, pk, isl having count(*) >= 2)"""


FILED_RICH = RICH.replace(plain(FILING), plain(FILED))
SIGNALS = """cy as (select * from (values ('establishment', '有限公司设立|股份公司设立|公司设立|发起设立'), ('capital_increase', '增资|增加注册资本|新增注册资本'), ('equity_transfer', '股权转让|股份转让|受让股权'), ('overall_change', '整体变更|整体改制|变更为股份有限公司'), ('capital_change', '注册资本变更|股本变更|减资|资本公积转增')) as q(kind, terms)),
sg0x as (select pt.*, list_distinct(regexp_extract_all(t, '(?:19|20)\\d{2}年(?:\\d{1,2}月(?:\\d{1,2}日)?)?') || regexp_extract_all(t, '(?:19|20)\\d{2}[./-]\\d{1,2}(?:[./-]\\d{1,2})?')) as days, regexp_matches(t, '审核问询函回复|审核问询回复|补充法律意见书|法律意见书|核查意见|专项说明') as barred from pt),
sg1x as (select company_id, pdf_page, null as kind, unnest(days) as day, false as barred from sg0x union all select company_id, pdf_page, kind, null, false from sg0x join cy on regexp_matches(t, terms) union all select company_id, pdf_page, null, null, true from sg0x where barred),
sv as (select company_id, pdf_page, count(distinct kind) as kinds, count(distinct day) as days from sg1x group by all)"""
FIVE = f"""{FILED_RICH}, {SIGNALS},
dt as (select dc.*, 'HEADING_SECTION' as source, hd.raw as title, hd.level, tree.parent_no, up.raw as parent_title, dc.heading_no::varchar as supporting from dc join hd on hd.company_id = dc.company_id and hd.heading_no = dc.heading_no join tree on tree.company_id = dc.company_id and tree.heading_no = dc.heading_no
  left join hd up on up.company_id = dc.company_id and up.heading_no = tree.parent_no),
eq0 as (select * from dt where type = 'equity_history'), eq1 as ({_CLIP("eq0")}), eq as ({_VALID("eq1")}), sh0 as (select * from dt where type = 'shareholders'), sh1 as ({_CLIP("sh0")}), sh as ({_HOLD("sh1")}),
{_group_sql("qg", "eq", 15, 0.12, "SIBLING_GROUP")}, qg3 as ({_CLIP("qg")}), {_group_sql("sg3", "sh", 15, 0.12, "SIBLING_GROUP")}, sg4 as ({_CLIP("sg3")}),
em as (select en.company_id, 'equity_history' as type, en.pdf_page as start_page, en.end_page, round(least(0.78::double, 0.52::double + least(n, 6) * 0.04::double), 3) as score, en.heading_no, hd.raw as title, en.parent_no, en.level, 0 as toc_support, n as context_support, up.raw as parent_title
  from en join hd on hd.company_id = en.company_id and hd.heading_no = en.heading_no left join hd up on up.company_id = en.company_id and up.heading_no = en.parent_no
  where en.type = 'equity_history' and n >= 2 and not barred and regexp_matches(en.core, '设立|成立|增资|股权转让|股份转让|整体变更|改制|减资|资本公积转增|股本变更|注册资本变更')),
{_group_sql("ec", "em", 10, 0.14, "EVENT_CLUSTER")}, ec3 as ({_CLIP("ec")}),
w0 as (select sv.company_id, sv.pdf_page, ms.start_page as ms, ms.end_page as me from sv join ms on ms.company_id = sv.company_id and pdf_page between ms.start_page and ms.end_page where kinds > 0 and days > 0),
w1 as (select *, coalesce((pdf_page - lag(pdf_page) over (partition by company_id order by pdf_page) > 2)::int, 1) as nw from w0), w2 as (select *, sum(nw) over (partition by company_id order by pdf_page rows unbounded preceding) as isl from w1),
w3 as (select company_id, ms, me, min(pdf_page) as start_page, least(me, max(pdf_page) + 1, min(pdf_page) + 19) as end_page from w2 group by company_id, ms, me, isl),
w4 as (select w3.company_id, ms, me, start_page, end_page, count(distinct kind) as k, count(distinct day) as n, bool_or(barred) as b, string_agg(distinct kind, ',' order by kind) as categories from w3 join sg1x on sg1x.company_id = w3.company_id and sg1x.pdf_page between start_page and end_page group by all),
ew as (select company_id, start_page, end_page, categories, k, n as dates, round(least(0.61::double + 0.05::double * k + 0.012::double * least(n, 10) + greatest(0.0::double, 0.06::double - (start_page - ms)::double / greatest(me - ms + 1, 1) * 0.08::double), 0.90::double), 3) as score from w4 where k >= 2 and n >= 2 and not b),
un as (select company_id, type, 2 as rk, source, start_page, end_page, score, title, supporting, toc_support, context_support from dt where type = 'issuer_overview'
  union all select company_id, type, 2, source, start_page, end_page, score, title, supporting, toc_support, context_support from eq union all select company_id, type, 2, source, start_page, end_page, score, title, supporting, toc_support, context_support from sh
  union all select company_id, 'issuer_overview', 1, 'ISSUER_MASTER_SECTION', start_page, end_page, confidence, title, null, 0, 0 from ms where start_page is not null
  union all select company_id, type, 3, source, start_page, end_page, score, title, supporting, toc_support, context_support from ({_VALID("qg3")}) union all select company_id, type, 3, source, start_page, end_page, score, title, supporting, toc_support, context_support from ({_HOLD("sg4")})
  union all select company_id, type, 4, source, start_page, end_page, score, title, supporting, toc_support, context_support from ({_VALID("ec3")})
  union all select company_id, 'equity_history', 5, 'EVENT_WINDOW', start_page, end_page, score, '发行人基本情况内正文事件窗口', null, 0, k from ew),
o1c as (select *, row_number() over (partition by company_id, type, start_page, end_page order by rk, score desc) as o from un), tp as (select * from (select *, row_number() over (partition by company_id, type order by rk, score desc, end_page - start_page desc, start_page)::int as rank from o1c where o = 1) where rank <= 3)"""  # fmt: skip
_BOTH = NUMS.removeprefix(LINES) if NUMS.startswith(LINES) else NUMS
RICH_NUMS = FIVE + _BOTH
_REVIEWS = """nd as (select company_id, unnest(['equity_history', 'shareholders']) as type from pc), cl as (select *, lead(score) over (partition by company_id, type order by rank) as rival from tp),
rv as (select company_id, type, 'missing_required_type' as reason from nd where not exists (select 1 from tp where tp.company_id = nd.company_id and tp.type = nd.type) union all select company_id, type, 'ambiguous_margin' from cl where rank = 1 and score - rival <= 0.08
  union all select distinct tp.company_id, null, 'pagination_problem' from tp join fn on fn.company_id = tp.company_id and fn.pdf_page between start_page and end_page where rank = 1 and type in ('equity_history', 'shareholders') and status not in ('CONFIRMED', 'INFERRED'))"""
CHAPTER_FIGURES = f"""{RICH_NUMS}, {_REVIEWS},
f1 as (select company_id, count(*) as pages, count(*) filter (status = 'CONFIRMED') as confirmed, count(*) filter (status = 'INFERRED') as inferred, count(*) filter (status = 'MISSING') as missing, count(*) filter (status = 'CONFLICT') as conflicts from fn group by 1),
f2 as (select company_id, count(*) as headings, count(*) filter (heading_class = 'BODY_HEADING' and len(types) > 0) as target_headings from hd group by 1),
f3 as (select company_id, count(*) as candidates, count(*) filter (rank = 1) as primaries, count(*) filter (rank = 1 and type in ('equity_history', 'shareholders')) as required_primaries from tp group by 1),
f4 as (select company_id, count(*) as required_pages, count(*) filter (status in ('CONFIRMED', 'INFERRED')) as required_mapped from (select distinct company_id, unnest(range(start_page, end_page + 1))::int as pdf_page from tp where rank = 1 and type in ('equity_history', 'shareholders')) join fn using (company_id, pdf_page) group by 1),
f5 as (select company_id, count(*) as reviews from rv group by 1),
fg as (select company_id, pages, confirmed, inferred, missing, conflicts, coalesce(headings, 0) as headings, coalesce(target_headings, 0) as target_headings, coalesce(candidates, 0) as candidates, coalesce(primaries, 0) as primaries, coalesce(required_primaries, 0) as required_primaries,
  coalesce(required_pages, 0) as required_pages, coalesce(required_mapped, 0) as required_mapped, coalesce(reviews, 0) as reviews, (ms.start_page is not null)::int as master, round((confirmed + inferred)::double / greatest(pages, 1), 4) as coverage, case when coalesce(reviews, 0) > 0 then 'REVIEW_REQUIRED' else 'READY' end as company_status
  from f1 left join f2 using (company_id) left join f3 using (company_id) left join f4 using (company_id) left join f5 using (company_id) join ms using (company_id))"""  # fmt: skip

QUERIES = {
    "enriched_headings": enriched_headings, "toc_support": toc_support, "direct_candidates": direct_candidates, "event_heading_clusters": event_heading_clusters, "chosen_ranges": chosen_ranges, "range_reviews": range_reviews,
    "required_coverage": required_coverage, "text_units": text_units, "following_lines": following_lines, "section_texts": section_texts, "resolved_pages": resolved_pages,
    "document_readiness": document_readiness, "loaded_pages": loaded_pages, "page_lines": page_lines, "text_shapes": text_shapes, "dense_lines": dense_lines,
    "printed_pages": printed_pages, "partial_dates": partial_dates, "repeated_lines": repeated_lines, "page_number_candidates": page_number_candidates,
    "initial_numbers": initial_numbers, "confirmed_numbers": confirmed_numbers, "page_segments": page_segments, "filled_numbers": filled_numbers,
    "number_coverage": number_coverage, "toc_pages": toc_pages, "headings": headings, "heading_tree": heading_tree, "master_sections": master_sections, "issuer_sections": issuer_sections, "page_signals": page_signals, "chapter_candidates": chapter_candidates, "chapter_figures": chapter_figures, "chapter_batch": chapter_batch,
    "clipped_ranges": clipped_ranges, "sibling_clusters": sibling_clusters, "event_windows": event_windows, "top_ranges": top_ranges,
}
_SP = "[\\s\\x0b\\x0c\\x1c-\\x1f\\x85\\p{Z}]+"
SQL = {
    "enriched_headings": f"with {RICH} select company_id, heading_no, coalesce(string_agg(type, ',' order by type) filter ((had or won) and not barred), '') as types, round(any_value(rich), 3)::double as score, max(n) filter (type = 'equity_history') as context from en group by company_id, heading_no",
    "toc_support": f"with {RICH} select company_id, heading_no, type, toc_support from tk",
    "direct_candidates": f"with {RICH} select company_id, type, start_page, end_page, score, heading_no, toc_support, context_support from dc",
    "event_heading_clusters": f"""with {RICH}, ev as (select company_id, pdf_page, line_index, end_page, coalesce('p' || parent_no, 'l' || level, '-') as parent_key, round(least(0.78, 0.52 + least(n, 6) * 0.04), 3)::double as s2 from en where type = 'equity_history' and n >= 2 and not barred and regexp_matches(core, '设立|成立|增资|股权转让|股份转让|整体变更|改制|减资|资本公积转增|股本变更|注册资本变更')),
      el as (select *, coalesce((pdf_page - lag(end_page) over (partition by company_id, parent_key order by pdf_page, line_index) > 2)::int, 1) as nw from ev), ei as (select *, sum(nw) over (partition by company_id, parent_key order by pdf_page, line_index rows unbounded preceding) as isl from el)
      select company_id, parent_key, min(pdf_page) as start_page, max(end_page) as end_page, round(least(1.0::double, max(s2) + 0.14::double), 3) as score, count(*) as members from ei group by company_id, parent_key, isl having count(*) >= 2""",
    "chosen_ranges": f"with {RICH_NUMS} select tp.company_id, type, source, start_page, end_page, score, rank, a.number as start_number, b.number as end_number, (coalesce(a.status, 'MISSING') not in ('CONFIRMED', 'INFERRED'))::int + (coalesce(b.status, 'MISSING') not in ('CONFIRMED', 'INFERRED'))::int as reasons from tp left join fn a on a.company_id = tp.company_id and a.pdf_page = start_page left join fn b on b.company_id = tp.company_id and b.pdf_page = end_page",
    "range_reviews": f"""with {RICH_NUMS}, nd as (select company_id, unnest(['equity_history', 'shareholders']) as type from pc), cl as (select *, lead(score) over (partition by company_id, type order by rank) as rival from tp)
      select company_id, type, 'missing_required_type' as reason from nd where not exists (select 1 from tp where tp.company_id = nd.company_id and tp.type = nd.type) union all select company_id, type, 'ambiguous_margin' from cl where rank = 1 and score - rival <= 0.08
      union all select distinct tp.company_id, null, 'pagination_problem' from tp join fn on fn.company_id = tp.company_id and fn.pdf_page between start_page and end_page where rank = 1 and type in ('equity_history', 'shareholders') and status not in ('CONFIRMED', 'INFERRED')""",
    "required_coverage": f"with {RICH_NUMS}, rq as (select distinct company_id, unnest(range(start_page, end_page + 1))::int as pdf_page from tp where rank = 1 and type in ('equity_history', 'shareholders')) select company_id, count(*) as pages, count(*) filter (status in ('CONFIRMED', 'INFERRED')) as mapped, avg(coalesce(status in ('CONFIRMED', 'INFERRED'), false)::int)::double as rate from rq left join fn using (company_id, pdf_page) group by 1",
    "text_units": f"with {LINES}, r as ({plain(RANGES)}) select ln.company_id, range_id, pdf_page, line_index, row_number() over (partition by ln.company_id, range_id order by pdf_page, line_index) - 1 as global_index from ln join r on r.company_id = ln.company_id and pdf_page between start_page and end_page",
    "following_lines": f"with {LINES}, u as (select *, row_number() over (partition by company_id order by pdf_page, line_index) as g from ln where pdf_page <= 40), f as (select a.company_id, a.g, string_agg(b.line, chr(10) order by b.g) as t from u a left join u b on b.company_id = a.company_id and b.pdf_page = a.pdf_page and b.g between a.g + 1 and a.g + 3 group by all) select company_id, g as global_index, md5(coalesce(t, '')) as digest from f",
    "section_texts": f"with {LINES}, r as ({plain(RANGES)}), t as (select r.company_id, range_id, string_agg(text, chr(10) order by pdf_page) as t, string_agg(text, chr(10) order by pdf_page) filter (pdf_page < start_page + 2) as x from r join pg on pg.company_id = r.company_id and pdf_page between start_page and least(end_page, start_page + 2) group by all) select company_id, range_id as section_id, md5(t) as digest, x[:480] as excerpt from t",
    "resolved_pages": f"with r as ({plain(RANGES)}), o as (select *, case when company_id::int % 4 = 0 then 3 when range_id = 1 then 2 end as off from r) select company_id, range_id, start_page - off as printed_start, end_page - off as printed_end from o",
    "document_readiness": f"""with v as ({plain(PAGES)}), n as (select company_id, max(pdf_page) as pages from v group by 1),
      s as (select distinct company_id, pages, unnest(list_filter([1, 2, 3, pages // 4, pages // 2, pages * 3 // 4, pages - 2, pages - 1, pages], lambda z: z >= 1 and z <= pages)) as pdf_page from n),
      g as (select company_id, pages, count(*)::int as sampled, (count(*) filter (length(regexp_replace(coalesce(text, ''), '{_SP}', '', 'g')) >= 40))::int as with_text from s join v using (company_id, pdf_page) group by all),
      t as (select *, case when with_text = sampled then 'TEXT' when with_text = 0 then 'NO_TEXT' else 'MIXED' end as text_layer from g)
      select company_id, lpad(regexp_extract(company_id, '(\\d+)', 1), 6, '0') as code, pages, sampled, with_text, text_layer, case text_layer when 'NO_TEXT' then 'no_text_layer' when 'MIXED' then 'partial_text_layer' else '' end as warnings, case when text_layer = 'TEXT' then 'READY' else 'REVIEW_REQUIRED' end as readiness from t""",
    "loaded_pages": f"with v as ({plain(PAGES)}), t as (select *, length(regexp_replace(coalesce(text, ''), '{_SP}', '', 'g')) as c from v) select company_id, pdf_page, case when c > 0 then 'EXTRACTED' else 'EMPTY' end as text_status, c as text_char_count, sha256(coalesce(text, '')) as page_text_sha256 from t",
    "page_lines": f"with {LINES} select company_id, pdf_page, count(*)::int as line_count, string_agg(line, '|' order by line_index) filter (line_index < 12) as first_lines, string_agg(line, '|' order by line_index) filter (line_index >= n - 12) as last_lines from fl group by all",
    "text_shapes": f"with v as ({plain(PAGES)}), t as (select doc_id, text, trim(regexp_replace(coalesce(text, ''), '{_SP}', ' ', 'g')) as one, instr(text, 'the') as pos from v) select doc_id, length(regexp_replace(coalesce(text, ''), '{_SP}', '', 'g')) as chars, case when length(one) > 180 then rtrim(one[:179]) || '…' else one end as title, substring(text, greatest(1, pos - 55), pos + 3 + 55 - greatest(1, pos - 55)) as context from t",
    "dense_lines": """with t as (select o_orderkey, repeat('x', 60) as a, concat(cast(year(o_orderdate) as string), '年', cast(month(o_orderdate) as string), '月设立', repeat('y', 60)) as b, concat('2001年5月增资', case when o_orderkey % 2 = 0 then '' else '，完成' end) as c from orders)
      select o_orderkey, 0 as segment, a as part from t union all select o_orderkey, 1, b from t union all select o_orderkey, 2, c from t""",
    "printed_pages": "select l_orderkey, concat(case when l_partkey % 2 = 0 then '1-1-' else '' end, cast(l_partkey as string)) as raw, case when l_partkey % 2 = 0 then '1-1' end as prefix, l_partkey::int as number, concat(case when l_partkey % 2 = 0 then '1-1-' else '' end, cast(l_partkey as string)) as again from lineitem",
    "partial_dates": "select o_orderkey, case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y') when o_orderkey % 3 = 1 then strftime(o_orderdate, '%Y-%m') else strftime(o_orderdate, '%Y-%m-%d') end as date_key from orders",
    "repeated_lines": f"with {LINES} select company_id, line, count(*) as pages from (select distinct company_id, pdf_page, translate(flat, '—–－﹣', '----') as line from fl where line_index < 3 or line_index >= n - 3) where length(line) between 2 and 70 group by all having count(*) > 1",
    "page_number_candidates": f"with {CAND} select company_id, pdf_page, prefix, number, pattern, position, line_index, confidence, strong, rank from cd",
    "initial_numbers": f"with {NUMS} select company_id, pdf_page, prefix, number, status, confidence::double as confidence from i1",
    "confirmed_numbers": f"with {NUMS} select * from nb",
    "page_segments": f'with {NUMS} select company_id, prefix, "offset", anchors, start_page, end_page, rank from sg',
    "filled_numbers": f"with {NUMS} select * from fn",
    "number_coverage": f"with {NUMS} select company_id, count(*) as pages, count(*) filter (status in ('CONFIRMED', 'INFERRED')) as mapped, avg((status in ('CONFIRMED', 'INFERRED'))::int)::double as rate from fn group by 1",
    "toc_pages": f"with {HEAD} select company_id, pdf_page, t1 or t2 as is_toc, concat_ws(',', case when t1 then 'toc_title_keyword' end, case when t2 then 'toc_dense_dot_leaders' end) as signals from tc",
    "headings": f"with {HEAD} select company_id, pdf_page, line_index, merged, raw, core, level, heading_class, score, array_to_string(types, ',') as types, heading_no from hd",
    "heading_tree": f"with {HEAD} select company_id, heading_no, pdf_page, level, parent_no, end_page from tree",
    "master_sections": f"with {HEAD} select company_id, status, start_page, end_page, title, context_support, confidence, review_reason from ms",
    "issuer_sections": f"with {HEAD.replace(plain(FILING), plain(FILED))} select * from ms",
    "clipped_ranges": f"with {HEAD.replace(plain(FILING), plain(FILED))} select t.company_id, t.heading_no, t.pdf_page as start_page, least(t.end_page, m.end_page) as end_page from tree t join ms m on t.company_id = m.company_id and t.pdf_page between m.start_page and m.end_page",
    "sibling_clusters": f"""with {HEAD}, sk as (select *, coalesce('p' || parent_no, 'l' || level, '-') as parent_key from tree), sl as (select *, coalesce((pdf_page - lag(end_page) over (partition by company_id, parent_key order by pdf_page, line_index) > 15)::int, 1) as nw from sk),
      si as (select *, sum(nw) over (partition by company_id, parent_key order by pdf_page, line_index rows unbounded preceding) as isl from sl) select company_id, parent_key, min(pdf_page) as start_page, max(end_page) as end_page, count(*) as members from si group by company_id, parent_key, isl having count(*) >= 2""",
    "event_windows": f"with {FIVE} select company_id, start_page, end_page, score, categories, dates from ew",
    "page_signals": f"""with {FIVE} select sg0x.company_id, sg0x.pdf_page, coalesce(c, '') as categories, array_to_string(list_sort(days), ',') as dates, case when barred then '补充法律意见书,法律意见书' else '' end as excluded
      from sg0x left join (select company_id, pdf_page, string_agg(distinct kind, ',' order by kind) as c from sg1x group by all) q using (company_id, pdf_page)""",
    "chapter_candidates": f"with {FIVE} select company_id, type, source, start_page, end_page, score, title, supporting, toc_support::bigint as toc_support, context_support from un",
    "chapter_figures": f"""with {CHAPTER_FIGURES} select * from fg""",
    "chapter_batch": f"""with {CHAPTER_FIGURES}, t as (select count(*) as companies, count(*) filter (company_status = 'REVIEW_REQUIRED') as companies_to_review, sum(pages)::bigint as pages, sum(confirmed)::bigint as confirmed, sum(inferred)::bigint as inferred, sum(missing)::bigint as missing,
        sum(conflicts)::bigint as conflicts, sum(headings)::bigint as headings, sum(target_headings)::bigint as target_headings, sum(candidates)::bigint as candidates, sum(primaries)::bigint as primaries, sum(required_primaries)::bigint as required_primaries,
        sum(required_pages)::bigint as required_pages, sum(required_mapped)::bigint as required_mapped, sum(reviews)::bigint as reviews, sum(master)::bigint as master from fg)
      select case when companies <> 1500 then 'BLOCKED' when reviews > 0 then 'READY_WITH_REVIEW' else 'READY' end as batch_status, *, 0 as failures, round((confirmed + inferred)::double / greatest(pages, 1), 4) as coverage, round(required_mapped::double / greatest(required_pages, 1), 4) as required_coverage,
        round(required_primaries::double / greatest(companies * 2, 1), 4) as required_primary_rate from t""",
    "top_ranges": f"""with {HEAD}, c as (select company_id, unnest(types) as type, pdf_page as start_page, end_page, score from tree), o as (select *, row_number() over (partition by company_id, type, start_page, end_page order by score desc) as r from c),
      k as (select *, row_number() over (partition by company_id, type order by score desc, end_page - start_page desc, start_page)::int as rank from o where r = 1) select company_id, type, start_page, end_page, score, rank, rank = 1 as is_primary, case when score >= 0.85 then 'HIGH' when score >= 0.65 then 'MEDIUM' else 'LOW' end as band from k where rank <= 3""",
}
