"""Queries over text units and event sections (inventory F, G), with their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.rules import EVENT_RULES as R
from dossier.operators import sections as s
from dossier.operators import units as u

from .views import EVENTS, plain, view

# A sentence for each order, of kinds that the predicates tell apart.
UNITS = """
select lpad(cast(o_custkey % 300 as string), 6, '0') as company_id, o_orderkey as unit_id, cast(o_orderkey % 400 as int) as page, concat(
  case o_orderkey % 6 when 0 then concat(cast(year(o_orderdate) as string), '年', cast(month(o_orderdate) as string), '月，') when 1 then '一、' when 2 then '（二）' when 3 then '第三节' else '' end,
  case o_orderkey % 23 when 0 then concat('第', cast(1 + o_custkey % 3 as string), '次股权转让及增资') when 1 then '股份公司设立情况' when 2 then concat('公司进行了', case o_custkey % 4 when 0 then '两' when 1 then '十二' when 2 then '三' else '7' end, '次增资和四次股权转让') when 3 then '报告期内公司未发生重大资产重组'
    when 4 then '会计师事务所出具验资报告，共三次增资' when 5 then '股权转让详见本招股说明书第五节' when 6 then '在全国中小企业股份转让系统挂牌并公开转让' when 7 then '资本公积转增股本，增资完成工商变更' when 8 then '有限公司整体变更为股份有限公司' when 9 then concat('发行人前身测试有限公司设立情况', cast(year(o_orderdate) as string), '.', cast(month(o_orderdate) as string))
    when 10 then '一般内容' when 11 then concat('3', cast(year(o_orderdate) as string), '年', cast(month(o_orderdate) as string), '月第一次增资') when 12 then concat('整体变更设立日期', cast(year(o_orderdate) as string), '年') when 13 then '发行人报告期内的重大资产重组情况' when 14 then '评估机构对本次增资出具评估报告'
    when 15 then '股权代持已解除' when 16 then '有限公司设立情况' when 17 then '增资' when 18 then '签署股权转让协议，支付价款' when 19 then '报告期内的股本和股东变化情况，增资' when 20 then '吸收合并' when 21 then concat('第二次增资，新增注册资本', cast(o_custkey % 90 as string), '万元') else '股权转让' end) as line
from {orders}
"""
# An event for each row, as a section: types, periods, ordinals, titles and extents that every rule of the merge meets.
SECTIONS = """
select lpad(cast(user_id % 40 as string), 6, '0') as company_id, cast(event_id as int) as section_no, cast(event_id % 397 as int) as page,
  case event_id % 7 when 0 then 'ABSORPTION_MERGER' when 1 then 'SHARE_CAPITAL_CHANGE' when 2 then 'OVERALL_CHANGE' when 3 then 'JOINT_STOCK_COMPANY_ESTABLISHMENT' when 4 then 'CAPITAL_INCREASE' when 5 then 'EQUITY_TRANSFER' else 'CONTROL_CHANGE' end as type,
  case when event_id % 4 = 0 then null when event_id % 4 = 1 then concat(cast(year(ts) as string), '-', lpad(cast(month(ts) as string), 2, '0')) else concat(cast(year(ts) as string), '-', lpad(cast(month(ts) as string), 2, '0'), '-', lpad(cast(day(ts) as string), 2, '0')) end as period,
  cast(case event_id % 10 when 0 then 1 when 5 then 2 else 0 end as int) as ord,
  case event_id % 5 when 0 then '历史沿革概述' when 1 then 'ABCDEFGHIJ' when 2 then '本次zyxwvuts' when 3 then '吸收合并后1234567' else '整体变更后增资后xyz0' end as title,
  cast(event_id % 397 * 10 as int) as start, cast(event_id % 397 * 10 + case when event_id % 17 = 0 then 250 else 12 end as int) as end, event_id % 9 = 0 as provider, event_id % 8 = 0 as timeline
from {events}
"""
ROOTS = """
select company_id, cast(row_number() over (partition by company_id order by event_id) as int) as global_index, event_id, cast(event_id % 3 as int) as k from
(select lpad(cast(user_id % 97 as string), 6, '0') as company_id, event_id from {events}) q
"""


def _units(spark, d):
    w = W.partitionBy("company_id").orderBy("page", "unit_id")
    return view(spark, d, UNITS).withColumn("global_index", F.row_number().over(w) - 1)


def _annotated(spark, d):
    return s.annotated(_units(spark, d))


def unit_predicates(spark, d):
    c = F.col("line")
    return view(spark, d, UNITS).select(
        "unit_id", F.array_join(u.dates_of(c), ",").alias("dates"), u.heading_like(c).alias("heading_like"), u.generic_summary(c).alias("generic_summary"), u.background_heading(c).alias("background"),
        F.array_join(u.provider_mentions(c), ",").alias("providers"), u.provider_only(c).alias("provider_only"), u.negative_reason(c).alias("negative"), F.array_join(u.ordinals(c), ",").alias("ordinals"),
        u.timeline_row(c).alias("timeline"), u.aggregate_statement(c).alias("aggregate"), u.metadata_date(c).alias("metadata"), u.reference_only(c).alias("reference_only"), u.date_role(c).alias("date_role"),
    )


def event_types(spark, d):
    t = view(spark, d, UNITS).withColumn("t", u.typed(F.col("line")))
    return t.select("unit_id", F.array_join("t.types", ",").alias("types"), F.col("t.combined").alias("combined"))


def disclosed_counts(spark, d):
    return view(spark, d, UNITS).select("unit_id", F.explode(u.disclosed_counts(F.col("line"))).alias("type", "disclosed"))


def unit_flags(spark, d):
    return _annotated(spark, d).select("unit_id", "global_index", "level", "boundary", "wrapper", "procedural", "history")


def section_dates(spark, d):
    a = _units(spark, d).withColumn("section", F.floor(F.col("global_index") / 6)).withColumn("is_title", F.col("global_index") % 6 == 0)
    return u.section_dates(a, ["company_id", "section"]).select("company_id", "section", "date_role", "date_key")


def section_extents(spark, d):
    return s.section_extent(s.with_last(_annotated(spark, d))).select("company_id", "global_index", "level", "end_index")


def uncovered_units(spark, d):
    a = s.with_last(_annotated(spark, d))
    return s.uncovered(a, s.section_extent(a, 2)).select("company_id", "unit_id", "global_index")


def root_headings(spark, d):
    return s.root_headings(_annotated(spark, d)).select("company_id", "global_index", "type", "end_index")


def section_negatives(spark, d):
    a = s.with_last(_annotated(spark, d))
    return s.section_negatives(a, s.section_extent(a, 12)).where("negative is not null")


def heading_sections(spark, d):
    kinds = F.array(*[F.lit(x) for x in ("ABSORPTION_MERGER", "CAPITAL_INCREASE", "EQUITY_TRANSFER", "CONTROL_CHANGE")])
    r = view(spark, d, ROOTS)
    types = F.array(F.get(kinds, (F.col("event_id") % 4).cast("int")), F.get(kinds, ((F.col("event_id") + F.col("k")) % 4).cast("int")))
    r = r.select("company_id", "global_index", (F.col("global_index") + F.col("event_id") % 13).cast("int").alias("end_index"), types.alias("types"), (F.col("event_id") % 5 == 0).alias("combined"), (F.col("event_id") % 11 == 0).alias("negative"))
    return s.heading_sections(r).select("company_id", "global_index", "accepted", s.section_confidence(F.when(F.col("combined"), "2020"), F.col("end_index") - F.col("global_index") + 1).alias("confidence"))


def summary_disclosures(spark, d):
    return s.summary_disclosures(_annotated(spark, d)).select("company_id", "summary_kind", "page", "global_index", F.array_join("types", ",").alias("types"), F.md5("evidence_text").alias("digest"))


def _found(a):
    return a.select("company_id", F.explode("types").alias("type")).groupBy("company_id", "type").agg(F.count(F.lit(1)).cast("int").alias("n"))


def coverage_gaps(spark, d):
    a = _annotated(spark, d)
    x = s.summary_disclosures(a).select("company_id", F.col("global_index").alias("seq"), "summary_kind", u.disclosed_counts(F.concat_ws("\n", "line", "evidence_text")).alias("counts"), F.col("evidence_text").alias("text"))
    return s.coverage_gaps(x, _found(a.where(F.get("types", F.lit(0)) == "EQUITY_TRANSFER")))


def _coarse(spark, d):
    """Sections of two units, every third company without any."""
    a = s.with_last(_annotated(spark, d))
    e = s.section_extent(a, 2).where("cast(company_id as int) % 3 > 0 and size(types) > 0")
    return a, e.select("company_id", "global_index", "end_index", F.get("types", F.lit(0)).alias("type"), "ordinals", F.col("line").alias("title"), F.lit(None).cast("string").alias("period"))


def fallback_windows(spark, d):
    a, e = _coarse(spark, d)
    return s.fallback_windows(a.drop("last"), e).select("company_id", "global_index", "type", "suppressed_by", "source_kind", "first", "final")


def _sections(spark, d):
    label = F.when(F.col("ord") > 0, F.array(F.concat(F.lit("第"), F.col("ord").cast("string"), F.lit("次")))).otherwise(F.array().cast("array<string>"))
    return view(spark, d, SECTIONS).withColumn("ordinals", label).drop("ord")


def merge_edges(spark, d):
    return s.merge_edges(_sections(spark, d))


def _clusters(spark, d):
    x = _sections(spark, d)
    return x, s.clustered(x)


def section_clusters(spark, d):
    return _clusters(spark, d)[1]


def cluster_summary(spark, d):
    c = s.cluster_members(*_clusters(spark, d))
    return c.select("company_id", "cluster", "title", "type", s.canonical_type(F.col("types"), F.col("type"), F.col("title")).alias("canonical"), "first_page", "last_page", "period", F.array_join("labels", ",").alias("labels"), "members")


def other_entity_groups(spark, d):
    x = view(spark, d, SECTIONS).where("section_no % 4 = 1 or provider").select("company_id", "section_no", "page", (F.col("page") + F.col("section_no") % 3).cast("int").alias("last_page"), "type")
    return s.other_entity_groups(x)


def accepted_roots(spark, d):
    e = view(spark, d, EVENTS).select("company_id", F.col("event_id").cast("int").alias("seq"), "page", F.col("event_type").alias("type"), (F.col("event_id") % 2 == 0).alias("dateless"))
    return s.accepted_roots(e)


def shareholder_evidence(spark, d):
    e = view(spark, d, EVENTS).select("company_id", F.col("event_type").alias("category"), F.col("event_id").cast("int").alias("seq"), F.concat("event_type", "event_date").alias("text"))
    return s.near_copies_dropped(e)


def shareholder_runs(spark, d):
    e = view(spark, d, EVENTS).select("company_id", F.col("event_type").alias("category"), F.col("page").alias("pdf_page"), (F.col("page") * 5 + F.col("event_id") % 5).alias("global_index")).distinct()
    return s.shareholder_clusters(e).select("company_id", "category", "first", "last", "hits")


# --- SQL ---------------------------------------------------------------------------------------------------------------


def _q(x: str) -> str:
    return x.replace("(", "\\(").replace(")", "\\)")


_any = lambda ts: "|".join(_q(t) for t in ts)
_pat = lambda ps: "|".join(f"(?:{p})" for p in ps)
_LEVEL = r"case when regexp_matches(s, '^第[一二三四五六七八九十百\d]+节') then 1 when regexp_matches(s, '^[一二三四五六七八九十百]+、') then 2 when regexp_matches(s, '^[（(][一二三四五六七八九十百]+[）)]') then 3 when regexp_matches(s, '^\d+[、.]') then 4 when regexp_matches(s, '^[（(]\d+[）)]') then 5 when regexp_matches(s, '^(?:19|20)\d{2}年') then 4 else 9 end"
_UN = f"un as (select *, translate(regexp_replace(line, '\\s+', '', 'g'), '—–－﹣', '----') as s, row_number() over (partition by company_id order by page, unit_id) - 1 as g from ({plain(UNITS)}))"
_TERMS = ", ".join(f"({R.priority.index(kind)}, '{kind}', '{t}')" for kind, ts in R.terms.items() for t in ts)
_PATS = ", ".join(f"({R.priority.index(kind)}, '{kind}', '{p}')" for kind, ps in R.patterns.items() for p in ps if "(?<!" not in p)
_SUP = ", ".join(f"('{a}', '{b}')" for a, bs in R.suppressed.items() for b in bs)
_VENUE = "全国中小企业股份转让系统|全国股转系统|股份转让系统挂牌|公开转让的公告|挂牌并公开转让"
_TYPES = rf"""{_UN}, tm as (select * from (values {_TERMS}) as q(r, kind, term)), pt as (select * from (values {_PATS}) as q(r, kind, p)), sp as (select * from (values {_SUP}) as q(kind, by_kind)),
h0 as (select unit_id, s, r, kind, length(term) as n from un join tm on contains(s, term) union all select unit_id, s, r, kind, length(regexp_extract(s, p)) from un cross join pt
  union all select unit_id, s, {R.priority.index('LIMITED_COMPANY_ESTABLISHMENT')}, 'LIMITED_COMPANY_ESTABLISHMENT', length(regexp_extract(s, '(?:^|[^份]|[^股]份)((?:有限责任公司|有限公司)的?设立情况)', 1)) from un),
h1 as (select unit_id, s, r, kind, max(n) as n from h0 where n > 0 and not (kind = 'EQUITY_TRANSFER' and regexp_matches(s, '{_VENUE}')) group by all),
h2 as (select * from h1 a where not exists (select 1 from sp join h1 b on b.kind = sp.by_kind where sp.kind = a.kind and b.unit_id = a.unit_id)),
h3 as (select *, row_number() over (partition by unit_id order by n desc, r) as rk, count(*) over (partition by unit_id) > 1 and regexp_matches(s, '股权转让和增资|股权转让及增资|同时增资|并增资|{u.COMBINED}') as combined from h2),
ty as (select * from h3 where combined or rk = 1), tl as (select unit_id, string_agg(kind, ',' order by n desc, r) as types, bool_or(combined) as combined, arg_min(kind, rk) as type from ty group by 1)"""
_D1, _D2 = (f"regexp_extract_all(s, '{p}')" for p in u.DATES)
_FLAGS = rf"""length(s) <= 150 and ({_LEVEL} < 9 or regexp_matches(s, '(?:设立情况|股权转让|增资|减资|整体变更|吸收合并情况|资本公积转增股本|发行融资情况|控制权变动情况|重大资产重组情况)$')) as heading,
  regexp_matches(s, '{_any(R.generic_summary)}') as generic_summary, regexp_matches(s, '{_any(R.background)}') as background, regexp_matches(s, '{_pat(R.timeline_rows)}') as timeline, regexp_matches(s, '{_pat(R.aggregate)}') as aggregate, regexp_matches(s, '{_pat(R.metadata_dates)}') as metadata,
  regexp_matches(s, '{_pat(R.references)}') and not regexp_matches(s, '{_pat(R.details)}') as reference_only, regexp_matches(s, '{_any(R.providers)}') and not regexp_matches(s, '{_any(R.issuer_deals)}') and regexp_matches(s, '出具|审验|评估|验资|审计|复核|本次整体变更|本次增资|本次股权转让|本次股份转让|本次吸收合并') as provider_only,
  case {' '.join(f"when regexp_matches(s, '{p}') then '{p}'" for p in R.negative)} end as negative,
  regexp_matches(s, '发行人报告期内的重大资产重组情况|报告期内重大资产重组情况|发行融资情况') as wrapper,
  regexp_matches(s, '^(?:19|20)\d{{2}}年') and not regexp_matches(s, '第[一二三四五六七八九十百\d]+次') and not regexp_matches(s, '第一次股权转让|第二次股权转让|第三次股权转让|第一次增资|第二次增资|第三次增资|整体变更|股份公司设立|有限公司设立|资本公积转增股本|吸收合并')
    and regexp_matches(s, '签署|签订|召开股东会|召开董事会|审议通过|支付|缴款|到账|办理工商变更|完成工商变更|办理完毕工商变更|取得营业执照|出具|验资|审验|评估|核准|登记') as procedural"""
_COUNT = r"[一二两三四五六七八九十\d]+次(?:股权转让|股份转让|增资|资本公积转增股本)|共进行过[一二两三四五六七八九十\d]+次定向发行"
_AN = rf"""{_TYPES}, c7 as (select unit_id, string_agg(s, '') over (partition by company_id, page order by g range between current row and 7 following) as ctx from un),
f0 as (select un.*, {_LEVEL} as level, {_FLAGS} from un), an as (select f0.*, types, combined, type, regexp_matches(ctx, '{_any(R.providers)}') and regexp_matches(ctx, '{_any(R.provider_reports)}') and regexp_matches(ctx, '{_COUNT}') as history, max(g) over (partition by f0.company_id) as last,
  list_distinct(regexp_extract_all(s, '第([一二三四五六七八九十百\d]+)次', 1)) as ords, list_concat({_D1}, {_D2}) as dates from f0 join c7 using (unit_id) left join tl using (unit_id)),
bd as (select *, heading and not timeline and not metadata and not aggregate and not (type is not null and procedural) and (not regexp_matches(s, '^(?:19|20)\d{{2}}年') or (type is not null and not provider_only)) as boundary from an)"""


def _extent(cap: int, extra: str = "") -> str:
    return f"select a.*, least(greatest(a.g, coalesce((select min(b.g) from bd b where b.company_id = a.company_id and b.g > a.g and b.boundary and b.level <= a.level) - 1, last)), a.g + {cap - 1}) as e from bd a where boundary {extra}"


_CN = "case when c ~ '^\\d+$' then c::int when c in ('十') then 10 when c like '十_' then 10 + instr('一二三四五六七八九', c[2]) when c like '_十' then instr('一二三四五六七八九', c[1]) * 10 when c = '两' then 2 else instr('一二三四五六七八九', c) end"


def _counts(source: str, key: str, text: str) -> str:
    """Common table ct (key, type, disclosed) of the counts that a text discloses."""
    kinds = [("EQUITY_TRANSFER", r"([一二两三四五六七八九十\d]+)次(?:股权转让|股份转让)"), ("CAPITAL_INCREASE", r"([一二两三四五六七八九十\d]+)次(?:增资扩股|增资)"), ("SHARE_CAPITAL_CHANGE", r"([一二两三四五六七八九十\d]+)次资本公积转增股本"), ("LISTING_OR_DIRECTIONAL_FINANCING", r"共进行过([一二两三四五六七八九十\d]+)次定向发行")]
    return "cn as (" + " union all ".join(f"select {key}, '{kd}' as type, unnest(regexp_extract_all({text}, '{p}', 1)) as c from {source}" for kd, p in kinds) + f"), ct as (select {key}, type, max({_CN}) as disclosed from cn group by all)"


_SUMMARY = """ev as (select unit_id, string_agg(line, chr(10)) over (partition by company_id order by g range between current row and 4 following) as evidence from un),
sm0 as (select an.*, evidence, case when history then 'SERVICE_PROVIDER_AGGREGATE_HISTORY' when aggregate then 'AGGREGATE_EVENT_SUMMARY' when timeline then 'TIMELINE_SUMMARY_ROW' when metadata then 'METADATA_DATE_FIELD' when reference_only then 'CROSS_REFERENCE_ONLY' when provider_only then 'SERVICE_PROVIDER_PROCEDURE' when wrapper then 'CLASSIFICATION_WRAPPER' end as kind from an join ev using (unit_id) where type is not null),
sm as (select * from (select *, row_number() over (partition by company_id, kind, page, s order by g) as k from sm0 where kind is not null) where k = 1)"""
_DK = r"case when t like '%年%' then concat_ws('-', t[1:4], nullif(lpad(regexp_extract(t, '年(\d{1,2})月', 1), 2, '0'), '00'), nullif(lpad(regexp_extract(t, '月(\d{1,2})日', 1), 2, '0'), '00')) else array_to_string(list_transform(regexp_extract_all(t, '\d+'), lambda x: lpad(x, greatest(length(x), 2)::int, '0')), '-') end"
_SE = f"se as ({plain(SECTIONS)})"
_EDGE = rf"""{_SE}, pr as (select a.company_id, a.section_no as a, b.section_no as b, a.type as ka, b.type as kb, a.page - b.page as gap, a.start <= b.end and b.start <= a.end as over, a.title || b.title as tt, a.ord > 0 and b.ord > 0 and a.ord <> b.ord as apart, a.period as ap, b.period as bp,
    a.provider or b.provider as pv, a.timeline or b.timeline as tl, a.title = b.title as alike from se a join se b on a.company_id = b.company_id and (b.page < a.page or (b.page = a.page and b.section_no < a.section_no))),
eg as (select company_id, a, b from pr where case
  when ka <> kb and not ((ka in ('JOINT_STOCK_COMPANY_ESTABLISHMENT', 'OVERALL_CHANGE') and kb in ('JOINT_STOCK_COMPANY_ESTABLISHMENT', 'OVERALL_CHANGE')) or (ka = 'SHARE_CAPITAL_CHANGE' and kb in ('ABSORPTION_MERGER', 'OVERALL_CHANGE', 'CAPITAL_INCREASE')) or (kb = 'SHARE_CAPITAL_CHANGE' and ka in ('ABSORPTION_MERGER', 'OVERALL_CHANGE', 'CAPITAL_INCREASE'))) then false
  when apart then false when ka <> kb and 'ABSORPTION_MERGER' in (ka, kb) then gap <= 4 and contains(tt, '吸收合并后') when ka <> kb and 'CAPITAL_INCREASE' in (ka, kb) then gap <= 3 and contains(tt, '增资后') when ka <> kb and 'SHARE_CAPITAL_CHANGE' in (ka, kb) then gap <= 3 and contains(tt, '整体变更后') when ka <> kb then over or gap <= 3
  when ka = 'ABSORPTION_MERGER' and gap <= 20 then true when pv and gap <= 3 and contains(tt, '本次') then true when ap is not null and bp is not null then (starts_with(ap, bp) or starts_with(bp, ap) or ap[:7] = bp[:7]) and gap <= 12 when over then true when gap <= 2 and alike then true when tl and gap <= 12 then true else false end)"""


def _fit(edges: str, source: str) -> str:
    """First fit by reach: the head of a section is the earliest of the heads that its earlier neighbours lead to."""
    return f"""rc as (select company_id, section_no as n, section_no as root from {source} x where not exists (select 1 from {edges} e where e.company_id = x.company_id and e.a = x.section_no) union select e.company_id, e.a, rc.root from rc join {edges} e on e.company_id = rc.company_id and e.b = rc.n),
hd as (select rc.company_id, n, min(struct_pack(p := x.page, s := root)) as head from rc join {source} x on x.company_id = rc.company_id and x.section_no = root group by all), fc as (select company_id, n as section_no, dense_rank() over (partition by company_id order by head) as cluster from hd)"""


_COARSE = f"""ce as ({_extent(2, "and company_id::int % 3 > 0 and type is not null")}), uc as (select * from bd where not exists (select 1 from ce where ce.company_id = bd.company_id and bd.g between ce.g and ce.e)),
fw0 as (select *, case when aggregate then 'aggregate_summary' when metadata then 'metadata_date' when reference_only then 'cross_reference' when wrapper then 'classification_wrapper' when history or procedural then 'procedural_line'
  when timeline and exists (select 1 from ce where ce.company_id = uc.company_id and case ce.type when 'JOINT_STOCK_COMPANY_ESTABLISHMENT' then 'OVERALL_CHANGE' else ce.type end = case uc.type when 'JOINT_STOCK_COMPANY_ESTABLISHMENT' then 'OVERALL_CHANGE' else uc.type end and list_has_any(ce.ords, uc.ords)) then 'timeline_row' end as why from uc where type is not null and negative is null),
fw as (select *, coalesce(why, case when provider_only or (regexp_matches(s, '{_VENUE}') and type = 'EQUITY_TRANSFER') then 'excluded_context' end) as cause from fw0 where len(dates) > 0 or why is not null)"""
_BARE = r"regexp_replace(s, '^[1234567890、.（）()一二三四五六七八九十]+', '')"
_ROOT = f"""rh0 as (select a.*, type as kind, least(greatest(a.g, coalesce((select min(b.g) from bd b where b.company_id = a.company_id and b.g > a.g and (b.boundary or b.heading) and b.level <= a.level) - 1, last)), a.g + 259) as e, len(dates) = 0 and {_BARE} in (select term from tm) as dateless
  from bd a where heading and type is not null and not (generic_summary or background or timeline or metadata or aggregate or wrapper or reference_only or procedural or provider_only)),
rh as (select *, row_number() over (partition by company_id, kind order by g) as rn from rh0),
rr as (select company_id, kind, rn, page as held, g, e, true as ok from rh where rn = 1 union all select rh.company_id, rh.kind, rh.rn, case when dateless and rh.page - rr.held <= 3 then rr.held else rh.page end, rh.g, rh.e, not (dateless and rh.page - rr.held <= 3) from rr join rh on rh.company_id = rr.company_id and rh.kind = rr.kind and rh.rn = rr.rn + 1)"""
_NEST = f"""ro as (select company_id, global_index as g, global_index + event_id % 13 as e, ['ABSORPTION_MERGER', 'CAPITAL_INCREASE', 'EQUITY_TRANSFER', 'CONTROL_CHANGE'] as kinds, event_id, k, event_id % 5 = 0 as combined, event_id % 11 = 0 as negative from ({plain(ROOTS)})),
rt as (select company_id, g, e, [kinds[event_id % 4 + 1], kinds[(event_id + k) % 4 + 1]] as types, combined, negative from ro),
ns as (select company_id, 0::bigint as g, []::struct(g bigint, e bigint, types varchar[], combined boolean)[] as held, false as accepted, 0::bigint as e, false as combined from (select distinct company_id from rt) union all
  select company_id, g, case when ok and not negative then list_append(live, struct_pack(g := g, e := e, types := types, combined := combined)) else live end, ok, e, combined from (
    select *, p is null or not (p.types[1] = 'ABSORPTION_MERGER' or (p.combined and list_contains(p.types, types[1])) or types[1] = p.types[1]) as ok from (
      select rt.company_id, rt.g::bigint as g, rt.e::bigint as e, rt.types, rt.combined, rt.negative, list_filter(ns.held, lambda x: x.e >= rt.g) as live, list_filter(ns.held, lambda x: x.e >= rt.g)[1] as p from ns join rt on rt.company_id = ns.company_id and rt.g = ns.g + 1)))"""

QUERIES = {
    "unit_predicates": unit_predicates, "event_types": event_types, "disclosed_counts": disclosed_counts, "unit_flags": unit_flags, "section_dates": section_dates, "section_extents": section_extents, "uncovered_units": uncovered_units,
    "root_headings": root_headings, "section_negatives": section_negatives, "heading_sections": heading_sections, "summary_disclosures": summary_disclosures, "coverage_gaps": coverage_gaps, "fallback_windows": fallback_windows,
    "merge_edges": merge_edges, "section_clusters": section_clusters, "cluster_summary": cluster_summary, "other_entity_groups": other_entity_groups, "accepted_roots": accepted_roots, "shareholder_evidence": shareholder_evidence,
    "shareholder_runs": shareholder_runs,
}
SQL = {
    "unit_predicates": f"with {_UN} select unit_id, array_to_string(list_filter(list_concat({_D1}, {_D2}), lambda x, i: list_position(list_concat({_D1}, {_D2}), x) = i), ',') as dates, heading as heading_like, generic_summary, background, array_to_string(list_filter([{', '.join(f'case when contains(s, {chr(39)}{t}{chr(39)}) then {chr(39)}{t}{chr(39)} end' for t in R.providers)}], lambda x: x is not null), ',') as providers, provider_only, negative, "
    + r"array_to_string(list_transform(regexp_extract_all(s, '第([一二三四五六七八九十百\d]+)次', 1), lambda x: '第' || x || '次'), ',') as ordinals, timeline, aggregate, metadata, reference_only, "
    + "case when regexp_matches(s, '股东会|董事会|决议|审议') then 'resolution_date' when regexp_matches(s, '签署|签订|协议|合同') then 'agreement_date' when regexp_matches(s, '缴款|支付|到账|实缴|出资到位') then 'payment_date' when regexp_matches(s, '验资|审验') then 'verification_date' when regexp_matches(s, '工商变更|变更登记|核准|市场监督管理局|营业执照') then 'registration_date' when regexp_matches(s, '公告|发布') then 'announcement_date' when regexp_matches(s, '实施完成|完成本次|办理完毕') then 'effective_date' else 'other_date' end as date_role "
    + rf"from (select *, {_FLAGS} from un)",
    "event_types": f"with {_TYPES} select un.unit_id, coalesce(types, '') as types, coalesce(combined, false) as combined from un left join tl using (unit_id)",
    "disclosed_counts": f"with {_UN}, {_counts('un', 'unit_id', 's')} select unit_id, type, disclosed from ct",
    "unit_flags": f"with {_AN} select unit_id, g as global_index, level, boundary, wrapper, procedural, history from bd",
    "section_dates": f"with {_UN}, dt as (select company_id, g, g // 6 as section, g % 6 = 0 as title, s, unnest(list_concat({_D1}, {_D2})) as t from un), dr as (select company_id, section, title, {_DK} as date_key, case when regexp_matches(s, '股东会|董事会|决议|审议') then 'resolution_date' when regexp_matches(s, '签署|签订|协议|合同') then 'agreement_date' when regexp_matches(s, '缴款|支付|到账|实缴|出资到位') then 'payment_date' when regexp_matches(s, '验资|审验') then 'verification_date' when regexp_matches(s, '工商变更|变更登记|核准|市场监督管理局|营业执照') then 'registration_date' when regexp_matches(s, '公告|发布') then 'announcement_date' when regexp_matches(s, '实施完成|完成本次|办理完毕') then 'effective_date' else 'other_date' end as role from dt) select company_id, section, role as date_role, date_key from dr union select company_id, section, 'event_period', date_key from dr where title",
    "section_extents": f"with {_AN} select company_id, g as global_index, level, e as end_index from ({_extent(260)})",
    "uncovered_units": f"with {_AN}, x as ({_extent(2)}) select company_id, unit_id, g as global_index from bd where not exists (select 1 from x where x.company_id = bd.company_id and bd.g between x.g and x.e)",
    "root_headings": f"with recursive {_AN}, {_ROOT} select company_id, g as global_index, kind as type, e as end_index from rr where ok",
    "section_negatives": f"with {_AN}, x as ({_extent(12)}), t as (select x.company_id, x.g, x.e, string_agg(b.s, '' order by b.g) as s from x join un b on b.company_id = x.company_id and b.g between x.g and least(x.e, x.g + 9) group by all), n as (select *, case {' '.join(f'when regexp_matches(s, {chr(39)}{p}{chr(39)}) then {chr(39)}{p}{chr(39)}' for p in R.negative)} end as negative from t) select company_id, g as global_index, e as end_index, negative from n where negative is not null",
    "heading_sections": f"with recursive {_NEST} select company_id, g as global_index, accepted, round(least(0.98, 0.76 + case when combined then 0.08 else 0 end + case when e - g >= 2 then 0.06 else 0 end), 3)::double as confidence from ns where g > 0",
    "summary_disclosures": f"with {_AN}, {_SUMMARY} select company_id, kind as summary_kind, page, g as global_index, types, md5(evidence) as digest from sm",
    "coverage_gaps": f"with {_AN}, {_SUMMARY}, tx as (select company_id, g, regexp_replace(line || chr(10) || evidence, '\\s+', '', 'g') as x, evidence from sm where kind in ('AGGREGATE_EVENT_SUMMARY', 'TIMELINE_SUMMARY_ROW', 'SERVICE_PROVIDER_AGGREGATE_HISTORY')), {_counts('tx', 'company_id, g', 'x')}, "
    + "sg as (select company_id, g, string_agg(type || '=' || disclosed::varchar, ',' order by type) as sig from ct group by all), ft as (select company_id, min(g) as g from sg group by company_id, sig), fd as (select an.company_id, ty.kind as type, count(*) as n from an join ty using (unit_id) where an.type = 'EQUITY_TRANSFER' group by all) "
    + "select ct.company_id, ct.g as seq, case when regexp_matches(evidence, '参见|详见|具体见|公开转让说明书|申报文件') then 'REFERENCE_LIMITED_AGGREGATE_HISTORY' else 'AGGREGATE_MULTI_EVENT_NOT_EXPANDED' end as gap_type, ct.type, disclosed, coalesce(n, 0) as found, disclosed - coalesce(n, 0) as missing from ct join ft using (company_id, g) join tx using (company_id, g) left join fd on fd.company_id = ct.company_id and fd.type = ct.type where disclosed > coalesce(n, 0)",
    "fallback_windows": f"with {_AN}, {_COARSE} select company_id, g as global_index, type, cause as suppressed_by, case when timeline then 'TIMELINE_ONLY' else 'DATED_FALLBACK' end as source_kind, case when cause is null then greatest(0, g - 2) end as first, case when cause is null then least(last, g + 18) end as final from fw",
    "merge_edges": f"with {_EDGE} select * from eg",
    "section_clusters": f"with recursive {_EDGE}, {_fit('eg', 'se')} select company_id, section_no, cluster from fc",
    "cluster_summary": f"with recursive {_EDGE}, {_fit('eg', 'se')}, m as (select * from fc join se using (company_id, section_no)), g as (select company_id, cluster, arg_min(title, struct_pack(p := page, n := section_no)) as title, arg_min(type, struct_pack(p := page, n := section_no)) as type, count(distinct type) filter (type in ('JOINT_STOCK_COMPANY_ESTABLISHMENT', 'OVERALL_CHANGE')) as pair, min(page) as first_page, max(page) as last_page, arg_min(period, struct_pack(p := page, n := section_no)) filter (period is not null) as period, list(ord order by page, section_no) filter (ord > 0) as os, count(*) as members from m group by all) "
    + "select company_id, cluster, title, type, case when pair = 2 or (type = 'JOINT_STOCK_COMPANY_ESTABLISHMENT' and contains(title, '整体变更')) then 'OVERALL_CHANGE' else type end as canonical, first_page, last_page, period, coalesce(case when list_contains(os, 1) and list_contains(os, 2) then case when list_position(os, 1) < list_position(os, 2) then '第1次,第2次' else '第2次,第1次' end when list_contains(os, 1) then '第1次' when list_contains(os, 2) then '第2次' end, '') as labels, members from g",
    "other_entity_groups": f"with recursive {_SE}, ot as (select company_id, section_no, page, page + section_no % 3 as last_page, case type when 'JOINT_STOCK_COMPANY_ESTABLISHMENT' then 'OVERALL_CHANGE' else type end as kind from se where section_no % 4 = 1 or provider), oe as (select a.company_id, a.section_no as a, b.section_no as b from ot a join ot b on a.company_id = b.company_id and a.kind = b.kind and (b.page < a.page or (b.page = a.page and b.section_no < a.section_no)) and a.page <= b.last_page + 1 and b.page <= a.last_page + 1), {_fit('oe', 'ot')} select company_id, section_no, cluster from fc",
    "accepted_roots": f"with recursive e as (select company_id, event_id::int as seq, page, event_type as type, event_id % 2 = 0 as dateless, row_number() over (partition by company_id, event_type order by event_id) as rn from ({plain(EVENTS)})), r as (select company_id, type, seq, rn, page as held, true as ok from e where rn = 1 union all select e.company_id, e.type, e.seq, e.rn, case when dateless and e.page - r.held <= 3 then r.held else e.page end, not (dateless and e.page - r.held <= 3) from r join e on e.company_id = r.company_id and e.type = r.type and e.rn = r.rn + 1) select company_id, type, seq from r where ok",
    "shareholder_runs": f"with e as (select distinct company_id, event_type as category, page as p, page * 5 + event_id % 5 as g from ({plain(EVENTS)})), l as (select *, coalesce((p - lag(p) over w > 1 or g - lag(g) over w > 24)::int, 1) as nw from e window w as (partition by company_id, category order by g)), r as (select *, sum(nw) over (partition by company_id, category order by g rows unbounded preceding) as run from l) select company_id, category, min(g) as first, max(g) as last, count(*) as hits from r group by company_id, category, run",
}
