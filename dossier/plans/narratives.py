"""Queries over narrative predicates and rule checks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators import narrative as n
from dossier.operators import units as u

from .sections import R, UNITS
from .views import EVENTS, plain, view

SAID = """
select lpad(cast(o_custkey % 300 as string), 6, '0') as company_id, o_orderkey as unit_id, case when o_custkey % 2 = 0 then '甲乙科技股份' else '庚辛材料' end as issuer, case o_orderkey % 14
  when 0 then concat('公司前身甲乙', cast(o_custkey % 3 as string), '有限公司于2001年成立') when 1 then concat('公司由丙丁', cast(o_custkey % 5 as string), '有限公司整体变更设立。') when 2 then concat('公司吸收合并戊己', cast(o_custkey % 4 as string), '有限公司，注销。') when 3 then concat('庚辛', cast(o_custkey % 6 as string), '有限公司成立')
  when 4 then concat(cast(year(o_orderdate) as string), '年，公司召开股东会会议') when 5 then concat(cast(year(o_orderdate) as string), '年，会计师事务所出具验资报告，共三次增资') when 6 then concat('，壬癸', cast(o_custkey % 4 as string), '股东大会审议通过') when 7 then concat(cast(year(o_orderdate) as string), '年全资子公司情况')
  when 8 then '注册资本1,000万元，由张三出资设立' when 9 then '一有限公司设立情况' when 10 then concat('被吸收合并方为戊己', cast(o_custkey % 4 as string), '有限公司。戊己', cast(o_custkey % 4 as string), '有限公司设立') when 11 then '2001年甲乙有限公司成立，办理登记' when 12 then '审议通过测试有限公司注册资本增加的' else '本公司总股本变更' end as line
from {orders}
"""
_S = f"un as (select *, regexp_replace(line, '\\s+', '', 'g') as s from ({plain(SAID)}))"


def narrative_flags(spark, d):
    c = F.col("line")
    v = view(spark, d, SAID)
    return v.select("unit_id", n.procedural(c).alias("procedural"), n.setup_row(c).alias("setup_row"), n.entity_scope(c, F.col("issuer")).alias("scope"))


def named_entities(spark, d):
    c = F.col("line")
    joined = lambda a: F.array_join(F.array_sort(a), ",")
    return view(spark, d, SAID).select("unit_id", joined(n.predecessors(c)).alias("predecessors"), joined(n.absorbed(c)).alias("absorbed"), joined(n.other_subjects(c, F.col("issuer"))).alias("subjects"))


def issuer_tokens(spark, d):
    v = view(spark, d, "select distinct c_custkey as id, concat('测', case c_custkey % 7 when 0 then '试' when 1 then '试科技' when 2 then '试新材股份' when 3 then '股份' when 4 then '量测控电子股份公司' when 5 then '' else '试生物医药' end) as name from {customer}")
    return v.select("id", F.array_join(F.array_sort(n.issuer_tokens(F.col("name"))), ",").alias("tokens"))


def best_predecessors(spark, d):
    v = view(spark, d, SAID)
    names = v.select("company_id", F.explode(F.array_union(n.predecessors(F.col("line")), n.absorbed(F.col("line")))).alias("name"))
    return n.best_predecessor(names, v.select("company_id", "issuer").distinct())


KINDS = ["LIMITED_COMPANY_ESTABLISHMENT", "OVERALL_CHANGE", "CAPITAL_INCREASE", "CAPITAL_REDUCTION", "EQUITY_TRANSFER", "SHARE_CAPITAL_CHANGE", "ABSORPTION_MERGER", "EQUITY_HOLDING_PROXY_RELEASE", "LISTING_OR_DIRECTIONAL_FINANCING", "CONTROL_CHANGE", "MAJOR_ASSET_RESTRUCTURING", "JOINT_STOCK_COMPANY_ESTABLISHMENT", "EQUITY_HOLDING_PROXY"]
ROLES = ["payment_date", "resolution_date", "registration_date", "effective_date", "other_date", "agreement_date", "announcement_date", "verification_date", "event_period"]


def primary_dates(spark, d):
    e = view(spark, d, EVENTS)
    pick = lambda xs, i: F.get(F.array(*[F.lit(x) for x in xs]), i.cast("int"))
    n_ = F.col("company_id").cast("int")
    dates = e.select("company_id", pick(KINDS, n_ % 13).alias("kind"), pick(ROLES, (F.col("event_id") + n_ % 7) % 9).alias("date_role"), F.col("event_date").alias("date_key"), F.col("event_id").alias("seq"), ((n_ % 5 == 0) & (F.col("event_id") % 37 == 0)).alias("title"))
    dates = dates.where((n_ % 3 != 0) | (F.col("seq") % 4 == n_ % 4))
    return n.primary_date(dates, ["company_id", "kind"])


def range_signals(spark, d):
    g = view(spark, d, UNITS).groupBy("company_id", F.floor(F.col("page") / 40).alias("range_no")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_id", "line"))), lambda x: x["line"]), "\n").alias("text"))
    dates, kinds = n.range_signals(F.col("text"))
    return g.select("company_id", "range_no", F.size(dates).alias("dates"), F.array_join(kinds, ",").alias("categories"), n.valid_range(F.col("text"), F.when(F.col("range_no") % 3 == 0, "发行人股本情况").otherwise("历史沿革")).alias("valid"))


CANDIDATES = "select lpad(cast(o_custkey % 500 as string), 6, '0') as company_id, cast(o_orderkey - o_orderkey % 97 % 2 as bigint) as candidate_id, cast(o_orderkey % 400 as int) as page, cast(o_orderkey % 400 + o_custkey % 5 - 1 as int) as last_page, o_orderpriority as type, concat(cast(o_orderkey as string), '-', cast(o_custkey % 6 as string)) as primary_evidence from {orders}"
CANDIDATE_EVIDENCE = "select lpad(cast(l_suppkey % 500 as string), 6, '0') as company_id, cast(l_orderkey as bigint) as candidate_id, concat(cast(l_orderkey as string), '-', cast(l_linenumber - l_linenumber % 7 % 6 as string)) as evidence_id, cast(l_orderkey % 400 as int) as page, cast(l_orderkey % 400 + l_partkey % 3 as int) as last_page, case when l_linenumber = 7 then ' ' else l_returnflag end as text from {lineitem}"
SPANS = "select distinct lpad(cast(o_custkey % 500 as string), 6, '0') as company_id, cast(50 as int) as start_page, cast(350 as int) as end_page from {orders}"
DENIALS = "select distinct lpad(cast(o_custkey % 500 as string), 6, '0') as company_id, o_orderpriority as type, cast(o_orderkey % 400 - 2 as int) as page, cast(o_orderkey % 400 + 3 as int) as last_page from {orders} where o_orderkey % 7 = 3"


def candidate_problems(spark, d):
    v = lambda sql: view(spark, d, sql)
    x = n.candidate_problems(v(CANDIDATES), v(CANDIDATE_EVIDENCE), v(SPANS), v(DENIALS), v(CANDIDATE_EVIDENCE), v(SPANS).withColumn("end_page", F.lit(200)))
    return x.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


PATCH = "select o_orderkey as patch_id, case when o_orderkey % 11 = 0 then null else lpad(cast(o_custkey % 500 as string), 6, '0') end as company_id, o_orderpriority as chapter_type, cast(o_orderkey % 40 as int) as start_page, cast(o_custkey % 60 as int) as end_page from {orders}"


def patch_problems(spark, d):
    return n.patch_problems(view(spark, d, PATCH))


_ALT = lambda ts: "|".join(ts)
_CL = lambda c: f"regexp_replace(regexp_replace(regexp_replace({c}, '^(?:19|20)\\d{{2}}年', ''), '^(?:截至本招股说明书签署日|截至报告期末|本次吸收合并后|本次分配后|本次增资后|本次转让后|经审议通过|吸收合并后|审议通过|公司前身|发行人前身|本公司前身|转让后|变更后|完成后|同意|前身)+', ''), '(?:的|之)+$', '')"
_N = "[一-鿿A-Za-z0-9（）()]"
_PULL = lambda ps: "list_distinct(list_filter(list_transform(list_concat(" + ", list_concat(".join(f"regexp_extract_all(s, '{p}', 1)" for p in ps[:-1]) + f", regexp_extract_all(s, '{ps[-1]}', 1)" + ")" * (len(ps) - 1) + f", lambda x: {_CL('x')}), lambda x: x <> ''))"
_PRE = _PULL([f"(?:公司|发行人|本公司)(?:系|是)?由({_N}{{2,30}}?)(?:整体变更|变更设立)", f"({_N}{{2,30}}?)(?:系发行人前身|为发行人前身|作为发行人前身)", f"发行人前身({_N}{{2,30}}?)(?:于|成立|设立|整体变更)", f"公司前身({_N}{{2,30}}?)(?:于|成立|设立|整体变更)"])
_GONE = _PULL([f"(?:发行人|公司|本公司)(?:拟)?吸收合并({_N}{{2,30}}?)(?:，|。|；|后|并|的|情况)", f"{_N}{{2,30}}?(?:有限责任公司|有限公司|有限|股份公司)?吸收合并({_N}{{2,30}}?)(?:，|。|；|注册资本|后|并|的|情况)", f"吸收合并对象为({_N}{{2,30}}?)(?:，|。|；)", f"被吸收合并方(?:为)?({_N}{{2,30}}?)(?:，|。|；)"])
_SUB = _PULL([f"(?:^|[，。；])({_N}{{2,24}}?)(?:(?:19|20)\\d{{2}}年)?年度股东大会", f"(?:^|[，。；])({_N}{{2,24}}?)(?:股东大会|董事会)(?:审议|通过|决议)", f"(?:^|[，。；])({_N}{{2,24}}?)总股本(?:变更|增加|减少)", f"(?:^|[，。；])({_N}{{2,24}}?)注册资本(?:变更|增加|减少)", f"(?:^|[，。；、])({_N}{{2,30}}?(?:有限责任公司|有限公司|有限))(?:的)?(?:成立|设立情况|设立)"])
# the two issuers' tokens, worked out by hand
_TOK = "case issuer when '甲乙科技股份' then ['甲乙科技股份', '甲乙科技', '甲乙'] else ['庚辛材料', '庚辛'] end"
_MEET = lambda x, l: f"len(list_filter({l}, lambda y: y = {x} or contains(y, {x}) or contains({x}, y))) > 0"
_LEGAL_FORMS = "('公司', '发行人', '本公司', '股份公司', '有限公司', '有限责任公司', '股份有限公司')"
_NE = f"""{_S}, ne as (select *, {_PRE} as pre, {_GONE} as gone, {_SUB} as sub, {_TOK} as tok from un), su as (select *, unnest(sub) as x from ne),
ok as (select * from su where x not in {_LEGAL_FORMS} and regexp_replace(x, '^[（(]?[一二三四五六七八九十百\\d]+[）)、.]?', '') not in {_LEGAL_FORMS} and not contains(issuer, x) and not contains(x, issuer)
  and ({_MEET('x', 'gone')} or not ({_MEET('x', 'pre')} or (regexp_matches(x, '有限(?:责任)?(?:公司)?$') and len(list_filter(tok, lambda t: contains(x, t))) > 0) or regexp_matches(x, '会计师事务所|资产评估有限公司|资产评估事务所|律师事务所|审计机构|评估机构|验资机构')))),
so as (select unit_id, string_agg(x, ',' order by x) as subjects from ok group by 1)"""
QUERIES = {
    "narrative_flags": narrative_flags, "named_entities": named_entities, "issuer_tokens": issuer_tokens, "best_predecessors": best_predecessors,
    "primary_dates": primary_dates, "range_signals": range_signals, "candidate_problems": candidate_problems, "patch_problems": patch_problems,
}
SQL = {
    "narrative_flags": f"with {_NE} select un.unit_id, regexp_matches(s, '^(?:19|20)\\d{{2}}年') and not regexp_matches(s, '第[一二三四五六七八九十百\\d]+次') and not regexp_matches(s, '第一次股权转让|第二次股权转让|第三次股权转让|第一次增资|第二次增资|第三次增资|整体变更|股份公司设立|有限公司设立|资本公积转增股本|吸收合并') and regexp_matches(s, '签署|签订|召开股东会|召开董事会|审议通过|支付|缴款|到账|办理工商变更|完成工商变更|办理完毕工商变更|取得营业执照|出具|验资|审验|评估|核准|登记') as procedural, regexp_matches(s, '注册资本[^，。；]{{0,40}}?(?:，|,)?由[^，。；]{{1,30}}?出资设立|由[^，。；]{{1,30}}?共同出资设立|由[^，。；]{{1,30}}?投资设立') as setup_row, case when regexp_matches(s, '子公司|孙公司|下属公司') or subjects is not null then 'SUBSIDIARY_OR_OTHER_ENTITY_RISK' else 'ISSUER_OR_UNRESOLVED' end as scope from un left join so using (unit_id)",
    "named_entities": f"with {_NE} select unit_id, array_to_string(list_sort(pre), ',') as predecessors, array_to_string(list_sort(gone), ',') as absorbed, coalesce(subjects, '') as subjects from ne left join so using (unit_id)",
    "issuer_tokens": "select c_custkey as id, case c_custkey % 7 when 0 then '测试' when 1 then '测试,测试科技' when 2 then '测试,测试新材,测试新材股份' when 3 then '测,测股份' when 4 then '测量,测量测控,测量测控电子,测量测控电子股份,测量测控电子股份公司' when 5 then '测' else '测试,测试生物,测试生物医药' end as tokens from customer",
    "best_predecessors": f"with {_NE}, nm as (select company_id, issuer, tok, unnest(list_concat(pre, gone)) as name from ne), st as (select *, regexp_replace(name, '(?:有限责任公司|有限公司|有限)$', '') as stem from nm), sc as (select *, (not list_contains(tok, stem))::int as a, coalesce(list_min(list_transform(list_filter(tok, lambda t: contains(stem, t)), lambda t: length(stem) - length(t))), length(stem)) as b from st), rk as (select *, row_number() over (partition by company_id order by a, b, length(name), name) as k from sc) select company_id, name as predecessor from rk where k = 1",
    "primary_dates": f"""with e as ({plain(EVENTS)}), pf as (select * from (values ('LIMITED_COMPANY_ESTABLISHMENT', ['registration_date', 'event_period', 'resolution_date', 'agreement_date', 'verification_date', 'other_date']),
        ('JOINT_STOCK_COMPANY_ESTABLISHMENT', ['registration_date', 'effective_date', 'event_period', 'resolution_date', 'verification_date', 'other_date']), ('OVERALL_CHANGE', ['registration_date', 'effective_date', 'event_period', 'resolution_date', 'verification_date', 'other_date']),
        ('CAPITAL_INCREASE', ['event_period', 'resolution_date', 'agreement_date', 'registration_date', 'payment_date', 'verification_date', 'other_date']), ('CAPITAL_REDUCTION', ['event_period', 'resolution_date', 'registration_date', 'other_date']),
        ('EQUITY_TRANSFER', ['event_period', 'agreement_date', 'resolution_date', 'registration_date', 'payment_date', 'other_date']), ('SHARE_CAPITAL_CHANGE', ['event_period', 'resolution_date', 'effective_date', 'registration_date', 'other_date']),
        ('ABSORPTION_MERGER', ['event_period', 'resolution_date', 'registration_date', 'effective_date', 'agreement_date', 'other_date']), ('EQUITY_HOLDING_PROXY_RELEASE', ['event_period', 'effective_date', 'resolution_date', 'other_date']),
        ('LISTING_OR_DIRECTIONAL_FINANCING', ['event_period', 'resolution_date', 'announcement_date', 'registration_date', 'verification_date', 'other_date']), ('CONTROL_CHANGE', ['event_period', 'effective_date', 'resolution_date', 'other_date']),
        ('MAJOR_ASSET_RESTRUCTURING', ['event_period', 'resolution_date', 'registration_date', 'other_date']),
        ('EQUITY_HOLDING_PROXY', ['event_period', 'resolution_date', 'agreement_date', 'registration_date', 'effective_date', 'verification_date', 'payment_date', 'announcement_date', 'other_date'])) as q(kind, roles)),
      x as (select company_id, [{', '.join(f"'{k}'" for k in KINDS)}][company_id::int % 13 + 1] as kind, [{', '.join(f"'{k}'" for k in ROLES)}][(event_id + company_id::int % 7) % 9 + 1] as role, event_date, event_id, company_id::int % 5 = 0 and event_id % 37 = 0 as title
        from e where company_id::int % 3 <> 0 or event_id % 4 = company_id::int % 4),
      r as (select x.*, case when title then 0 else list_position(roles, role) end as k from x join pf using (kind)),
      o as (select *, row_number() over (partition by company_id, kind order by k, case when k > 0 and kind in ('LIMITED_COMPANY_ESTABLISHMENT', 'JOINT_STOCK_COMPANY_ESTABLISHMENT', 'OVERALL_CHANGE') then event_date else '' end, event_id) as f from r where title or k > 0)
      select company_id, kind, event_date as primary_date, case when k = 0 then 'event_period' else role end as role, case when k = 0 then 'TITLE_DATE' else 'ROLE_PRIORITY:' || role end as basis from o where f = 1""",
    "range_signals": f"""with u0 as ({plain(UNITS)}), g as (select company_id, floor(page / 40)::bigint as range_no, regexp_replace(string_agg(line, chr(10) order by unit_id), '\\s+', '', 'g') as s from u0 group by all),
      x as (select *, len(list_distinct(list_concat(regexp_extract_all(s, '{u.DATES[0]}'), regexp_extract_all(s, '{u.DATES[1]}')))) as dates,
        list_filter([case when regexp_matches(s, '注册资本变更|股本变更|减资|资本公积转增') then 'capital_change' end, case when regexp_matches(s, '增资|增加注册资本|新增注册资本') then 'capital_increase' end, case when regexp_matches(s, '股权转让|股份转让|受让股权') then 'equity_transfer' end,
          case when regexp_matches(s, '有限公司设立|股份公司设立|公司设立|发起设立') then 'establishment' end, case when regexp_matches(s, '整体变更|整体改制|变更为股份有限公司') then 'overall_change' end], lambda z: z is not null) as c from g)
      select company_id, range_no, dates, array_to_string(c, ',') as categories, dates >= 2 and len(c) >= 2 and range_no % 3 <> 0 and not regexp_matches(s, '审核问询函回复|审核问询回复|补充法律意见书|法律意见书|核查意见|专项说明') as valid from x""",
    "candidate_problems": f"""with c as ({plain(CANDIDATES)}), ev as ({plain(CANDIDATE_EVIDENCE)}), sp as ({plain(SPANS)}), ng as ({plain(DENIALS)}),
      p as (select 'duplicate_id' as problem from c group by candidate_id having count(*) > 1 union all select 'duplicate_evidence_id' from ev group by evidence_id having count(*) > 1
        union all select 'outside_ranges' from c where not exists (select 1 from sp where sp.company_id = c.company_id and page >= 50 and last_page >= page and last_page <= 350) union all select 'evidence_outside_ranges' from ev where not exists (select 1 from sp where sp.company_id = ev.company_id and page >= 50 and last_page <= 350)
        union all select 'no_primary_evidence' from c where primary_evidence not in (select evidence_id from ev) union all select 'empty_evidence' from ev where text = ' '
        union all select 'overlaps_negative' from c where exists (select 1 from ng where ng.company_id = c.company_id and ng.type = c.type) and exists (select 1 from ng where ng.company_id = c.company_id and c.page between ng.page and ng.last_page)
        union all select 'holder_outside_ranges' from ev where not exists (select 1 from sp where sp.company_id = ev.company_id and page >= 50 and last_page <= 200)) select problem, count(*) as n from p group by 1""",
    "patch_problems": f"with p as ({plain(PATCH)}) select patch_id, 'missing_field' as problem from p where company_id is null union all select patch_id, 'start_not_positive' from p where start_page <= 0 union all select patch_id, 'end_before_start' from p where end_page < start_page union all select min(patch_id), 'duplicate_chapter' from p group by company_id, chapter_type having count(*) > 1",
}
