"""Queries over investors and investment paths (inventory K), with their SQL, whose lists are stated here again."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators import investors as k

from .views import plain, view

# A party name for each customer, of all kinds that the rules tell apart.
NAMES = """
select lpad(cast(c_custkey % 20 as string), 6, '0') as company_id, c_custkey as seq, concat(case c_custkey % 5 when 0 then '股东名称：' when 1 then '认购对象' else '' end,
  case c_custkey % 17 when 0 then '张三' when 1 then '深圳测试创业投资有限公司' when 2 then '天健会计师事务所' when 3 then '合计' when 4 then concat('第', cast(c_custkey % 7 as string), '号实业有限公司') when 5 then '上海某某基金'
    when 6 then '李四、王五和赵六' when 7 then '测试合伙企业（有限合伙）' when 8 then '12,000.00' when 9 then '深圳测试股权投资有限公司' when 10 then '某某资产管理有限公司' when 11 then '并购基金' when 12 then '某某资本有限公司'
    when 13 then '前公司股东泽升贸易、罗世兵、共青城泽升、达晨创联基金参与本次增资' when 14 then '股东为甲乙投资管理有限公司认购，丙丁实业有限公司增资入股' when 15 then '一般性文字描述不是名称' else case when c_custkey % 2 = 0 then '友升股份有限公司' else '芜湖三联锻造股份有限公司' end end) as name,
  concat('T', cast(c_custkey % 211 as string)) as transaction_id, case c_custkey % 4 when 0 then 'EQUITY_TRANSFER' when 1 then 'CAPITAL_INCREASE' when 2 then 'DIRECTIONAL_FINANCING' else 'OVERALL_CHANGE' end as transaction_type
from {customer}
"""
COMPANIES = "select distinct lpad(cast(c_custkey % 20 as string), 6, '0') as company_id, case when c_custkey % 2 = 0 then '友升股份' else '三联锻造' end as company_short_name from {customer}"
# An evidence text for each order; a candidate is one event.
TEXTS = """
select lpad(cast(o_custkey % 20 as string), 6, '0') as company_id, concat('CE-', cast(o_custkey as string)) as candidate_event_id, o_custkey as event_id, o_orderkey as evidence_id,
  case o_orderkey % 8 when 0 then '前公司股东泽升贸易、罗世兵、共青城泽升、达晨创联基金参与本次增资' when 1 then concat('原股东将股权转让给测试', cast(o_custkey % 5 as string), '投资有限公司') when 2 then '发行对象为深圳甲乙创业投资合伙企业（有限合伙），认购股份100万股'
    when 3 then '公司办理工商登记' when 4 then '芜湖三联锻造股份有限公司股东会审议通过' when 5 then '本次增资由丙丁产业投资基金认购；投资者为张三、李四' when 6 then '受让方为戊己实业有限公司。其他说明' else null end as evidence_text
from {orders}
"""
TRANSACTIONS = "select distinct lpad(cast(o_custkey % 20 as string), 6, '0') as company_id, o_custkey as event_id, concat('CE-', cast(o_custkey as string)) as candidate_event_id, concat('T', cast(o_custkey as string)) as transaction_id, case o_custkey % 3 when 0 then 'EQUITY_TRANSFER' when 1 then 'CAPITAL_INCREASE' else 'DIRECTIONAL_FINANCING' end as transaction_type from {orders}"


def _aliases(spark, d):
    return k.issuer_aliases(view(spark, d, COMPANIES))


def investor_names(spark, d):
    c, x = F.col("name"), k.classify(F.col("name"))
    return view(spark, d, NAMES).select(
        "seq", k.investor_name(c).alias("clean"), k.investor_key(c).alias("key"), k.is_noise(c).alias("noise"), k.is_fund(c).alias("fund"), k.high_quality(c).alias("high_quality"),
        x["class"].alias("class"), x["status"].alias("status"), x["confidence"].alias("confidence"), k.company_core(c).alias("core"), k.is_issuer(c, F.lit("测试创业投资有限公司")).alias("issuer"),
    )


def issuer_aliases(spark, d):
    return _aliases(spark, d)


def _candidates(spark, d):
    n = view(spark, d, NAMES)
    return n.select("company_id", F.concat_ws("-", "company_id", "transaction_id", "transaction_type").alias("transaction_id"), "transaction_type", "seq", F.explode(k.split_names(F.col("name"))).alias("name"))


def investor_split(spark, d):
    return _candidates(spark, d).select("seq", "name")


def collapsed_names(spark, d):
    return k.collapse_contained(_candidates(spark, d).select("company_id", "seq", "name").distinct(), keys=("company_id",)).select("company_id", "seq", "name")


def linked_candidates(spark, d):
    n = view(spark, d, NAMES)
    parties = n.select("company_id", F.col("transaction_id").alias("event_id"), F.col("seq").alias("party_id"), F.col("name").alias("party_name"))
    t = n.groupBy("company_id", F.col("transaction_id").alias("event_id"), "transaction_type").agg(F.collect_set("seq").alias("party_ids")).withColumn("transaction_id", F.concat_ws("-", "event_id", "transaction_type"))
    return k.linked_candidates(t, parties).distinct()


def evidence_texts(spark, d):
    t = k.evidence_texts(view(spark, d, TRANSACTIONS), view(spark, d, TEXTS).drop("company_id", "event_id"))
    return t.select("company_id", "event_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


def _evidence_candidates(spark, d):
    t = view(spark, d, TRANSACTIONS)
    texts = k.evidence_texts(t, view(spark, d, TEXTS).drop("company_id", "event_id")).join(t.drop("candidate_event_id"), ["company_id", "event_id"])
    return k.evidence_candidates(texts, _aliases(spark, d))


def evidence_candidates(spark, d):
    return _evidence_candidates(spark, d).select("company_id", "event_id", "transaction_id", "name", "source")


def discarded_candidates(spark, d):
    kept, gone = k.judged_candidates(_candidates(spark, d), _aliases(spark, d))
    return kept.select("company_id", "seq", "name", F.lit(None).cast("string").alias("reason")).unionByName(gone.select("company_id", "seq", "name", "reason"))


def _entities(spark, d):
    kept, _ = k.judged_candidates(_candidates(spark, d), _aliases(spark, d))
    return k.entities(kept.where(F.col("transaction_type").isin(k.PATH_TYPES)).withColumn("turn", F.struct("seq", "name")), "turn")


def _paths(spark, d):
    return k.paths(_entities(spark, d), _candidates(spark, d).select("transaction_id", "transaction_type").distinct())


def investor_entities(spark, d):
    return _entities(spark, d).select("company_id", "key", "class", "status", "confidence", F.array_join("transaction_ids", ",").alias("transaction_ids"))


def investment_paths(spark, d):
    return _paths(spark, d)


def missing_investors(spark, d):
    c = _candidates(spark, d)
    return k.missing_investors(c.select("transaction_id", "transaction_type").distinct(), c.where(~k.classify(F.col("name"))["status"].isin(k.EXCLUDED)))


def fund_paths(spark, d):
    return k.pevc_only(_entities(spark, d), _paths(spark, d))[2]


def path_problems(spark, d):
    """Entities and paths with faults put in: some entities left out, some methods and evidence gone, the issuer let in."""
    c = _candidates(spark, d).where(F.col("transaction_type").isin(k.PATH_TYPES)).withColumn("turn", F.struct("seq", "name"))
    ents = k.entities(c, "turn")
    p = k.paths(ents, c.select("transaction_id", "transaction_type").distinct())
    odd = F.length("transaction_id") + F.length("key")
    p = p.withColumn("entry_method", F.when(odd % 7 == 0, "LOAN").otherwise(F.col("entry_method")))
    return k.path_problems(p, ents.where(F.length("key") % 5 != 0), _aliases(spark, d), p.where(odd % 3 != 0).select("company_id", "key", "transaction_id"))


_E = r"'^[，。；、:：\[\]【】]+|[，。；、:：\[\]【】]+$'"


def _inv(c: str) -> str:
    out = f"regexp_replace(regexp_replace({c}, '\\s+', '', 'g'), {_E}, '', 'g')"
    for p in ("发行对象名称", "认购对象名称", "股东名称", "投资者名称", "发行对象", "认购对象", "受让方", "投资者", "股东"):
        out = f"regexp_replace({out}, '^{p}', '')"
    return f"regexp_replace({out}, {_E}, '', 'g')"


_STRONG = "股权投资基金|创业投资基金|私募投资基金|私募基金|产业投资基金|并购基金|投资基金|创业投资"
_MEDIUM = "股权投资|创业投资|创投|投资管理|资产管理|资本管理|投资合伙"
_LEGAL = r"合伙企业（有限合伙）|合伙企业\(有限合伙\)|有限合伙企业|股份有限公司|有限责任公司|有限公司|有限合伙|投资基金|基金"
_OPEN = "^(?:前公司股东|原公司股东|公司股东|原股东|现有股东|股东包括|股东为|投资者包括|投资者为|发行对象包括|认购对象包括)"
_PART = r"合伙企业（有限合伙）|合伙企业\(有限合伙\)|有限合伙企业|股份有限公司|有限责任公司|有限公司|有限合伙|股权投资基金|创业投资基金|私募投资基金|私募基金|产业投资基金|并购基金|投资基金|基金|创业投资|股权投资|投资管理|资产管理|资本管理"
_WORDS = "股权投资基金|创业投资基金|私募投资基金|私募基金|产业投资基金|并购基金|投资基金|基金|创业投资|股权投资|投资管理|资产管理|资本管理"
_key = lambda n: rf"regexp_replace({n}, '(?:股份有限公司|有限责任公司|有限公司|合伙企业（有限合伙）|合伙企业\(有限合伙\)|有限合伙企业|有限合伙|投资基金|基金)$', '')"
_core = lambda n: f"regexp_replace(regexp_replace({n}, '^(?:安徽|江苏|浙江|上海|北京|深圳|广州|芜湖|黄山|昆山|苏州|无锡|常州|杭州|南京|共青城)', ''), '(?:股份有限公司|有限责任公司|有限公司|股份公司|集团公司|公司|股份)$', '')"
_noise = lambda n: (
    rf"(length({n}) not between 2 and 60 or regexp_matches({n}, '序号|发行对象名称|认购对象名称|股东名称|投资者名称|数量（股|数量\(股|金额（元|金额\(元|认购数量|认购金额|新增股本|包括优先|每股价格|50元的价格|合计|比例|持股数量|名称')"
    rf" or regexp_matches({n}, '会计师事务所|律师事务所|资产评估事务所|资产评估有限公司|市场监督管理局|工商行政管理局|证券登记结算|银行') or regexp_full_match({n}, '[\d.,，.%％元股万元亿元/（）()]+') or not regexp_matches({n}, '[一-鿿A-Za-z]'))"
)
_person = lambda n: f"regexp_full_match({n}, '[一-鿿·]{{2,4}}') and not {_noise(n)}"
_fund = lambda n: f"regexp_matches({n}, '{_STRONG}|基金$')"
_high = lambda n: f"(not {_noise(n)} and (regexp_matches({n}, '(?:{_LEGAL})$') or {_person(n)} or regexp_matches({n}, '{_STRONG}|{_MEDIUM}')))"
_class = lambda n: f"case when {_noise(n)} then 0 when {_fund(n)} then 1 when regexp_matches({n}, '{_MEDIUM}') then 2 when {_person(n)} then 3 when regexp_matches({n}, '(?:{_LEGAL})$') then 4 else 5 end"
_CLASSES = """cl as (select * from (values (0, 'INVALID_TEXT_FRAGMENT', 'EXCLUDED_NOISE', 0.99::double), (1, 'PRIVATE_EQUITY_OR_VENTURE_ENTITY', 'PEVC_CANDIDATE', 0.93), (2, 'INVESTMENT_ENTITY_UNRESOLVED', 'POSSIBLE_PEVC', 0.75),
  (3, 'NATURAL_PERSON', 'NOT_PEVC', 0.9), (4, 'LEGAL_ENTITY_OR_STRATEGIC_INVESTOR', 'NOT_PEVC_OR_UNRESOLVED_STRATEGIC', 0.78), (5, 'UNRESOLVED_NAME', 'EXCLUDED_LOW_QUALITY', 0.35)) as q(c, class, status, confidence))"""
_SEP = "[、，,；;]|以及|及|和"


def _split(source: str, v: str, cols: str) -> str:
    """Common tables that end in sp (cols, name): the names in v of each row of source."""
    return rf"""p0 as (select {cols}, {v} as v, regexp_replace({v}, '{_OPEN}', '') as rest from {source}),
p1 as (select {cols}, unnest(case when regexp_matches(v, '{_OPEN}') or regexp_matches(rest, '{_SEP}') then regexp_split_to_array(rest, '{_SEP}') else [rest] end) as x from p0),
p2 as (select {cols}, regexp_replace(regexp_replace({_inv('x')}, '^(?:前公司股东|原公司股东|公司股东|原股东|股东|投资者|发行对象|认购对象)', ''), '(?:参与本次增资|参与增资|参与认购|认购本次发行|认购|增资入股|受让股权|受让股份|参与本次交易|参与交易|持有公司股权|持有公司股份).*$', '') as y from p1),
p3 as (select {cols}, y, regexp_extract(y, '([一-鿿A-Za-z0-9·（）()]{{2,60}}?(?:{_PART}))', 1) as f from p2),
sp as (select distinct * from (select {cols}, {_inv("case when f <> '' then f else y end")} as name from p3) where name <> '')"""


_ALIASES = f"al as (select distinct company_id, alias from (select company_id, unnest([{_inv('company_short_name')}, {_core(_inv('company_short_name'))}]) as alias from ({plain(COMPANIES)})) where alias <> '')"
_issuer = lambda n: f"exists (select 1 from al where al.company_id = {n.split('.')[0]}.company_id and ({n} = alias or {_core(n)} = {_core('alias')} or (length({_core('alias')}) >= 3 and contains({_core(n)}, {_core('alias')}) and length({_core(n)}) - length({_core('alias')}) <= 2)))"
_CAND = f"""nm as (select *, concat_ws('-', company_id, transaction_id, transaction_type) as tx, {_inv('name')} as clean from ({plain(NAMES)})), {_split('nm', 'clean', 'company_id, tx, transaction_type, seq')},
ca as (select company_id, tx as transaction_id, transaction_type, seq, name, {_inv('name')} as n2 from sp), {_CLASSES}, {_ALIASES}, cb as (select ca.*, {_key('n2')} as key, class, status, confidence, {_issuer('ca.n2')} as own from ca join cl on cl.c = {_class('n2')})"""
_GOOD = "status not in ('EXCLUDED_NOISE', 'EXCLUDED_LOW_QUALITY') and key <> ''"


def _ent(own: str) -> str:
    return f"""{_CAND}, en0 as (select * from cb where {_GOOD} and {own} and transaction_type <> 'OVERALL_CHANGE'),
en as (select company_id, key, arg_min(name, struct_pack(a := seq, b := name)) as name, arg_min(class, struct_pack(a := seq, b := name)) as class, arg_min(status, struct_pack(a := seq, b := name)) as status, arg_min(confidence, struct_pack(a := seq, b := name)) as confidence from en0 group by all),
pa as (select distinct e.company_id, e.key, e.class, transaction_id, case when transaction_type = 'EQUITY_TRANSFER' then 'TRANSFER_ENTRY' else 'CAPITAL_INCREASE_ENTRY' end as entry_method, least(e.confidence, case when transaction_type = 'EQUITY_TRANSFER' then 0.88 else 0.92 end)::double as confidence from en e join en0 using (company_id, key))"""


_TX = f"tx as ({plain(TRANSACTIONS)}), te as (select tx.company_id, tx.event_id, transaction_id, transaction_type, string_agg(chr(10) || coalesce(evidence_text, ''), '' order by evidence_id) as text from tx join ({plain(TEXTS)}) e using (candidate_event_id) group by all)"
_LC = lambda v: (
    f"(regexp_replace(regexp_replace({_inv(v)}, '(?s)^.*(?:发行对象名称|认购对象名称|投资者名称|股东名称|受让方为|转让给|转让予|发行对象|认购对象|新增股东|投资者|受让方)', ''), '^(?:序号|名称|对象|为|由)+', ''))"
)
_WHOLE, _PLAIN = r"([一-鿿A-Za-z0-9·]{2,60}(?:合伙企业（有限合伙）|合伙企业\(有限合伙\)|有限合伙企业))", "([一-鿿A-Za-z0-9·]{2,60}?(?:股份有限公司|有限责任公司|有限公司|有限合伙|投资基金|基金))"
_EVIDENCE = rf"""{_TX}, s0 as (select company_id, event_id, transaction_id, transaction_type, unnest(a) as raw, unnest(range(len(a))) as no from (select *, regexp_split_to_array(text, '[\n\r。；;]') as a from te)),
s1 as (select *, {_inv('raw')} as s from s0), se as (select * from s1 where s <> '' and (regexp_matches(s, case when transaction_type = 'EQUITY_TRANSFER' then '转让给|受让|股权转让|股东' else '认购|增资|发行对象|新增股东|投资者|股东' end) or regexp_matches(s, '{_STRONG}|{_MEDIUM}'))),
ls as (select * from se where regexp_matches(s, '[、，,]|^(?:前公司股东|原公司股东|公司股东|现有股东|股东包括|股东为|投资者包括|发行对象包括|认购对象包括)')), {_split('ls', 's', 'company_id, event_id, transaction_id, no')},
lg as (select company_id, event_id, transaction_id, no, 1 as src, s as raw from se union all select company_id, event_id, transaction_id, no, 2, unnest(regexp_extract_all(s, '([一-鿿A-Za-z0-9·（）()]{{2,70}}?(?:{_LEGAL}))', 1)) from se),
l2 as (select * exclude (raw), {_LC('raw')} as y from lg), l3 as (select * exclude (y), {_inv(f"case when regexp_extract(y, '{_WHOLE}', 1) <> '' then regexp_extract(y, '{_WHOLE}', 1) when regexp_extract(y, '{_PLAIN}', 1) <> '' then regexp_extract(y, '{_PLAIN}', 1) else y end")} as name from l2),
kw as (select company_id, event_id, transaction_id, no, 3 as src, unnest(regexp_extract_all(s, '([一-鿿A-Za-z0-9·]{{2,30}}?(?:{_WORDS}))', 1)) as raw from se),
k2 as (select * exclude (raw), {_inv(f"regexp_replace({_inv('raw')}, '^(?:前公司股东|原公司股东|公司股东|原股东|股东|投资者|发行对象|认购对象)', '')")} as name from kw),
fa as (select company_id, event_id, transaction_id, no, 0 as src, name from sp union all select * from l3 union all select * from k2), {_ALIASES},
fb as (select company_id, event_id, transaction_id, name, min(no * 4 + src) as first from fa where name <> '' and {_high('name')} and not {_issuer('fa.name')} group by all)
select company_id, event_id, transaction_id, name, case first % 4 when 0 then 'EVIDENCE_COMPOUND_LIST' when 1 then 'EVIDENCE_ROLE_PHRASE' when 2 then 'EVIDENCE_LEGAL_ENTITY' else 'EVIDENCE_INVESTMENT_KEYWORD' end as source from fb a
where not exists (select 1 from fb b where b.transaction_id = a.transaction_id and b.event_id = a.event_id and b.company_id = a.company_id and contains(b.name, a.name) and length(b.name) > length(a.name))"""

QUERIES = {
    "investor_names": investor_names, "issuer_aliases": issuer_aliases, "investor_split": investor_split, "collapsed_names": collapsed_names, "linked_candidates": linked_candidates,
    "evidence_texts": evidence_texts, "evidence_candidates": evidence_candidates, "discarded_candidates": discarded_candidates, "investor_entities": investor_entities, "investment_paths": investment_paths,
    "missing_investors": missing_investors, "fund_paths": fund_paths, "path_problems": path_problems,
}
SQL = {
    "investor_names": f"with nm as (select *, {_inv('name')} as clean from ({plain(NAMES)})), {_CLASSES} select seq, clean, {_key('clean')} as key, {_noise('clean')} as noise, {_fund('clean')} as fund, {_high('clean')} as high_quality, class, status, confidence, {_core('clean')} as core, clean = '测试创业投资有限公司' or {_core('clean')} = '测试创业投资' or (contains({_core('clean')}, '测试创业投资') and length({_core('clean')}) - 6 <= 2) as issuer from nm join cl on cl.c = {_class('clean')}",
    "issuer_aliases": f"with {_ALIASES} select * from al",
    "investor_split": f"with {_CAND} select seq, name from ca",
    "collapsed_names": f"with {_CAND}, q as (select distinct company_id, seq, name from ca) select * from q a where not exists (select 1 from q b where b.company_id = a.company_id and contains(b.name, a.name) and (length(b.name) > length(a.name) or (length(b.name) = length(a.name) and b.seq < a.seq)))",
    "linked_candidates": f"with nm as (select *, {_inv('name')} as clean from ({plain(NAMES)})), {_split('nm', 'clean', 'company_id, transaction_id, transaction_type')} select distinct company_id, transaction_id as event_id, transaction_id || '-' || transaction_type as transaction_id, name from sp where transaction_type <> 'OVERALL_CHANGE' and {_high(_inv('name'))}",
    "evidence_texts": f"with {_TX} select company_id, event_id, length(text) as chars, md5(text) as digest from te",
    "evidence_candidates": "with " + _EVIDENCE,
    "discarded_candidates": f"with {_CAND} select company_id, seq, name, case when own then 'ISSUER_SELF_EXCLUDED' when status like 'EXCLUDED%' then status end as reason from cb",
    "investor_entities": f"with {_ent('not own')} select e.company_id, e.key, e.class, e.status, e.confidence, array_to_string(list_sort(list(distinct transaction_id)), ',') as transaction_ids from en e join en0 using (company_id, key) group by all",
    "investment_paths": f"with {_ent('not own')} select * from pa",
    "missing_investors": f"with {_CAND} select transaction_id, transaction_type from cb where transaction_type <> 'OVERALL_CHANGE' group by all having bool_and(status like 'EXCLUDED%')",
    "fund_paths": f"with {_ent('not own')} select pa.* from pa join en using (company_id, key) where status in ('PEVC_CANDIDATE', 'POSSIBLE_PEVC')",
    "path_problems": f"""with {_ent('true')}, ek as (select * from en where length(key) % 5 <> 0), pk as (select *, length(transaction_id) + length(key) as odd from pa)
select distinct company_id, key, 'entity_is_issuer' as problem from ek where {_issuer('ek.name')} union select company_id, key, 'entity_missing' from pk where length(key) % 5 = 0 union select company_id, key, 'method_unknown' from pk where odd % 7 = 0 union select company_id, key, 'evidence_missing' from pk where odd % 3 = 0""",
}
