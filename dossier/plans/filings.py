"""Queries over extraction and validation (inventory I and J), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators import extraction as x
from dossier.operators import validation as v
from dossier.sources.stages import kept

from .views import EVENTS, EVIDENCE, plain, view

KEYS = ["company_id", "event_id"]
EV = f"ev as ({plain(EVIDENCE)}), t as (select *, regexp_replace(evidence_text, '\\s+', '', 'g') as s from ev)"


def _evidence(spark, d):
    return view(spark, d, EVIDENCE)


def _facts(spark, d, *kinds):
    """Facts of the named types, or of all: types don't meet, so the patterns of the others needn't run."""
    return x.extract_numeric(_evidence(spark, d), [r for r in x.NUMERIC if not kinds or r[0] in kinds])


def _as_double(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


_unit = lambda i: "case raw_unit " + " ".join(f"when '{u[0]}' then {'null' if u[i] is None else (u[i] if i == 3 else repr(u[i]))}" for u in x.UNITS) + " end"
FACTS_SQL = (
    "with " + EV + ", m as ("
    + " union all ".join(
        f"select company_id, event_id, evidence_id, {i} as no, '{k}' as fact_type, {c}::double as confidence, unnest(range(len(regexp_extract_all(s, '{p}', 1)))) as pos, unnest(regexp_extract_all(s, '{p}', 1)) as raw_value, unnest(regexp_extract_all(s, '{p}', 2)) as raw_unit from t"
        for i, (k, p, c) in enumerate(x.NUMERIC)
    )
    + f"), f as (select *, row_number() over (partition by company_id, event_id, fact_type, raw_value, raw_unit order by evidence_id, no, pos) as first from m), facts as (select company_id, event_id, evidence_id, no, pos, fact_type, raw_value, raw_unit, {_unit(1)} as currency, {_unit(2)} as base_unit, (try_cast(regexp_replace(raw_value, '[,，]', '', 'g') as decimal(38,6)) * {_unit(3)})::double as normalized_value, confidence from f where first = 1)"
)
VALUES_SQL = FACTS_SQL + ", vals as (select company_id, event_id, " + ", ".join(
    f"arg_min(normalized_value, struct_pack(a := evidence_id, b := no, c := pos)) filter (fact_type = '{k}' and normalized_value is not null) as {k.lower()}"
    for k in ("REGISTERED_CAPITAL_BEFORE", "CAPITAL_INCREASE_AMOUNT", "REGISTERED_CAPITAL_AFTER", "SHARE_QUANTITY", "SHARE_PRICE", "CONSIDERATION")
) + " from facts group by company_id, event_id)"
CAP_SQL = ", cap as (select *, case when registered_capital_before is null or capital_increase_amount is null or registered_capital_after is null then 'NOT_APPLICABLE' when abs(registered_capital_before + capital_increase_amount - registered_capital_after) <= 1 or (registered_capital_after <> 0 and abs(registered_capital_before + capital_increase_amount - registered_capital_after) / abs(registered_capital_after) <= 0.0001) then 'PASSED' else 'FAILED' end as status from vals)"
PRICE_SQL = ", pr as (select *, share_quantity * share_price as calc, case when share_quantity is null or share_price is null or consideration is null then 'NOT_APPLICABLE' when abs(share_quantity * share_price - consideration) <= 1 or (consideration <> 0 and abs(share_quantity * share_price - consideration) / abs(consideration) <= 0.005) then 'PASSED' else 'FAILED' end as status from vals)"
KINDS = ["REGISTERED_CAPITAL_BEFORE", "CAPITAL_INCREASE_AMOUNT", "REGISTERED_CAPITAL_AFTER", "SHARE_QUANTITY", "SHARE_PRICE", "CONSIDERATION"]


def numeric_facts(spark, d):
    return _as_double(_facts(spark, d), "normalized_value").drop("at", "review_required")


def transaction_values(spark, d):
    df = v.first_values(_facts(spark, d), KINDS)
    return _as_double(df, *[k.lower() for k in KINDS])


def _values(spark, d, kinds=KINDS):
    return x.first_numeric(_evidence(spark, d), kinds)


def flagship_capital_check(spark, d):
    return v.check_capital(_values(spark, d, KINDS[:3])).groupBy("rule_id", "status").agg(F.count(F.lit(1)).alias("n"))


def capital_check(spark, d):
    return _as_double(v.check_capital(_values(spark, d, KINDS[:3])), "calculated_value").select(*KEYS, "rule_id", "status", "calculated_value", "review_required")


def price_check(spark, d):
    return v.check_price(_values(spark, d, KINDS[3:])).select(*KEYS, "rule_id", "status", "review_required")


def ratio_check(spark, d):
    return v.check_ratio(_facts(spark, d, "EQUITY_RATIO")).groupBy(*KEYS, "rule_id", "status").agg(F.count(F.lit(1)).alias("n"))


def duplicate_facts(spark, d):
    """Raw texts kept apart ("12" and "12.0") that mean one value in one evidence."""
    both = F.when(F.col("fact_type") == "SHARE_QUANTITY", F.array("raw_value", F.concat("raw_value", F.lit(".0")))).otherwise(F.array("raw_value"))
    f = _facts(spark, d).withColumn("raw_value", F.explode(both))  # not a union with itself, which would extract all facts twice
    return v.check_duplicates(f).groupBy("company_id", "rule_id", "status").agg(F.count(F.lit(1)).alias("n"))


def rule_status(spark, d):
    r = v.check_capital(_values(spark, d)).unionByName(v.check_price(_values(spark, d)))
    return v.rule_status(r)


def validation_ids(spark, d):
    values = kept(_values(spark, d), "values")  # two rules read them
    r = v.check_capital(values).unionByName(v.check_price(values))
    return v.result_ids(r).select("validation_id", *KEYS, "rule_id", "status")


def quarantined(spark, d):
    good, bad = v.quarantine_ratios(_facts(spark, d).withColumn("normalized_value", F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("normalized_value"))))
    return good.select(F.lit("checked").alias("side"), "fact_type").union(bad.select(F.lit("quarantine"), "fact_type")).groupBy("side", "fact_type").agg(F.count(F.lit(1)).alias("n"))


def fact_evidence(spark, d):
    return v.fact_evidence(_facts(spark, d)).select(*KEYS, F.array_join(F.transform("evidence_ids", lambda i: i.cast("string")), ",").alias("evidence_ids"))


def chronology(spark, d):
    r = v.check_chronology(view(spark, d, EVENTS))
    return r.select("company_id", "rule_id", "status", F.array_join("date_order", ",").alias("date_order"))


def party_records(spark, d):
    return x.extract_parties(_evidence(spark, d)).select(*KEYS, "evidence_id", "party_role", "party_name", "identity_key", "party_type", "confidence")


MERGERS = """
select lpad(cast(o_custkey % 500 as string), 6, '0') as company_id, cast(floor(o_orderkey / 3) as bigint) as event_id, cast(o_orderkey as int) as evidence_id,
  case o_orderkey % 9 when 0 then concat('公司吸收合并昆山测试', cast(o_custkey % 9 as string), '有限公司，昆山测试依法注销。') when 1 then '公司吸收合并昆山测试有限公司，被吸收合并方为昆山测试有限公司；吸收合并前昆山测试基本情况如下。' when 2 then '吸收合并情况如下，'
    when 3 then '吸收合并的乙有限公司' when 4 then '本次吸收合并对象为丙丁有限公司注册资本100万元' when 5 then '被吸收合并方甲乙有限公司注销' when 6 then '由甲公司、乙公司共同出资设立。' when 7 then '张三将其持有的股份转让给李四；受让方为王五。' else '吸收合并程序合法，吸收合并后公司存续' end as evidence_text
from {orders}
"""


def absorbed_parties(spark, d):
    return x.extract_parties(view(spark, d, MERGERS)).select(*KEYS, "evidence_id", "party_role", "party_name", "identity_key", "party_type", "confidence")


def date_facts(spark, d):
    return x.extract_dates(_evidence(spark, d)).select(*KEYS, "evidence_id", "date_role", "date_text", "date_key")


def transaction_dates(spark, d):
    return x.transaction_date(x.extract_dates(_evidence(spark, d)))


def event_numbers(spark, d):
    e = view(spark, d, EVENTS).withColumnRenamed("event_id", "candidate_event_id").withColumnRenamed("page", "pdf_page_start")
    return x.event_ids(e).select("event_id", "company_id", "candidate_event_id", "seq")


TYPES = """select lpad(cast(o_custkey % 500 as string), 6, '0') as company_id, cast(o_orderkey as bigint) as event_id, o_orderkey % 13 as a, o_orderkey % 5 as b from {orders}"""
_NAMES = [r[0] for r in x.EVENT_TYPES]


def _typed(spark, d):
    names = F.array(*[F.lit(n) for n in _NAMES])
    return view(spark, d, TYPES).withColumn("event_types", F.array_distinct(F.array(names[F.col("a").cast("int")], names[F.col("b").cast("int")])))


def transactions(spark, d):
    return x.transactions(_typed(spark, d)).select(*KEYS, "seq", "event_type", "transaction_type", "event_group")


def facts_by_type(spark, d):
    g = x.ids_by(_facts(spark, d), "fact_type", KINDS, "raw_value", ["evidence_id", "at"])
    return g.select(*KEYS, *[F.array_join(k.lower(), ";").alias(k.lower()) for k in KINDS])


def completeness_reasons(spark, d):
    e = _evidence(spark, d)
    have = x.extract_numeric(e).groupBy(*KEYS).agg(F.collect_set("fact_type").alias("f"))
    roles = x.extract_parties(e).groupBy(*KEYS).agg(F.collect_set("party_role").alias("r"))
    t = x.transactions(_typed(spark, d)).join(have, KEYS, "left").join(roles, KEYS, "left")
    names = {n: F.array_contains("f", n) for n in ("CAPITAL_INCREASE_AMOUNT", "REGISTERED_CAPITAL_AFTER", "SHARE_QUANTITY", "REGISTERED_CAPITAL", "NET_ASSET_VALUE")}
    names |= {n: F.array_contains("r", n) for n in ("TRANSFEROR", "TRANSFEREE", "ABSORBED_ENTITY", "FOUNDER_OR_CONTRIBUTOR")}
    names = {k: F.coalesce(c, F.lit(False)) for k, c in names.items()}
    return t.select("company_id", "event_id", "transaction_type", F.array_join(x.completeness(F.col("transaction_type"), names), ";").alias("reasons"))


def orphan_facts(spark, d):
    events = view(spark, d, TYPES).where("event_id % 4 <> 0")
    return x.extract_numeric(x.orphans(_evidence(spark, d), events)).groupBy("company_id", "fact_type").agg(F.count(F.lit(1)).alias("n"))


def referential_problems(spark, d):
    """Events with types, pages and candidates derived from the orders, every fourth event left out."""
    e = _typed(spark, d)
    ev = e.where("event_id % 4 <> 0").withColumn("candidate_event_id", F.concat(F.lit("CE"), F.col("event_id").cast("string"))).withColumn("pdf_page_start", F.col("a")).withColumn("pdf_page_end", F.col("b") + 6)
    p = x.extract_parties(view(spark, d, MERGERS))
    ca = e.select("company_id", F.concat(F.lit("CE"), F.col("event_id").cast("string")).alias("candidate_event_id")).where("event_id % 8 < 7")
    return x.referential_problems(ev, x.transactions(e), _facts(spark, d), p, ca).groupBy("problem", "detail").agg(F.count(F.lit(1)).alias("n"))


def review_queue(spark, d):
    cap = v.check_capital(_values(spark, d, KINDS[:3])).where("review_required").select(*KEYS, F.col("status").alias("reason"))
    facts = _facts(spark, d, "EQUITY_RATIO").where("review_required").select(*KEYS, F.col("fact_type").alias("reason"))
    return x.review_queue(validation=cap, numeric_fact=facts).groupBy("record_type", "company_id", "review_reason").agg(F.count(F.lit(1)).alias("n"))


def link_check(spark, d):
    """Transactions of the merger texts; identity keys of two characters or less are left out of the parties."""
    p = x.extract_parties(view(spark, d, MERGERS)).select(*KEYS, "party_role", F.col("identity_key").alias("party_id"))
    role = lambda name: F.collect_set(F.when(F.col("party_role") == name, F.col("party_id")))
    kind = F.when(F.col("event_id") % 3 == 0, "EQUITY_TRANSFER").when(F.col("event_id") % 3 == 1, "ABSORPTION_MERGER").otherwise("CAPITAL_INCREASE")
    t = p.groupBy(*KEYS).agg(role("TRANSFEROR").alias("transferor_party_ids"), role("TRANSFEREE").alias("transferee_party_ids"), role("ABSORBED_ENTITY").alias("absorbed_party_ids"))
    t = t.withColumn("transaction_type", kind).withColumn("transaction_id", F.concat_ws("-", *KEYS))
    return v.check_links(t, p.where(F.length("party_id") > 2)).select("transaction_id", "rule_id", "status", F.array_join("missing_fields", ";").alias("missing_fields"), F.array_join("missing", ";").alias("missing"))


_TR = f"tt as (select company_id, event_id, list_distinct([{', '.join(repr(n) for n in _NAMES)}][a + 1:a + 1] || [{', '.join(repr(n) for n in _NAMES)}][b + 1:b + 1]) as l, [{', '.join(repr(n) for n in _NAMES)}][a + 1] as n1, [{', '.join(repr(n) for n in _NAMES)}][b + 1] as n2 from ({plain(TYPES)}))"
_MAP = "mp as (select * from (values " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in x.EVENT_TYPES) + ") as q(event_type, event_group, transaction_type))"
TRANS_SQL = f"""{_TR}, {_MAP}, ll as (select company_id, event_id, case when n1 = n2 then [n1] else [n1, n2] end as l from tt),
l1 as (select company_id, event_id, case when list_contains(l, 'OVERALL_CHANGE') then list_filter(l, lambda z: z <> 'JOINT_STOCK_COMPANY_ESTABLISHMENT') else l end as l from ll),
l2 as (select company_id, event_id, case when list_contains(l, 'EQUITY_HOLDING_PROXY_RELEASE') then list_filter(l, lambda z: z <> 'EQUITY_HOLDING_PROXY') else l end as l from l1),
tr as (select company_id, event_id, seq::int as seq, event_type, transaction_type, event_group from (select company_id, event_id, unnest(range(len(l))) as seq, unnest(l) as event_type from l2) join mp using (event_type))"""
_PN = lambda c: f"regexp_replace(regexp_replace(regexp_replace({c}, '^(?:由|与|和|及|其中|股东|公司|本公司|发行人)', ''), '(?:分别|共同|合计|持有|认购|受让|转让)$', ''), '^[，。；、:：()（）]+|[，。；、:：()（）]+$', '', 'g')"
_CUT = "case when party_role = 'ABSORBED_ENTITY' then regexp_replace(raw, '(?:注册资本|基本情况|注销|财务|资产|负债|业务|影响|程序|股东|后).*$', '') else raw end"
# The party patterns for a matcher without look-ahead: closing marks are taken along, and a merger followed by a word that names no party is put out of reach.
_N = "[一-鿿A-Za-z0-9（）()·]"
_PARTIES = [
    ("TRANSFEROR", f"({_N}{{2,35}}?)(?:将其持有的|将所持|转让其持有的)", 0.86), ("TRANSFEREE", f"(?:转让给|受让方为|转让予)({_N}{{2,35}}?)(?:，|。|；|持有|支付|受让|$)", 0.88), ("TRANSFEREE", f"({_N}{{2,35}}?)(?:受让|取得)(?:了)?[^。；]{{0,10}}?(?:公司)?(?:股权|股份)", 0.82),
    ("INVESTOR", f"({_N}{{2,35}}?)(?:认购|缴纳出资|增资入股)", 0.84), ("ABSORBED_ENTITY", f"(?:吸收合并|被吸收合并方(?:为)?|吸收合并对象为)({_N}{{2,30}}?)(?:，|。|；|注册资本|注销|被注销|后|$)", 0.92), ("FOUNDER_OR_CONTRIBUTOR", "由([一-鿿A-Za-z0-9（）()·、和及与]{2,80}?)(?:共同)?(?:出资|投资)设立", 0.90),
]
_BARRED = "regexp_replace(s, '吸收合并(前|后|的|情况|程序|影响)', '吸收#合并\\1', 'g')"


def party_sql(ev: str) -> str:
    return (
    "with " + ev + ", m as ("
    + " union all ".join(
        f"select company_id, event_id, evidence_id, {i} as no, '{k}' as party_role, {c}::double as confidence, unnest(range(len(regexp_extract_all({_BARRED if i == 4 else 's'}, '{p}', 1)))) as pos, unnest(regexp_extract_all({_BARRED if i == 4 else 's'}, '{p}', 0)) as whole, unnest(regexp_extract_all({_BARRED if i == 4 else 's'}, '{p}', 1)) as name from t"
        for i, (k, p, c) in enumerate(_PARTIES)
    )
    + "), m2 as (select * from m where not (party_role = 'TRANSFEREE' and regexp_matches(whole, '营业执照|市场监督管理局|换发|工商登记'))),"
    " m3 as (select * exclude (name), unnest(case when party_role = 'FOUNDER_OR_CONTRIBUTOR' then regexp_split_to_array(name, '[、，,；;和及与]') else [name] end) as raw, unnest(range(len(case when party_role = 'FOUNDER_OR_CONTRIBUTOR' then regexp_split_to_array(name, '[、，,；;和及与]') else [name] end))) as part from m2),"
    f" m4 as (select *, {_PN(_CUT)} as party_name from m3), m5 as (select *, regexp_replace({_PN('party_name')}, '(?:股份有限公司|有限责任公司|有限公司|有限)$', '') as identity_key, {_PN('party_name')} as n2 from m4),"
    f" m6 as (select * from m5 where length(n2) between 2 and 45 and not regexp_matches(n2, '{'|'.join(x.NOT_A_NAME)}') and regexp_matches(n2, '[一-鿿A-Za-z]')),"
    " m7 as (select *, row_number() over (partition by company_id, event_id, party_role, identity_key order by evidence_id, no, pos, part) as first from m6),"
    " parties as (select company_id, event_id, evidence_id, party_role, party_name, identity_key, case when regexp_full_match(n2, '[一-鿿]{2,4}') then 'NATURAL_PERSON' when regexp_matches(n2, '有限公司|有限合伙|合伙企业|投资基金|基金|集团|公司') then 'LEGAL_ENTITY_OR_FUND' else 'UNRESOLVED' end as party_type, confidence from m7 where first = 1)"
    )


PARTY_SQL = party_sql(EV)
MERGER_TEXTS = f"t as (select company_id, event_id, evidence_id, regexp_replace(evidence_text, '\\s+', '', 'g') as s from ({plain(MERGERS)}))"
DATE_SQL = (
    "with " + EV + ", m as ("
    + " union all ".join(f"select company_id, event_id, evidence_id, {i} as no, '{k}' as date_role, unnest(range(len(regexp_extract_all(s, '{p}', 1)))) as pos, unnest(regexp_extract_all(s, '{p}', 1)) as date_text from t" for i, (k, p) in enumerate(x.DATES))
    + "), f as (select *, row_number() over (partition by company_id, event_id, date_role, date_text order by evidence_id, no, pos) as first from m),"
    " dates as (select company_id, event_id, evidence_id, no, pos, date_role, date_text, regexp_extract(date_text, '^(\\d{4})', 1) || '-' || lpad(regexp_extract(date_text, '年(\\d+)月', 1), 2, '0') || '-' || lpad(regexp_extract(date_text, '月(\\d+)日', 1), 2, '0') as date_key from f where first = 1)"
)
_RES = ", res as (select company_id, event_id, 'NV-CAP-001' as rule_id, status from cap union all select company_id, event_id, 'NV-PRICE-001', status from pr)"

QUERIES = {
    "flagship_capital_check": flagship_capital_check, "numeric_facts": numeric_facts, "transaction_values": transaction_values, "capital_check": capital_check,
    "price_check": price_check, "ratio_check": ratio_check, "duplicate_facts": duplicate_facts, "rule_status": rule_status, "validation_ids": validation_ids,
    "quarantined": quarantined, "fact_evidence": fact_evidence, "chronology": chronology, "party_records": party_records, "absorbed_parties": absorbed_parties, "referential_problems": referential_problems, "date_facts": date_facts,
    "transaction_dates": transaction_dates, "event_numbers": event_numbers, "transactions": transactions, "facts_by_type": facts_by_type,
    "completeness_reasons": completeness_reasons, "orphan_facts": orphan_facts, "review_queue": review_queue, "link_check": link_check,
}
SQL = {
    "flagship_capital_check": VALUES_SQL + CAP_SQL + " select 'NV-CAP-001' as rule_id, status, count(*) as n from cap group by status",
    "numeric_facts": FACTS_SQL + " select * exclude (no, pos) from facts",
    "transaction_values": VALUES_SQL + " select * from vals",
    "capital_check": VALUES_SQL + CAP_SQL + " select company_id, event_id, 'NV-CAP-001' as rule_id, status, registered_capital_before + capital_increase_amount as calculated_value, status = 'FAILED' as review_required from cap",
    "price_check": VALUES_SQL + PRICE_SQL + " select company_id, event_id, 'NV-PRICE-001' as rule_id, status, status = 'FAILED' as review_required from pr",
    "ratio_check": FACTS_SQL + " select company_id, event_id, 'NV-RATIO-001' as rule_id, case when normalized_value is null then 'NOT_APPLICABLE' when normalized_value between 0 and 1 then 'PASSED' else 'FAILED' end as status, count(*) as n from facts where fact_type = 'EQUITY_RATIO' group by all",
    "duplicate_facts": FACTS_SQL + ", both_ as (select * from facts union all select * from facts where fact_type = 'SHARE_QUANTITY'), g as (select company_id, event_id, fact_type, normalized_value, evidence_id, count(*) as k from both_ where normalized_value is not null group by all having count(*) > 1) select company_id, 'NV-DUP-001' as rule_id, 'REVIEW_REQUIRED' as status, count(*) as n from g group by company_id",
    "rule_status": VALUES_SQL + CAP_SQL + PRICE_SQL + _RES + " select rule_id, status, count(*) as n from res group by cube (rule_id, status)",
    "validation_ids": VALUES_SQL + CAP_SQL + PRICE_SQL + _RES + " select 'NV-' || company_id || '-' || lpad((row_number() over (partition by company_id order by rule_id, event_id))::varchar, 5, '0') as validation_id, company_id, event_id, rule_id, status from res",
    "quarantined": FACTS_SQL + " select case when fact_type = 'EQUITY_RATIO' and event_id % 5 = 0 then 'quarantine' else 'checked' end as side, fact_type, count(*) as n from facts group by all",
    "fact_evidence": FACTS_SQL + " select company_id, event_id, string_agg(evidence_id::varchar, ',' order by evidence_id) as evidence_ids from (select distinct company_id, event_id, evidence_id from facts) group by all",
    "chronology": f"with e as ({plain(EVENTS)}), k as (select *, split_part(event_date, '-', 1)::int * 10000 + split_part(event_date, '-', 2)::int * 100 + coalesce(try_cast(split_part(event_date, '-', 3) as int), 0) as d from e), l as (select *, lag(d) over (partition by company_id order by page, event_id) > d as bad from k) select company_id, 'NV-DATE-001' as rule_id, case when bool_or(coalesce(bad, false)) then 'INFORMATIONAL' else 'PASSED' end as status, string_agg(event_date, ',' order by page, event_id) as date_order from l group by company_id",
    "party_records": PARTY_SQL + " select * from parties",
    "absorbed_parties": party_sql(MERGER_TEXTS) + " select * from parties",
    "date_facts": DATE_SQL + " select company_id, event_id, evidence_id, date_role, date_text, date_key from dates",
    "transaction_dates": DATE_SQL + ", r as (select *, list_position(['registration_date', 'effective_date', 'resolution_date', 'agreement_date', 'event_period'], date_role) as k from dates), b as (select *, row_number() over (partition by company_id, event_id order by k, evidence_id, no, pos) as first from r where k > 0) select company_id, event_id, date_key as transaction_date, date_role as date_basis from b where first = 1",
    "event_numbers": f"with e as ({plain(EVENTS)}), n as (select *, row_number() over (partition by company_id order by page, event_id)::int as seq from e) select 'EVT-' || company_id || '-' || lpad(seq::varchar, 5, '0') as event_id, company_id, event_id as candidate_event_id, seq from n",
    "transactions": "with " + TRANS_SQL + " select * from tr",
    "facts_by_type": FACTS_SQL + " select company_id, event_id, " + ", ".join(f"coalesce(string_agg(raw_value, ';' order by evidence_id, no, pos) filter (fact_type = '{k}'), '') as {k.lower()}" for k in KINDS) + " from facts group by all",
    "completeness_reasons": FACTS_SQL + ", " + PARTY_SQL.split(", m as (", 1)[1].join([" pm as (", ""]).replace("from m where", "from pm where") + ", " + TRANS_SQL
    + """, hf as (select company_id, event_id, list(distinct fact_type) as f from facts group by all), hr as (select company_id, event_id, list(distinct party_role) as r from parties group by all),
    j as (select tr.*, coalesce(f, []) as f, coalesce(r, []) as r from tr left join hf using (company_id, event_id) left join hr using (company_id, event_id))
    select company_id, event_id, transaction_type, concat_ws(';', case when transaction_type = 'EQUITY_TRANSFER' and not list_contains(r, 'TRANSFEROR') then '股权转让未抽取到转让方' end,
      case when transaction_type = 'EQUITY_TRANSFER' and not list_contains(r, 'TRANSFEREE') then '股权转让未抽取到受让方' end,
      case when transaction_type in ('CAPITAL_INCREASE', 'DIRECTIONAL_FINANCING') and not list_has_any(f, ['CAPITAL_INCREASE_AMOUNT', 'REGISTERED_CAPITAL_AFTER', 'SHARE_QUANTITY']) then '增资或发行未抽取到金额、注册资本或股份数量' end,
      case when transaction_type = 'ABSORPTION_MERGER' and not list_contains(r, 'ABSORBED_ENTITY') then '吸收合并未抽取到被吸收方' end,
      case when transaction_type = 'OVERALL_CHANGE' and not list_has_any(f, ['REGISTERED_CAPITAL', 'SHARE_QUANTITY', 'NET_ASSET_VALUE']) then '整体变更未抽取到注册资本、折股数或净资产' end,
      case when transaction_type = 'ESTABLISHMENT' and not list_contains(f, 'REGISTERED_CAPITAL') and not list_contains(r, 'FOUNDER_OR_CONTRIBUTOR') then '设立事件未抽取到注册资本或出资人' end) as reasons from j""",
    "orphan_facts": FACTS_SQL + f" select company_id, fact_type, count(*) as n from facts where (company_id, event_id) not in (select company_id, event_id from ({plain(TYPES)}) where event_id % 4 <> 0) group by all",
    "review_queue": VALUES_SQL + CAP_SQL + " select 'validation' as record_type, company_id, status as review_reason, count(*) as n from cap where status = 'FAILED' group by all union all select 'numeric_fact', company_id, fact_type, count(*) from facts where fact_type = 'EQUITY_RATIO' and normalized_value > 1 group by all",
    "referential_problems": party_sql(MERGER_TEXTS) + f", {TRANS_SQL}, fe as (select distinct company_id, event_id from parties), ev as (select company_id, event_id, a, b from ({plain(TYPES)}) where event_id % 4 <> 0), tl as (select distinct company_id, event_id from tr where transaction_type in ('EQUITY_TRANSFER', 'EQUITY_HOLDING_PROXY_RELEASE')), "
    + FACTS_SQL.removeprefix("with ").replace("ev as (", "ev0 as (").replace("from ev)", "from ev0)").replace("t as (", "t0 as (", 1).replace(" from t union", " from t0 union").replace(" from t)", " from t0)").replace(", m as (", ", fm as (").replace("from m)", "from fm)").replace(", f as (", ", ff as (").replace("from f ", "from ff ")
    + ", lt as (select company_id, event_id from ll where list_contains(l, 'OVERALL_CHANGE') and list_contains(l, 'JOINT_STOCK_COMPANY_ESTABLISHMENT')), al as (select 'fact_without_event' as problem, fact_type as detail from facts anti join ev using (company_id, event_id) union all select 'party_without_event', party_role from parties anti join ev using (company_id, event_id) union all select 'transaction_without_event', transaction_type from tr anti join ev using (company_id, event_id) "
    + "union all select 'transfer_party_without_transfer', party_role from parties anti join tl using (company_id, event_id) where party_role in ('TRANSFEROR', 'TRANSFEREE') union all select 'overall_change_and_joint_stock', null from ev join lt using (company_id, event_id) union all select 'pages_reversed', null from ev where b + 6 < a union all select 'candidate_without_event', 'CE' || event_id from tt where event_id % 4 = 0 and event_id % 8 < 7) select problem, detail, count(*) as n from al group by all",
    "link_check": party_sql(MERGER_TEXTS) + ", k as (select *, concat_ws('-', company_id, event_id) as transaction_id, case event_id % 3 when 0 then 'T' when 1 then 'A' else 'C' end as kind from parties), g as (select transaction_id, kind, count(*) filter (party_role = 'TRANSFEROR') as a, count(*) filter (party_role = 'TRANSFEREE') as b, count(*) filter (party_role = 'ABSORBED_ENTITY') as c, "
    + "coalesce(string_agg(distinct identity_key, ';' order by identity_key) filter (length(identity_key) <= 2 and party_role in (case kind when 'T' then 'TRANSFEROR' else 'ABSORBED_ENTITY' end, case kind when 'T' then 'TRANSFEREE' else 'ABSORBED_ENTITY' end)), '') as missing from k where kind <> 'C' group by all), "
    + "f as (select *, array_to_string(list_filter([case when kind = 'T' and a = 0 then 'transferor_party_ids' end, case when kind = 'T' and b = 0 then 'transferee_party_ids' end, case when kind = 'A' and c = 0 then 'absorbed_party_ids' end], lambda z: z is not null), ';') as missing_fields from g) "
    + "select transaction_id, 'NV-LINK-001' as rule_id, case when missing_fields <> '' or missing <> '' then 'REVIEW_REQUIRED' else 'PASSED' end as status, missing_fields, missing from f",
}
