"""Queries over the review ledger and assembly (inventory H, L), with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators import extraction as x
from dossier.operators import investors as k

from .filings import FACTS_SQL, TRANS_SQL, _facts, _typed
from .views import plain, view

LABELS = "select l.doc_id, l.quality, l.toxic, d.source as company_id, d.text, d.n_chars from {labels} l join {documents} d on l.doc_id = d.doc_id"


def survivors(spark, d):
    kept, gone = k.survivorship(view(spark, d, LABELS).select("doc_id", "company_id", "quality", "n_chars"), ["company_id", "quality"], [F.desc("n_chars")], "doc_id")
    return kept.select("doc_id", "company_id", "quality", F.lit(None).cast("long").alias("replaced_by")).unionByName(gone.select("doc_id", "company_id", "quality", "replaced_by"))


RANKED = """
select event_id, case event_id % 4 when 0 then concat(cast(year(ts) as string), '年', cast(month(ts) as string), '月') else '' end as event_period, case when event_id % 4 = 1 then concat('-', cast(year(ts) as string), '-') end as event_date_text, event_type as title, case when event_id % 5 = 0 then 'PAGE_TIMELINE_RECOVERY' else 'HEADING_SECTION' end as source_kind,
  case event_id % 3 when 0 then 'LIMITED_COMPANY_ESTABLISHMENT' else 'CAPITAL_INCREASE' end as event_type_candidate, year(ts) as y, month(ts) as m
from {events}
"""


def ranking_inputs(spark, d):
    r = view(spark, d, RANKED).withColumn("event_date_candidates", F.when(F.col("event_id") % 4 == 2, F.array(F.lit("2001-02")))).withColumn("signals", F.when(F.col("event_id") % 7 == 0, F.array(F.lit("page_timeline_recovery"), F.lit("x"))))
    return k.ranking_inputs(r).select("event_id", "rank_period", "rank_title", F.array_join("rank_signals", ",").alias("signals"), "is_recovery", "is_limited_establishment")


def patch_records(spark, d):
    rows = view(spark, d, LABELS).select("doc_id", "quality", "toxic", "company_id").where("company_id is not null and quality is not null and toxic is not null")
    return k.patch_record(rows, "REMOVE").select("doc_id", "action", "before_value")


def kept_evidence(spark, d):
    kept = view(spark, d, "select o_orderkey as l_orderkey from {orders} where o_orderstatus <> 'O'")
    e = view(spark, d, "select l_orderkey, l_linenumber, l_partkey from {lineitem}")
    return k.kept_evidence(e, kept, "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_partkey").alias("parts"))


def candidate_evidence(spark, d):
    c = view(spark, d, "select cast(o_orderkey as bigint) as candidate_event_id, o_orderstatus from {orders}")
    e = view(spark, d, "select cast(l_orderkey as bigint) as candidate_event_id, l_linenumber as evidence_id, 'x' as company_id from {lineitem} where l_linenumber <> 2")
    return x.with_evidence(c, e).select("candidate_event_id", "o_orderstatus", "evidence_id")


def review_rows(spark, d):
    a = view(spark, d, "select source as company_id, cast(null as string) as review_status, doc_id from {documents}")
    b = view(spark, d, "select source as company_id, case when doc_id % 3 = 0 then 'CLOSED' when doc_id % 3 = 1 then 'OPEN' end as review_status from {documents}")
    return k.normalized_reviews(structured=a.drop("review_status"), numeric=b).groupBy("stage", "company_id", "review_status").agg(F.count(F.lit(1)).alias("n"))


def packages(spark, d):
    c = view(spark, d, "select distinct source as company_id from {documents}")
    docs = view(spark, d, "select source as company_id, doc_id, n_chars from {documents}")
    labels = view(spark, d, LABELS).where("quality = 1").select("company_id", "doc_id")
    p = k.packages(c, docs=docs, labels=labels)
    return p.select("company_id", F.size("docs").alias("docs"), F.get("docs", F.lit(0))["doc_id"].alias("first_doc"), F.coalesce(F.size("labels"), F.lit(0)).alias("labels"), F.array_join(F.transform("labels", lambda r: r["doc_id"].cast("string")), ",").alias("label_ids"))


def combined_tables(spark, d):
    docs = view(spark, d, "select source, doc_id from {documents}").groupBy("source").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return k.combined_tables({"docs": ["source", "ids", "note"]}, docs=docs)["docs"]


def ledger_decisions(spark, d):
    reviews = view(spark, d, LABELS).select("doc_id", "company_id")
    decisions = view(spark, d, "select doc_id, case when quality = 1 then 'ACCEPT' when toxic = 1 then 'REJECT' else 'REVISE' end as decision from {labels} where doc_id % 3 <> 0")
    done, lost = k.apply_decisions(reviews, decisions, "doc_id")
    return done.select("doc_id", "review_status").unionByName(lost.select("doc_id", F.lit("UNMATCHED").alias("review_status")))


def expected_counts(spark, d):
    e = view(spark, d, "select source as company_id, count(*) as expected from {documents} group by source")
    return k.expected_counts(view(spark, d, LABELS).select("company_id"), e)


def gold_cross_check(spark, d):
    auto = view(spark, d, "select doc_id, case when n_chars > 2000 then 1 else 0 end as quality, 0 as toxic from {documents}")
    gold = view(spark, d, "select doc_id, quality, toxic from {labels}")
    return k.cross_check(auto, gold, ["doc_id"], ["quality", "toxic"])


def contract_violations(spark, d):
    df = view(spark, d, "select doc_id, source, case when doc_id % 7 = 0 then null else lang end as lang, n_chars from {documents}")
    return k.check_contract(df, required=["lang"], minimum={"n_chars": 100}, pattern={"source": r"^src\d$"}, const={"lang": "en"})


def duplicate_values(spark, d):
    df = view(spark, d, "select doc_id, text from {documents}").withColumn("digest", F.sha2("text", 256))
    return k.duplicates(df, "digest", "doc_id").select("digest", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


def company_metrics(spark, d):
    c = view(spark, d, "select distinct lpad(cast(o_custkey % 500 as string), 6, '0') as company_id from {orders}")
    m = k.company_metrics(c, facts=_facts(spark, d), transactions=x.transactions(_typed(spark, d)))
    return m.withColumn("status", k.batch_status(F.lit(0), F.when(F.col("facts") == 0, 1).otherwise(0), F.when(F.col("transactions") > 20, 1).otherwise(0)))


def snapshots(spark, d):
    c = view(spark, d, "select distinct lpad(cast(o_custkey % 500 as string), 6, '0') as company_id from {orders}")
    return k.snapshot_status(_facts(spark, d).withColumn("party_id", F.when(F.col("event_id") % 50 == 0, F.col("raw_value"))), c)


QUERIES = {
    "ranking_inputs": ranking_inputs, "patch_records": patch_records, "kept_evidence": kept_evidence, "candidate_evidence": candidate_evidence, "review_rows": review_rows, "packages": packages, "combined_tables": combined_tables,
    
    
    
    "survivors": survivors, "ledger_decisions": ledger_decisions,
    "expected_counts": expected_counts, "gold_cross_check": gold_cross_check, "contract_violations": contract_violations, "duplicate_values": duplicate_values, "company_metrics": company_metrics, "snapshots": snapshots,
}
SQL = {
    "ranking_inputs": f"with r as ({plain(RANKED)}) select event_id, case event_id % 4 when 0 then y || '-' || m when 1 then y::varchar when 2 then '2001-02' else '' end as rank_period, title as rank_title, case when event_id % 7 = 0 then 'page_timeline_recovery,x' else '' end as signals, event_id % 7 = 0 or event_id % 5 = 0 as is_recovery, event_id % 3 = 0 as is_limited_establishment from r",
    "patch_records": f"select doc_id, 'REMOVE' as action, concat('{{\"doc_id\":', doc_id, ',\"quality\":', quality, ',\"toxic\":', toxic, ',\"company_id\":\"', company_id, '\"}}') as before_value from ({plain(LABELS)}) where company_id is not null and quality is not null and toxic is not null",
    "kept_evidence": "select l_orderkey, count(*) as rows, sum(l_partkey)::bigint as parts from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'O') group by 1",
    "candidate_evidence": "select o_orderkey::bigint as candidate_event_id, o_orderstatus, l_linenumber as evidence_id from orders left join (select * from lineitem where l_linenumber <> 2) on l_orderkey = o_orderkey",
    "review_rows": "select 'structured' as stage, source as company_id, 'PENDING' as review_status, count(*) as n from documents group by all union all select 'numeric', source, case when doc_id % 3 = 0 then 'CLOSED' when doc_id % 3 = 1 then 'OPEN' else 'PENDING' end, count(*) from documents group by all",
    "packages": f"with l as (select company_id, count(*) as n, string_agg(doc_id::varchar, ',' order by doc_id) as ids from ({plain(LABELS)}) where quality = 1 group by 1) select source as company_id, count(*) as docs, min(doc_id) as first_doc, coalesce(any_value(n), 0) as labels, any_value(ids) as label_ids from documents left join l on l.company_id = source group by source",
    "combined_tables": "select source, string_agg(doc_id::varchar, ';' order by doc_id) as ids, null::varchar as note from documents group by source",
    "survivors": f"with v as (select doc_id, company_id, quality, n_chars from ({plain(LABELS)})), r as (select *, row_number() over w as k, first(doc_id) over w as f from v window w as (partition by company_id, quality order by n_chars desc, doc_id)) select doc_id, company_id, quality, case when k > 1 then f end as replaced_by from r",
    "ledger_decisions": "select doc_id, case when doc_id % 3 = 0 then 'OPEN' when quality = 1 or toxic = 0 then 'CLOSED' else 'REJECTED' end as review_status from labels",
    "expected_counts": f"with a as (select company_id, count(*) as found from ({plain(LABELS)}) group by 1), e as (select source as company_id, count(*) as expected from documents group by source) select coalesce(a.company_id, e.company_id) as company_id, coalesce(found, 0) as found, coalesce(expected, 0) as expected, coalesce(found, 0) = coalesce(expected, 0) as ok from a full join e using (company_id)",
    "gold_cross_check": "with a as (select doc_id, case when n_chars > 2000 then 1 else 0 end as q, 0 as t from documents) select coalesce(a.doc_id, l.doc_id) as doc_id, case when a.doc_id is null then 'GOLD_ONLY' when l.doc_id is null then 'AUTO_ONLY' else 'COMMON' end as side, concat_ws(',', case when a.q <> l.quality then 'quality' end, case when a.t <> l.toxic then 'toxic' end) as differs from a full join labels l on a.doc_id = l.doc_id",
    "contract_violations": "with d as (select doc_id, source, case when doc_id % 7 = 0 then null else lang end as lang, n_chars from documents) select doc_id as id, unnest(list_filter([case when lang is null then 'required:lang' end, case when n_chars < 100 then 'minimum:n_chars' end, case when not regexp_matches(source, '^src\\d$') then 'pattern:source' end, case when lang <> 'en' then 'const:lang' end], lambda z: z is not null)) as rule from d",
    "duplicate_values": "select sha256(text) as digest, string_agg(doc_id::varchar, ',' order by doc_id) as ids from documents group by text having count(*) > 1",
    "company_metrics": FACTS_SQL + ", " + TRANS_SQL + ", c as (select distinct lpad(cast(o_custkey % 500 as string), 6, '0') as company_id from orders), fc as (select company_id, count(*) as facts from facts group by 1), tn as (select company_id, count(*) as transactions from tr group by 1) select company_id, coalesce(facts, 0) as facts, coalesce(transactions, 0) as transactions, case when facts is null then 'BLOCKED' when transactions > 20 then 'READY_WITH_REVIEW' else 'READY' end as status from c left join fc using (company_id) left join tn using (company_id)",
    "snapshots": FACTS_SQL + ", c as (select distinct lpad(cast(o_custkey % 500 as string), 6, '0') as company_id from orders), g as (select company_id, count(*) as n, count(*) filter (event_id % 50 = 0) as l from facts where fact_type = 'EQUITY_RATIO' group by 1) select company_id, case when n is null then 'NO_RATIOS' when l = 0 then 'RATIOS_WITHOUT_PARTY' else 'SNAPSHOT' end as snapshot_status from c left join g using (company_id)",
}
