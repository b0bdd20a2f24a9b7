"""The query over schema documents, with its SQL, whose rules are stated here again without a document."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators.contracts import check_schema

from .views import plain, view

# A bundle for each order: a candidate with its counts, its dates by role and its evidence in order.
HEADS = """
select o_orderkey as bundle_id, case when o_custkey % 50 = 0 then null when o_custkey % 50 = 1 then concat('X', cast(o_custkey as string)) else lpad(cast(o_custkey % 1000 as string), 6, '0') end as company_id,
  case when o_orderstatus = 'P' then 'DRAFT' else 'AUTO_CANDIDATE' end as candidate_status, o_totalprice / 1000 as score
from {orders}
"""
LINES = """
select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) - 1 as i, case when l_quantity = 13 then null else concat('E', cast(l_partkey as string)) end as evidence_id,
  l_linenumber - 1 as page, case when l_linenumber = 5 then null when l_linenumber = 6 then '' else concat(cast(year(l_shipdate) as string), '-', lpad(cast(month(l_shipdate) as string), 2, '0')) end as event_date, l_returnflag
from {lineitem}
"""
BUNDLE = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "$defs": {
        "evidence": {
            "type": "object",
            "required": ["evidence_id", "page"],
            "properties": {"evidence_id": {"type": "string"}, "page": {"type": "integer", "minimum": 1}},
        },
        "candidate": {
            "type": "object",
            "required": ["company_id", "candidate_status", "primary_evidence_id"],
            "properties": {
                "company_id": {"type": "string", "pattern": "^\\d{6}$"},
                "candidate_status": {"const": "AUTO_CANDIDATE"},
                "primary_evidence_id": {"type": "string"},
                "score": {"type": "number", "maximum": 400},
                "counts": {"type": "object", "additionalProperties": {"type": "integer", "minimum": 1}},
                "event_dates": {"type": "object", "additionalProperties": {"type": "array", "items": {"type": "string", "minLength": 7}}},
                "evidence": {"type": "array", "minItems": 2, "items": {"$ref": "#/$defs/evidence"}},
            },
        },
    },
}


def bundle_violations(spark, d):
    lines = view(spark, d, LINES).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("i", "evidence_id", "page", "event_date"))).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_returnflag") == "A").alias("accepted"),
    )
    bundle = view(spark, d, HEADS).join(lines, F.col("bundle_id") == F.col("l_orderkey")).select(
        "bundle_id", "company_id", "candidate_status", F.col("lines")[0]["evidence_id"].alias("primary_evidence_id"), "score",
        F.create_map(F.lit("returned"), "returned", F.lit("accepted"), "accepted").alias("counts"),
        F.create_map(F.lit("resolution"), F.transform("lines", lambda x: x["event_date"])).alias("event_dates"),
        F.transform("lines", lambda x: F.struct(x["evidence_id"].alias("evidence_id"), x["page"].alias("page"))).alias("evidence"),
    )
    return check_schema(bundle, BUNDLE, "candidate")


QUERIES = {"bundle_violations": bundle_violations}
SQL = {
    "bundle_violations": plain(f"""
with heads as ({HEADS}), lines as ({LINES}), l as (select lines.* from lines join heads on l_orderkey = bundle_id),
n as (select l_orderkey, count(*) as n, count(*) filter (where l_returnflag = 'R') as returned, count(*) filter (where l_returnflag = 'A') as accepted, max(case when i = 0 then evidence_id end) as first_id from l group by l_orderkey),
h as (select * from heads join n on bundle_id = l_orderkey)
select bundle_id as id, 'company_id' as path, 'required' as rule from h where company_id is null
union all select bundle_id, 'company_id', 'pattern' from h where not regexp_full_match(company_id, '[0-9]+') or length(company_id) <> 6
union all select bundle_id, 'candidate_status', 'const' from h where candidate_status <> 'AUTO_CANDIDATE'
union all select bundle_id, 'primary_evidence_id', 'required' from h where first_id is null
union all select bundle_id, 'score', 'maximum' from h where score > 400
union all select bundle_id, 'counts.returned', 'minimum' from h where returned < 1
union all select bundle_id, 'counts.accepted', 'minimum' from h where accepted < 1
union all select bundle_id, 'evidence', 'minItems' from h where n < 2
union all select l_orderkey, 'event_dates.resolution[' || cast(i as varchar) || ']', case when event_date is null then 'type' else 'minLength' end from l where event_date is null or length(event_date) < 7
union all select l_orderkey, 'evidence[' || cast(i as varchar) || '].evidence_id', 'required' from l where evidence_id is null
union all select l_orderkey, 'evidence[' || cast(i as varchar) || '].page', 'minimum' from l where page < 1
"""),
}
