"""Facts of texts at scale: one pass over an event's evidence, and only the types that a query reads (findings F21 to F37 of round 3)."""

import re

from dossier.functions.text import SPACE
from dossier.operators import extraction as x
from dossier.plans import filings

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def folded(rows):
    """(company, event, evidence, type, raw value, unit) of each event's first matches, by the patterns as they stand."""
    out, seen = [], set()
    for company, event, evidence, text in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        flat = "".join(c for c in text or "" if c not in SPACE)
        for kind, pattern, _ in x.NUMERIC:
            for value, unit in re.findall(pattern, flat, re.ASCII):
                if (company, event, kind, value, unit) not in seen:
                    seen.add((company, event, kind, value, unit))
                    out.append((company, event, evidence, kind, value, unit))
    return sorted(out, key=str)


def test_first_facts_across_batches(spark):
    texts = ["注册资本由 1,000　万元增加至1，200.5万元，新增注册资本200万元，占比30%", None, "", "占比 30%，又占比 1234,5.5%，发行 10 万股、10股，每股 5 元/股，每股5万元", "净资产为３元，净资产为3元，评估值：.5亿元。元元%股", "注册\x1c资本5元，注册 资本5元"]
    rows = [(None if k == 3 else f"c{k % 2}", k // 2, i, texts[(i * 5 + k) % len(texts)]) for k in range(9) for i in range(7)]
    e = spark.createDataFrame(rows, "company_id string, event_id long, evidence_id int, evidence_text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = x.extract_numeric(e.repartition(5)).select("company_id", "event_id", "evidence_id", "fact_type", "raw_value", "raw_unit").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == folded(rows)


def test_facts_are_not_sorted(spark):
    p = plan(filings.numeric_facts(spark, SF))
    assert p.count("MapInArrow") == 1 and "Window" not in p.split("MapInArrow")[0] and "Generate" not in p.split("MapInArrow")[0]


def test_only_the_types_read(spark, monkeypatch):
    asked, extract = [], x.extract_numeric
    monkeypatch.setattr(x, "extract_numeric", lambda e, table=x.NUMERIC: asked.append([r[0] for r in table]) or extract(e, table))
    filings.ratio_check(spark, SF)
    filings.review_queue(spark, SF)
    assert asked == [["EQUITY_RATIO"]] * 2


def test_texts_of_known_events_leave_first(spark):
    p = plan(filings.orphan_facts(spark, SF))
    assert p.index("MapInArrow") < p.index("LeftAnti")


def test_facts_of_duplicates_are_found_once(spark):
    assert plan(filings.duplicate_facts(spark, SF)).count("MapInArrow") == 1


def test_values_are_found_once_and_dealt(spark):
    p = plan(filings.validation_ids(spark, SF))
    assert "regexp_extract_all" not in p and "RepartitionByExpression [company_id" in p
