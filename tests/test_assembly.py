"""Candidates from sections, recovery of a set-up, evidence of shareholders, chapters of a filing: against plain statements of their rules."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from dossier.functions import rules as r
from dossier.operators import assembly as a
from dossier.operators import chapters as c
from dossier.operators import extraction as x
from dossier.operators import headings as h
from dossier.operators import narrative as n
from dossier.sources import tables
from dossier.sources.stages import Stages

ISSUER = "青山木石"
UNIT = "company_id string, global_index int, page int, line_index int, line string"


def units_of(spark, pages, company="301001"):
    rows, g = [], 0
    for page, text in pages.items():
        for i, line in enumerate(text.split("\n")):
            rows.append((company, g, page, i, line))
            g += 1
    return spark.createDataFrame(rows, UNIT)


def issuers(spark, company="301001"):
    return spark.createDataFrame([(company, ISSUER)], "company_id string, short_name string")


# --- recovery

COLUMNS = "2012年6月\n2021年4月\n2022年9月\n木石有限成立\n第一次股权转让\n整体变更为股份公司"
SECTION = "company_id string, type string, scope string, period string, opening string, source_kind string"
SETUP, OWN = "LIMITED_COMPANY_ESTABLISHMENT", "ISSUER_OR_UNRESOLVED"


def recover(spark, pages, sections=()):
    known = spark.createDataFrame([("301001", *x) for x in sections], SECTION)
    return a.recovered_establishments(units_of(spark, pages), known, issuers(spark)).collect()


def test_scattered_columns_are_recovered(spark):
    (x,) = recover(spark, {10: COLUMNS})
    assert (x["type"], x["period"], x["title"], x["page"], x["confidence"]) == (SETUP, "2012-06", "2012-06，木石有限成立", 10, 0.82)
    assert x["signal"] == "explicit_issuer_predecessor"
    assert x["units"] == [0, 1, 2, 3, 4, 5]  # three before, four after, and the unit of the earliest date


def test_a_section_of_another_entity_does_not_block(spark):
    other = (SETUP, OWN, "2009-03", "海滨木石金属制品有限公司设立情况", "HEADING_SECTION")
    risky = (SETUP, a.RISK, "2012-06", "木石有限设立情况，木石有限成立", "HEADING_SECTION")
    assert [x["period"] for x in recover(spark, {10: COLUMNS}, [other, risky])] == ["2012-06"]


def test_a_detailed_section_blocks(spark):
    assert recover(spark, {10: COLUMNS}, [(SETUP, OWN, None, "（一）公司前身木石有限的设立情况\n木石有限取得营业执照", "HEADING_SECTION")]) == []
    assert len(recover(spark, {10: COLUMNS}, [(SETUP, OWN, None, "（一）公司前身木石有限的设立情况\n木石有限取得营业执照", "PAGE_TIMELINE_RECOVERY")])) == 1


def test_a_represented_period_is_skipped(spark):
    assert recover(spark, {10: COLUMNS}, [(SETUP, OWN, "2012-06-15", "某有限公司设立", "DATED_FALLBACK")]) == []


def test_a_field_of_particulars_is_no_set_up(spark):
    assert recover(spark, {10: "2012年6月\n木石有限成立日期2012年6月\n增资"}) == []


def test_a_merged_company_is_not_recovered(spark):
    assert recover(spark, {10: COLUMNS, 12: "公司吸收合并木石有限，\n其他"}) == []


def test_a_row_of_an_unnamed_set_up(spark):
    pages = {10: "2012年6月\n2021年4月\n注册资本1,000万元，由海滨木石出资设立\n海滨木石将其所持木石有限股权转让\n整体变更为股份公司"}
    (x,) = recover(spark, pages)
    assert (x["title"], x["signal"], x["period"]) == ("2012-06，发行人前身设立", "generic_capital_setup_row", "2012-06")


def test_the_page_with_most_dates_wins(spark):
    (x,) = recover(spark, {8: "2010年1月\n木石有限成立", 10: COLUMNS, 11: "注册资本由某人出资设立\n2001年1月\n2002年1月\n2003年1月\n2004年1月"})
    assert x["page"] == 10


# --- shareholders' evidence


def plain_holders(units):
    out = []
    for kind, terms in r.EVENT_RULES.categories.items():
        hits = [(g, p, [f"{kind}:{t}" for t in terms if t in line]) for g, p, line in units if any(t in line for t in terms)]
        runs = []
        for x in hits:
            if runs and x[1] - runs[-1][-1][1] <= 1 and x[0] - runs[-1][-1][0] <= 24:
                runs[-1].append(x)
            else:
                runs.append([x])
        kept = []
        for run in runs:
            start = max(units[0][0], run[0][0] - 2)
            block = [x for x in units if start <= x[0] <= run[-1][0] + 16][:90]
            text = "\n".join(x[2] for x in block).strip()
            flat = "".join(text.split())
            if not text or any(SequenceMatcher(None, "".join(k[3].split())[:1000], flat[:1000]).ratio() >= 0.76 for k in kept):
                continue
            kept.append((kind, block[0][1], block[-1][1], text, list(dict.fromkeys(t for x in run for t in x[2]))))
            if len(kept) == 2:
                break
        out += [(kind, i + 1, *k[1:]) for i, k in enumerate(kept)]
    return sorted(out)


def test_shareholder_evidence_against_a_fold(spark):
    rng = random.Random(8)
    terms = [t for ts in r.EVENT_RULES.categories.values() for t in ts]
    units = []
    for g in range(700):
        line = "".join(rng.choice("甲乙丙丁戊己庚辛") for _ in range(rng.randint(3, 20)))
        if rng.random() < (0.5 if 100 < g < 230 else 0.02):
            line += rng.choice(terms)
        units.append((g, 5 + g // 20, line))
    df = spark.createDataFrame([("c", g, p, 0, line) for g, p, line in units], UNIT)
    got = sorted((x["category"], x["evidence_no"], x["page"], x["last_page"], x["text"], x["signals"]) for x in a.shareholder_evidence(df).collect())
    assert got == plain_holders(units) and len(got) > 6
    assert max(len(x[4].split("\n")) for x in got) == 90


# --- candidates


def plain_assembly(members):
    """members: dicts of one cluster."""
    members = sorted(members, key=lambda m: (m["source_kind"] not in a.MAIN_KINDS, -m["confidence"], m["page"], m["section_no"]))
    p = members[0]
    union = lambda f: list(dict.fromkeys(v for m in members for v in m[f]))
    roles = {}
    for m in members:
        for k, vs in m["date_roles"].items():
            for v in vs:
                if v not in roles.setdefault(k, []):
                    roles[k].append(v)
    kinds = {m["type"] for m in members}
    pair = {"JOINT_STOCK_COMPANY_ESTABLISHMENT", "OVERALL_CHANGE"}
    text = "".join(m["text"] for m in members)
    kind = p["type"]
    if len(kinds & pair) >= 2:
        kind = "OVERALL_CHANGE"
    elif kind == "JOINT_STOCK_COMPANY_ESTABLISHMENT" and any(t in text for t in ("整体变更", "净资产折股", "折合股本", "变更为股份公司")):
        kind = "OVERALL_CHANGE"
    date = None
    if len(kinds & pair) >= 2:
        for k in r.DATE_CHOICE.get(kind, r.DATE_ROLES):
            if roles.get(k):
                date = (min(roles[k]), k, f"CLUSTER_CANONICAL_ROLE:{k}")
                break
    if not date:
        date = next(((m["period"], m["period_role"], m["period_basis"]) for m in members if m["period"]), None)
    if not date:
        date = next(((roles[k][0], k, f"CLUSTER_ROLE_PRIORITY:{k}") for k in r.DATE_ROLES if roles.get(k)), (None, None, "NO_RELEVANT_DATE"))
    types = union("types")
    confidence = round(min(0.99, max(m["confidence"] for m in members) + (0.05 if len(members) > 1 else 0)), 3)
    reasons = union("review_reasons") + ["候选正文页码无法完整确认"] + (["候选置信度低于复核阈值"] if confidence < 0.7 else []) + (["候选事件缺少可识别主要日期"] if not date[0] and p["type"] != "EQUITY_HOLDING_PROXY" else [])
    return {
        "type": kind, "types": types if kind in types else [kind, *types], "ordinals": union("ordinals"), "period": date[0], "period_role": date[1], "period_basis": date[2], "date_roles": roles, "title": p["title"], "page": min(m["page"] for m in members),
        "last_page": max(m["last_page"] for m in members), "primary_section": p["section_no"], "supporting_sections": [m["section_no"] for m in members[1:]], "scope": a.RISK if any(m["scope"] == a.RISK for m in members) else OWN, "providers": union("providers"),
        "signals": union("signals"), "confidence": confidence, "review_reasons": list(dict.fromkeys(reasons)),
    }


def test_assembly_against_a_fold(spark):
    rng = random.Random(3)
    kinds = ["CAPITAL_INCREASE", "JOINT_STOCK_COMPANY_ESTABLISHMENT", "OVERALL_CHANGE", "EQUITY_HOLDING_PROXY"]
    rows, clusters = [], []
    for i in range(160):
        pick = lambda xs, k: rng.sample(xs, rng.randint(0, k))
        roles = {k: sorted({f"20{rng.randint(10, 14)}-0{rng.randint(1, 9)}" for _ in range(rng.randint(1, 3))}, key=lambda _: rng.random()) for k in pick(r.DATE_ROLES, 3)}
        period = rng.choice([None, "2011-02", "2013-05"])
        kind = rng.choice(kinds)
        rows.append({
            "company_id": f"c{i % 3}", "section_no": i, "page": rng.randint(1, 9), "last_page": rng.randint(9, 20), "source_kind": rng.choice(["HEADING_SECTION", "DATED_FALLBACK", "TIMELINE_ONLY"]), "title": f"标题{i}", "type": kind,
            "types": [kind, *[k for k in pick(kinds, 1) if k != kind]], "ordinals": pick(["第一次", "第二次"], 2), "period": period, "period_role": period and "event_period", "period_basis": "TITLE_DATE" if period else "NO_RELEVANT_DATE", "date_roles": roles,
            "scope": rng.choice([OWN, OWN, a.RISK]), "providers": pick(["评估机构", "审计机构"], 2), "signals": ["event_heading", *pick(["x", "y"], 2)], "confidence": rng.choice([0.62, 0.68, 0.76, 0.84, 0.98]), "review_reasons": pick(["甲", "乙"], 1), "text": rng.choice(["整体变更", "无", "折合股本"]),
        })
        clusters.append((f"c{i % 3}", i, rng.randint(1, 25)))
    schema = "company_id string, section_no int, page int, last_page int, source_kind string, title string, type string, types array<string>, ordinals array<string>, period string, period_role string, period_basis string, date_roles map<string,array<string>>, scope string, providers array<string>, signals array<string>, confidence double, review_reasons array<string>, text string"
    df, cl = spark.createDataFrame(rows, schema), spark.createDataFrame(clusters, "company_id string, section_no int, cluster int")
    got = {(x["company_id"], x["cluster"]): x.asDict() for x in a.assembled(df.drop("text"), cl, df.select("company_id", "section_no", "text")).collect()}
    groups = {}
    for row, (company, _, cluster) in zip(rows, clusters, strict=True):
        groups.setdefault((company, cluster), []).append(row)
    assert set(got) == set(groups)
    for key, members in groups.items():
        want = plain_assembly(members)
        assert {k: got[key][k] for k in want} == want


def test_from_units_to_candidates(spark):
    pages = {
        10: "一、历史沿革\n（一）2010年3月第一次增资\n2010年2月5日，公司召开股东会，审议增资。\n2010年3月8日，完成工商变更登记。\n验资机构出具验资报告。",
        11: "（二）2012年5月第一次股权转让\n2012年5月，双方签署股权转让协议。",
        12: "（三）报告期内重大资产重组情况\n报告期内公司未发生重大资产重组。\n（四）股份公司设立情况\n2015年6月，公司整体变更为股份有限公司。",
        13: "（五）2015年6月整体变更为股份有限公司\n2015年7月1日取得营业执照。",
    }
    units = units_of(spark, pages)
    numbers = spark.createDataFrame([("301001", p, p - 1) for p in (10, 11, 12)], "company_id string, pdf_page int, number int")
    got, evidence, negatives, other = a.candidates_of(units, issuers(spark), numbers)
    rows = {x["type"]: x for x in got.collect()}
    assert set(rows) == {"CAPITAL_INCREASE", "EQUITY_TRANSFER", "OVERALL_CHANGE"}
    inc = rows["CAPITAL_INCREASE"]
    assert (inc["period"], inc["period_role"], inc["period_basis"]) == ("2010-03", "event_period", "TITLE_DATE")
    assert inc["date_roles"]["resolution_date"] == ["2010-02-05"] and inc["date_roles"]["registration_date"] == ["2010-03-08"]
    assert (inc["printed_start"], inc["ordinals"], inc["providers"], inc["confidence"]) == (9, ["第一次"], ["验资机构"], 0.9)
    assert (rows["EQUITY_TRANSFER"]["printed_start"], rows["EQUITY_TRANSFER"]["review_reasons"]) == (10, [])
    change = rows["OVERALL_CHANGE"]  # two sections of equivalent types: the earliest registration date; the dated line is one of its own
    assert len(change["supporting_sections"]) == 2 and (change["period"], change["period_basis"]) == ("2015-07-01", "CLUSTER_CANONICAL_ROLE:registration_date")
    assert [x["type"] for x in negatives.collect()] == ["MAJOR_ASSET_RESTRUCTURING"] and other.count() == 0
    lines = {(x["cluster"], x["evidence_no"]): x for x in evidence.collect()}
    first = lines[inc["cluster"], 1]
    assert [tuple(x) for x in first["lines"]] == [(10, 1, 4)] and first["role"] == "PRIMARY" and first["text"].startswith("（一）2010年3月第一次增资\n2010年2月5日")
    assert n.candidate_problems(
        got.select("company_id", F.col("cluster").alias("candidate_id"), "page", "last_page", "type", F.concat_ws("-", "cluster", F.lit(1)).alias("primary_evidence")),
        evidence.select("company_id", F.col("cluster").alias("candidate_id"), F.concat_ws("-", "cluster", "evidence_no").alias("evidence_id"), "page", "last_page", "text"),
        spark.createDataFrame([("301001", 10, 13)], "company_id string, start_page int, end_page int"), negatives,
    ).count() == 0


def test_dates_of_three_origins(spark):
    rows = [("a", "EQUITY_TRANSFER", "event_period", "2001-01", 3, False), ("a", "EQUITY_TRANSFER", "resolution_date", "2000-12-01", 1, False), ("a", "EQUITY_TRANSFER", "agreement_date", "2000-12-05", 2, False)]
    rows += [("b", "OVERALL_CHANGE", "registration_date", "2005-02", 1, False), ("b", "OVERALL_CHANGE", "registration_date", "2005-01", 2, False), ("c", "CAPITAL_INCREASE", "resolution_date", "2005-02", 1, False), ("c", "CAPITAL_INCREASE", "resolution_date", "2005-01", 2, False)]
    rows += [("d", "OVERALL_CHANGE", "other_date", "1999", 0, True), ("d", "OVERALL_CHANGE", "registration_date", "1998", 1, False), ("e", "CAPITAL_REDUCTION", "payment_date", "1998", 1, False), ("f", "UNKNOWN", "payment_date", "1998", 1, False)]
    got = {x["k"]: tuple(x)[1:] for x in n.primary_date(spark.createDataFrame(rows, "k string, kind string, date_role string, date_key string, seq int, title boolean"), ["k"]).collect()}
    assert got == {"a": ("2001-01", "event_period", "ROLE_PRIORITY:event_period"), "b": ("2005-01", "registration_date", "ROLE_PRIORITY:registration_date"), "c": ("2005-02", "resolution_date", "ROLE_PRIORITY:resolution_date"), "d": ("1999", "event_period", "TITLE_DATE"), "f": ("1998", "payment_date", "ROLE_PRIORITY:payment_date")}


# --- chapters


def filed(spark, pages, company="301001"):
    rows = [(company, p, text.split("\n")) for p, text in pages.items()]
    df = h.toc_flags(spark.createDataFrame(rows, "company_id string, pdf_page int, lines array<string>"))
    return df, df.groupBy("company_id").agg(F.max("pdf_page").alias("page_count"))


def test_contents_do_not_name_the_issuers_section(spark):
    body = "\n".join(f"行{i}" for i in range(9)) + "\n第五节 发行人基本情况\n注册资本，法定代表人"
    pages = {p: "正文" for p in range(1, 61)} | {2: "目录\n第五节 发行人基本情况", 10: body, 20: "续 第五节 发行人基本情况", 30: "第六节 业务与技术"}
    (m,) = c.master_sections(*filed(spark, pages)).collect()
    assert (m["start_page"], m["end_page"], m["status"], m["context_support"], m["confidence"], m["title"]) == (10, 29, "CONFIRMED_BY_NEXT_MAJOR_SECTION", 2, 0.9, "第五节发行人基本情况")
    (m,) = c.master_sections(*filed(spark, {1: "正文", 2: "第五节 发行人基本情况"} | {p: "正文" for p in range(3, 200)})).collect()
    assert (m["start_page"], m["end_page"], m["status"], m["review_reason"]) == (2, 121, "CAPPED_BY_MAX_SPAN", c.WEAK)
    (m,) = c.master_sections(*filed(spark, {1: "目录\n第五节 发行人基本情况", 2: "正文"})).collect()
    assert (m["status"], m["start_page"], m["review_reason"]) == ("NOT_FOUND", None, c.NO_SECTION)


def test_categories_of_windows_are_their_own(spark):
    one = lambda text: spark.createDataFrame([(text,)], "t string").select(n.valid_range(F.col("t"))).first()[0]
    assert not one("2001年股票定向发行，2003年控制权变动")
    assert one("2001年增资，2003年股权转让") and not one("2001年增资，2001年股权转让") and not one("2001年增资，2003年股权转让，核查意见")


def test_windows_know_their_pages(spark):
    pages = {p: "正文" for p in range(1, 41)} | {4: "第五节 发行人基本情况", 33: "第六节 业务与技术", 6: "2001年增资", 7: "股权转让", 8: "2003年减资", 20: "2004年增资", 21: "2005年增资", 35: "2001年增资，2002年股权转让"}
    df, counts = filed(spark, pages)
    got = c.event_windows(c.page_signals(df), c.master_sections(df, counts)).collect()
    assert [(x["start_page"], x["end_page"], x["categories"], x["dates"]) for x in got] == [(6, 9, ["capital_change", "capital_increase", "equity_transfer"], ["2001年", "2003年"])]
    assert got[0]["score"] == pytest.approx(0.61 + 0.15 + 0.024 + 0.06 - 2 / 29 * 0.08, abs=6e-4)


def test_candidates_are_cut_to_the_issuers_section(spark):
    """Headings outside the section are no candidates of a required type; groups keep their members."""
    pages = {p: "正文" for p in range(1, 61)} | {4: "第五节 发行人基本情况\n注册资本，法定代表人", 33: "第六节 业务与技术"}
    pages |= {6: "一、发行人的设立及历次股本变化\n2001年增资，2002年股权转让\n验资报告", 12: "二、发行人历史沿革\n2003年增资，2004年股权转让", 40: "一、发行人历史沿革\n2001年增资，2002年股权转让"}
    df, counts = filed(spark, pages)
    lines = df.select("company_id", "pdf_page", "is_toc", F.posexplode("lines").alias("line_index", "line"))
    none = spark.createDataFrame([], "company_id string, line string, pages long")
    hs = h.headings(lines, none)
    tree = h.enriched(h.hierarchy(hs, counts), df.withColumn("text", F.array_join("lines", "\n")))
    m, signals = c.master_sections(df, counts), c.page_signals(df)
    every = c.all_candidates(h.direct_candidates(tree, h.toc_support(hs), counts), tree, signals, m, hs)
    eq = {(x["source"], x["start_page"]): x for x in every.where("type = 'equity_history'").collect()}
    assert max(k[1] for k in eq) < 33 and {k[0] for k in eq} >= {"HEADING_SECTION", "SIBLING_GROUP", "EVENT_WINDOW"}
    group = eq["SIBLING_GROUP", 6]
    assert len(group["supporting_headings"]) == 2 and group["supporting_titles"] == ["一、发行人的设立及历次股本变化", "二、发行人历史沿革"] and group["end_page"] == 32
    top = c.top_candidates(every.withColumn("source_rank", c.source_rank(F.col("source")))).where("is_primary").collect()
    assert {x["type"]: x["source"] for x in top} == {"equity_history": "HEADING_SECTION", "issuer_overview": "ISSUER_MASTER_SECTION"}


def test_titles_are_held_once(spark):
    """The plan of headings holds the expression of a title once, not at each mention."""
    lines = spark.createDataFrame([("c", 1, 0, "一、历史沿革", False)], "company_id string, pdf_page int, line_index int, line string, is_toc boolean")
    plan = h.headings(lines, spark.createDataFrame([], "company_id string, line string, pages long"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 40


def rows_joined(df):
    """The most rows that a join of the plan gives."""
    def most(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return most(plan.executedPlan())
        own = plan.metrics().get("numOutputRows").get().value() if "Join" in name else 0
        below = plan.children()
        inner = [plan.plan()] if name.endswith("QueryStage") else []
        return max([own, *[most(below.apply(i)) for i in range(below.size())], *[most(x) for x in inner]])

    df.collect()
    return most(df._jdf.queryExecution().executedPlan())


def test_contents_entries_are_counted_before_they_meet(spark):
    """Equal titles and shared aliases count each entry once; headings don't meet entries one by one."""
    titles = ["发行人的设立及历次股本变化", "历次股权转让情况", "发行人历史沿革", "无名标题"]
    rows = [("c", i, titles[i % 4], "BODY_HEADING" if i < 400 else "TOC_ENTRY", ["equity_history"] if i % 5 else ["equity_history", "shareholders"]) for i in range(800)]
    got = h.toc_support(spark.createDataFrame(rows, "company_id string, heading_no int, core string, heading_class string, types array<string>"))
    most = rows_joined(got)
    keys = {t: set(spark.range(1).select(h.matched_aliases(F.lit(t)).alias("a")).first()["a"]) | {t} for t in titles}
    want = {(i, k): sum(1 for _, _, t, kind, ks in rows if kind == "TOC_ENTRY" and k in ks and keys[t] & keys[core]) for _, i, core, kind_, types in rows if kind_ == "BODY_HEADING" for k in types}
    assert {(x["heading_no"], x["type"]): x["toc_support"] for x in got.collect()} == want
    assert most <= 800


# --- stage tables


def test_stage_tables(spark, tmp_path):
    st = Stages(spark, str(tmp_path))
    assert st.pointer("a") is None
    first = st.run("a", lambda: spark.range(3), "one")
    assert first.count() == 3 and st.pointer("a") == "one"
    with pytest.raises(Exception, match="no"):
        st.run("a", lambda: spark.range(9).select(F.raise_error(F.lit("no"))), "two")
    assert st.pointer("a") == "one"  # a failed run never moves the pointer
    with pytest.raises(Exception, match="(?i)exist"):
        st.run("a", lambda: spark.range(5), "one")
    assert st.pointer("a") == "one" and st.read("a").count() == 3
    st.run("a", lambda: spark.range(7), "three")
    assert st.read("a").count() == 7 and st.read("a", "one").count() == 3
    with pytest.raises(FileNotFoundError):
        st.read("a", "two")
    assert st.ensure("a", lambda: spark.range(1)).count() == 7 and st.ensure("b", lambda: spark.range(2)).count() == 2
    assert sorted((x["stage"], x["run_id"] if x["stage"] == "a" else "", x["status"]) for x in st.log().collect()) == [("a", "one", "COMPLETED"), ("a", "one", "FAILED"), ("a", "three", "COMPLETED"), ("a", "two", "FAILED"), ("b", "", "COMPLETED")]




def test_rejected_lines_keep_their_numbers(spark, tmp_path):
    """Line numbers run through a file of many splits."""
    bad = {1, 700, 1999}
    lines = ["{oops" if i in bad else '{"a": %d, "t": "%s"}' % (i, "x" * (i % 90)) for i in range(2000)]
    lines[5] = ""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.jsonl").write_text("\ufeff" + "\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "in" / "two.jsonl").write_text('{"a": 1}\n[1\n', encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows, rejected = tables.read_numbered_jsonl(spark, str(tmp_path / "in"), "a int, t string")
        assert sorted((x["file"].rsplit("/", 1)[1], x["line"]) for x in rejected.collect()) == [("one.jsonl", 2), ("one.jsonl", 701), ("one.jsonl", 2000), ("two.jsonl", 2)]
        got = {x["a"]: x["line"] for x in rows.where("file like '%one%'").collect()}
        assert got == {i: i + 1 for i in range(2000) if i not in bad | {5}}
        assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dates_and_providers_of_candidates(spark):
    ev = spark.createDataFrame([("c", 1, 1, "2010年3月8日，公司召开股东会。2010年4月1日完成工商变更登记。张三将其持有的公司股权转让给测试投资有限公司。")], "company_id string, event_id long, evidence_id int, evidence_text string")
    found = x.extract_dates(ev)
    text = found.first()
    cand = spark.createDataFrame([("c", 1, {text["date_role"]: [text["date_text"], "2010-05"], "event_period": ["2010-03"]}, "2010-03", ["评估机构", "评估机构", "某某会计师事务所"])], "company_id string, event_id long, date_roles map<string,array<string>>, period string, providers array<string>")
    got = {(r_["date_role"], r_["date_text"]): (r_["source"], r_["confidence"]) for r_ in x.date_facts(cand, found).collect()}
    assert got[text["date_role"], text["date_text"]] == ("CANDIDATE_DATE_ROLE", 0.96) and got["event_period", "2010-03"][0] == "CANDIDATE_DATE_ROLE"
    assert len(got) == 3 + found.count() - 1 and "EVIDENCE_REGEX" in {v[0] for v in got.values()}
    parties = x.extract_parties(ev)
    more = x.with_providers(parties, cand, ev).where("party_role = 'SERVICE_PROVIDER'").collect()
    assert sorted(r_["party_name"] for r_ in more) == ["某某会计师事务所", "评估机构"] and {r_["evidence_id"] for r_ in more} == {1} and x.with_providers(parties, cand, ev).count() == parties.count() + 2


def test_pages_of_a_filing_are_counted_without_their_texts(spark):
    """Lines come with the line after them, and numbering headings drops equal rows: no window over lines, and no aggregate of headings."""
    df = spark.createDataFrame([("c", 1, ["第一节", "历史沿革", "一、股本演变情况"]), ("c", 2, ["一、股本演变情况", "x"]), ("c", 2, ["一、股本演变情况", "x"])], "company_id string, pdf_page int, lines array<string>")
    lines = h.page_lines(h.toc_flags(df))
    none = spark.createDataFrame([], "company_id string, line string, pages long")
    fast, slow = h.headings(lines, none), h.headings(lines.drop("next").dropDuplicates(), none)
    key = lambda d: sorted((r.pdf_page, r.line_index, r.merged, r.raw, r.core, r.heading_no) for r in d.collect())
    assert key(fast) == key(slow) and [r[-1] for r in key(fast)] == [1, 2, 3] and any(r[2] for r in key(fast))
    plan = fast._jdf.queryExecution().optimizedPlan().toString()
    assert "lead(" not in plan and "Aggregate" not in plan


def test_shareholder_windows_are_cut_out_of_sorted_lines(spark):
    """Pages give what their lines give; a window's lines meet in no join, and are shuffled as often as the lines themselves: once."""
    rng = random.Random(5)
    terms = [t for ts in r.EVENT_RULES.categories.values() for t in ts]
    pages = [("c" if p < 60 else "d", 1 + p, [rng.choice("甲乙丙丁") * rng.randint(1, 9) + (rng.choice(terms) if rng.random() < 0.06 else "") for _ in range(rng.randint(0, 7))]) for p in range(120)]
    of_pages = a.shareholder_evidence_of_pages(spark.createDataFrame(pages, "company_id string, page int, lines array<string>").repartition(7))
    units = [(c, g, p, 0, line) for c in "cd" for g, (p, line) in enumerate((p, line) for k, p, lines in pages if k == c for line in lines)]
    got = sorted((x["company_id"], x["category"], x["evidence_no"], x["page"], x["last_page"], x["text"], x["signals"]) for x in of_pages.collect())
    want = sorted((c, *x) for c in "cd" for x in plain_holders([(g, p, line) for k, g, p, _, line in units if k == c]))
    assert got == want and len(got) > 12
    assert got == sorted((x["company_id"], x["category"], x["evidence_no"], x["page"], x["last_page"], x["text"], x["signals"]) for x in a.shareholder_evidence(spark.createDataFrame(units, UNIT)).collect())
    plan = of_pages._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and plan.count("RepartitionByExpression") == 1
    spaced = spark.createDataFrame([("c", 3, ["甲", "主 要\u3000股东", None, "乙 "]), ("c", 9, []), ("c", 10, None)], "company_id string, page int, lines array<string>")
    assert [(x["category"], x["page"], x["last_page"], x["text"], x["signals"]) for x in a.shareholder_evidence_of_pages(spaced).collect()] == [("MAJOR_SHAREHOLDERS", 3, 3, "甲\n主 要\u3000股东\n乙", ["MAJOR_SHAREHOLDERS:主要股东"])]


def test_master_sections_against_a_fold(spark):
    """Words run over page breaks, short and missing pages and contents included; pages meet those after them in blocks."""
    rng = random.Random(9)
    context, names = r.MASTER["context"], ["第五节 发行人基本情况", "第 六 节 公司基本情况", "第七节 业务与技术", "第五节发行人基本情况", "甲节乙"]
    books = {}
    for company in range(12):
        text = ["".join(rng.choice([*context, "甲", "乙"]) for _ in range(rng.choice([0, 1, 3, 8]))) for _ in range(rng.randint(3, 30))]
        cut = ["".join(text[:i])[-rng.randint(0, 9) :] for i in range(len(text))]  # ends and starts of words on pages of their own
        books[str(company)] = {500 + p: [rng.choice(["x", "目录"]) if rng.random() < 0.1 else "x", *([rng.choice(names)] if rng.random() < 0.5 else []), *([rng.choice(names)] if rng.random() < 0.2 else []), t] for p, t in enumerate(text + cut) if rng.random() < 0.9}
    df = h.toc_flags(spark.createDataFrame([(k, p, ls) for k, b in books.items() for p, ls in b.items()], "company_id string, pdf_page int, lines array<string>"))
    counts = df.groupBy("company_id").agg(F.max("pdf_page").alias("page_count"))
    got = c.master_sections(df, counts)
    have = {x["company_id"]: (x["start_page"], x["title"], x["context_support"], x["confidence"], x["status"], x["end_page"]) for x in got.collect()}
    toc = {(x["company_id"], x["pdf_page"]) for x in df.where("is_toc").collect()}
    squash = lambda x: "".join(x.split())
    for k, book in books.items():
        told = [(p, i, m.group()) for p, ls in sorted(book.items()) if (k, p) not in toc for i, x in enumerate(ls) if (m := re.search(r"第[一二三四五六七八九十百\d]+节.*$", squash(x)))]
        own, last, best = [x for x in told if any(a_ in x[2] for a_ in r.MASTER["aliases"])], max(book), []
        for p, i, tail in own:
            near = "".join(squash("".join(book[q])) for q in range(p, p + 4) if q in book)
            support = sum(w in near for w in context)
            score = round(min(1.0, 0.7 + min(support, 5) * 0.05 + 0.05 * (support >= 2) + 0.05 * (p <= last // 2)), 6)
            best.append((-score, p, i, tail, support))
        if not best:
            assert have[k][:2] == (None, None)
            continue
        s, p, _, tail, support = min(best)
        ends = [q for q, _, t in told if q > p and t != tail and (q, t) not in {(x[0], x[2]) for x in own}]
        end = max(p, min(ends) - 1) if ends else min(last, p + 119)
        assert have[k] == (p, tail, support, round(-s, 3), "CONFIRMED_BY_NEXT_MAJOR_SECTION" if ends else "CAPPED_BY_MAX_SPAN", end), k
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString().lower()  # texts are read once, before


def test_signals_look_at_a_pages_text_once(spark):
    """What pages tell, with white space inside words, dashes of all kinds, both forms of dates, and no text at all."""
    from dossier.operators import units as u

    texts = [["增 资，2001年", "1月3日 股权　转让"], ["2003—5—6 减资", "1999/1/2，2003-5"], ["补充法律意见书"], [], None, ["二〇〇一年", "19年", "2001.7 整体变更", None], ["x" * 200]]
    df = spark.createDataFrame(list(enumerate(texts)), "pdf_page int, lines array<string>").withColumn("company_id", F.lit("c"))
    flat = F.array_join(F.transform("lines", u.norm), "")
    want = {x["pdf_page"]: (x["k"], x["d"]) for x in df.select("pdf_page", F.array(*[flat.rlike("|".join(ts)) for _, ts in sorted(r.WINDOW["categories"].items())]).alias("k"), F.array_sort(u.dates_of(flat)).alias("d")).collect()}
    got = c.page_signals(df)
    for x in got.collect():
        hits, dates = want[x["pdf_page"]]
        assert (x["categories"], x["dates"]) == ([k for k, hit in zip(sorted(r.WINDOW["categories"]), hits, strict=True) if hit], dates), x
        assert x["excluded"] == [t for t in r.WINDOW["exclude"] if t in "".join(y or "" for y in texts[x["pdf_page"]] or [])]
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("regexp_replace") <= 2 and "transform(lines" not in plan
