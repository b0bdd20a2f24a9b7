"""Table-in, table-out cases of the reference inventory, and SQL twins on the smallest tables."""

import random

import pytest
from pyspark.sql import functions as F

from dossier.functions import text as tx
from dossier.operators import extraction as x
from dossier.operators import investors as k
from dossier.operators import islands, narrative, units
from dossier.operators import pages as p
from dossier.operators import sections as sec
from dossier.operators import validation as v
from dossier.sources import tables as t
from dossier.streaming import evidence as se


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(expr.alias("v")).first()["v"]


def facts_of(spark, text):
    e = spark.createDataFrame([("000001", 1, 1, text)], "company_id string, event_id long, evidence_id int, evidence_text string")
    return {(r["fact_type"]): float(r["normalized_value"]) for r in x.extract_numeric(e).collect()}


def test_before_increase_after(spark):
    f = facts_of(spark, "注册资本由1,000万元增加至1,500万元，新增注册资本500万元。")
    assert (f["REGISTERED_CAPITAL_BEFORE"], f["CAPITAL_INCREASE_AMOUNT"], f["REGISTERED_CAPITAL_AFTER"]) == (1e7, 5e6, 1.5e7)


def test_capital_rule(spark):
    df = spark.createDataFrame([("c", 1, 10, 5, 15), ("c", 2, 10, 5, 99), ("c", 3, 10, None, 99)], "company_id string, event_id int, registered_capital_before int, capital_increase_amount int, registered_capital_after int")
    got = {r["event_id"]: r["status"] for r in v.check_capital(df).collect()}
    assert got == {1: "PASSED", 2: "FAILED", 3: "NOT_APPLICABLE"}


def test_transfer_parties(spark):
    e = spark.createDataFrame([("c", 1, 1, "张三将其持有的公司10%股权转让给测试投资有限公司。")], "company_id string, event_id int, evidence_id int, evidence_text string")
    got = {(r["party_role"], r["party_name"]) for r in x.extract_parties(e).collect()}
    assert ("TRANSFEROR", "张三") in got and ("TRANSFEREE", "测试投资有限公司") in got


@pytest.mark.parametrize("text, kinds", [
    ("在全国中小企业股份转让系统挂牌并公开转让", []), ("股票定向发行", ["LISTING_OR_DIRECTIONAL_FINANCING"]), ("2、股份公司设立情况", ["JOINT_STOCK_COMPANY_ESTABLISHMENT"]),
    ("第一次股权转让及增资", ["CAPITAL_INCREASE", "EQUITY_TRANSFER"]), ("一般内容", []),
])
def test_event_types(spark, text, kinds):
    assert sorted(one(spark, units.event_types(F.col("a")), a=text)) == kinds


def test_counts(spark):
    got = one(spark, units.disclosed_counts(F.col("a")), a="公司进行了四次股权转让和四次增资，另有一次资本公积转增股本。")
    assert got == {"EQUITY_TRANSFER": 4, "CAPITAL_INCREASE": 4, "SHARE_CAPITAL_CHANGE": 1}
    assert [one(spark, tx.chinese_number(F.col("a")), a=a) for a in ("十", "十二", "二十", "三十五", "两", "7", "x")] == [10, 12, 20, 35, 2, 7, None]


def test_wide_space_and_dates(spark):
    assert one(spark, tx.norm(F.col("a")), a="一　二 —x") == "一二-x"
    assert [one(spark, tx.date_key(F.col("a")), a=a) for a in ("2021年9月16日", "2021年9月", "2021.9", "2021年", "none")] == ["2021-09-16", "2021-09", "2021-09", "2021", "none"]


def page(spark, lines, n=100, no=10):
    df = spark.createDataFrame([("c", no, lines, n)], "company_id string, pdf_page int, lines array<string>, page_count int")
    return [(r["pattern"], r["prefix"], r["number"]) for r in p.page_number_candidates(df).orderBy("rank").collect()]


def test_page_numbers(spark):
    assert page(spark, ["某公司招股说明书 29 第四节"])[0] == ("PROSPECTUS_HEADER_BARE", None, 29)
    assert page(spark, ["x", "1-1-37"])[0] == ("EXACT_PREFIXED", "1-1", 37)
    assert page(spark, ["基金备案日期2016-12-30", "a 5-20 15-40 5-20"]) == []
    df = spark.createDataFrame([("c", i, None, None if i == 11 else i - 9, "MISSING" if i == 11 else "CONFIRMED") for i in (10, 11, 12, 13)], "company_id string, pdf_page int, prefix string, number int, status string")
    got = {r["pdf_page"]: (r["number"], r["status"]) for r in p.fill_numbers(df, p.page_segments(df)).collect()}
    assert got[11] == (2, "INFERRED")


def test_hierarchy_against_a_stack(spark):
    rng, rows, want = random.Random(3), [], {}
    for c in range(30):
        levels = [rng.choice([None, 0, 1, 2, 3, 4]) for _ in range(rng.randint(0, 12))]
        stack = []
        for i, lv in enumerate(levels):
            rows.append((str(c), i, i * 2, lv))
            stack = [] if lv is None else stack
            while stack and stack[-1][1] is not None and stack[-1][1] >= lv:
                stack.pop()
            nxt = next((j * 2 - 1 for j in range(i + 1, len(levels)) if lv is None or (levels[j] is not None and levels[j] <= lv)), 99)
            want[str(c), i] = (stack[-1][0] if stack else None, max(i * 2, nxt) if nxt != 99 else 99)
            stack.append((i, lv))
    df = spark.createDataFrame(rows, "company_id string, no int, page int, level int")
    got = df.select("company_id", "no", islands.parent(["company_id"], ["no"], "level", F.col("no")).alias("p"), islands.section_end(["company_id"], ["no"], "level", "page", F.lit(99)).alias("e"))
    assert {(r["company_id"], r["no"]): (r["p"], r["e"]) for r in got.collect()} == want


def test_first_fit_is_not_components(spark):
    s = spark.createDataFrame([("c", i, i, i, i) for i in range(1, 5)], "company_id string, section_no int, page int, start int, end int")
    e = spark.createDataFrame([("c", 3, 1), ("c", 3, 2), ("c", 4, 2)], "company_id string, a int, b int")
    assert {r["section_no"]: r["cluster"] for r in sec.first_fit(s, e).collect()} == {1: 1, 2: 2, 3: 1, 4: 2}


def test_first_fit_against_a_fold(spark):
    rng, rows, edges, want = random.Random(6), [], [], set()
    for c in "abc":
        pages = sorted(rng.randint(0, 900) for _ in range(60))
        mine = [(c, i, pg, pg * 10, pg * 10 + rng.choice([5, 400])) for i, pg in enumerate(pages)]
        rows += mine
        near = {(i, j) for i in range(60) for j in range(i) if (pages[i] - pages[j] <= 20 or mine[j][4] >= mine[i][3]) and rng.random() < 0.5}
        edges += [(c, i, j) for i, j in near]
        clusters = []
        for i in range(60):
            mine_ = next((k for k in clusters if any((i, j) in near for j in k)), None)
            clusters.append([i]) if mine_ is None else mine_.append(i)
        want |= {(c, i, n + 1) for n, k in enumerate(clusters) for i in k}
    s = spark.createDataFrame(rows, "company_id string, section_no int, page int, start int, end int")
    got = sec.first_fit(s, spark.createDataFrame(edges, "company_id string, a int, b int"))
    assert {tuple(r) for r in got.collect()} == want


def test_accepted_roots_and_near_copies(spark):
    h = spark.createDataFrame([("c", 1, 1, "A", True), ("c", 2, 3, "A", True), ("c", 3, 9, "A", True), ("c", 4, 9, "A", False)], "company_id string, seq int, page int, type string, dateless boolean")
    assert sorted(r["seq"] for r in sec.accepted_roots(h).collect()) == [1, 3, 4]
    e = spark.createDataFrame([("c", "k", 1, "abcdefgh"), ("c", "k", 2, "abcdefgx"), ("c", "k", 3, "12345678"), ("c", "k", 4, "zzzzyyyy")], "company_id string, category string, seq int, text string")
    assert sorted(r["seq"] for r in sec.near_copies_dropped(e).collect()) == [1, 3]


SECTION = "company_id string, section_no int, page int, type string, period string, ordinals array<string>, title string, start int, end int, provider boolean, timeline boolean"


@pytest.mark.parametrize("one_, other, merged", [
    ((10, "OVERALL_CHANGE", "2021-09-16", [], "a", 0, 5, False, False), (16, "OVERALL_CHANGE", "2021-09", [], "b", 60, 65, False, False), True),
    ((10, "OVERALL_CHANGE", "2021-09", [], "a", 0, 5, False, False), (23, "OVERALL_CHANGE", "2021-09", [], "b", 60, 65, False, False), False),
    ((10, "ABSORPTION_MERGER", "2021-01", [], "a", 0, 5, False, False), (30, "ABSORPTION_MERGER", "2022-02", [], "b", 90, 95, False, False), True),
    ((10, "EQUITY_TRANSFER", "2021-01", ["第一次"], "a", 0, 5, False, False), (10, "EQUITY_TRANSFER", "2021-01", ["第二次"], "a", 3, 9, False, False), False),
    ((10, "JOINT_STOCK_COMPANY_ESTABLISHMENT", None, [], "a", 0, 5, False, False), (13, "OVERALL_CHANGE", "2021", [], "b", 60, 65, False, False), True),
    ((10, "ABSORPTION_MERGER", None, [], "a", 0, 5, False, False), (14, "SHARE_CAPITAL_CHANGE", None, [], "吸收合并后变更", 60, 65, False, False), True),
    ((10, "CAPITAL_INCREASE", None, [], "a", 0, 5, False, False), (14, "SHARE_CAPITAL_CHANGE", None, [], "增资后变更", 60, 65, False, False), False),
    ((10, "CAPITAL_INCREASE", "2020", [], "本次增资", 0, 5, True, False), (13, "CAPITAL_INCREASE", "2021", [], "b", 60, 65, False, False), True),
    ((10, "CAPITAL_INCREASE", None, [], "a", 0, 900, False, False), (60, "CAPITAL_INCREASE", None, [], "b", 800, 950, False, False), True),
    ((10, "CAPITAL_INCREASE", None, [], "第一次增资情况", 0, 5, False, False), (12, "CAPITAL_INCREASE", None, [], "第一次增资的情况", 60, 65, False, False), True),
    ((10, "CAPITAL_INCREASE", None, [], "abc", 0, 5, False, True), (22, "CAPITAL_INCREASE", "2021", [], "xyz", 60, 65, False, False), True),
    ((10, "CAPITAL_INCREASE", None, [], "abc", 0, 5, False, False), (11, "EQUITY_TRANSFER", None, [], "abc", 3, 65, False, False), False),
])
def test_merge_rules(spark, one_, other, merged):
    df = spark.createDataFrame([("c", 1, *one_), ("c", 2, *other)], SECTION)
    assert [(r["a"], r["b"]) for r in sec.merge_edges(df).collect()] == ([(2, 1)] if merged else [])


def test_pairs_of_sections_are_made_in_many_tasks(spark, tmp_path):
    """Sections of one small file meet in several tasks; undecided pairs alone have their titles measured."""
    rows = [(f"c{i % 8}", i, i // 40, "CAPITAL_INCREASE", None, [], ["第一次增资情况", "第一次增资的情况", "abc"][i % 3], i * 10, i * 10 + 5, False, False) for i in range(320)]
    spark.createDataFrame(rows, SECTION).coalesce(1).write.parquet(f"{tmp_path}/sections")
    got = sec.merge_edges(spark.read.parquet(f"{tmp_path}/sections"))
    assert sum(n > 0 for n in got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()) > 2
    flat = {r[1]: r for r in rows}
    alike = lambda a, b: flat[a][6] == flat[b][6] or "abc" not in (flat[a][6], flat[b][6])
    want = {(a, b) for a in flat for b in flat if b < a and flat[a][0] == flat[b][0] and flat[a][2] - flat[b][2] <= 2 and alike(a, b)}
    assert {(r["a"], r["b"]) for r in got.collect()} == want


def test_roots_of_a_page(spark):
    """Summaries, particulars, references and wrappers head no section; a bare heading soon after its kind goes; a nested child goes."""
    lines = [
        (10, "（一）公司前身赛分有限的设立情况"), (10, "2009年3月16日，赛分有限取得营业执照。"), (10, "公司进行了四次股权转让和四次增资。"), (11, "股份公司成立日期2015年"), (11, "一、2021年4月，吸收合并"), (11, "（一）股权转让"),
        (12, "（二）发行人报告期内的重大资产重组情况"), (13, "二、增资"), (14, "（一）增资"), (15, "三、2020年5月，第二次增资"), (15, "报告期内，公司未发生重大资产重组。"),
    ]
    df = spark.createDataFrame([("c", i, pg, s) for i, (pg, s) in enumerate(lines)], "company_id string, global_index int, page int, line string")
    a = sec.annotated(df)
    roots = sec.root_headings(a)
    assert {r["global_index"]: r["type"] for r in roots.collect()} == {0: "LIMITED_COMPANY_ESTABLISHMENT", 4: "ABSORPTION_MERGER", 5: "EQUITY_TRANSFER", 7: "CAPITAL_INCREASE", 9: "CAPITAL_INCREASE"}
    got = sec.heading_sections(roots.withColumn("negative", F.lit(False)))
    assert {r["global_index"]: r["accepted"] for r in got.collect()} == {0: True, 4: True, 5: False, 7: True, 9: True}
    assert {r["global_index"]: r["summary_kind"] for r in sec.summary_disclosures(a).collect()} == {2: "AGGREGATE_EVENT_SUMMARY", 6: "CLASSIFICATION_WRAPPER"}
    neg = sec.section_negatives(a, spark.createDataFrame([("c", 9, 10), ("c", 0, 1)], "company_id string, global_index int, end_index int"))
    assert {r["global_index"]: r["negative"] is not None for r in neg.collect()} == {9: True, 0: False}


def test_coverage_gap_of_unexpanded_history(spark):
    s = spark.createDataFrame([("c", 1, "AGGREGATE_EVENT_SUMMARY", {"EQUITY_TRANSFER": 4, "CAPITAL_INCREASE": 4}, "详见公开转让说明书"), ("c", 2, "TIMELINE_SUMMARY_ROW", {"CAPITAL_INCREASE": 4, "EQUITY_TRANSFER": 4}, "x"), ("c", 3, "METADATA_DATE_FIELD", {"CAPITAL_INCREASE": 9}, "x")], "company_id string, seq int, summary_kind string, counts map<string,int>, text string")
    found = spark.createDataFrame([("c", "EQUITY_TRANSFER", 4)], "company_id string, type string, n int")
    assert [(r["seq"], r["gap_type"], r["type"], r["missing"]) for r in sec.coverage_gaps(s, found).collect()] == [(1, "REFERENCE_LIMITED_AGGREGATE_HISTORY", "CAPITAL_INCREASE", 4)]


def test_rule_documents(spark, tmp_path):
    from dossier.functions.rules import read_event_rules

    (tmp_path / "r.json").write_text('{"heading_suffixes": ["沿革"]}')
    r = read_event_rules(spark, f"{tmp_path}/r.json")
    assert one(spark, units.heading_like(F.col("a"), r), a="公司沿革") and not one(spark, units.heading_like(F.col("a")), a="公司沿革")
    (tmp_path / "x.json").write_text('{"no_such": 1}')
    with pytest.raises(ValueError):
        read_event_rules(spark, f"{tmp_path}/x.json")


def test_complete_categories_are_not_compared(spark):
    """After two kept texts the rest of a category costs no comparison; null categories are one group, and a null text is like none."""
    slow = ["".join(random.Random(i).choice("甲乙") for _ in range(1000)) for i in range(2)]
    df = spark.createDataFrame([("c", "k", 1, "first"), ("c", "k", 2, slow[0]), ("c", None, 1, None), ("c", None, 2, None), ("c", None, 3, "x")], "company_id string, category string, seq int, text string")
    rest = spark.range(3, 3000).select(F.lit("c").alias("company_id"), F.lit("k").alias("category"), F.col("id").cast("int").alias("seq"), F.lit("first" + slow[1][:995]).alias("text"))
    got = sorted((r["category"] or "", r["seq"]) for r in sec.near_copies_dropped(df.unionByName(rest)).collect())
    assert got == [("", 1), ("", 2), ("k", 1), ("k", 2)]
    plan = sec.near_copies_dropped(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_shareholder_evidence_judges_all_events(spark):
    from difflib import SequenceMatcher

    from dossier.plans import sections as events

    d, kept = "/root/testdata/sf0.001", {}
    rows = events.view(spark, d, events.EVENTS).select("company_id", "event_type", "event_id", F.concat("event_type", "event_date")).collect()
    for company, kind, seq, text in sorted(rows, key=lambda r: r[2]):
        k = kept.setdefault((company, kind), [])
        if len(k) < 2 and all(SequenceMatcher(None, text, t).ratio() < 0.76 for _, t in k):
            k.append((seq, text))
    want = sorted((c, kind, seq) for (c, kind), k in kept.items() for seq, _ in k)
    assert sorted(map(tuple, events.shareholder_evidence(spark, d).collect())) == want


def test_near_copies_against_a_fold(spark):
    from difflib import SequenceMatcher

    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice(["k", None]), i, "".join(rng.choice("xyz") for _ in range(6))) for i in range(80)]
    e, kept = spark.createDataFrame(rows, "company_id string, category string, seq int, text string"), {}
    for c, g, seq, text in rows:
        k = kept.setdefault((c, g), [])
        if len(k) < 3 and all(SequenceMatcher(None, text, t).ratio() < 0.6 for _, t in k):
            k.append((seq, text))
    want = {(*g, seq) for g, k in kept.items() for seq, _ in k}
    assert {tuple(r) for r in sec.near_copies_dropped(e, 0.6, 3).collect()} == want


def test_cover(spark):
    pts = spark.createDataFrame([("c", i) for i in range(200)], "k string, at int")
    spans = spark.createDataFrame([("c", 10, 90), ("c", 150, 150)], "k string, s int, e int")
    assert islands.cover(pts, spans, "k", "at", "s", "e").count() == 82
    assert islands.cover(pts, spans, "k", "at", "s", "e", "left_anti").count() == 118


@pytest.mark.parametrize("name, status", [
    ("序号发行对象名称", "EXCLUDED_NOISE"), ("数量（股", "EXCLUDED_NOISE"), ("50元的价格", "EXCLUDED_NOISE"), ("上海测试股权投资基金合伙企业（有限合伙）", "PEVC_CANDIDATE"), ("达晨创联基金", "PEVC_CANDIDATE"), ("并购基金", "PEVC_CANDIDATE"),
    ("深圳测试创业投资有限公司", "PEVC_CANDIDATE"), ("股权投资有限公司", "POSSIBLE_PEVC"), ("资产管理有限公司", "POSSIBLE_PEVC"), ("张三", "NOT_PEVC"), ("资本有限公司", "NOT_PEVC_OR_UNRESOLVED_STRATEGIC"), ("某某实业有限公司", "NOT_PEVC_OR_UNRESOLVED_STRATEGIC"), ("x1", "EXCLUDED_LOW_QUALITY"),
])
def test_investor_classes(spark, name, status):
    assert one(spark, k.classify(F.col("a")), a=name)["status"] == status


def test_names_and_evidence_of_investors(spark):
    text = "前公司股东泽升贸易、罗世兵、共青城泽升、达晨创联基金参与本次增资"
    assert one(spark, k.split_names(F.col("a")), a=text) == ["泽升贸易", "罗世兵", "共青城泽升", "达晨创联基金"]
    rows = [("603418", 1, "T1", "CAPITAL_INCREASE", text), ("123456", 2, "T2", "EQUITY_TRANSFER", "原股东将股权转让给测试投资有限公司"), ("001282", 3, "T3", "CAPITAL_INCREASE", "芜湖三联锻造股份有限公司增资"), ("9", 4, "T4", "DIRECTIONAL_FINANCING", "发行对象名称上海测试股权投资基金合伙企业（有限合伙）认购100万股")]
    texts = spark.createDataFrame(rows, "company_id string, event_id int, transaction_id string, transaction_type string, text string")
    alias = k.issuer_aliases(spark.createDataFrame([("603418", "友升股份"), ("001282", "三联锻造")], "company_id string, company_short_name string"))
    got = k.evidence_candidates(texts, alias)
    names = {(r["event_id"], r["name"]) for r in got.collect()}
    assert (1, "达晨创联基金") in names and not any("、" in n for _, n in names) and (4, "上海测试股权投资基金合伙企业（有限合伙）") in names
    assert any("测试投资有限公司" in n for i, n in names if i == 2) and not [n for i, n in names if i == 3]
    ents = k.entities(got)
    p = k.paths(ents, texts)
    assert {r["entry_method"] for r in p.collect()} == {"CAPITAL_INCREASE_ENTRY", "TRANSFER_ENTRY"}
    own, others, fund_paths = k.pevc_only(ents, p)
    assert "达晨创联基金" in {r["name"] for r in own.collect()} and "罗世兵" in {r["name"] for r in others.collect()} and fund_paths.count() == own.count()
    assert k.path_problems(p, ents, alias, p.select("company_id", "key", "transaction_id")).count() == 0


@pytest.mark.parametrize("text, names", [
    ("公司吸收合并昆山测试有限公司，昆山测试依法注销。", {"昆山测试有限公司"}), ("公司吸收合并昆山测试有限公司，被吸收合并方为昆山测试有限公司；吸收合并前昆山测试基本情况如下。", {"昆山测试有限公司"}), ("吸收合并情况如下，", set()), ("吸收合并的乙有限公司", set()),
])
def test_absorbed_parties(spark, text, names):
    e = spark.createDataFrame([("c", 1, 1, text)], "company_id string, event_id int, evidence_id int, evidence_text string")
    assert {r["party_name"] for r in x.extract_parties(e).where("party_role = 'ABSORBED_ENTITY'").collect()} == names


def test_closing_marks_are_not_consumed(spark):
    e = spark.createDataFrame([("c", 1, 1, "张三将其持有的股份转让给李四受让方为王五。")], "company_id string, event_id int, evidence_id int, evidence_text string")
    assert {r["party_name"] for r in x.extract_parties(e).where("party_role = 'TRANSFEREE'").collect()} >= {"李四", "王五"}


def test_referential_problems(spark):
    ev = spark.createDataFrame([("c", 1, "CE1", ["OVERALL_CHANGE", "JOINT_STOCK_COMPANY_ESTABLISHMENT"], 5, 4), ("c", 2, "CE2", ["EQUITY_TRANSFER"], 1, 2)], "company_id string, event_id int, candidate_event_id string, event_types array<string>, pdf_page_start int, pdf_page_end int")
    tr = spark.createDataFrame([("c", 2, "EQUITY_TRANSFER"), ("c", 7, "CAPITAL_INCREASE")], "company_id string, event_id int, transaction_type string")
    pa_ = spark.createDataFrame([("c", 1, "TRANSFEROR"), ("c", 2, "TRANSFEROR"), ("c", 9, "INVESTOR")], "company_id string, event_id int, party_role string")
    fa = spark.createDataFrame([("c", 8, "SHARE_PRICE")], "company_id string, event_id int, fact_type string")
    ca = spark.createDataFrame([("c", "CE1"), ("c", "CE3")], "company_id string, candidate_event_id string")
    got = {(r["event_id"], r["problem"]) for r in x.referential_problems(ev, tr, fa, pa_, ca, expected=3).collect()}
    assert got == {(8, "fact_without_event"), (9, "party_without_event"), (7, "transaction_without_event"), (1, "transfer_party_without_transfer"), (1, "overall_change_and_joint_stock"), (1, "pages_reversed"), (None, "candidate_without_event"), (None, "event_count")}


@pytest.mark.parametrize("opening, own", [
    ("（一）公司前身谷捷有限的设立情况\n2009年3月16日，谷捷有限取得营业执照。", True), ("（一）昆山谷捷金属制品有限公司设立情况", False), ("公司吸收合并谷捷有限，\n谷捷有限成立于2009年", False), ("2009年谷捷有限成立日期如下，公司设立", False), ("谷捷有限召开会议", False),
])
def test_own_establishment(spark, opening, own):
    assert one(spark, narrative.own_establishment(F.col("a"), F.lit("黄山谷捷")), a=opening) == own


def test_subjects(spark):
    got = lambda text, name: one(spark, narrative.other_subjects(F.col("a"), F.lit(name)), a=text)
    assert got("，壬癸股东大会审议通过", "黄山谷捷") == ["壬癸"] and got("一有限公司设立情况", "黄山谷捷") == [] and got("谷捷有限设立情况", "黄山谷捷") == []
    assert got("公司吸收合并谷捷有限，谷捷有限设立", "黄山谷捷") == ["谷捷有限"]
    names = spark.createDataFrame([("c", "谷捷金属制品有限公司"), ("c", "谷捷有限")], "company_id string, name string")
    assert narrative.best_predecessor(names, spark.createDataFrame([("c", "黄山谷捷")], "company_id string, issuer string")).first()["predecessor"] == "谷捷有限"
    assert set(one(spark, narrative.issuer_tokens(F.col("a")), a="测量测控电子股份公司")) == {"测量测控电子股份公司", "测量测控电子股份", "测量测控电子", "测量测控", "测量"}


def test_links_need_their_parties(spark):
    t_ = spark.createDataFrame([("c", 1, "T1", "EQUITY_TRANSFER", ["a"], ["b"], []), ("c", 2, "T2", "EQUITY_TRANSFER", [], ["x"], None), ("c", 3, "T3", "CAPITAL_INCREASE", [], [], []), ("c", 4, "T4", "ABSORPTION_MERGER", None, None, None)], "company_id string, event_id int, transaction_id string, transaction_type string, transferor_party_ids array<string>, transferee_party_ids array<string>, absorbed_party_ids array<string>")
    ps = spark.createDataFrame([("c", 1, "a"), ("c", 1, "b")], "company_id string, event_id int, party_id string")
    got = {r["transaction_id"]: (r["status"], r["missing_fields"], r["missing"]) for r in v.check_links(t_, ps).collect()}
    assert got == {"T1": ("PASSED", [], []), "T2": ("REVIEW_REQUIRED", ["transferor_party_ids"], ["x"]), "T4": ("REVIEW_REQUIRED", ["absorbed_party_ids"], [])}


def test_gate_and_packages(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "company_id string, n int")
    k.assert_metrics(df, "n > 0")
    with pytest.raises(ValueError):
        k.assert_metrics(df, "n > 1")
    k.write_packages(str(tmp_path), facts=df)
    assert spark.read.json(f"{tmp_path}/facts/company_id=b").first()["n"] == 2
    assert t.read_json_document(spark, t_json(tmp_path)).first()["b"] == [1, 2]


def t_json(tmp_path):
    (tmp_path / "d.json").write_text('{"a": 1,\n "b": [1, 2]}')
    return f"{tmp_path}/d.json"


def test_snapshot_needs_a_party(spark):
    f = spark.createDataFrame([("a", "EQUITY_RATIO", None), ("b", "EQUITY_RATIO", "p")], "company_id string, fact_type string, party_id string")
    c = spark.createDataFrame([("a",), ("b",), ("c",)], "company_id string")
    assert {r[0]: r[1] for r in k.snapshot_status(f, c).collect()} == {"a": "RATIOS_WITHOUT_PARTY", "b": "SNAPSHOT", "c": "NO_RATIOS"}


def test_guard_and_unique(spark):
    with pytest.raises(ValueError):
        k.guard_rules({"a": [{"known_investor": 1}]})
    with pytest.raises(ValueError):
        p.assert_unique(spark.createDataFrame([(1,), (1,)], "a int"), ["a"])


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": 1})], "id int, l array<string>, m map<string,int>")
    t.write_jsonl(df, f"{tmp_path}/j")
    assert t.read_jsonl(spark, f"{tmp_path}/j", df.schema).collect() == df.collect()
    t.write_flat_csv(df, f"{tmp_path}/c", ["id", "l", "m", "none"], ";")
    r = t.read_csv(spark, f"{tmp_path}/c", "id int, l string, m string, none string").first()
    assert (r["l"], r["m"], r["none"]) == ("a;b", '{"k":1}', None)
    t.save_run(df, str(tmp_path), "s", "r1")
    with pytest.raises(Exception):
        t.save_run(df, str(tmp_path), "s", "r1")
    with pytest.raises(FileNotFoundError):
        t.require_tables(spark, {"x": f"{tmp_path}/none"})
    (tmp_path / "f.pdf").write_bytes(b"abc")
    assert t.scan_documents(spark, str(tmp_path)).first()["size_bytes"] == 3


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, "2021年9月，第一次股权转让"), (2, "一般内容")], "id int, line string")
    df.write.parquet(f"{tmp_path}/in")
    s = se.annotated(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
    q = s.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination(60)
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(map(str, se.annotated(df).collect()))


def test_a_partys_name_is_worked_out_once(spark):
    """The plan of parties holds the expressions of a name once, and a name is searched only in runs of characters that hold a word after it."""
    texts = ["甲" * 50 + "认购，乙公司认购丙公司增资入股", "张三将其持有的股份转让给李四。", "无", None, "王五受让公司股权"]
    e = spark.createDataFrame([("c", 1, i, t) for i, t in enumerate(texts)], "company_id string, event_id int, evidence_id int, evidence_text string")
    df = x.extract_parties(e)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") < 20
    for i, (_, p, _) in enumerate(x.PARTIES):
        got = e.select(x._name_matches(F.coalesce("evidence_text", F.lit("")), p).alias("a"), F.regexp_extract_all(F.coalesce("evidence_text", F.lit("")), F.lit(p), F.lit(0)).alias("b")).collect()
        assert all(r.a == r.b for r in got), i
    numbers = spark.createDataFrame([("1,2万元34股5股..6%7%%，8股12.5万股元9",), ("注册资本由1万元增加至1,234.50万元",)], "t string")
    for _, p, _ in x.NUMERIC:
        r = numbers.select(F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias("a"), F.regexp_extract_all("t", F.lit(x.possessive(p)), F.lit(0)).alias("b")).collect()
        assert all(q.a == q.b for q in r), p


def test_pages_without_a_number_are_dealt_and_pages_met_once(spark):
    rows = [("c", i, None, None, "MISSING") for i in range(1, 201)] + [("c", i, "1-1", i - 2, "CONFIRMED") for i in (300, 301, 304)] + [("c", i, None, None, "MISSING") for i in (302, 303, 305)]
    n = spark.createDataFrame(rows, "company_id string, pdf_page int, prefix string, number int, status string")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        w = p.confirm_weak(n)
        tasks = w.where("status = 'MISSING'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
        filled = p.fill_numbers(w, p.page_segments(w))
        assert filled._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    got = {r["pdf_page"]: (r["prefix"], r["number"], r["status"]) for r in filled.where("pdf_page >= 300").collect()}
    assert got == {300: ("1-1", 298, "CONFIRMED"), 301: ("1-1", 299, "CONFIRMED"), 302: ("1-1", 300, "INFERRED"), 303: ("1-1", 301, "INFERRED"), 304: ("1-1", 302, "CONFIRMED"), 305: (None, None, "MISSING")}


def test_candidates_of_edge_lines_keep_every_form(spark):
    lines = ["1-1-5", "1 - 1 - 6", "第 7 页", "x招股说明书：1-1-8", "招股说明书 9 节", "1999", "2001年5月", "12", "12-3", "1—1—4"]
    pages = spark.createDataFrame([("c", 1, 10, lines)], "company_id string, pdf_page int, page_count int, lines array<string>")
    got = {(r["line_index"], r["position"], r["pattern"], r["prefix"], r["number"]) for r in p.page_number_candidates(pages).collect()}
    both = {(i, at, "EXACT_PREFIXED" if pre else "EXACT_CHINESE", pre, no) for i, pre, no in ((0, "1-1", 5), (1, "1-1", 6), (2, None, 7), (9, "1-1", 4)) for at in (["HEADER"] if i < 2 else ["FOOTER"] if i > 7 else ["HEADER", "FOOTER"])}
    assert got == both | {(3, "HEADER", "PROSPECTUS_HEADER_PREFIXED", "1-1", 8), (7, "FOOTER", "EXACT_BARE", None, 12)}


def test_lines_that_head_nothing_leave_before_titles_are_worked_out(spark):
    from dossier.operators import headings as h

    lines = ["一、股本演变情况", "（一）", "历次增资情况", "一般内容", "发行人 基本情况", "1"]
    pages = spark.createDataFrame([("c", i, lines, False) for i in (1, 2)], "company_id string, pdf_page int, lines array<string>, is_toc boolean")
    got = h.headings(h.page_lines(pages), p.repeated_edge_lines(pages))
    assert {(r["pdf_page"], r["line_index"], r["merged"], r["core"]) for r in got.collect()} == {(i, *x) for i in (1, 2) for x in ((0, False, "股本演变情况"), (1, True, "历次增资情况"), (4, False, "发行人基本情况"))}
    left = h.heading_units(h.page_lines(pages), only=lambda own: own.rlike("^一、|发行人基本"))
    assert {r["flat"] for r in left.collect()} == {"一、股本演变情况", "发行人基本情况"}
    assert {(r["line"], r["pages"]) for r in p.repeated_edge_lines(pages).collect()} == {(x, 2) for x in ("一、股本演变情况", "（一）", "历次增资情况", "一般内容", "发行人基本情况")}
