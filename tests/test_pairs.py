"""Pairs of sections and their clusters beside a plain fold over all pairs."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from dossier.functions.rules import EVENT_RULES as R
from dossier.operators import sections as sec

SECTION = "company_id string, section_no int, page int, type string, period string, ordinals array<string>, title string, start int, end int, provider boolean, timeline boolean"
TYPES = ["ABSORPTION_MERGER", "SHARE_CAPITAL_CHANGE", "OVERALL_CHANGE", "JOINT_STOCK_COMPANY_ESTABLISHMENT", "CAPITAL_INCREASE", "EQUITY_TRANSFER", None]
TITLES = ["本次增资 情况", "第一次增资情况", "整体变更后", "吸收合并后增资后", "abcdefgh", "股权转让", None]


def rows_of(seed: int, n: int) -> list[tuple]:
    rng, out = random.Random(seed), []
    for i in range(n):
        page, start = rng.randrange(90), rng.randrange(900)
        period = rng.choice([None, "", "2021", "2021-0", "2021-09", "2021-09-16", "2022-01", "2022-01-05"])
        labels = rng.choice([[], [], ["第一次"], ["第二次"], ["第一次", "第二次"], ["第三次", None]])
        out.append((rng.choice("ab"), i, rng.choice([page] * 30 + [None]), rng.choice(TYPES), period, labels, rng.choice(TITLES), rng.choice([start] * 20 + [None]), start + rng.choice([5, 9, 200]), rng.random() < 0.2, rng.random() < 0.2))
    return out


def belongs(a: tuple, b: tuple) -> bool:
    (ta, pa, oa, na, sa, ea, va, la), (tb, pb, ob, nb, sb, eb, vb, lb) = a[3:], b[3:]
    na, nb = ("".join((x or "").split()) for x in (na, nb))
    gap, g = a[2] - b[2], R.gaps
    over = None not in (sa, sb) and sa <= eb and sb <= ea
    if oa and ob and not set(oa) & set(ob) and None not in [*oa, *ob]:
        return False
    if ta != tb:
        for x in R.consequences:
            if {ta, tb} <= set(x["types"]):
                return gap <= x["gap"] and any(m in na + nb for m in x["markers"])
        return any({ta, tb} <= set(x["types"]) and (over or gap <= x["gap"]) for x in R.equivalent)
    if ta == "ABSORPTION_MERGER" and gap <= g["merger"] or (va or vb) and gap <= g["provider"] and ("本次" in na or "本次" in nb):
        return True
    if pa and pb:
        return (pa.startswith(pb) or pb.startswith(pa) or pa[:7] == pb[:7]) and gap <= g["period"]
    return over or (la or lb) and gap <= g["timeline"] or gap <= g["untold"] and SequenceMatcher(None, na, nb).ratio() >= R.title_similarity


def all_edges(rows: list[tuple]) -> set[tuple]:
    told = [r for r in rows if None not in (r[2], r[3])]
    return {(a[0], a[1], b[1]) for a in told for b in told if a[0] == b[0] and (b[2], b[1]) < (a[2], a[1]) and belongs(a, b)}


def test_edges_and_clusters_against_a_fold(spark):
    """More rows than a chunk holds, unknown values, periods of all lengths, units that don't follow the pages."""
    rows = rows_of(3, 700)
    df, edges = spark.createDataFrame(rows, SECTION).repartition(5), all_edges(rows)
    got = [tuple(r) for r in sec.merge_edges(df).collect()]
    assert len(got) == len(set(got)) and set(got) == edges
    heads, want = {}, {}
    for r in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[1])):
        near = [heads[r[0], b] for c, a, b in edges if (c, a) == (r[0], r[1])]
        heads[r[0], r[1]] = min(near) if near else (-1 if r[2] is None else r[2], r[1])
    for c in "ab":
        order = sorted({h for (k, _), h in heads.items() if k == c})
        want |= {k: order.index(h) + 1 for k, h in heads.items() if k[0] == c}
    assert {(r["company_id"], r["section_no"]): r["cluster"] for r in sec.clustered(df).collect()} == want
    plain = df.where("page is not null and type is not null")
    assert sorted(map(tuple, sec.clustered(plain).collect())) == sorted(map(tuple, sec.first_fit(plain.withColumn("start", F.coalesce("start", F.lit(10**6))), sec.merge_edges(plain), 10**6).collect()))


def test_pairs_are_no_rows(spark):
    """Sections that meet become no rows of a join: what isn't an edge costs a cell of a matrix, and clusters need no edges."""
    df = spark.createDataFrame(rows_of(4, 20), SECTION)
    for got in (sec.merge_edges(df), sec.clustered(df)):
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_members_of_a_cluster_are_put_together_by_their_ordinals(spark):
    rows = [("c", 3, 1, "A", None, ["第二次"], "x", 0, 1, False, False), ("c", 1, 2, "B", "2021", ["第一次", "第二次"], "y", 0, 1, False, False), ("c", 2, 2, "A", "2020", ["第二次"], "z", 0, 1, False, False), ("c", 4, 9, "A", None, [], "z", 0, 1, False, False), ("c", 5, 9, "A", None, None, "z", 0, 1, False, False)]
    df = spark.createDataFrame(rows, SECTION)
    r = sec.cluster_members(df, df.select("company_id", "section_no", F.lit(1).alias("cluster"))).collect()[0]
    assert (r["title"], r["type"], sorted(r["types"]), r["first_page"], r["last_page"], r["period"], r["labels"], r["members"]) == ("x", "A", ["A", "B"], 1, 9, "2021", ["第二次", "第一次"], 5)
