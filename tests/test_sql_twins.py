"""Registered queries beside their SQL on the smallest tables; tools/verify.py does the same for all of them."""

from pathlib import Path

import duckdb
import pytest

from dossier.plans import registry

D = "/root/testdata/sf0.001"
NAMES = [
    "capital_check", "chronology", "transactions", "page_number_candidates", "toc_pages", "event_types", "merge_edges", "section_clusters", "cluster_summary", "heading_sections", "accepted_roots", "summary_disclosures", "coverage_gaps", "fallback_windows", "named_entities", "issuer_tokens",
    "investment_paths", "evidence_candidates", "path_problems", "link_check", "absorbed_parties", "ranking_inputs", "patch_records", "packages", "review_rows", "gold_cross_check", "latest_runs", "flat_table", "snapshots", "section_texts", "resolved_pages",
]


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    show = lambda v: "~" if v is None else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not Path(D).exists(), reason="no tables here")
@pytest.mark.parametrize("name", [n for n in NAMES if n in registry.queries()])
def test_twin(spark, name):
    con = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    df = registry.queries()[name](spark, D)
    cur = con.execute(registry.oracle_sql()[name])
    theirs = cur.fetchall()
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(theirs, cols)


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
