"""The registered queries over the driver's tables, with their SQL twins."""

from __future__ import annotations

from . import candidates, contracts, events, filings, investing, narratives, paging, sections, storage

MODULES: list = [filings, paging, sections, candidates, events, investing, contracts, narratives, storage]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
