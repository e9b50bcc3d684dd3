"""All registered core queries and their SQL."""

from __future__ import annotations

from ..operators import timestamps
from . import dedupe_queries, report_queries, rollup_queries, scalar_queries

_MODULES = (dedupe_queries, rollup_queries, scalar_queries, report_queries)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()} | {"p4_found": timestamps.p4_found, "p4_normalized": timestamps.p4_normalized}

SQL: dict[str, str] = {name: text for m in _MODULES for name, text in m.SQL.items()}
