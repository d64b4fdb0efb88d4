"""All queries of the corpus operators, and their SQL."""

from __future__ import annotations

from wordloom.plans import alignment, corpus, files, records, scoring

_PLANS = [scoring, alignment, corpus, files, records]
QUERIES = {name: f for plan in _PLANS for name, f in plan.QUERIES.items()}
ORACLE_SQL = {name: sql for plan in _PLANS for name, sql in plan.ORACLE_SQL.items()}
