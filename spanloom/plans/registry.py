"""Every query of the library outside the training-data subpackage, by name."""

from __future__ import annotations

from spanloom.plans import cascade_queries, consensus_queries, interval_queries, report_queries, rollup_queries, sequence_queries

MODULES = (interval_queries, rollup_queries, cascade_queries, consensus_queries, report_queries, sequence_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
