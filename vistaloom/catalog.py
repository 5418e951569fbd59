"""Registered queries of the engine and their reference SQL."""

from __future__ import annotations

from vistaloom.plans import check_queries, question_queries, record_queries, relation_queries, reshape_queries, source_queries, space_queries, text_queries

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (check_queries, question_queries, record_queries, relation_queries, reshape_queries, source_queries, space_queries, text_queries):
    QUERIES |= _module.query.queries
    ORACLE_SQL |= _module.query.oracle_sql
FLAGSHIP = "rel2d_directions"
