"""All registered queries outside of the text operators: name, Spark function, DuckDB counterpart or None."""

from __future__ import annotations

from . import calls_queries, extract_queries, import_queries, matching_queries, report_queries, resolve_queries, result_queries, rule_queries

GROUPS = [calls_queries, matching_queries, report_queries, result_queries, rule_queries, resolve_queries, extract_queries, import_queries]


def queries() -> dict:
    return {name: pair[0] for g in GROUPS for name, pair in g.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: pair[1] for g in GROUPS for name, pair in g.QUERIES.items() if pair[1]}
