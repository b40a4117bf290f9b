"""The registered queries of the text operators and, where SQL can say it, their DuckDB counterparts."""

from __future__ import annotations

from . import q01_simhash, q02_pii, q03_toxicity, q04_decontamination, q05_quality, q06_bpe, q08_chat, q09_html, q10_quality_rules, q11_prefix_trie, q12_digest, q13_alignment

MODULES = [q01_simhash, q02_pii, q03_toxicity, q04_decontamination, q05_quality, q06_bpe, q08_chat, q09_html, q10_quality_rules, q11_prefix_trie, q12_digest, q13_alignment]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
