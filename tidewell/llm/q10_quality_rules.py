"""Query of the quality rules over the whole documents table, and its DuckDB counterpart."""

from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .quality_rules import BOILERPLATE, SENTENCE_END, LineRules, measure


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def fails_sql(line: str, rules: LineRules = LineRules()) -> str:
    """The line rules as a DuckDB expression over the column or lambda variable line."""
    quoted = lambda x: x.replace("'", "''")
    n = rf"len(list_filter(regexp_split_to_array({line}, '[\x20\x09-\x0D]+'), lambda v: v <> ''))"
    boilerplate = BOILERPLATE.partition(")")[2]  # without the look-ahead, which only saves time
    return f"""({n} > 0 AND (
        length({line}) - length(replace({line}, '|', '')) >= {rules.max_bars}
        OR length(regexp_replace({line}, '[^#*$%&|<>]+', '', 'g')) > {rules.symbols_per_words} * {n}
        OR length({line}) - length(replace({line}, '!!', '')) > {2 * rules.shouts_per_words} * {n}
        OR ({n} >= {rules.no_end_words} AND NOT regexp_matches({line}, '{quoted(SENTENCE_END)}'))
        OR regexp_matches({line}, '{quoted(boilerplate)}')))"""


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             string_split(t, chr(10)) AS ls FROM d),
win AS (SELECT r, i, ws[i : i + 7] AS x FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
ln AS (SELECT r, list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lw,
              list_sum(list_transform(list_filter(ls, lambda x: {fails_sql("x")}), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')))) AS lost FROM w),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lw) - len(list_distinct(lw)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM w JOIN ln USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost <= {LineRules().max_loss} * word_chars) AS kept
FROM f
"""

QUERIES = {"op10_quality_rules": op10_quality_rules}
ORACLE_SQL = {"op10_quality_rules": SQL}
