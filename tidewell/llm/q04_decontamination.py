"""Query of benchmark decontamination over the whole documents table, and its DuckDB counterpart."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .decontamination import contamination


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.col("n_near").alias("n_near_items"),
    )


WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
b AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
p AS (SELECT r, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: {{'i': i, 'w': array_to_string(ws[i : i + n - 1], ' ')}})) AS x
      FROM d, (SELECT DISTINCT n FROM bw) k WHERE len(ws) >= n),
m AS (SELECT p.r, x.i AS i, p.n, bw.item_id FROM p JOIN bw ON bw.n = p.n AND bw.w = x.w),
h AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM m) GROUP BY r),
tk AS (SELECT DISTINCT item_id, ws, unnest(ws) AS w FROM b),
df AS (SELECT w, count(*) AS df FROM (SELECT unnest(ws) AS w FROM d) GROUP BY w),
rk AS (SELECT item_id, ws, w, coalesce(df, 0) AS df, row_number() OVER (PARTITION BY item_id, ws ORDER BY coalesce(df, 0), w) AS k, least(3, count(*) OVER (PARTITION BY item_id, ws)) AS need FROM tk LEFT JOIN df USING (w)),
ne AS (SELECT *, min(df) OVER (PARTITION BY item_id, ws) AS least FROM rk WHERE k <= 3),
ps AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
me AS (SELECT r, item_id, need, count(DISTINCT ps.w) OVER (PARTITION BY r, item_id, ne.ws ORDER BY pos RANGE BETWEEN 19 PRECEDING AND CURRENT ROW) AS met FROM ps JOIN ne ON ne.w = ps.w AND least > 0),
nr AS (SELECT r, count(DISTINCT item_id) AS n FROM me WHERE met = need GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(nr.n, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN h USING (r) LEFT JOIN it USING (r) LEFT JOIN nr USING (r)
"""

QUERIES = {"op4_decontamination": op4_decontamination}
ORACLE_SQL = {"op4_decontamination": SQL}
