"""Queries of evidence, roll-ups, ordered windows, queues and import over documents, pages and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import keys
from tidewell.functions import text as tx
from tidewell.operators import evidence, rollups, scheduling
from tidewell.sources.tables import last_by_key, table

md5 = lambda c: F.md5(F.encode(c, "UTF-8"))

LINES_CTE = r"""
raw AS (SELECT lang, source, doc_id, n_chars, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
lines AS (SELECT source, doc_id, n_chars, i, trim(regexp_replace(x, '[ \t\r\f\x0b]+', ' ', 'g'))[1:500] AS line FROM raw WHERE length(trim(regexp_replace(x, '[ \t\r\f\x0b]+', ' ', 'g'))) >= 3),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, lower(line) ORDER BY n_chars DESC, doc_id, i) AS r FROM lines) WHERE r = 1),
numbered AS (SELECT source, doc_id, n_chars, i, line, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id, i) AS n FROM firsts)
"""


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return evidence.numbered_lines(table(spark, d, "documents").select("source", "doc_id", "n_chars", "text"), "source", "doc_id", "n_chars")


def evidence_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sources as entities, documents as pages, longest first: every line once, numbered."""
    return _numbered(spark, d).select("source", "doc_id", "n", md5(F.col("line")).alias("line_md5"))


def evidence_budget(spark: SparkSession, d: str) -> DataFrame:
    """The lines within a budget of characters for each source."""
    kept = evidence.within_budget(_numbered(spark, d), "source", "doc_id", "n_chars", 90_000, 400)
    return kept.groupBy("source", "doc_id").agg(F.count("*").alias("n_lines"), F.max("n").alias("last_n"))


BUDGET_SQL = f"""
WITH {LINES_CTE},
s AS (SELECT source, doc_id, n_chars, sum(length(line) + 8) AS size FROM numbered GROUP BY ALL),
q AS (SELECT *, least(size, greatest(400, 90000 // count(*) OVER (PARTITION BY source))) AS quota FROM s),
e AS (SELECT *, 90000 - sum(quota) OVER (PARTITION BY source) AS spare, coalesce(sum(size - quota) OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken FROM q),
r AS (SELECT source, doc_id, quota + greatest(0, least(size - quota, spare - taken)) AS room FROM e),
u AS (SELECT *, sum(length(line) + 8) OVER (PARTITION BY source, doc_id ORDER BY i) AS used FROM numbered)
SELECT source, doc_id, count(*) AS n_lines, max(n)::BIGINT AS last_n FROM u JOIN r USING (source, doc_id) WHERE used <= room GROUP BY 1, 2
"""


def line_slices(spark: SparkSession, d: str) -> DataFrame:
    """Slices of 140 numbered lines with four or more lines that hold a bar."""
    return evidence.slices_with_hits(_numbered(spark, d), "source", F.contains("line", F.lit("|")))


def near_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every numbered line with the lines up to two before and after in its document, as a digest."""
    near = evidence.near_lines(_numbered(spark, d), "source", "doc_id", 2)
    return near.select("source", "n", md5(F.array_join("near", "\n")).alias("near_md5"))


def quote_checks(spark: SparkSession, d: str) -> DataFrame:
    """Two passages of every document as one quote with dots of omission, in their order and in the other, and the first alone from an official source."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    first, later = F.substring("text", 3, 12), F.substring("text", 30, 9)
    return docs.select(
        "doc_id", tx.quote_in_text(F.concat(first, F.lit(" ... "), later), F.col("text")).alias("ordered"), tx.quote_in_text(F.concat(later, F.lit(" ... "), first), F.col("text")).alias("reversed"),
        evidence.claim_verified(F.col("text"), first, F.lit(True)).alias("official"),
    )


def _comparable_sql(x: str) -> str:
    marks, plain = "‘’“”–—\u00a0", "\'\'\"\"-- ".replace("'", "''")
    return rf"trim(regexp_replace(replace(translate(strip_accents(lower({x})), '{marks}', '{plain}'), 'ß', 'ss'), '\s+', ' ', 'g'))"


def _quote_sql() -> str:
    both = lambda a, b: f"CASE WHEN {a} = '' AND {b} = '' THEN false WHEN {a} = '' THEN length({b}) >= 3 AND contains(h, {b}) WHEN {b} = '' THEN length({a}) >= 3 AND contains(h, {a}) ELSE contains(h, {a}) AND contains(h[instr(h, {a}) + length({a}) :], {b}) END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
c AS (SELECT doc_id, t, {_comparable_sql("t")} AS h, {_comparable_sql("t[3:14]")} AS a, {_comparable_sql("t[30:38]")} AS b FROM t)
SELECT doc_id, {both("a", "b")} AS ordered, {both("b", "a")} AS reversed, t[3:14] <> '' AND length(a) >= 3 AND contains(h, a) AS official FROM c
"""


def contact_checks(spark: SparkSession, d: str) -> DataFrame:
    """Contacts made of each document's own address, checked against the text of the document five ids on."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    who = t.select((F.col("doc_id") + 5).alias("doc_id"), F.coalesce(F.get(tx.emails_in(F.col("text")), 0), F.lit("")).alias("email"), F.substring("text", 1, 9).alias("name"), F.col("source").alias("own"))
    both = who.join(t, "doc_id")
    problems = evidence.contact_problems(F.col("text"), F.col("name"), F.col("email"), F.lit(""), F.col("name"), F.col("source") == F.col("own"))
    return both.select("doc_id", F.array_join(problems, "; ").alias("problems"))


def _contact_sql() -> str:
    return rf"""
WITH f AS (SELECT doc_id, source, coalesce(text, '') AS t, list_transform(regexp_extract_all(coalesce(text, ''), '<([^<>\s@]+@[^<>\s]+)>', 1), lambda x: regexp_replace(x, '[.,;:]+$', '')) AS marked,
                  list_transform(regexp_extract_all(coalesce(text, ''), '{tx.EMAIL}'), lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{"|".join(tx.ENDINGS)}))[A-Z].*$', '\1')) AS plain FROM documents),
w AS (SELECT doc_id + 5 AS doc_id, source AS own, t[1:9] AS name, coalesce(CASE WHEN len(marked) > 0 THEN marked[1] ELSE plain[1] END, '') AS email FROM f),
j AS (SELECT f.doc_id, f.t, f.source = own AS official, name, email, {_comparable_sql("name")} AS q FROM w JOIN f ON f.doc_id = w.doc_id)
SELECT doc_id, array_to_string(list_filter([CASE WHEN length(q) < 3 OR NOT contains({_comparable_sql("t")}, q) THEN 'quote not on page' END, CASE WHEN NOT contains(lower(t), lower(name)) THEN 'name not on page' END,
    CASE WHEN email <> '' AND NOT contains(lower(t), lower(trim(email))) THEN 'email not on page' END, CASE WHEN NOT official THEN 'source not on the institute''s own domain' END], lambda x: x IS NOT NULL), '; ') AS problems FROM j
"""


HOSTS_SQL = r"""
WITH h AS (SELECT regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '[/?#:].*$', ''), '^www\.', '') AS host FROM pages), l AS (SELECT host, string_split(host, '.') AS p FROM h)
SELECT array_to_string(p[-least(len(p), CASE WHEN p[greatest(len(p) - 1, 1)] IN ('co','com','ac','edu','gov','org','net') AND length(p[-1]) = 2 THEN 3 ELSE 2 END) :], '.') AS domain, count(*) AS pages, count(DISTINCT host) AS hosts FROM l GROUP BY 1
"""


def dashboard(spark: SparkSession, d: str) -> DataFrame:
    """Orders in total, by day and by status with a vector of metrics."""
    o = table(spark, d, "orders")
    rows = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderstatus").alias("batch"), "o_orderpriority", "o_totalprice")
    return rollups.dashboard(rows, "day", "batch", {"n": F.lit(1), "urgent": (F.col("o_orderpriority").startswith("1")).cast("int"), "large": (F.col("o_totalprice") > 100_000).cast("int")})


DASHBOARD_SQL = """
SELECT CASE WHEN grouping(day) = 1 AND grouping(batch) = 1 THEN 'total' WHEN grouping(batch) = 1 THEN 'day' ELSE 'batch' END AS level, day, batch,
       count(*)::BIGINT AS n, count_if(o_orderpriority[1] = '1')::BIGINT AS urgent, count_if(o_totalprice > 100000)::BIGINT AS large
FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS batch, o_orderpriority, o_totalprice FROM orders) GROUP BY GROUPING SETS ((), (day), (batch))
"""


def day_sections(spark: SparkSession, d: str) -> DataFrame:
    """Events of each day under a heading with their number."""
    e = table(spark, d, "events").filter("event_type = 'error'").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id")
    return rollups.with_headings(e, "day", F.col("event_id"), "label")


def coordinator_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Per customer: orders, total, kinds of priority in order, latest date."""
    return rollups.coordinators(table(spark, d, "orders"), "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")


def best_hook(spark: SparkSession, d: str) -> DataFrame:
    """Per order the part of the best line: returned ones preferred, then the largest quantity, then the first line."""
    li = table(spark, d, "lineitem").withColumn("place", F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.col("l_partkey"))
    return rollups.best_of(li, "l_orderkey", F.col("l_returnflag") == "R", "l_quantity", "place", "l_partkey")


def confidence_histogram(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    score = F.when(F.col("l_returnflag") != "N", F.bround(1 - F.col("l_discount") * 5, 2))
    return li.groupBy(rollups.buckets(score).alias("bucket")).agg(F.count("*").alias("n"))


def spend_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Spend of each month and what the next batch may spend under a total cap."""
    o = rollups.spend_by_month(table(spark, d, "orders"), "o_orderdate", "o_totalprice")
    return o.select("month", F.bround("spent", 2).alias("spent"), F.bround(scheduling.spending_cap(F.lit(3_000_000.0), F.col("spent")), 2).alias("cap"))


def best_phone(spark: SparkSession, d: str) -> DataFrame:
    """Per supplier the part with the best of trust (status), count and earliest date."""
    return rollups.best_phone(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", F.when(F.col("l_linestatus") == "F", 2).otherwise(1), "l_shipdate")


def search_worklist(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers by nation: whether any needs a check, the first and the others."""
    return rollups.search_worklist(table(spark, d, "supplier"), "s_nationkey", F.col("s_acctbal") < 0, "s_suppkey")


def position_blocks(spark: SparkSession, d: str) -> DataFrame:
    """First and last order of each customer's block by date."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return rollups.blocks(o, "o_custkey", "o_orderkey")


def round_robin(spark: SparkSession, d: str) -> DataFrame:
    """Eight lines a supplier in turns over the return flags, by price."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_extendedprice", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return rollups.round_robin(li, "l_suppkey", "l_returnflag", "l_extendedprice", "id", 8).select("l_suppkey", "id", F.col("place").cast("bigint").alias("place"))


ROBIN_SQL = """
WITH t AS (SELECT l_suppkey, l_returnflag, l_orderkey * 10 + l_linenumber AS id, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) AS turn FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY turn, l_returnflag) AS place FROM t)
SELECT l_suppkey, id, place FROM p WHERE place <= 8
"""


def queue_start(spark: SparkSession, d: str) -> DataFrame:
    """Orders that each nation's lane may start within a budget: urgent first, then by date."""
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    rows = o.select(F.col("c_nationkey").alias("lane"), F.col("o_orderpriority").startswith("1").alias("priority"), F.col("o_orderdate").alias("added"), F.col("o_totalprice").alias("cost"), F.col("o_orderkey").alias("item_id"))
    return scheduling.startable(rows, 2_000_000).select("lane", "item_id", F.col("place").cast("bigint").alias("place"))


QUEUE_SQL = """
WITH r AS (SELECT c_nationkey AS lane, o_orderkey AS item_id, row_number() OVER w AS place, sum(o_totalprice::DECIMAL(18,2)) OVER w AS spent FROM orders JOIN customer ON c_custkey = o_custkey
           WINDOW w AS (PARTITION BY c_nationkey ORDER BY o_orderpriority[1] = '1' DESC, o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING))
SELECT lane, item_id, place FROM r WHERE spent <= 2000000
"""


def dead_sites(spark: SparkSession, d: str) -> DataFrame:
    """Users with errors on three or more days since their last purchase."""
    e = table(spark, d, "events").filter(F.col("event_type").isin("error", "purchase")).select("user_id", F.to_date("ts").alias("day"), (F.col("event_type") == "purchase").alias("ok"))
    return scheduling.dead_sites(e, "user_id", "day", "ok", 3)


DEAD_SQL = """
WITH e AS (SELECT user_id, ts::DATE AS day, event_type = 'purchase' AS ok FROM events WHERE event_type IN ('error', 'purchase')), l AS (SELECT user_id, max(CASE WHEN ok THEN day END) AS last FROM e GROUP BY 1)
SELECT user_id, count(DISTINCT day) AS days FROM e JOIN l USING (user_id) WHERE NOT ok AND (last IS NULL OR day > last) GROUP BY 1 HAVING count(DISTINCT day) >= 3
"""


def numbers_once(spark: SparkSession, d: str) -> DataFrame:
    """Parts given out once per nation of the customer, three an order at most, in order of the orders."""
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), "c_nationkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(o, "l_orderkey")
    return scheduling.numbers_once(li, "c_nationkey", "l_orderkey", "l_linenumber", "l_partkey")


def last_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The last event of every user, last writer wins."""
    return last_by_key(table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


def wait_states(spark: SparkSession, d: str) -> DataFrame:
    """States of orders read as batches: open lines, progress, reason; staleness by age."""
    o = table(spark, d, "orders")
    state = scheduling.wait_state(F.when(F.col("o_orderstatus") == "F", 0).otherwise(1), F.col("o_orderstatus") == "P", F.when(F.col("o_orderpriority").startswith("1"), "quota").when(F.col("o_orderpriority").startswith("2"), "busy"))
    age = scheduling.stale(F.col("o_orderkey") % 100, F.col("o_custkey") % 5)
    return o.groupBy(state.alias("state"), age.alias("age")).agg(F.count("*").alias("n"))


WAIT_SQL = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority[1] = '1' THEN 'waiting daily' WHEN o_orderpriority[1] = '2' THEN 'waiting busy' WHEN o_orderstatus = 'P' THEN 'running' ELSE 'waiting retry' END AS state,
       CASE WHEN o_orderkey % 100 <= 60 THEN 'running' WHEN o_custkey % 5 < 3 THEN 'restart' ELSE 'failed' END AS age, count(*) AS n FROM orders GROUP BY 1, 2
"""


def cell_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of all lines of the documents, read as cells, and how many look like names."""
    cells = table(spark, d, "documents").select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("c"))
    return cells.groupBy(tx.cell_kind(F.col("c")).alias("kind")).agg(F.count("*").alias("n"), F.count_if(tx.name_like(F.col("c"))).alias("names"))


CELL_SQL = r"""
WITH c AS (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS c FROM documents),
k AS (SELECT c, CASE WHEN trim(c) = '' THEN '' WHEN regexp_matches(trim(c), '(?i)^(https?://|www\.)') THEN 'link' WHEN regexp_matches(trim(c), '^[-+0-9.,()/ ]+$') THEN 'number' ELSE 'text' END AS kind FROM c)
SELECT kind, count(*) AS n, count_if(kind = 'text' AND length(c) >= 8 AND 2 * length(regexp_replace(c, '[^\p{L}]', '', 'g')) >= length(c))::BIGINT AS names FROM k GROUP BY 1
"""


def attempts_long(spark: SparkSession, d: str) -> DataFrame:
    """Lines' quantities, discounts and taxes from columns to rows, by column."""
    long = rollups.attempts_long(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])
    return long.groupBy("sheet_column").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


def page_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Pages by registrable domain, and how many pairs of hosts are the same site."""
    p = table(spark, d, "pages").select(keys.host(F.col("url")).alias("host"))
    return p.groupBy(keys.registrable_domain(F.col("host")).alias("domain")).agg(F.count("*").alias("pages"), F.count_distinct("host").alias("hosts"))


def ranked_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Three suppliers a nation by balance band, then key, with a confidence of their rank."""
    band = F.when(F.col("s_acctbal") > 5000, 0).when(F.col("s_acctbal") > 0, 1).otherwise(2)
    s = rollups.ranked_contacts(table(spark, d, "supplier"), "s_nationkey", band, "s_suppkey")
    return s.select("s_nationkey", "s_suppkey", F.col("rank").cast("bigint").alias("rank"), "confidence")


def order_parts_missing(spark: SparkSession, d: str) -> DataFrame:
    """Parts by size that no large returned line holds: set difference."""
    back = table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return rollups.missing_from(table(spark, d, "part").select("p_partkey", "p_size"), back, "p_partkey").groupBy("p_size").agg(F.count("*").alias("n"))


QUERIES = {
    "evidence_lines": (evidence_lines, f"WITH {LINES_CTE} SELECT source, doc_id, n, md5(line) AS line_md5 FROM numbered"),
    "evidence_budget": (evidence_budget, BUDGET_SQL),
    "line_slices": (line_slices, f"WITH {LINES_CTE} SELECT source, (n - 1) // 140 AS slice, count_if(contains(line, '|'))::BIGINT AS hits FROM numbered GROUP BY 1, 2 HAVING hits >= 4"),
    "near_lines": (near_lines, f"WITH {LINES_CTE} SELECT source, n, md5(string_agg(line, chr(10)) OVER (PARTITION BY source, doc_id ORDER BY n ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS near_md5 FROM numbered"),
    "quote_checks": (quote_checks, _quote_sql()),
    "contact_checks": (contact_checks, _contact_sql()),
    "dashboard": (dashboard, DASHBOARD_SQL),
    "day_sections": (day_sections, "WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_id FROM events WHERE event_type = 'error') SELECT day, true AS is_heading, day AS label, count(*) AS n FROM e GROUP BY day UNION ALL SELECT day, false, event_id::VARCHAR, 1 FROM e"),
    "coordinator_rollup": (coordinator_rollup, "SELECT o_custkey, count(*) AS projects, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS kinds, strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM orders GROUP BY 1"),
    "best_hook": (best_hook, "SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag = 'R' DESC, l_quantity DESC, l_linenumber, l_partkey) AS r FROM lineitem) WHERE r = 1"),
    "confidence_histogram": (confidence_histogram, "WITH s AS (SELECT CASE WHEN l_returnflag <> 'N' THEN round_even(1 - l_discount * 5, 2) END AS s FROM lineitem) SELECT CASE WHEN s IS NULL THEN 'none' WHEN s >= 0.75 THEN 'high' WHEN s >= 0.5 THEN 'medium' ELSE 'low' END AS bucket, count(*) AS n FROM s GROUP BY 1"),
    "spend_by_month": (spend_by_month, "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS s FROM orders GROUP BY 1) SELECT month, round_even(s, 2) AS spent, CASE WHEN 3000000 - 1 - s < 0.5 THEN 0 ELSE round_even(3000000 - 1 - s, 2) END AS cap FROM m"),
    "best_phone": (best_phone, "WITH g AS (SELECT l_suppkey, l_partkey, max(CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END) AS t, count(*) AS n, min(l_shipdate) AS f FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY t DESC, n DESC, f, l_partkey) AS r FROM g) WHERE r = 1"),
    "search_worklist": (search_worklist, "SELECT s_nationkey, bool_or(s_acctbal < 0) AS needs, min(s_suppkey) AS first, string_agg(s_suppkey::VARCHAR, ';' ORDER BY s_suppkey) AS all_keys FROM supplier GROUP BY 1"),
    "position_blocks": (position_blocks, "SELECT o_custkey, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS n FROM orders GROUP BY 1"),
    "round_robin": (round_robin, ROBIN_SQL),
    "queue_start": (queue_start, QUEUE_SQL),
    "dead_sites": (dead_sites, DEAD_SQL),
    "numbers_once": (numbers_once, None),
    "last_snapshot": (last_snapshot, "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1"),
    "wait_states": (wait_states, WAIT_SQL),
    "cell_kinds": (cell_kinds, CELL_SQL),
    "attempts_long": (attempts_long, "SELECT sheet_column, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM (UNPIVOT (SELECT l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME sheet_column VALUE value) GROUP BY 1"),
    "page_hosts": (page_hosts, HOSTS_SQL),
    "ranked_contacts": (ranked_contacts, "WITH r AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY CASE WHEN s_acctbal > 5000 THEN 0 WHEN s_acctbal > 0 THEN 1 ELSE 2 END, s_suppkey) AS rank FROM supplier) SELECT s_nationkey, s_suppkey, rank, round_even(least(0.95, greatest(0.3, 1.0 - 0.25 * rank))::DOUBLE, 2) AS confidence FROM r WHERE rank <= 3"),
    "order_parts_missing": (order_parts_missing, "SELECT p_size, count(*) AS n FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) GROUP BY 1"),
}
