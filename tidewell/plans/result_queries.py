"""Queries of building, merging, checking and choosing results over whole tables, with their DuckDB counterparts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators import results
from tidewell.sources.tables import table


def attempt_rows(spark: SparkSession, d: str) -> DataFrame:
    """All turns of conversations as attempts, with dates from the text or the heading, by category."""
    c = table(spark, d, "conversations").select("conv_id", F.concat_ws("/", F.col("turn") + 1, F.lit("11")).alias("column"), "text")
    rows = results.attempt_rows(c, "conv_id", "column", "text")
    return rows.groupBy("category", "date_dm", "date_from", "needs_review").agg(F.count("*").alias("n"), F.sum(F.char_length("text")).cast("bigint").alias("chars"))


def _attempt_sql() -> str:
    from tidewell.functions import text as tx

    each = ", ".join(f"CASE WHEN regexp_matches(lower(t), '{p}') THEN '{c}' END" for c, p in tx.ATTEMPT_RULES)
    return rf"""
WITH t AS (SELECT (turn + 1) || '/11' AS col, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM conversations),
h AS (SELECT col, t, list_filter([{each}], lambda x: x IS NOT NULL) AS h, regexp_extract(t, '\b(\d{{1,2}})/(\d{{1,2}})\b', ['d', 'm']) AS g, regexp_matches(col, '^\d{{1,2}}/\d{{1,2}}$') AS dated FROM t WHERE t <> ''),
c AS (SELECT *, CASE WHEN contains(lower(t), 'respond well') OR len(h) = 0 THEN ['other'] ELSE h END AS c, CASE WHEN g.d = '' THEN '' ELSE lpad(g.d, 2, '0') || '/' || lpad(g.m, 2, '0') END AS own FROM h)
SELECT c[1] AS category, CASE WHEN own <> '' THEN own WHEN dated THEN lpad(string_split(col, '/')[1], 2, '0') || '/11' ELSE '' END AS date_dm, CASE WHEN own <> '' THEN 'text' WHEN dated THEN 'column_header' ELSE '' END AS date_from,
       CASE WHEN len(c) > 1 OR c[1] IN ('other', 'speaker_unclear') THEN 'yes' ELSE '' END AS needs_review, count(*) AS n, sum(length(t))::BIGINT AS chars FROM c GROUP BY 1, 2, 3, 4
"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


def merged_results(spark: SparkSession, d: str) -> DataFrame:
    """Customers with the result of their open orders, or of the first customer of their nation and segment that has one."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"), "c_nationkey", "c_mktsegment")
    res = _orders(spark, d).filter("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("row_id")).agg(F.max("o_orderkey").alias("best"), F.count("*").alias("items"))
    first = rows.join(res, "row_id", "left_semi").groupBy("c_nationkey", "c_mktsegment").agg(F.min("row_id").alias("first_id"))
    out = results.merge_results(rows, res, rows.join(first, ["c_nationkey", "c_mktsegment"]).select("row_id", "first_id"))
    return out.select("row_id", "repeat_of", "best", "items")


MERGED_SQL = """
WITH r AS (SELECT o_custkey AS k, max(o_orderkey) AS best, count(*) AS items FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
f AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS first_id FROM customer WHERE c_custkey IN (SELECT k FROM r) GROUP BY 1, 2),
m AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey NOT IN (SELECT k FROM r) THEN first_id END AS repeat_of FROM customer LEFT JOIN f USING (c_nationkey, c_mktsegment))
SELECT row_id, repeat_of, best, items FROM m JOIN r ON k = coalesce(repeat_of, row_id)
"""


def detail_rows(spark: SparkSession, d: str) -> DataFrame:
    """The priorities of every customer's orders as details of its result; repeats give none."""
    res = _orders(spark, d).groupBy(F.col("o_custkey").alias("row_id")).agg(F.sort_array(F.collect_set("o_orderpriority")).alias("items"))
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("n"))
    first = rows.join(res, "row_id", "left_semi").groupBy("n").agg(F.min("row_id").alias("first_id"))
    merged = results.merge_results(rows, res, rows.join(first, "n").select("row_id", "first_id"))
    return results.detail_rows(merged, "items").select("row_id", F.col("place").cast("bigint").alias("place"), "item")


def verified_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Verified customers (those with a balance) by the number in their name."""
    c = table(spark, d, "customer").select(F.col("c_name").alias("row_id"), "c_acctbal")
    return results.verified_first(c, "row_id", F.col("c_acctbal") > 0).select("row_id", "number")


def newest_orders(spark: SparkSession, d: str) -> DataFrame:
    """The 3,000 newest orders: a report of that length."""
    return results.newest(_orders(spark, d).select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", 3000).select("o_orderkey")


def union_of_passes(spark: SparkSession, d: str) -> DataFrame:
    """Three passes over customers' orders by status; the last that read a customer wins."""
    one = lambda s: _orders(spark, d).filter(F.col("o_orderstatus") == s).groupBy("o_custkey").agg(F.max("o_orderkey").alias("k"), F.count("*").alias("n"))
    return results.union_of_passes([one("F"), one("O"), one("P")], "o_custkey")


PASSES_SQL = """
WITH p AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS s, max(o_orderkey) AS k, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1, 2)
SELECT o_custkey, arg_max(k, s) AS k, arg_max(n, s) AS n FROM p GROUP BY 1
"""


def keyed_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The last event of those users who are customers; others are pruned."""
    state = table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return results.keyed_snapshot(state, table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")), "user_id")


def upload_rows(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as rows of an upload: the template's seven columns as text."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return results.upload_rows(s, {"Phone": F.concat(F.lit("+"), F.col("s_suppkey")), "Name": F.col("s_name"), "Designation": F.lit(None), "Institute": F.col("s_name"), "Email": F.lit(""), "Country": F.col("n_name"), "Notes": F.col("s_nationkey")})


def lead_groups(spark: SparkSession, d: str) -> DataFrame:
    """Orders as leads of a customer: the set of priorities, how many, and the first one's status."""
    leads = _orders(spark, d).select("o_custkey", F.array("o_orderpriority").alias("v"), "o_orderstatus", "o_orderkey")
    return results.lead_groups(leads, "o_custkey", "v", "o_orderstatus", "o_orderkey").select("o_custkey", F.array_join("v", ";").alias("v"), "leads", "o_orderstatus")


def reuse_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Earlier results by part and supplier: returned lines are older than accepted ones; the other lines' pairs ask by part, then by supplier."""
    li = table(spark, d, "lineitem")
    keyed = lambda flag: li.filter(F.col("l_returnflag") == flag).select(F.array(F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey")).alias("keys"), F.col("l_orderkey").alias("v"))
    index = results.reuse_index([keyed("R"), keyed("A")], "keys", "v")
    pairs = li.filter("l_returnflag = 'N'").select("l_partkey", "l_suppkey").distinct()
    rows = pairs.select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("id"), F.array(F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey")).alias("keys"))
    return results.reuse_lookup(rows, index, "id", "keys", "v").groupBy("v").agg(F.count("*").alias("n"))


REUSE_SQL = """
WITH e AS (SELECT unnest(['p' || l_partkey, 's' || l_suppkey]) AS key, CASE l_returnflag WHEN 'R' THEN 0 ELSE 1 END AS b, l_orderkey AS v FROM lineitem WHERE l_returnflag IN ('R', 'A')),
i AS (SELECT key, arg_max(v, (b, v)) AS v FROM e GROUP BY 1),
q AS (SELECT coalesce(a.v, s.v) AS v FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N') LEFT JOIN i a ON a.key = 'p' || l_partkey LEFT JOIN i s ON s.key = 's' || l_suppkey)
SELECT v, count(*) AS n FROM q WHERE v IS NOT NULL GROUP BY 1
"""


def best_match(spark: SparkSession, d: str) -> DataFrame:
    """For every part the supplier with the most, then the largest lines; ambiguous where two tie in both."""
    c = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.max("l_quantity").alias("q"))
    return results.best_match(c, "l_partkey", "l_suppkey", [F.col("n"), F.col("q")], F.col("q") >= 10)


BEST_SQL = """
WITH c AS (SELECT l_partkey, l_suppkey, count(*) AS n, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2 HAVING max(l_quantity) >= 10),
r AS (SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY n DESC, q DESC) AS r FROM c)
SELECT l_partkey, min(l_suppkey) AS l_suppkey, count(*) > 1 AS ambiguous FROM r WHERE r = 1 GROUP BY 1
"""


def fill_from(spark: SparkSession, d: str) -> DataFrame:
    """Customers' contacts from one source, blanks from another that knows more of them."""
    c = table(spark, d, "customer")
    a = c.filter("c_acctbal > 0").select("c_custkey", F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).otherwise("").alias("phone"), F.col("c_name").alias("site"))
    b = _orders(spark, d).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("phone"), F.max("o_orderstatus").alias("site"))
    return results.fill_from(a, b, "c_custkey", ["phone", "site"])


FILL_SQL = """
WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_mktsegment ELSE '' END AS phone, c_name AS site FROM customer WHERE c_acctbal > 0),
b AS (SELECT o_custkey AS c_custkey, max(o_orderpriority) AS phone, max(o_orderstatus) AS site FROM orders GROUP BY 1)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(nullif(a.phone, ''), nullif(b.phone, ''), '') AS phone, coalesce(nullif(a.site, ''), nullif(b.site, ''), '') AS site FROM a FULL JOIN b ON a.c_custkey = b.c_custkey
"""


def fan_out(spark: SparkSession, d: str) -> DataFrame:
    """Orders that a line's supplier and the next one claim; those of more than three suppliers are dropped."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    next_ = F.array(F.col("l_suppkey") + 1)
    return results.fan_out(li.withColumn("also", next_), "l_suppkey", "also", "l_orderkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))


FAN_SQL = """
WITH e AS (SELECT DISTINCT l_suppkey + k AS l_suppkey, l_orderkey FROM lineitem, (SELECT unnest([0, 1]) AS k)), k AS (SELECT l_orderkey FROM e GROUP BY 1 HAVING count(*) <= 3)
SELECT l_suppkey, count(*) AS n FROM e WHERE l_orderkey IN (SELECT l_orderkey FROM k) GROUP BY 1
"""


def first_positions(spark: SparkSession, d: str) -> DataFrame:
    """Where links to a customer's block lead: its first order."""
    return results.first_positions(_orders(spark, d), "o_custkey", "o_orderkey")


def hidden_batches(spark: SparkSession, d: str) -> DataFrame:
    """Customers as batches, rebuilt as their segment's in their nation: which are hidden."""
    c = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.concat_ws("-", "c_mktsegment", "c_nationkey")).alias("rebuild_of"), (F.col("c_acctbal") > 5000).alias("done"))
    return results.hidden_batches(c)


def wrong_retracted(spark: SparkSession, d: str) -> DataFrame:
    """Orders' priorities cleared where the customer's list of wrong ones (those of cheap orders) has them."""
    o = _orders(spark, d).select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    out = results.wrong_retracted(o, o.filter("o_totalprice < 20000"), "o_custkey", "o_orderpriority")
    return out.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if("retracted").alias("retracted"))


WRONG_SQL = """
WITH w AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_totalprice < 20000),
j AS (SELECT o.o_orderpriority AS p, w.o_custkey IS NOT NULL AS r FROM orders o LEFT JOIN w ON w.o_custkey = o.o_custkey AND w.o_orderpriority = o.o_orderpriority)
SELECT CASE WHEN r THEN '' ELSE p END AS o_orderpriority, count(*) AS n, count_if(r)::BIGINT AS retracted FROM j GROUP BY 1
"""


def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Parts of the re-check list of orders by their keys, 500 each."""
    out = results.batches_of(_orders(spark, d).select("o_orderkey"), "o_orderkey", "recheck", 500)
    return out.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


def inbox_new(spark: SparkSession, d: str) -> DataFrame:
    """Documents as files by source and length; those of French texts were picked up before."""
    t = table(spark, d, "documents").select(F.concat_ws("-", "source", "n_chars").alias("name"), F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("md5"), F.col("doc_id").alias("seen"), "lang")
    return results.inbox_new(t.drop("lang"), t.filter("lang = 'fr'"), "seen")


INBOX_SQL = """
WITH t AS (SELECT concat_ws('-', source, n_chars) AS name, md5(coalesce(text, '')) AS md5, doc_id AS seen, lang FROM documents), s AS (SELECT * FROM t WHERE lang = 'fr'),
f AS (SELECT * FROM t WHERE md5 NOT IN (SELECT md5 FROM s) AND name NOT IN (SELECT name FROM s)),
o AS (SELECT md5, min(seen) AS seen, arg_min(name, (seen, name)) AS name FROM f GROUP BY 1)
SELECT name, arg_min(md5, (seen, md5)) AS md5, min(seen) AS seen FROM o GROUP BY 1
"""


def choice_rules(spark: SparkSession, d: str) -> DataFrame:
    """What is missing, reusable, searchable, counted and how read, of suppliers' lines by part; the values' counts."""
    p = table(spark, d, "part")
    miss = results.missing_fields({"name": F.col("p_name"), "type": F.when(F.col("p_size") > 20, F.col("p_type"))})
    reuse = results.reusable(F.col("p_brand"), F.col("p_type"), ("STANDARD", "SMALL"))
    cell = results.count_cell(F.col("p_size") > 10, F.col("p_size") - 11, F.greatest(F.lit(0), F.col("p_size") - 45), "partner")
    label = results.method_label(F.when(F.col("p_size") == 1, "none"), F.when(F.col("p_size") < 25, "rules").when(F.col("p_size") < 40, "gemini"))
    group = results.group_of(F.lower("p_brand"), F.col("p_type"))
    gap = results.merge_gap(F.col("p_size").cast("double"))
    return p.groupBy(miss["no_type"].alias("no_type"), reuse.alias("reusable"), cell.alias("cell"), label.alias("label"), group.alias("grp"), results.searchable(F.col("p_name")).alias("searchable")).agg(F.count("*").alias("n"), F.sum(gap).alias("gap"), F.min(results.query_name(F.concat("p_name", F.lit(" - x")))).alias("name"))


CHOICE_SQL = r"""
SELECT p_size <= 20 AS no_type, p_brand <> '' AND NOT starts_with(p_type, 'STANDARD') AND NOT starts_with(p_type, 'SMALL') AS reusable,
       CASE WHEN p_size <= 10 THEN 'not searched' WHEN p_size = 11 THEN 'none published' WHEN p_size <= 45 THEN 'none confirmed' WHEN p_size = 46 THEN '1 partner' ELSE (p_size - 45) || ' partners' END AS cell,
       CASE WHEN p_size = 1 THEN 'not read' WHEN p_size < 25 THEN 'rules-only (lower accuracy)' WHEN p_size < 40 THEN 'AI-read' ELSE '' END AS label,
       CASE WHEN contains(lower(p_brand), 'retail') THEN 'retail' WHEN regexp_matches(lower(p_type), 'school|universit|college|lyc|gymnas|institut|academ|schule|escuela') THEN 'education' ELSE 'other' END AS grp,
       length(regexp_replace(p_name, '[^\p{L}]', '', 'g')) >= 4 AS searchable, count(*) AS n, sum(greatest(8.0, 4.0 * p_size))::DOUBLE AS gap, min(trim(p_name)) AS name FROM part GROUP BY 1, 2, 3, 4, 5, 6
"""


def official_inbox(spark: SparkSession, d: str) -> DataFrame:
    """The office's address among every text's addresses, the last one's host as the site; where a text has one, the site is another."""
    from tidewell.functions.contacts import page_emails

    e = table(spark, d, "documents").select("doc_id", page_emails(F.coalesce("text", F.lit(""))).alias("e")).filter(F.size("e") > 0)
    site = F.when(F.size("e") == 1, "www.other.org").otherwise(F.substring_index(F.element_at("e", -1), "@", -1))
    return e.select("doc_id", results.pick_official(F.col("e"), site).alias("picked"))


def _official_sql() -> str:
    from .rule_queries import PAGE_EMAILS, _domain_sql

    either = lambda parts: "|".join(re.escape(x) for x in parts)
    return rf"""
WITH {PAGE_EMAILS},
x AS (SELECT doc_id, CASE WHEN len(e) = 1 THEN 'other.org' ELSE string_split(e[-1], '@')[-1] END AS site, unnest(e) AS a, generate_subscripts(e, 1) AS i FROM e),
y AS (SELECT *, {_domain_sql("site")} AS own, string_split(a, '@')[1] AS l, string_split(a, '@')[-1] AS h FROM x),
k AS (SELECT doc_id, a, (NOT regexp_matches(l, 'erasmus|internation|mobilit'), NOT regexp_matches(l, '{"|".join(results.OFFICE_LOCAL)}'), i) AS o, CASE WHEN ends_with(h, own) THEN 0 WHEN regexp_matches(h, '{either(results.EDU_MAIL)}') AND NOT regexp_matches(h, '{either(results.FREE_MAIL)}') THEN 1 END AS t FROM y)
SELECT doc_id, coalesce(arg_min(a, (t, o)) FILTER (WHERE t IS NOT NULL), '') AS picked FROM k GROUP BY 1
"""


def paid_usage(spark: SparkSession, d: str) -> DataFrame:
    """Events as paid uses, in micro-dollars, by day: how many may still be paid for under a day's limit."""
    e = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("value").alias("usd"))
    return results.paid_usage(e, "event_id", "usd", 500.0).groupBy("day").agg(F.count("*").alias("n"), F.count_if("allowed").alias("allowed"), F.max("spent").alias("spent"))


USAGE_SQL = """
WITH m AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, round(value * 1000000)::BIGINT AS u FROM events),
s AS (SELECT *, coalesce(sum(u) OVER (PARTITION BY day ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spent FROM m)
SELECT day, count(*) AS n, count_if(spent + u <= 500000000)::BIGINT AS allowed, max(spent) AS spent FROM s GROUP BY 1
"""


def presence_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Alerts of the presence fold over all events read as polls; views are polls without an answer."""
    from tidewell.streaming.monitors import presence_alerts_batch

    online = F.when(F.col("event_type") != "view", F.col("event_type") != "error")
    polls = table(spark, d, "events").select(F.col("user_id").alias("extension"), F.col("ts").cast("timestamp").alias("at"), "event_id", online.alias("online"))
    # Polls of one moment: the last event counts.
    last = polls.groupBy("extension", "at").agg(F.max_by(F.struct("online"), "event_id").alias("o")).select("extension", "at", "o.online")
    return presence_alerts_batch(last, ("08:00", "20:00"), 900, 3600).select("extension", F.unix_micros("at").alias("at_us"), "reason")


PRESENCE_SQL = """
WITH RECURSIVE p AS (SELECT user_id AS x, ts AS t, arg_max({'o': CASE WHEN event_type <> 'view' THEN event_type <> 'error' END}, event_id).o AS online FROM events GROUP BY 1, 2),
s AS (SELECT *, lag(online) OVER w AS before, max(CASE WHEN online THEN t END) OVER (PARTITION BY x ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM p WINDOW w AS (PARTITION BY x ORDER BY t)),
c AS (SELECT x, t, CASE WHEN NOT online THEN 'offline during shift' ELSE 'no activity change' END AS reason FROM s
      WHERE strftime(t, '%H:%M') BETWEEN '08:00' AND '20:00' AND online IS NOT NULL AND (NOT online OR (before AND seen IS NOT NULL AND epoch_us(t) - epoch_us(seen) >= 900000000))),
a AS (SELECT x, min(t) AS t FROM c GROUP BY 1
      UNION ALL SELECT a.x, (SELECT min(c.t) FROM c WHERE c.x = a.x AND epoch_us(c.t) - epoch_us(a.t) >= 3600000000) AS t FROM a WHERE a.t IS NOT NULL)
SELECT c.x AS extension, epoch_us(c.t) AS at_us, c.reason FROM a JOIN c ON c.x = a.x AND c.t = a.t
"""

QUERIES = {
    "attempt_rows": (attempt_rows, _attempt_sql()),
    "merged_results": (merged_results, MERGED_SQL),
    "detail_rows": (detail_rows, "WITH c AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) SELECT o_custkey AS row_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) - 1 AS place, o_orderpriority AS item FROM c"),
    "verified_sorted": (verified_sorted, r"SELECT c_name AS row_id, regexp_extract(c_name, '(\d+)', 1)::BIGINT AS number FROM customer WHERE c_acctbal > 0"),
    "newest_orders": (newest_orders, "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 3000"),
    "union_of_passes": (union_of_passes, PASSES_SQL),
    "keyed_snapshot": (keyed_snapshot, "SELECT user_id, max(event_id) AS event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY 1"),
    "upload_rows": (upload_rows, "SELECT '+' || s_suppkey AS Phone, s_name AS Name, '' AS Designation, s_name AS Institute, '' AS Email, n_name AS Country, s_nationkey::VARCHAR AS Notes FROM supplier JOIN nation ON n_nationkey = s_nationkey"),
    "lead_groups": (lead_groups, "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS v, count(DISTINCT o_orderkey) AS leads, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1"),
    "reuse_lookup": (reuse_lookup, REUSE_SQL),
    "best_match": (best_match, BEST_SQL),
    "fill_from": (fill_from, FILL_SQL),
    "fan_out": (fan_out, FAN_SQL),
    "first_positions": (first_positions, "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1"),
    "hidden_batches": (hidden_batches, "SELECT DISTINCT CASE WHEN c_acctbal > 5000 THEN c_mktsegment || '-' || c_nationkey ELSE c_name END AS name FROM customer WHERE c_acctbal > 0"),
    "wrong_retracted": (wrong_retracted, WRONG_SQL),
    "fixed_batches": (fixed_batches, "WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 + 1 AS p, count(*) OVER () AS c FROM orders) SELECT CASE WHEN c > 500 THEN 'recheck-p' || p ELSE 'recheck' END AS batch, count(*) AS n, min(o_orderkey) AS first FROM r GROUP BY 1"),
    "inbox_new": (inbox_new, INBOX_SQL),
    "choice_rules": (choice_rules, CHOICE_SQL),
    "official_inbox": (official_inbox, _official_sql()),
    "paid_usage": (paid_usage, USAGE_SQL),
    "presence_alerts": (presence_alerts, PRESENCE_SQL),
}
