"""Queries of importing sheets, checking results against pages and choosing what to read again, with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import text as tx
from tidewell.operators import inboxes, results, sheets, verification, workbook
from tidewell.sources.tables import table

from .report_queries import _comparable_sql
from .rule_queries import PAGE_EMAILS

HEADINGS = ["Kind of institution", "Partner Name", "Country", "Name", "Surname", "Its website here", "Primary phone"]


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """Documents as rows of a sheet."""
    t = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ").alias("t"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    name = F.when(F.col("doc_id") % 11 == 0, F.col("doc_id").cast("string")).otherwise(F.substring("t", 1, 30))
    site = F.concat(F.lit("http://"), F.col("source"), F.lit(".org, www.x.org;https://y.org/"), F.col("doc_id"))
    return t.select(F.col("doc_id").alias("n"), F.array(F.lit("school"), name, F.col("lang"), F.substring("t", 1, 4), F.when(F.col("doc_id") % 3 > 0, F.substring("t", 6, 5)).otherwise(""), site, F.concat(F.lit("+49 "), F.col("doc_id"))).alias("cells"))


def sheet_import(spark: SparkSession, d: str) -> DataFrame:
    """Documents as a sheet with headings: the rows of a batch."""
    head = spark.range(1).select(F.lit(-1).cast("bigint").alias("n"), F.array(*map(F.lit, HEADINGS)).alias("cells"))
    return sheets.batch_rows(head.unionByName(_cells(spark, d))).select("row_id", "institution_name", "country_sheet", "phone_1", "contact_name", "seed_urls", "flags")


SHEET_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\s+', ' ', 'g') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER (ORDER BY doc_id) AS k FROM documents),
c AS (SELECT *, trim(CASE WHEN doc_id % 11 = 0 THEN doc_id::VARCHAR ELSE t[1:30] END) AS name, trim(t[1:4]) AS a, CASE WHEN doc_id % 3 > 0 THEN trim(t[6:10]) ELSE '' END AS b FROM t)
SELECT 'r' || CASE WHEN k < 1000 THEN lpad(k::VARCHAR, 3, '0') ELSE k::VARCHAR END AS row_id, name AS institution_name, lang AS country_sheet, '+49 ' || doc_id AS phone_1, CASE WHEN a <> '' AND b <> '' THEN a || ' ' || b ELSE a || b END AS contact_name,
       'http://' || source || '.org https://y.org/' || doc_id AS seed_urls, '' AS flags FROM c WHERE name <> '' AND NOT regexp_matches(name, '^([0-9\s.,+()#/:-]+|#.*)$')
"""


def headerless_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The same sheet without headings: the column of names is found by its cells."""
    return sheets.headerless_rows(_cells(spark, d)).select("n", "institution_name", "seed_urls")


HEADERLESS_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\s+', ' ', 'g') AS t, coalesce(source, '') AS source FROM documents), c AS (SELECT *, trim(CASE WHEN doc_id % 11 = 0 THEN doc_id::VARCHAR ELSE t[1:30] END) AS name FROM t)
SELECT doc_id AS n, name AS institution_name, 'http://' || source || '.org, www.x.org;https://y.org/' || doc_id AS seed_urls FROM c WHERE name <> '' AND NOT regexp_matches(lower(name), '^(http|www\.)|@') AND NOT regexp_matches(name, '^([0-9\s.,+()#/:-]+|#.*)$')
"""


def contact_notes(spark: SparkSession, d: str) -> DataFrame:
    """Contacts made of each document's beginning and own address, checked against the pages that every document is: the one three ids on for some, a page that wasn't read for others."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("source"))
    url = lambda i: F.concat(F.lit("http://www.host.org/"), i)
    page_id = F.when(F.col("doc_id") % 5 == 0, F.col("doc_id") + 3).when(F.col("doc_id") % 7 == 0, -1).otherwise(F.col("doc_id"))
    who = t.select(
        "doc_id", F.substring("text", 3, 9).alias("name"), F.coalesce(F.get(tx.emails_in(F.col("text")), 0), F.lit("")).alias("email"), F.when(F.col("doc_id") % 4 == 0, "0012345678").otherwise("").alias("phone"), url(page_id).alias("source_url"),
        F.substring("text", 3, 20).alias("evidence_quote"), F.when(F.col("doc_id") % 6 == 0, url(F.col("doc_id") + 1)).alias("email_source_url"), F.when(F.col("doc_id") % 9 == 0, "other.net").otherwise("host.org").alias("official"),
    )
    pages = t.select(url(F.col("doc_id")).alias("url"), "text", (F.char_length("source") > 4).alias("uncertified"))
    return verification.contact_notes(who, pages, "doc_id")


def _notes_sql() -> str:
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source, list_transform(regexp_extract_all(coalesce(text, ''), '<([^<>\s@]+@[^<>\s]+)>', 1), lambda x: regexp_replace(x, '[.,;:]+$', '')) AS marked,
           list_transform(regexp_extract_all(coalesce(text, ''), '{tx.EMAIL}'), lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{"|".join(tx.ENDINGS)}))[A-Z].*$', '\1')) AS plain FROM documents),
w AS (SELECT doc_id, t[3:11] AS name, coalesce(CASE WHEN len(marked) > 0 THEN marked[1] ELSE plain[1] END, '') AS email, CASE WHEN doc_id % 4 = 0 THEN '12345678' ELSE '' END AS phone, CASE WHEN doc_id % 5 = 0 THEN doc_id + 3 WHEN doc_id % 7 = 0 THEN -1 ELSE doc_id END AS s,
      t[3:22] AS quote, CASE WHEN doc_id % 9 = 0 THEN 'other.net' ELSE 'host.org' END AS site FROM d),
m AS (SELECT *, CASE WHEN doc_id % 6 = 0 THEN doc_id + 1 ELSE s END AS e FROM w),
j AS (SELECT m.*, a.t AS st, coalesce(length(a.source) > 4, false) AS bad, CASE WHEN e <> s THEN coalesce(b.t, '') ELSE a.t END AS et, {_comparable_sql("quote")} AS q, string_split(email, '@')[-1] AS at_host FROM m LEFT JOIN d a ON a.doc_id = s LEFT JOIN d b ON b.doc_id = e),
p AS (SELECT *, list_filter([CASE WHEN NOT (length(q) >= 3 AND contains({_comparable_sql("st")}, q)) THEN 'quote not on page' END, CASE WHEN NOT contains({_comparable_sql("st")}, {_comparable_sql("name")}) THEN 'name not on page' END,
      CASE WHEN email <> '' AND NOT contains(lower(et), lower(trim(email))) THEN 'email not on page' END,
      CASE WHEN e <> s AND NOT (at_host = site OR ends_with(at_host, '.' || site) OR ends_with(site, '.' || at_host)) THEN 'email is not on the institute''s own domain' END,
      CASE WHEN phone <> '' AND NOT contains(regexp_replace(st, '[^0-9]', '', 'g'), phone) THEN 'phone not on page' END, CASE WHEN site <> 'host.org' THEN 'source not on the institute''s own domain' END], lambda x: x IS NOT NULL) AS wrong FROM j)
SELECT doc_id, CASE WHEN name = '' THEN false WHEN st IS NULL THEN NULL ELSE len(wrong) = 0 END AS verified,
       CASE WHEN name = '' THEN 'no contact found' WHEN st IS NULL THEN 'cited page was not read by the fetcher (cannot check)' WHEN len(wrong) > 0 THEN array_to_string(wrong, '; ')
         ELSE 'name' || CASE WHEN email <> '' THEN ', email' ELSE '' END || CASE WHEN phone <> '' THEN ', phone' ELSE '' END || ' found on page' || CASE WHEN bad THEN ' (site certificate could not be verified)' ELSE '' END END AS note FROM p
"""


def recheck_list(spark: SparkSession, d: str) -> DataFrame:
    """Orders as results: how many are set aside in a second round, with and without a search for websites, and how many after that."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.lit("School "), "o_orderpriority").alias("name"), F.when(F.col("o_orderstatus") == "F", "x.org").alias("site"), F.when(F.col("o_totalprice") > 100_000, "Jo").alias("contact"),
        F.when(F.col("o_orderkey") % 4 == 0, "Website not found: search unavailable").when(F.col("o_orderkey") % 4 == 1, "Website not found").alias("notes"), (F.col("o_custkey") % 3).alias("rechecked"),
    )
    args = [F.col(c) for c in ("name", "site", "contact", "notes", "rechecked")]
    out = None
    for websites in (False, True):
        stay, again = verification.set_aside(o, verification.needs_recheck(*args, 2, websites), "rechecked", 2)
        twice = again.filter(verification.needs_recheck(*args, 2, websites))
        part = stay.agg(F.count("*").alias("stay")).join(again.agg(F.count("*").alias("again"))).join(twice.agg(F.count("*").alias("twice"))).select(F.lit(websites).alias("websites"), "stay", "again", "twice")
        out = part if out is None else out.unionByName(part)
    return out


RECHECK_SQL = """
WITH o AS (SELECT o_orderstatus = 'F' AS site, o_totalprice > 100000 AS contact, o_orderkey % 4 = 0 AS unsearched, o_orderkey % 4 < 2 AS none, o_custkey % 3 >= 2 AS done FROM orders),
n AS (SELECT false AS websites, NOT done AND site AND NOT contact AND NOT none AS again, false AS twice FROM o UNION ALL SELECT true, unsearched OR (NOT done AND none AND NOT contact), unsearched FROM o)
SELECT websites, count_if(NOT again)::BIGINT AS stay, count_if(again)::BIGINT AS again, count_if(twice)::BIGINT AS twice FROM n GROUP BY 1
"""


def query_names(spark: SparkSession, d: str) -> DataFrame:
    """Names for a search, and what refusals say, over all parts and events."""
    p = table(spark, d, "part").select(F.concat_ws(" ", results.full_name(F.col("p_name"), F.col("p_type")), F.when(F.col("p_size") % 3 == 0, F.lit("- Campus North")).when(F.col("p_size") % 3 == 1, F.lit("GmbH"))).alias("x"))
    return p.select(results.query_name(F.col("x")).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


NAMES_SQL = r"""
WITH p AS (SELECT trim(p_name) || ' ' || trim(p_type) || CASE WHEN p_size % 3 = 0 THEN ' - Campus North' WHEN p_size % 3 = 1 THEN ' GmbH' ELSE '' END AS x FROM part)
SELECT trim(regexp_replace(regexp_replace(x, '\s+[-–]\s.*$', ''), '(?i)[,\s]+(?:gmbh|ltd|llc|inc|s\.?a|s\.?r\.?l|b\.?v|e\.?v|plc|ag)\.?$', '')) AS name, count(*) AS n FROM p GROUP BY 1
"""

def shared_inboxes(spark: SparkSession, d: str) -> DataFrame:
    """Three documents at a time as an institution's pages, an address of one of four kinds printed on each, some at a provider of free mail: the best inbox of each."""
    t = table(spark, d, "documents").select("doc_id", F.floor(F.col("doc_id") / 3).alias("entity"), F.coalesce("text", F.lit("")).alias("text"))
    domain = F.concat(F.lit("mail"), F.col("entity") % 8, F.lit(".example.com"))
    local = F.get(F.array(*map(F.lit, ("marie", "info", "jobs", "international"))), (F.col("doc_id") % 4).cast("int"))
    said = F.concat("text", F.lit("\n"), local, F.lit("@"), F.when(F.col("doc_id") % 5 < 2, "gmail.com").otherwise(domain))
    pages = t.select("entity", (F.col("doc_id") % 3).alias("i"), F.concat(F.lit("http://www."), domain, F.when(F.col("doc_id") % 2 == 0, "/contact/").otherwise("/"), F.col("doc_id")).alias("url"), said.alias("text"))
    sites = t.select("entity").distinct().select("entity", F.concat(F.lit("http://www."), domain, F.lit("/")).alias("site"), F.lit("Some Institution").alias("name"))
    return inboxes.shared_inboxes(pages, sites, "entity").select("entity", "email", F.substring_index("url", "/", -1).alias("page"), F.col("tier").cast("bigint").alias("tier"))


def _inbox_sql() -> str:
    made = PAGE_EMAILS.replace("coalesce(text, '')", "said").replace("FROM documents", "FROM told")
    return rf"""
WITH told AS (SELECT doc_id, coalesce(text, '') || chr(10) || ['marie', 'info', 'jobs', 'international'][doc_id % 4 + 1] || '@' || CASE WHEN doc_id % 5 < 2 THEN 'gmail.com' ELSE 'mail' || (doc_id // 3) % 8 || '.example.com' END AS said FROM documents), {made},
x AS (SELECT doc_id // 3 AS entity, doc_id, doc_id % 3 AS i, 'mail' || (doc_id // 3) % 8 || '.example.com' AS host, unnest(e) AS email FROM e),
y AS (SELECT *, string_split(email, '@')[1] AS l, string_split(email, '@')[-1] AS h, string_split(host, '.')[1] AS label FROM x),
o AS (SELECT *, CASE WHEN h = host OR ends_with(h, '.' || host) OR ends_with(host, '.' || h) THEN CASE WHEN regexp_matches(l, '{inboxes.INTERNATIONAL}') THEN 0 WHEN regexp_matches(l, '^({"|".join(inboxes.OFFICES)})') OR (length(l) >= 3 AND (contains(label, l) OR contains(l, label))) THEN 1 ELSE 2 END
      WHEN h = 'gmail.com' AND (i = 0 OR doc_id % 2 = 0) THEN 3 END AS tier FROM y WHERE NOT regexp_matches(l, '{inboxes.NOT_SHARED}')),
t AS (SELECT entity, email, max(tier) AS tier, count(*) AS n, min(i * 1000000000 + doc_id) AS first FROM o WHERE tier IS NOT NULL GROUP BY 1, 2)
SELECT entity, email, (first % 1000000000)::VARCHAR AS page, tier::BIGINT AS tier FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY tier, n DESC, first, email) AS r FROM t) WHERE r = 1
"""


def institution_tabs(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as tabs of a workbook: their large returned lines as partners, their nation as a campus if they have a balance."""
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("row_id"), "s_suppkey", F.col("s_name").alias("name"), "s_nationkey", "s_acctbal")
    li = table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 45").select(F.concat(F.lit("s"), "l_suppkey").alias("row_id"), F.col("l_orderkey").alias("s_suppkey"), "l_partkey", "l_quantity")
    campus = s.filter("s_acctbal > 0").select("row_id", "s_suppkey", F.concat(F.lit("Nation "), "s_nationkey").alias("campus"))
    tabs = workbook.institution_tabs(s, [("Partners ({n})", li, [("l_partkey", "Part"), ("", ""), ("s_suppkey", "Order")]), ("Campuses ({n})", campus, [("campus", "Campus")])], "row_id", "name", "s_suppkey", ["Institutions"])
    return tabs.groupBy("title").agg(F.max("line").cast("bigint").alias("lines"), F.sum(F.char_length(F.array_join("cells", "|"))).cast("bigint").alias("chars"))


TABS_SQL = """
WITH p AS (SELECT l_suppkey AS k, count(*) AS n, sum(length(l_partkey || '||' || l_orderkey)) AS c FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45 GROUP BY 1),
s AS (SELECT s_suppkey AS k, s_name, s_acctbal > 0 AS campus, s_nationkey, coalesce(n, 0) AS n, coalesce(c, 0) AS c FROM supplier LEFT JOIN p ON k = s_suppkey)
SELECT trim(('s' || k || ' ' || s_name)[1:31]) AS title, (2 + CASE WHEN n > 0 THEN 3 + n ELSE 0 END + CASE WHEN campus THEN 4 ELSE 0 END)::BIGINT AS lines,
       (length(s_name) + 2 + length('Back to all institutes') + 2 + CASE WHEN n > 0 THEN 2 + length('Partners (' || n || ')') + 2 + length('Part||Order') + c ELSE 0 END + CASE WHEN campus THEN 2 + length('Campuses (1)') + 2 + length('Campus') + 2 + length('Nation ' || s_nationkey) + 2 ELSE 0 END)::BIGINT AS chars
FROM s WHERE n > 0 OR campus
"""

QUERIES = {
    "shared_inboxes": (shared_inboxes, _inbox_sql()),
    "institution_tabs": (institution_tabs, TABS_SQL),
    "sheet_import": (sheet_import, SHEET_SQL),
    "headerless_sheet": (headerless_sheet, HEADERLESS_SQL),
    "contact_notes": (contact_notes, _notes_sql()),
    "recheck_list": (recheck_list, RECHECK_SQL),
    "query_names": (query_names, NAMES_SQL),
}
