"""Queries of resolving claims, registers and lists over whole tables, with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import contacts, keys
from tidewell.functions import text as tx
from tidewell.operators import resolve, results
from tidewell.sources.tables import table

EMAIL = tx.EMAIL


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """All lines of all documents, numbered from 1: entity, page, n, line."""
    t = table(spark, d, "documents").select("doc_id", "source", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    return t.select(F.col("doc_id").alias("entity"), F.col("source").alias("page"), (F.col("i") + 1).alias("n"), "line")


LINES = "lines AS (SELECT doc_id AS entity, source AS page, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)"


def phone_lines(spark: SparkSession, d: str) -> DataFrame:
    """The first line of every document that bears its first number."""
    phones = table(spark, d, "documents").select(F.col("doc_id").alias("entity"), tx.first_phone(F.coalesce("text", F.lit(""))).alias("phone")).filter("phone IS NOT NULL")
    return resolve.phone_on_lines(_lines(spark, d), phones, "entity", "phone").select("entity", F.col("n").cast("bigint").alias("n"))


TOK = "list_distinct(list_filter(string_split(trim(regexp_replace(strip_accents(lower({})), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= {}))"
PHONE_SQL = rf"""
WITH {LINES}, p AS (SELECT doc_id AS entity, right(regexp_replace(list_filter(regexp_extract_all(coalesce(text, ''), '(\+?[0-9(][0-9() ./-]{{6,}}[0-9])', 1), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 8)[1], '[^0-9]', '', 'g'), 8) AS d FROM documents)
SELECT entity, min(n)::BIGINT AS n FROM lines JOIN p USING (entity) WHERE length(d) >= 7 AND contains(regexp_replace(line, '[^0-9]', '', 'g'), d) GROUP BY 1
"""


def resolved_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Claims that the person named by the first two words of a line, with capitals, holds a role there: every line that has two, the next line as the role's,
    the document's first address and number as theirs. Some lines state a role in place of a frequent word."""
    lines = claim_lines(spark, d)
    mail = lines.groupBy("entity").agg(F.min(F.when(F.col("line").rlike(EMAIL), F.col("n"))).alias("email_n"), F.min(F.when(tx.first_phone(F.col("line")).isNotNull(), F.col("n"))).alias("phone_n"))
    name = lines.filter(F.col("line").rlike(r"^[A-Za-z]+ [A-Za-z]+ ")).select("entity", F.col("n").alias("claim"), F.initcap(F.substring_index("line", " ", 2)).alias("name"), F.when(F.col("n") % 2 == 0, "mobility_coordinator").otherwise("boss").alias("role_class"), F.col("n").alias("name_n"), (F.col("n") + 1).alias("role_n"))
    out = resolve.resolve_contacts(name.join(mail, "entity"), lines, "entity")
    return out.select("entity", F.col("claim").cast("bigint").alias("claim"), "name", "role_class", "email", "phone", F.md5(F.encode("quote", "UTF-8")).alias("quote_md5"), "confidence", F.col("place").cast("bigint").alias("place"))


def claim_lines(spark: SparkSession, d: str) -> DataFrame:
    """All lines of all documents, 'the' and 'que' read as a title."""
    said = F.replace(F.replace("line", F.lit(" the "), F.lit(" Director ")), F.lit(" que "), F.lit(" Erasmus "))
    return _lines(spark, d).withColumn("line", said)


CLAIM_LINES = LINES.replace("lines AS (", "lines0 AS (") + ", lines AS (SELECT entity, page, n, replace(replace(line, ' the ', ' Director '), ' que ', ' Erasmus ') AS line FROM lines0)"
TOKENS = "regexp_extract_all(strip_accents(lower({})), '([a-z]{{{},}})', 1)"


def _resolved_sql() -> str:
    mails = lambda t: rf"CASE WHEN regexp_matches({t}, '<[^<>\s@]+@[^<>\s]+>') THEN list_transform(regexp_extract_all({t}, '<([^<>\s@]+@[^<>\s]+)>', 1), lambda x: regexp_replace(x, '[.,;:]+$', '')) ELSE list_transform(regexp_extract_all({t}, '{EMAIL}'), lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{'|'.join(tx.ENDINGS)}))[A-Z].*$', '\1')) END"
    phone = r"list_filter(regexp_extract_all({}, '(\+?[0-9(][0-9() ./-]{{6,}}[0-9])', 1), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 8)[1]"
    fits = "len(list_filter(nt, lambda t: contains(strip_accents(lower(string_split({}, '@')[1])), t))) > 0"
    words = "list_filter(string_split(name, ' '), lambda x: lower(regexp_replace(x, '^[.,]+|[.,]+$', '', 'g')) NOT IN {})".format((*contacts.NAME_PARTICLES, *contacts.NAME_TITLES))
    return rf"""
WITH {CLAIM_LINES}, m AS (SELECT entity, min(CASE WHEN regexp_matches(line, '{EMAIL}') THEN n END) AS en, min(CASE WHEN {phone.format("line")} IS NOT NULL THEN n END) AS pn FROM lines GROUP BY 1),
c AS (SELECT l.entity, l.n, l.page, l.line AS nl, string_split(l.line, ' ') AS w, r.line AS r0, e.line AS el, p.line AS pl, m.en, m.pn FROM lines l JOIN m USING (entity) LEFT JOIN lines r ON r.entity = l.entity AND r.n = l.n + 1 AND r.page = l.page
      LEFT JOIN lines e ON e.entity = l.entity AND e.n = m.en AND e.page = l.page LEFT JOIN lines p ON p.entity = l.entity AND p.n = m.pn AND p.page = l.page WHERE regexp_matches(l.line, '^[A-Za-z]+ [A-Za-z]+ ')),
k AS (SELECT *, upper(w[1][1]) || lower(w[1][2:]) || ' ' || upper(w[2][1]) || lower(w[2][2:]) AS name, coalesce(r0, nl) AS rl, r0 IS NULL AS same FROM c),
t AS (SELECT *, {TOKENS.format("name", 2)} AS toks, {TOK.format("name", 3)} AS nt, list_concat({mails("coalesce(el, '')")}, {mails("nl")}, {mails("rl")}) AS es FROM k),
u AS (SELECT *, list_filter(es, lambda e, i: list_position(list_transform(es, lambda x: lower(x)), lower(e)) = i) AS u FROM t WHERE len(toks) > 0 AND len(list_filter(toks, lambda x: NOT contains(strip_accents(lower(nl)), x))) = 0
      AND len({words}) >= 2 AND len(list_filter({words}, lambda x: regexp_matches(strip_accents(lower(x)), '{"|".join(contacts.ROLE_STEMS)}'))) = 0),
v AS (SELECT *, coalesce(list_filter(u, lambda e: {fits.format("e")})[1], CASE WHEN len(u) = 1 THEN u[1] END, '') AS email, strip_accents(lower(rl || ' ' || nl)) AS said FROM u),
g AS (SELECT *, CASE WHEN n % 2 = 0 THEN 'mobility_coordinator' ELSE 'other' END AS role_class FROM v WHERE regexp_matches(said, '{"|".join(contacts.ROLE_STEMS)}') OR regexp_matches(said, '\b(?:{"|".join(contacts.BUSINESS_ROLES)})\b')
      OR (regexp_matches(strip_accents(lower(rl)), '{resolve.REMIT}') AND ((el IS NOT NULL AND abs(en - n) <= 6) OR (pl IS NOT NULL AND abs(pn - n) <= 6))) OR (email <> '' AND {fits.format("email")} AND (el IS NULL OR abs(en - n) <= 3)))
SELECT entity, n::BIGINT AS claim, name, role_class, email, CASE WHEN pl IS NULL THEN '' ELSE coalesce({phone.format("pl")}, '') END AS phone, md5(CASE WHEN same THEN nl ELSE nl || ' ... ' || rl END) AS quote_md5,
       round_even(greatest(0.3, least(0.95, CASE role_class WHEN 'other' THEN 0.3 ELSE 0.8 END + CASE WHEN email <> '' THEN 0.05 ELSE -0.1 END)), 2)::DOUBLE AS confidence,
       row_number() OVER (PARTITION BY entity ORDER BY role_class = 'other', email = '', n) AS place FROM g
"""


def networks(spark: SparkSession, d: str) -> DataFrame:
    """Parts' types as partners of their brand: each folded first word once, those in the brand's largest part's type dropped as its own."""
    p = table(spark, d, "part")
    partners = p.select("p_brand", F.substring_index("p_name", " ", 1).alias("name"), F.col("p_partkey").alias("k"))
    own = p.groupBy("p_brand").agg(F.max_by(F.substring_index("p_name", " ", 1), F.struct("p_size", "p_partkey")).alias("name"))
    return resolve.resolve_network(partners, own, "p_brand", "name", "k")


NETWORK_SQL = """
WITH p AS (SELECT p_brand, string_split(p_name, ' ')[1] AS name, p_partkey AS k, p_size FROM part), f AS (SELECT *, regexp_replace(strip_accents(lower(name)), '[^a-z0-9]', '', 'g') AS key FROM p),
o AS (SELECT p_brand, arg_max(key, (p_size, k)) AS own FROM f GROUP BY 1)
SELECT p_brand, min(k) AS k, arg_min(name, k) AS name FROM f JOIN o USING (p_brand) WHERE key <> '' AND key <> own GROUP BY p_brand, key
"""


def topic_people(spark: SparkSession, d: str) -> DataFrame:
    """Lines that begin with a capital as people: those with a word of the remit within two lines and an address or number within six."""
    lines = _lines(spark, d)
    people = lines.filter(F.col("line").rlike("^[A-Z]")).select("entity", F.col("n").alias("person"), "n")
    return resolve.topic_roles(people, lines, "entity", "tion|ein").select("entity", F.col("person").cast("bigint").alias("person"))


TOPIC_SQL = rf"""
WITH {LINES}, p AS (SELECT entity, page, n FROM lines WHERE regexp_matches(line, '^[A-Z]')),
o AS (SELECT entity, page, n AS m, regexp_matches(lower(line), 'tion|ein') AS remit, regexp_matches(line, '{EMAIL}|[0-9][0-9 ()/-]{{7,}}[0-9]') AS reach FROM lines)
SELECT p.entity, p.n::BIGINT AS person FROM p JOIN o ON o.entity = p.entity AND o.page = p.page AND abs(m - n) <= 6 GROUP BY p.entity, p.n HAVING bool_or(remit AND abs(m - n) <= 2) AND bool_or(reach)
"""


def town_matches(spark: SparkSession, d: str) -> DataFrame:
    """Parts' names as names of a place: the brand whose part of the same kind, whose town is the last word, has just the same other words."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.substring_index("p_type", " ", 1).alias("country"), F.split(F.lower("p_name"), " ").alias("words"))
    names = p.select(F.col("p_partkey").alias("name_id"), "country", "words")
    register = p.select(F.col("p_partkey").alias("entry_id"), F.col("p_brand").alias("grp"), "country", F.slice("words", -1, 1).alias("town"), "words")
    return resolve.town_match(names, register, ("red", "blue"))


TOWN_SQL = """
WITH p AS (SELECT p_partkey AS k, p_brand AS grp, string_split(p_type, ' ')[1] AS cc, string_split(lower(p_name), ' ') AS w FROM part), t AS (SELECT *, list_filter(w, lambda x: length(x) >= 3 AND x NOT IN ('red', 'blue')) AS s, w[-1] AS town FROM p),
f AS (SELECT a.k AS name_id, b.grp FROM t a JOIN t b ON a.cc = b.cc AND list_contains(a.w, b.town) AND length(b.town) > 3
      WHERE len(list_filter(a.s, lambda x: x <> b.town)) > 0 AND list_has_all(list_concat(b.s, [b.town]), list_filter(a.s, lambda x: x <> b.town)) AND list_has_all(a.s, list_filter(b.s, lambda x: x <> b.town)))
SELECT name_id, min(grp) AS grp FROM f GROUP BY 1 HAVING count(DISTINCT grp) = 1
"""


def directory_matches(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items in a directory of documents by their first four words: the one document that holds them, or the one of several whose source the item names."""
    words = lambda t: F.array_distinct(F.filter(F.split(keys.folded_words(F.coalesce(t, F.lit(""))), " "), lambda w: F.char_length(w) >= 3))
    names = table(spark, d, "benchmark").select(F.col("item_id").alias("name_id"), words(F.col("text")).alias("words"))
    register = table(spark, d, "documents").select(F.col("doc_id").alias("entry_id"), F.coalesce(F.lower("source"), F.lit("")).alias("town"), words(F.col("text")).alias("words"))
    return resolve.directory_match(names, register, ("the", "and", "les", "der"))


DIRECTORY_SQL = r"""
WITH n AS (SELECT item_id, list_filter(string_split(trim(regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3) AS w FROM benchmark),
u AS (SELECT item_id, list_filter(w, lambda v, i: list_position(w, v) = i) AS w FROM n), c AS (SELECT item_id, w, list_filter(w, lambda v: v NOT IN ('the', 'and', 'les', 'der'))[1:4] AS core FROM u),
d AS (SELECT doc_id, lower(coalesce(source, '')) AS town, string_split(trim(regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
f AS (SELECT item_id, doc_id, list_contains(c.w, town) AS here FROM c JOIN d ON len(core) > 0 AND list_has_all(d.w, core))
SELECT item_id AS name_id, CASE WHEN count(*) = 1 THEN min(doc_id) ELSE min(CASE WHEN here THEN doc_id END) END AS entry_id FROM f GROUP BY 1 HAVING count(*) = 1 OR count_if(here) = 1
"""


def on_file_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a customer as contacts by their priority and status; those with both words of the first order's priority, or with its clerk's address, are on file and go last."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("name"), F.concat(F.lower("o_orderstatus"), F.col("o_orderkey") % 7, F.lit("@X.org")).alias("email"))
    known = o.groupBy("o_custkey").agg(F.min_by("name", "o_orderkey").alias("name"), F.lower(F.min_by("email", "o_orderkey")).alias("email"))
    return resolve.on_file(o, known, "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey", "known", F.col("place").cast("bigint").alias("place"))


ON_FILE_SQL = r"""
WITH t AS (SELECT o_custkey, o_orderkey, lower(o_orderpriority || ' ' || o_orderstatus) AS name, lower(o_orderstatus) || (o_orderkey % 7) AS mail FROM orders),
k AS (SELECT o_custkey, regexp_extract_all(arg_min(name, o_orderkey), '([a-z]{3,})', 1)[1:2] AS k, arg_min(mail, o_orderkey) AS m FROM t GROUP BY 1),
f AS (SELECT o_custkey, o_orderkey, (len(k) > 0 AND len(list_filter(k, lambda x: NOT contains(name, x))) = 0) OR mail = m AS known FROM t JOIN k USING (o_custkey))
SELECT o_custkey, o_orderkey, known, row_number() OVER (PARTITION BY o_custkey ORDER BY known, o_orderkey) AS place FROM f
"""


def tool_calls(spark: SparkSession, d: str) -> DataFrame:
    """The turns of every conversation as calls of tools by their role; what each is answered."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.col("conv_id").alias("id"), F.coalesce("role", F.lit("none")).alias("name")))).alias("items"))
    out = resolve.tool_calls(c, {"user": F.lit("Noted."), "assistant": F.concat(F.lit("Booked for "), F.col("c.turn"))})
    return out.groupBy("id", "text").agg(F.count("*").alias("n"), F.sum("place").cast("bigint").alias("places"))


TOOLS_SQL = """
WITH r AS (SELECT conv_id AS id, turn, coalesce(role, 'none') AS name, row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, 'none')) - 1 AS place FROM conversations)
SELECT id, CASE name WHEN 'user' THEN 'Noted.' WHEN 'assistant' THEN 'Booked for ' || turn ELSE 'Sorry, I can''t do that.' END AS text, count(*) AS n, sum(place)::BIGINT AS places FROM r GROUP BY 1, 2
"""


def contact_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents by source as rows of a sheet: how many have an own and an office address, the first line being the person."""
    t = table(spark, d, "documents").select("source", F.substring(F.coalesce("text", F.lit("")), 1, 40).alias("person"), F.coalesce(F.get(tx.emails_in(F.coalesce("text", F.lit(""))), 0), F.lit("")).alias("email"))
    return resolve.contact_counts(t, F.coalesce("source", F.lit("")), resolve.contact_kind(F.col("person"), F.col("email")))


COUNTS_SQL = rf"""
WITH f AS (SELECT source, coalesce(text, '')[1:40] AS person, list_transform(regexp_extract_all(coalesce(text, ''), '<([^<>\s@]+@[^<>\s]+)>', 1), lambda x: regexp_replace(x, '[.,;:]+$', '')) AS marked,
                  list_transform(regexp_extract_all(coalesce(text, ''), '{EMAIL}'), lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{"|".join(tx.ENDINGS)}))[A-Z].*$', '\1')) AS plain FROM documents),
e AS (SELECT coalesce(source, '') AS key, person, coalesce(CASE WHEN len(marked) > 0 THEN marked[1] ELSE plain[1] END, '') AS email FROM f),
k AS (SELECT key, CASE WHEN email = '' THEN '' WHEN len(list_filter(string_split(trim(regexp_replace(strip_accents(lower(person)), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND contains(strip_accents(lower(string_split(email, '@')[1])), w))) > 0 THEN 'own' ELSE 'office' END AS kind FROM e)
SELECT key, count(*) AS n, count_if(kind = 'own')::BIGINT AS own, count_if(kind = 'office')::BIGINT AS office FROM k GROUP BY 1
"""


def ranked_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The ten best customers of each segment by a weighted score; those in debt are dropped."""
    c = table(spark, d, "customer")
    score = F.floor(F.col("c_acctbal") / 1000) * 2 + F.when(F.col("c_nationkey") < 10, 3).otherwise(0)
    out = resolve.ranked_profiles(c, "c_mktsegment", score, "c_custkey", F.col("c_acctbal") >= 0, 10)
    return out.select("c_mktsegment", "c_custkey", F.col("score").cast("bigint").alias("score"), F.col("place").cast("bigint").alias("place"))


PROFILES_SQL = """
WITH s AS (SELECT c_mktsegment, c_custkey, (floor(c_acctbal / 1000) * 2 + CASE WHEN c_nationkey < 10 THEN 3 ELSE 0 END)::BIGINT AS score FROM customer WHERE c_acctbal >= 0),
p AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY score DESC, c_custkey) AS place FROM s) SELECT * FROM p WHERE place <= 10
"""


def partner_order(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders as partners of their supplier: the block of its first line, and the rank of the flag; counted by block."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_returnflag")
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return resolve.partner_order(li, li, "l_suppkey", "l_orderkey", rank, "l_orderkey").groupBy("block", "rank").agg(F.count("*").alias("n"))


def tried_leads(spark: SparkSession, d: str) -> DataFrame:
    """Customers as leads: the hashes of what was tried, as a digest of their number."""
    c = table(spark, d, "customer")
    h = resolve.tried_hashes([F.col("c_name"), F.lit("12"), F.concat(F.lit("+49 30 "), F.substring("c_name", -6, 6))], F.when(F.col("c_acctbal") > 0, F.concat(F.lower("c_mktsegment"), F.lit("@b.org"))))
    return c.select("c_custkey", F.array_join(h, ",").alias("hashes"))


TRIED_SQL = r"""
WITH d AS (SELECT c_custkey, c_acctbal, c_mktsegment, regexp_replace(c_name, '[^0-9]', '', 'g') AS a, '4930' || regexp_replace(c_name[-6:], '[^0-9]', '', 'g') AS b FROM customer),
h AS (SELECT c_custkey, [CASE WHEN length(a) >= 6 THEN sha256('p:' || right(a, 8))[1:16] END, CASE WHEN length(b) >= 6 THEN sha256('p:' || right(b, 8))[1:16] END, CASE WHEN c_acctbal > 0 THEN sha256('e:' || lower(c_mktsegment) || '@b.org')[1:16] END] AS h FROM d)
SELECT c_custkey, array_to_string(list_filter(h, lambda x, i: x IS NOT NULL AND list_position(h, x) = i), ',') AS hashes FROM h
"""


def refreshed_queue(spark: SparkSession, d: str) -> DataFrame:
    """Priorities as batches of customers: open orders are queued, all orders came."""
    o = table(spark, d, "orders")
    queue = o.filter("o_orderstatus = 'O'").select(F.concat_ws("-", "o_orderpriority", F.year("o_orderdate")).alias("batch"), "o_custkey", (F.col("o_orderpriority") < "3").alias("started"))
    return resolve.refreshed_queue(queue, o.select(F.concat_ws("-", "o_orderpriority", F.year("o_orderdate")).alias("batch"), "o_custkey"), "batch", "o_custkey")


QUEUE_SQL = """
WITH o AS (SELECT o_orderpriority || '-' || year(o_orderdate) AS batch, o_custkey, o_orderstatus, o_orderpriority < '3' AS s FROM orders),
h AS (SELECT batch, count(*) AS had, bool_or(s) AS started FROM o WHERE o_orderstatus = 'O' GROUP BY 1), c AS (SELECT batch, count(*) AS came FROM o GROUP BY 1),
f AS (SELECT batch, count(DISTINCT o_custkey) AS fresh FROM o WHERE (batch, o_custkey) NOT IN (SELECT batch, o_custkey FROM o WHERE o_orderstatus = 'O') GROUP BY 1),
a AS (SELECT batch, came, coalesce(fresh, 0) AS fresh, CASE WHEN started IS NULL THEN 'add' WHEN NOT started AND came > coalesce(had, 0) THEN 'replace' WHEN coalesce(fresh, 0) > 0 THEN 'extra' ELSE 'none' END AS action FROM c LEFT JOIN h USING (batch) LEFT JOIN f USING (batch))
SELECT batch, action, CASE action WHEN 'extra' THEN fresh WHEN 'none' THEN 0 ELSE came END::BIGINT AS rows FROM a
"""


def keyword_roles(spark: SparkSession, d: str) -> DataFrame:
    """The words of parts' names as keywords of their brand, each once whatever its case, as the first part has it."""
    p = table(spark, d, "part").select("p_brand", "p_partkey", F.posexplode(F.split(F.concat_ws(" ", "p_name", F.initcap("p_name")), " ")).alias("i", "word"))
    return resolve.keyword_roles(p.withColumn("k", F.col("p_partkey") * 100 + F.col("i")), "p_brand", "word", "k")


KEYWORD_SQL = """
WITH s AS (SELECT p_brand, p_partkey, string_split(p_name, ' ') AS w FROM part), e AS (SELECT p_brand, p_partkey * 100 + unnest(range(0, len(w))) AS k, unnest(w) AS word FROM s)
SELECT p_brand, arg_min(word, k) AS word FROM e WHERE trim(word) <> '' GROUP BY p_brand, lower(trim(word))
"""


def registry_union(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers as two registers whose heads are the first of their nation; the head's address goes before."""
    c = table(spark, d, "customer").select(F.concat(F.lit("n"), F.col("c_custkey")).alias("code"), F.concat(F.lit("n"), F.col("c_nationkey")).alias("head"), F.when(F.col("c_acctbal") > 0, F.lower("c_mktsegment")).otherwise("-").alias("email"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("code"), F.concat(F.lit("n"), F.col("s_nationkey")).alias("head"), F.lit("N/A").alias("email"), F.col("s_name").alias("name"))
    return resolve.registry_union([c, s], "code", "head", ["email", "name"]).select("code", "email", "name", F.col("source").cast("bigint").alias("source"))


UNION_SQL = """
WITH c AS (SELECT 'n' || c_custkey AS code, 'n' || c_nationkey AS head, CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) ELSE '' END AS email, c_name AS name, 0 AS source FROM customer UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, '', s_name, 1 FROM supplier),
h AS (SELECT code AS head, max(email) AS he FROM c GROUP BY 1)
SELECT code, coalesce(nullif(he, ''), email) AS email, name, source::BIGINT AS source FROM c LEFT JOIN h USING (head)
"""


def cached_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every page's address without its query asked of a cache of all pages, the latest of equal keys."""
    p = table(spark, d, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    bare = F.regexp_replace("url", r"\?.*$", "")
    cache = p.select("page_id", "url", bare.alias("final_url"), F.col("page_id").alias("at"))
    return resolve.cached_pages(p.select(F.col("page_id").alias("asked"), F.concat(bare, F.lit("#top")).alias("url")), cache, keys.url_key).select("asked", "page_id")


CACHED_SQL = r"""
WITH k AS (SELECT page_id, regexp_replace(coalesce(url, ''), '\?.*$', '') AS bare, coalesce(url, '') AS url FROM pages),
n AS (SELECT page_id, unnest([url, bare]) AS u FROM k), c AS (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^www\.', ''), '/+$', '') AS key, max(page_id) AS page_id FROM n GROUP BY 1)
SELECT k.page_id AS asked, c.page_id FROM k LEFT JOIN c ON c.key = regexp_replace(regexp_replace(regexp_replace(regexp_replace(bare, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^www\.', ''), '/+$', '')
"""


def json_objects(spark: SparkSession, d: str) -> DataFrame:
    """The props of all events nested six deep in prose and fences, beside a string that holds braces: the object that is in it."""
    inner = F.concat(F.repeat(F.lit('{"in": '), F.lit(6)), F.coalesce("props", F.lit("null")), F.repeat(F.lit("}"), F.lit(6)))
    said = F.concat(F.lit('Here it is: ```json\n{"said": "}\\"{", "at": '), inner, F.lit("}\n``` as {asked}"))
    return table(spark, d, "events").select("event_id", F.coalesce(resolve.json_object(said), F.lit("")).alias("object"))


def clean_report(spark: SparkSession, d: str) -> DataFrame:
    """Turns of conversations as attempts: per category how many, and how many to review."""
    c = table(spark, d, "conversations").select("conv_id", F.lit("x").alias("column"), "text")
    return results.clean_report(results.attempt_rows(c, "conv_id", "column", "text"))


def _report_sql() -> str:
    each = ", ".join(f"CASE WHEN regexp_matches(lower(t), '{p}') THEN '{c}' END" for c, p in tx.ATTEMPT_RULES)
    return rf"""
WITH t AS (SELECT trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM conversations), h AS (SELECT t, list_filter([{each}], lambda x: x IS NOT NULL) AS h FROM t WHERE t <> ''),
c AS (SELECT CASE WHEN contains(lower(t), 'respond well') OR len(h) = 0 THEN ['other'] ELSE h END AS c FROM h)
SELECT c[1] AS category, count(*) AS attempts, count_if(len(c) > 1 OR c[1] IN ('other', 'speaker_unclear'))::BIGINT AS to_review FROM c GROUP BY 1
"""


def flag_counts(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as imported rows: how often each flag stands."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    country = F.when(F.col("s_acctbal") > 0, F.col("n_name")).otherwise("")
    flags = contacts.row_flags(F.col("s_name"), country, F.array(F.col("s_name"), F.lit("49")), F.when(F.col("s_nationkey") > 5, "Germany"), F.when(F.col("s_acctbal") > 5000, F.col("s_name")))
    return results.flag_counts(s.select(flags.alias("flags")), "flags")


FLAGS_SQL = """
WITH s AS (SELECT s_name, s_acctbal, s_nationkey, CASE WHEN s_acctbal > 0 THEN n_name ELSE '' END AS c FROM supplier JOIN nation ON n_nationkey = s_nationkey),
f AS (SELECT unnest([CASE WHEN c = '' THEN 'country_missing' END, 'multiple_phones', CASE WHEN c <> '' AND s_nationkey > 5 THEN 'country_mismatch' END, CASE WHEN s_nationkey <= 5 THEN 'phone_prefix_unrecognised' END, CASE WHEN s_acctbal <= 5000 THEN 'no_contact_name' END]) AS flag FROM s)
SELECT flag, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY 1
"""

QUERIES = {
    "phone_lines": (phone_lines, PHONE_SQL),
    "resolved_contacts": (resolved_contacts, _resolved_sql()),
    "networks": (networks, NETWORK_SQL),
    "topic_people": (topic_people, TOPIC_SQL),
    "town_matches": (town_matches, TOWN_SQL),
    "directory_matches": (directory_matches, DIRECTORY_SQL),
    "on_file_contacts": (on_file_contacts, ON_FILE_SQL),
    "tool_calls": (tool_calls, TOOLS_SQL),
    "contact_counts": (contact_counts, COUNTS_SQL),
    "ranked_profiles": (ranked_profiles, PROFILES_SQL),
    "partner_order": (partner_order, "WITH b AS (SELECT *, min(l_orderkey) OVER (PARTITION BY l_suppkey) AS block FROM lineitem) SELECT block, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS rank, count(*) AS n FROM b GROUP BY 1, 2"),
    "tried_leads": (tried_leads, TRIED_SQL),
    "refreshed_queue": (refreshed_queue, QUEUE_SQL),
    "keyword_roles": (keyword_roles, KEYWORD_SQL),
    "registry_union": (registry_union, UNION_SQL),
    "cached_pages": (cached_pages, CACHED_SQL),
    "json_objects": (json_objects, """SELECT event_id, '{"said": "}\\"{", "at": ' || repeat('{"in": ', 6) || coalesce(props, 'null') || repeat('}', 6) || '}' AS object FROM events"""),
    "clean_report": (clean_report, _report_sql()),
    "flag_counts": (flag_counts, FLAGS_SQL),
}
