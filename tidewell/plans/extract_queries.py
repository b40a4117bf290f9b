"""Queries of rules over numbered lines, of giving out, looking up and pacing over whole tables, with their DuckDB counterparts.

The tables' prose holds hardly any roles, names or institutions, so frequent words are read as such; both sides read them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import contacts as ct
from tidewell.functions import keys
from tidewell.functions import phones as ph
from tidewell.operators import allocation, extraction, pacing, resolve, reuse, rollups, similar
from tidewell.sources.tables import table

from .rule_queries import TOK

#: What frequent words are read as.
READ = [(" the ", " Erasmus coordinator "), (" de ", " Director "), (" and ", " Partner "), (" of ", " School "), (" que ", " University "), (" th", " Th"), (" e", " E")]


#: Lines of orders that a task holds at most where shuffle partitions would be larger.
LINES_A_TASK = 1_000_000


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of all documents as lines: entity, page (ten lines), n from 1, line."""
    said = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(". "))
    t = table(spark, d, "documents").select(F.col("doc_id").alias("entity"), F.posexplode(F.split(said, r"\. ")).alias("i", "line"))
    line: Column = F.col("line")
    for a, b in READ:
        line = F.replace(line, F.lit(a), F.lit(b))
    return t.select("entity", F.floor(F.col("i") / 10).alias("page"), (F.col("i") + 1).alias("n"), line.alias("line"))


def _own(spark: SparkSession, d: str) -> DataFrame:
    start = F.substring(F.coalesce("text", F.lit("")), 1, 12)
    return table(spark, d, "documents").select(F.col("doc_id").alias("entity"), F.regexp_extract_all(keys.fold(start), F.lit("([a-z0-9]{4,})"), F.lit(1)).alias("tokens"))


def _lines_sql() -> str:
    line = "l"
    for a, b in READ:
        line = f"replace({line}, '{a}', '{b}')"
    return f"""s AS (SELECT doc_id, string_split(replace(coalesce(text, ''), chr(10), '. '), '. ') AS w FROM documents), e AS (SELECT doc_id AS entity, unnest(w) AS l, generate_subscripts(w, 1) AS n FROM s),
lines AS (SELECT entity, (n - 1) // 10 AS page, n, {line} AS line FROM e), own AS (SELECT doc_id AS entity, regexp_extract_all(strip_accents(lower(coalesce(text, '')[1:12])), '([a-z0-9]{{4,}})', 1) AS tokens FROM documents)"""


def rules_contacts(spark: SparkSession, d: str) -> DataFrame:
    """People beside a role in the sentences of all documents: three at most each."""
    out = extraction.rules_contacts(_lines(spark, d), _own(spark, d), "entity")
    return out.select("entity", "name", "role_class", *[F.col(c).cast("bigint").alias(c) for c in ("role_n", "name_n", "email_n", "place")], "confidence")


def _contacts_sql() -> str:
    q = lambda s: s.replace("'", "''")
    cases = " ".join(f"WHEN regexp_matches(f, '{'|'.join(f'(?:{p})' for p in ps)}') THEN '{name}'" for name, ps in ct.ROLE_CLASSES)
    rank = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(resolve.ROLE_CONFIDENCE))
    sure = " ".join(f"WHEN '{k}' THEN {v}" for k, v in resolve.ROLE_CONFIDENCE.items())
    near = lambda x, k: f"first_value({x} IGNORE NULLS) OVER (PARTITION BY entity, page ORDER BY n ROWS BETWEEN {k} PRECEDING AND {k} FOLLOWING)"
    return rf"""
WITH {_lines_sql()},
m AS (SELECT entity, page, n, line, strip_accents(lower(line)) AS f, list_filter(regexp_extract_all(line, '{q(extraction.NAME)}', 1), lambda p: len(list_filter(regexp_split_to_array(p, '\s+'), lambda w: trim(strip_accents(lower(w)), '.') IN {tuple(extraction.NO_NAMES)})) = 0)[1] AS person,
      CASE WHEN regexp_matches(line, '{ct.EMAIL}') THEN n END AS mail FROM lines),
r AS (SELECT *, CASE {cases} END AS role FROM m),
w AS (SELECT entity, n, role, {near("person", 2)} AS person, {near("CASE WHEN person IS NOT NULL THEN n END", 2)} AS pn, coalesce({near("mail", 2)}, {near("mail", 5)}, 0) AS mail FROM r),
g AS (SELECT entity, person AS name, min(n) AS role_n, arg_min(role, n) AS role_class, arg_min(pn, n) AS name_n, arg_min(mail, n) AS email_n FROM w WHERE role IS NOT NULL AND person IS NOT NULL GROUP BY 1, 2),
t AS (SELECT g.*, own.tokens, list_distinct(regexp_extract_all(strip_accents(lower(name)), '([a-z]{{4,}})', 1)) AS nt FROM g JOIN own USING (entity)),
k AS (SELECT *, round_even(greatest(0.3, least(0.95, CASE role_class {sure} END + CASE WHEN email_n > 0 THEN 0.05 ELSE -0.1 END)), 2)::DOUBLE AS confidence,
      row_number() OVER (PARTITION BY entity ORDER BY CASE role_class {rank} END, email_n = 0, role_n) AS place FROM t WHERE NOT (len(tokens) > 0 AND len(nt) > 0 AND 2 * len(list_intersect(nt, tokens)) >= len(nt)))
SELECT entity, name, role_class, role_n::BIGINT AS role_n, name_n::BIGINT AS name_n, email_n::BIGINT AS email_n, place, confidence FROM k WHERE place <= 3
"""


def rules_partners(spark: SparkSession, d: str) -> DataFrame:
    """Items of partner lists in the sentences of all documents, and what kind of institution each document would be."""
    lines = _lines(spark, d).drop("page").withColumn("page", F.floor(F.col("n") / 100))
    found = extraction.rules_partners(lines, _own(spark, d), "entity").groupBy("entity").agg(F.count("*").alias("partners"), F.min("n").cast("bigint").alias("first"), F.sum("n").cast("bigint").alias("places"))
    return extraction.institution_kind(lines, "entity").join(found, "entity", "left").select("entity", "kind", F.coalesce("partners", F.lit(0)).alias("partners"), F.coalesce("first", F.lit(0)).alias("first"), F.coalesce("places", F.lit(0)).alias("places"))


def _partners_sql() -> str:
    kinds = " ".join(f"WHEN bool_or(regexp_matches(lower(line), '{p}')) THEN '{k}'" for k, p in extraction.KINDS)
    return rf"""
WITH {_lines_sql()}, l AS (SELECT entity, n // 100 AS page, n, line, list_filter(list_distinct(regexp_extract_all(strip_accents(lower(line)), '([a-z0-9]{{4,}})', 1)), lambda w: w NOT IN {tuple(extraction.STOP)}) AS t FROM lines),
h AS (SELECT entity, page, n AS head FROM l WHERE regexp_matches(line, '{extraction.PARTNER_HEADING}') AND length(line) < 90),
i AS (SELECT l.entity, page, n FROM l JOIN own USING (entity) WHERE regexp_matches(line, '{extraction.INSTITUTION}') AND length(line) < 120 AND NOT (len(tokens) > 0 AND len(t) > 0 AND list_has_all(tokens, t))),
g AS (SELECT h.entity, h.page, head, n, n - coalesce(lag(n) OVER w, head) - 1 > 6 AS far FROM h JOIN i ON i.entity = h.entity AND i.page = h.page AND n BETWEEN head + 1 AND head + 199 WINDOW w AS (PARTITION BY h.entity, h.page, head ORDER BY n)),
b AS (SELECT *, bool_or(far) OVER (PARTITION BY entity, page, head ORDER BY n) AS broken FROM g),
k AS (SELECT *, row_number() OVER (PARTITION BY entity, page, head ORDER BY n) AS k, count(*) OVER (PARTITION BY entity, page, head) AS c FROM b WHERE NOT broken),
u AS (SELECT entity, n, min(head) AS head FROM k WHERE c >= 3 AND k <= 80 GROUP BY 1, 2), p AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY head, n) AS place FROM u),
f AS (SELECT entity, count(*) AS partners, min(n)::BIGINT AS first, sum(n)::BIGINT AS places FROM p WHERE place <= 300 GROUP BY 1),
y AS (SELECT entity, CASE {kinds} ELSE 'unknown' END AS kind FROM lines WHERE n <= 120 GROUP BY 1)
SELECT entity, kind, coalesce(partners, 0) AS partners, coalesce(first, 0) AS first, coalesce(places, 0) AS places FROM y LEFT JOIN f USING (entity)
"""


def lead_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Orders as rows of a dialler's file: parts as the sheet's numbers, suppliers as further persons', returned parts as tried by the customer."""
    phone = lambda c: F.concat(F.lit("+49 30 "), F.lpad((F.col(c) if isinstance(c, str) else c).cast("string"), 6, "0"))
    institute = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("institute"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("row"), "l_linenumber", "l_partkey", "l_suppkey", F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("returned"))
    # rows, people and tried are all read from the one shuffle of the lines
    n = -(-li.count() // LINES_A_TASK)
    dealt = li.repartition(n, "row") if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else li.repartition("row")
    lines = dealt.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "returned"))).alias("p"))
    filed = lines.join(institute, F.col("row") == F.col("o_orderkey")).select("row", "institute", "p")
    rows = filed.select("row", "institute", F.transform("p", lambda x: phone(x["l_partkey"])).alias("numbers"))
    people = lines.select("row", F.explode("p").alias("x")).groupBy("row", (F.col("x.l_linenumber") - 1).alias("person")).agg(F.min(phone("x.l_suppkey")).alias("phone"))
    tried = filed.select("institute", F.explode(F.filter("p", lambda x: x["returned"])).alias("x")).select("institute", keys.phone_hash(phone("x.l_partkey")).alias("hash"))
    out = allocation.lead_numbers(rows, people, tried, "row")
    return out.select("row", F.col("person").cast("bigint").alias("person"), F.col("k").cast("bigint").alias("k"), "number")


def _register(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.coalesce("lang", F.lit("")).alias("lang"), "source")
    tokens = lambda a, n: ct.name_tokens(F.substring("t", a, n), 4)
    names = t.select(F.col("doc_id").alias("name_id"), tokens(1, 40).alias("words"), F.concat(F.lit("0"), F.char_length("lang"), F.col("doc_id") % 10).alias("area"))
    register = t.select(F.col("doc_id").alias("code"), F.col("lang").alias("sig"), tokens(1, 36).alias("names"), tokens(20, 40).alias("towns"), tokens(1, 60).alias("label"), (F.col("doc_id") % 3 == 0).alias("private"))
    langs = t.select(F.col("lang").alias("sig")).distinct()
    areas = langs.select(F.concat(F.lit("0"), F.char_length("sig")).alias("prefix"), "sig").union(langs.filter("sig = 'fr'").select(F.lit("023").alias("prefix"), "sig"))
    return names, register, areas


def register_best(spark: SparkSession, d: str) -> DataFrame:
    """Beginnings of documents as names looked up in a register of all documents' beginnings, by language as province."""
    out = similar.register_best(*_register(spark, d))
    return out.select("name_id", "code", "ambiguous", F.bround("score", 3).alias("score"))


REGISTER_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
n AS (SELECT doc_id AS id, {TOK.format("t[1:40]", 4)} AS w, CASE WHEN '0' || length(lang) || (doc_id % 10) = '023' THEN ['fr'] ELSE (SELECT list(DISTINCT lang) FROM t) END AS sigs FROM t),
r AS (SELECT doc_id AS code, lang, {TOK.format("t[1:36]", 4)} AS a, {TOK.format("t[20:59]", 4)} AS b, {TOK.format("t[1:60]", 4)} AS l, doc_id % 3 = 0 AS private FROM t),
p AS (SELECT id, code, round_even(len(list_intersect(w, list_distinct(list_concat(a, b)))) / len(w) + CASE WHEN list_has_any(w, a) AND list_has_any(w, b) THEN 0.25 ELSE 0 END, 3) AS cover, round_even(len(list_intersect(w, l)) / greatest(1, len(l)), 3) AS precise, NOT private AS public
      FROM n JOIN r ON list_contains(sigs, lang) AND (list_has_any(w, a) OR list_has_any(w, b)) WHERE len(w) > 0),
k AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY cover DESC, precise DESC, public DESC) AS place FROM p WHERE cover >= 0.99)
SELECT id AS name_id, min(code) AS code, count(DISTINCT code) > 1 AS ambiguous, max(cover)::DOUBLE AS score FROM k WHERE place = 1 GROUP BY 1
"""


def _sites(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    title = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?s)<title>(.*?)</title>", 1)
    p = table(spark, d, "pages").select("page_id", keys.host(F.coalesce("url", F.lit(""))).alias("host"), title.alias("title"))
    sites = p.filter("host <> ''").groupBy("host").agg(F.min_by("title", "page_id").alias("text"))
    names = p.select(F.col("page_id").alias("name_id"), F.concat_ws(" ", F.substring_index("title", " ", 2), F.element_at(F.split("host", r"\."), 1)).alias("name"))
    return names, sites


def site_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every page's title and first label as a name looked for in all hosts."""
    return similar.site_candidates(*_sites(spark, d), generic=("thingth",))


SITE_SQL = rf"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(url, ''))), '^[a-z][a-z0-9+.-]*://', ''), '[/?#:].*$', ''), '^www\.', '') AS host, regexp_extract(coalesce(html, ''), '(?s)<title>(.*?)</title>', 1) AS title FROM pages),
s AS (SELECT host, arg_min(title, page_id) AS text, replace(regexp_replace(strip_accents(lower(regexp_replace(host, '\.[^.]*$', ''))), '([aou])e', '\1', 'g'), '-', '') AS label FROM p WHERE host <> '' GROUP BY 1),
n AS (SELECT page_id, array_to_string(string_split(title, ' ')[1:2], ' ') || ' ' || string_split(host, '.')[1] AS name FROM p),
w AS (SELECT *, list_distinct(list_filter(list_transform(list_filter(list_distinct(regexp_extract_all(strip_accents(lower(name)), '([a-z0-9]{{5,}})', 1)), lambda w: w <> 'thingth'), lambda w: regexp_replace(w, '([aou])e', '\1', 'g')), lambda w: length(w) >= 5)) AS ws FROM n),
m AS (SELECT page_id, name, host, text, len(list_filter(ws, lambda w: contains(label, w))) AS held FROM w JOIN s ON len(list_filter(ws, lambda w: contains(label, w))) > 0),
t AS (SELECT *, {TOK.format("name", 4)} AS nt, list_filter(string_split(trim(regexp_replace(strip_accents(lower(name)), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) >= 4) AS words,
      list_filter(regexp_split_to_array(lower(host), '[.\-_]'), lambda x: length(x) >= 4) AS parts, strip_accents(lower(name)) AS f, string_split(lower(host), '.')[1] AS l FROM m),
q AS (SELECT page_id AS name_id, host, (held + CASE WHEN contains(strip_accents(lower(text)), string_split(host, '.')[1]) OR (len(nt) > 0 AND len(list_filter(nt, lambda x: contains(strip_accents(lower(text)), x))) >= CASE WHEN len(nt) <= 3 THEN least(len(nt), 2) ELSE round_even(0.6 * len(nt), 0) END) THEN 2 ELSE 0 END
      + CASE WHEN list_has_any(list_transform(parts, lambda x: x[1:4]), list_transform(words, lambda x: x[1:4])) AND NOT ((regexp_matches(f, 'lyceum|lykeio|lyceo') AND regexp_matches(l, '^\d*gym')) OR (regexp_matches(f, 'gymnas') AND regexp_matches(l, '^\d*lyk')) OR (regexp_matches(f, 'primary|dimotik') AND regexp_matches(l, '^\d*(gym|lyk)'))) THEN 1 ELSE 0 END)::BIGINT AS proof FROM t)
SELECT name_id, host, proof, proof = max(proof) OVER (PARTITION BY name_id) AND count(*) OVER (PARTITION BY name_id, proof) = 1 AS "unique" FROM q
"""


def results_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Open orders that ask for what was known of their customer, else of their priority's year, on their day: from another priority, at most 180 days old, and large."""
    o = table(spark, d, "orders").select("*", F.to_date("o_orderdate").alias("day"), F.array(F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("y"), F.year("o_orderdate"), F.substring("o_orderpriority", 1, 1))).alias("keys"))
    index = o.filter("o_orderstatus <> 'P'").select(F.explode("keys").alias("key"), F.col("o_orderpriority").alias("batch"), F.col("o_orderkey").alias("result"), F.when(F.col("o_orderkey") % 50 > 0, F.col("day")).alias("at"), (F.col("o_totalprice") > 50_000).alias("good"))
    rows = o.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("row_id"), "keys", F.col("o_orderpriority").alias("batch"), "day")
    return reuse.reuse_as_of(rows, index).select("row_id", "batch", "result", F.date_format("at", "yyyy-MM-dd").alias("scraped"))


AS_OF_SQL = """
WITH o AS (SELECT *, o_orderdate::DATE AS day, ['c' || o_custkey, 'y' || year(o_orderdate) || o_orderpriority[1]] AS ks FROM orders),
i AS (SELECT unnest(ks) AS key, o_orderpriority AS batch, o_orderkey AS result, CASE WHEN o_orderkey % 50 > 0 THEN day END AS scraped, o_totalprice > 50000 AS good FROM o WHERE o_orderstatus <> 'P'),
a AS (SELECT o_orderkey, o_orderpriority AS own, day, unnest(ks) AS key, generate_subscripts(ks, 1) AS k FROM o WHERE o_orderstatus = 'P'),
h AS (SELECT a.o_orderkey, own, day, k, batch, result, scraped, good, row_number() OVER (PARTITION BY a.o_orderkey, k ORDER BY coalesce(scraped, DATE '0001-01-01') DESC, batch DESC, result DESC) AS r FROM a JOIN i ON i.key = a.key AND coalesce(scraped, DATE '0001-01-01') <= day),
f AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY k) AS first FROM h WHERE r = 1 AND batch <> own AND good AND (scraped IS NULL OR day - scraped <= 180))
SELECT o_orderkey AS row_id, batch, result, strftime(scraped, '%Y-%m-%d') AS scraped FROM f WHERE first = 1
"""


def call_paces(spark: SparkSession, d: str) -> DataFrame:
    """Events as calls of their user, errors as refusals: the gap after each, in thousandths."""
    e = table(spark, d, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("no"))
    return pacing.paced(e, "user_id", "event_id", "no").select("user_id", "event_id", F.floor(F.col("gap") * 1000 + 0.001).cast("bigint").alias("gap"))


PACES_SQL = """
WITH RECURSIVE e AS (SELECT user_id, event_id, event_type = 'error' AS no, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
p AS (SELECT user_id, 0::BIGINT AS i, NULL::BIGINT AS event_id, 0 AS run, 0.0::DOUBLE AS gap FROM e GROUP BY 1
      UNION ALL SELECT e.user_id, e.i, e.event_id, CASE WHEN no OR run + 1 >= 10 THEN 0 ELSE run + 1 END, CASE WHEN no THEN least(greatest(gap * 2, 2.0), 30.0) WHEN run + 1 < 10 THEN gap WHEN gap > 0.5 THEN gap * 0.7 ELSE 0.0 END FROM p JOIN e ON e.user_id = p.user_id AND e.i = p.i + 1)
SELECT user_id, event_id, floor(gap * 1000 + 0.001)::BIGINT AS gap FROM p WHERE i > 0
"""


def round_robin_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Eight documents a source in turns over kinds of which a document may have several."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("text", F.lit("")).alias("t"))
    kinds = F.array_compact(F.array(*[F.when(F.contains("t", F.lit(k)), F.lit(k)) for k in ("tion", "que", "ch", "@")]))
    rows = t.select("source", "doc_id", (F.char_length("t") % 50).alias("score"), kinds.alias("kinds"))
    return rollups.round_robin_kinds(rows, "source", "doc_id", "score", "kinds", ["@", "ch", "que", "tion"], 8).select("source", "doc_id", F.col("place").cast("bigint").alias("place"))


def page_phones(spark: SparkSession, d: str) -> DataFrame:
    """Numbers in all texts read as pages printed in the United States, with their trust; every third text has a telephone link and data as well."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    more = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('<a href="tel:+1%20212%20555%20'), F.lpad((F.col("doc_id") % 9999).cast("string"), 4, "0"), F.lit('">ring</a> {"telephone": "(0)212 555 '), F.lpad((F.col("doc_id") % 777).cast("string"), 4, "0"), F.lit('"}'))).otherwise("")
    out = ph.page_phones(t.select("doc_id", F.concat(more, F.col("t")).alias("html"), F.lit("US").alias("cc")), "doc_id", "html", "cc")
    return out.select("doc_id", F.col("place").cast("bigint").alias("place"), F.col("trust").cast("bigint").alias("trust"), "phone", F.md5(F.encode("quote", "UTF-8")).alias("quote_md5"))


def site_phones(spark: SparkSession, d: str) -> DataFrame:
    """Of every source of documents the number that its texts bear out best."""
    src = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("site"))
    found = page_phones(spark, d).join(src, "doc_id").withColumn("at", F.col("doc_id") * 1000 + F.col("place"))
    return ph.best_site_phone(found, "site", "at").select("site", "phone", "trust")


def _phones_cte() -> str:
    run, q = ph.RUN, lambda s: s.replace("'", "''")
    codes = "|".join(sorted({c for c in ph.CODES.values() if c != "39"}, key=lambda c: (-len(c), c)))
    world = f"CASE WHEN starts_with(a, '39') THEN a ELSE regexp_replace(a, '^({codes})0', '\\1') END"
    return rf"""
t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '<a href="tel:+1%20212%20555%20' || lpad((doc_id % 9999)::VARCHAR, 4, '0') || '">ring</a> {{"telephone": "(0)212 555 ' || lpad((doc_id % 777)::VARCHAR, 4, '0') || '"}}' ELSE '' END || coalesce(text, '') AS h FROM documents),
x AS (SELECT doc_id, h, regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<svg\b.*?</svg\s*>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s{{2,}}', ' ', 'g') AS t FROM t),
s AS (SELECT doc_id, h, regexp_split_to_array(t, '{q(run.replace("(", "(?:", 1))}') AS p, regexp_extract_all(t, '{q(run)}', 1) AS n FROM x),
u AS (SELECT doc_id, 0 AS cls, generate_subscripts(regexp_extract_all(h, '(?i)href\s*=\s*["'']tel:([^"'']+)', 1), 1) AS i, 4 AS trust, replace(unnest(regexp_extract_all(h, '(?i)href\s*=\s*["'']tel:([^"'']+)', 1)), '%20', ' ') AS raw, 'tel: link ' || unnest(regexp_extract_all(h, '(?i)href\s*=\s*["'']tel:([^"'']+)', 1)) AS quote FROM s
      UNION ALL SELECT doc_id, 1, generate_subscripts(regexp_extract_all(h, '"telephone"\s*:\s*"([^"]{{6,30}})"', 1), 1), 3, unnest(regexp_extract_all(h, '"telephone"\s*:\s*"([^"]{{6,30}})"', 1)), 'data ' || trim(unnest(regexp_extract_all(h, '"telephone"\s*:\s*"([^"]{{6,30}})"', 1))) FROM s
      UNION ALL SELECT doc_id, 2, i, CASE WHEN regexp_matches(b, '{q(ph.NO_PHONE)}') OR regexp_matches(af, '(?i)^\s*fax') OR regexp_matches(b, '[\w/.=#@-]$') OR regexp_matches(af, '^\w') THEN 0 WHEN regexp_matches(b, '{q(ph.LABEL)}') THEN 2 ELSE 1 END, raw, trim(right(b, 60) || raw || af[1:30])
      FROM (SELECT doc_id, generate_subscripts(n, 1) AS i, unnest(n) AS raw, p[generate_subscripts(n, 1)] AS b, p[generate_subscripts(n, 1) + 1] AS af FROM s)),
d AS (SELECT *, trim(replace(raw, '(0)', ' ')) AS s2, regexp_replace(replace(raw, '(0)', ' '), '[^0-9]', '', 'g') AS g, regexp_replace(raw, '[^0-9]', '', 'g') AS d FROM u WHERE trust > 0),
a AS (SELECT *, CASE WHEN starts_with(s2, '+') THEN g WHEN starts_with(s2, '00') AND length(g) > 10 THEN g[3:] END AS a FROM d),
f AS (SELECT *, CASE WHEN a IS NOT NULL THEN CASE WHEN length({world}) BETWEEN 8 AND 15 THEN '+' || {world} ELSE '' END WHEN length(g) BETWEEN 6 AND 12 AND regexp_matches(g, '^(?:{ph.NATIONAL["US"]})$') THEN '+1' || g ELSE '' END AS form FROM a),
v AS (SELECT *, CASE WHEN trust = 1 THEN CASE WHEN regexp_matches(trim(raw), '^(\d{{1,2}}[./-]\d{{1,2}}[./-](19|20)\d{{2}}|(19|20)\d{{2}}[./-]\d{{1,2}}[./-]\d{{1,2}})$') OR regexp_matches(trim(raw), '(19|20)\d{{2}}\s*[-–/]\s*(19|20)\d{{2}}') OR regexp_matches(d, '^(19|20)\d{{2}}(19|20)\d{{2}}$')
          OR len(list_distinct(string_split(d, ''))) <= 2 OR contains('01234567890123456789', d) OR regexp_matches(trim(raw), '^0?1\s?0?2\s?0?3') THEN NULL
        WHEN regexp_matches(trim(raw), '^(\+|00)') THEN CASE WHEN starts_with(regexp_replace(d, '^00', ''), '1') THEN nullif(form, '') END WHEN length(d) < 8 OR (NOT regexp_matches(trim(raw), '[ .\-/]') AND length(d) > 9) THEN NULL ELSE nullif(form, '') END
      ELSE coalesce(nullif(form, ''), CASE WHEN starts_with(trim(raw), '+') AND length(d) BETWEEN 8 AND 15 THEN '+' || d END) END AS phone FROM f),
b AS (SELECT *, bool_or(trust > 1) OVER (PARTITION BY doc_id) AS better FROM v WHERE phone IS NOT NULL),
found AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY cls, i) - 1 AS place, trust, phone, quote FROM b WHERE trust > 1 OR NOT better)"""


PHONES_SQL = f"WITH {_phones_cte()} SELECT doc_id, place::BIGINT AS place, trust::BIGINT AS trust, phone, md5(quote) AS quote_md5 FROM found"
SITES_SQL = f"""
WITH {_phones_cte()}, w AS (SELECT coalesce(source, '') AS site, trust, phone, found.doc_id * 1000 + place AS spot FROM found JOIN documents USING (doc_id)), m AS (SELECT site, max(trust) AS trust FROM w GROUP BY 1),
c AS (SELECT w.site, w.trust, phone, count(*) AS n, min(spot) AS spot, regexp_matches(phone, '{ph.MOBILE}')::INT AS mob FROM w JOIN m ON m.site = w.site AND m.trust = w.trust GROUP BY 1, 2, 3)
SELECT site, phone, trust::BIGINT AS trust FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY n - 0.5 * mob DESC, mob, spot) AS r FROM c) WHERE r = 1
"""

QUERIES = {
    "rules_contacts": (rules_contacts, _contacts_sql()),
    "rules_partners": (rules_partners, _partners_sql()),
    "lead_numbers": (lead_numbers, None),
    "register_best": (register_best, REGISTER_SQL),
    "site_candidates": (site_candidates, SITE_SQL),
    "results_as_of": (results_as_of, AS_OF_SQL),
    "call_paces": (call_paces, PACES_SQL),
    "round_robin_kinds": (round_robin_kinds, None),
    "page_phones": (page_phones, PHONES_SQL),
    "site_phones": (site_phones, SITES_SQL),
}
