"""Queries that apply the rules of text.py, contacts.py, pages.py and importing.py to whole tables, with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import contacts as ct
from tidewell.functions import keys, pages
from tidewell.functions import phones as ph
from tidewell.functions import text as tx
from tidewell.operators import evidence, importing
from tidewell.sources.tables import table

md5 = lambda c: F.md5(F.encode(c, "UTF-8"))
FOLD = "strip_accents(lower({}))"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"), "lang", "source")


def phone_rules(spark: SparkSession, d: str) -> DataFrame:
    """The first number of every text: international form in Germany and Hungary, country, plausibility, trust, whether the page bears it out."""
    p = F.coalesce(tx.first_phone(F.col("t")), F.lit(""))
    rows = _texts(spark, d).select("doc_id", "t", p.alias("p"))
    digits = keys.phone_digits(F.col("p"))
    return rows.filter("p <> ''").select(
        "doc_id", "p", ph.normal_phone(F.col("p"), F.lit("DE")).alias("german"), ph.normal_phone(F.col("p"), F.lit("HU")).alias("hungarian"), F.coalesce(tx.dial_country(digits), F.lit("")).alias("country"),
        ph.plausible_phone(F.col("p"), F.lit("DE")).alias("plausible"), ph.phone_trust(F.col("p"), F.col("t"), F.lit(False), F.lit(False), F.lit("DE")).alias("trust"), tx.phone_in_text(F.col("p"), F.col("t")).alias("borne_out"),
        ct.area_code(F.col("p")).alias("area"), F.array_join(tx.split_phones(F.concat_ws(";", "p", "p")), ",").alias("both"),
    )


def _form_sql(form: str, code: str, trunk: str) -> str:
    return rf"""CASE WHEN abroad IS NOT NULL THEN CASE WHEN length(world) BETWEEN 8 AND 15 THEN '+' || world ELSE '' END WHEN length(g) BETWEEN 6 AND 12 AND regexp_matches(g, '^(?:{form})$') THEN '+{code}' || regexp_replace(g, '^{trunk}', '') ELSE '' END"""


def _phone_sql() -> str:
    dial = " ".join(f"WHEN d[1:{n}] = '{k}' THEN '{v}'" for n in (3, 2) for k, v in tx.DIAL.items() if len(k) == n)
    codes = "|".join(sorted({c for c in ph.CODES.values() if c != "39"}, key=lambda c: (-len(c), c)))
    return rf"""
WITH f AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_extract_all(coalesce(text, ''), '(\+?[0-9(][0-9() ./-]{{6,}}[0-9])', 1), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 8)[1] AS p FROM documents),
g AS (SELECT *, regexp_replace(p, '[^0-9]', '', 'g') AS d, trim(replace(p, '(0)', ' ')) AS s, regexp_replace(replace(p, '(0)', ' '), '[^0-9]', '', 'g') AS g FROM f WHERE p IS NOT NULL),
a AS (SELECT *, CASE WHEN starts_with(s, '+') THEN g WHEN starts_with(s, '00') AND length(g) > 10 THEN g[3:] END AS abroad FROM g),
w AS (SELECT *, CASE WHEN starts_with(abroad, '39') THEN abroad ELSE regexp_replace(abroad, '^({codes})0', '\1') END AS world FROM a),
n AS (SELECT *, {_form_sql(ph.NATIONAL["DE"], "49", "0")} AS german, {_form_sql(ph.NATIONAL["HU"], "36", "06")} AS hungarian, trim(p) AS q, regexp_replace(d, '^(0039|39)', '') AS n FROM w),
h AS (SELECT *, CASE WHEN regexp_matches(q, '^(\d{{1,2}}[./-]\d{{1,2}}[./-](19|20)\d{{2}}|(19|20)\d{{2}}[./-]\d{{1,2}}[./-]\d{{1,2}})$') OR regexp_matches(q, '(19|20)\d{{2}}\s*[-–/]\s*(19|20)\d{{2}}') OR regexp_matches(d, '^(19|20)\d{{2}}(19|20)\d{{2}}$')
        OR len(list_distinct(string_split(d, ''))) <= 2 OR contains('01234567890123456789', d) OR regexp_matches(q, '^0?1\s?0?2\s?0?3') THEN ''
      WHEN regexp_matches(q, '^(\+|00)') THEN CASE WHEN starts_with(regexp_replace(d, '^00', ''), '49') THEN german ELSE '' END
      WHEN length(d) < 8 OR (NOT regexp_matches(q, '[ .\-/]') AND length(d) > 9) THEN '' ELSE german END AS plausible FROM n)
SELECT doc_id, p, german, hungarian, CASE {dial} ELSE '' END AS country, plausible,
       CASE WHEN regexp_matches(lower(t), '\b(tel|phone|telefon|telephone|fon|call)\b') AND NOT regexp_matches(lower(t), '\bfax\b') THEN 2 WHEN plausible <> '' THEN 1 ELSE 0 END AS trust,
       length(d) >= 7 AND contains(regexp_replace(t, '[^0-9]', '', 'g'), right(d, 8)) AS borne_out, CASE WHEN starts_with(n, '3') THEN '' ELSE n END AS area, d || ',' || d AS both FROM h
"""


TOK = "list_distinct(list_filter(string_split(trim(regexp_replace(strip_accents(lower({})), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= {}))"


def email_rules(spark: SparkSession, d: str) -> DataFrame:
    """The addresses of every text read as a page, and how the first one fits the text's beginning as a name and a host as a site."""
    rows = _texts(spark, d).select("doc_id", ct.page_emails(F.col("t")).alias("e"), F.substring("t", 1, 24).alias("name")).filter(F.size("e") > 0)
    rows = rows.withColumn("first", F.get("e", 0)).withColumn("host", F.substring_index("first", "@", -1))
    return rows.select(
        "doc_id", F.array_join("e", ";").alias("emails"), ct.email_names_person(F.col("first"), F.col("name")).alias("names_person"), F.coalesce(ct.pick_email(F.col("name"), F.col("e")), F.lit("")).alias("picked"),
        ct.name_in_domain(F.col("host"), F.col("name")).alias("in_domain"), ct.own_email_domain(F.col("first"), F.concat(F.lit("www."), keys.registrable_domain(F.col("host")))).alias("own"),
        ct.own_email_domain(F.col("first"), F.concat(F.lit("sister."), F.col("host"))).alias("above"), ct.names_organisation(F.col("name"), F.col("host"), F.col("host")).alias("names_org"),
        ct.inbox_tier(F.col("first"), F.col("host"), F.lit(False)).alias("tier"),
    )


def _domain_sql(h: str) -> str:
    p = f"string_split({h}, '.')"
    return f"array_to_string({p}[-least(len({p}), CASE WHEN {p}[greatest(len({p}) - 1, 1)] IN ('co','com','ac','edu','gov','org','net') AND length({p}[-1]) = 2 THEN 3 ELSE 2 END) :], '.')"


PAGE_EMAILS = rf"""p AS (SELECT doc_id, coalesce(text, '')[1:24] AS name, regexp_replace(regexp_replace(coalesce(text, ''), '(?i)\s*[\[({{]\s*(?:at|@|arroba|chez)\s*[\])}}]\s*', '@', 'g'),
    '(?i)\s*[\[({{]\s*(?:dot|punkt|point|punto|\.)\s*[\])}}]\s*', '.', 'g') AS t FROM documents),
r AS (SELECT doc_id, name, list_transform(regexp_extract_all(t, '<([^<>\s@]+@[^<>\s]+)>', 1), lambda x: regexp_replace(x, '[.,;:]+$', '')) AS marked,
      list_transform(regexp_extract_all(t, '{tx.EMAIL}'), lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{"|".join(tx.ENDINGS)}))[A-Z].*$', '\1')) AS plain FROM p),
m AS (SELECT doc_id, name, list_filter(list_transform(list_concat(marked, plain), lambda x: lower(regexp_replace(string_split(x, '?')[1], '^(?:%20)+', ''))), lambda x: contains(x, '@')) AS e FROM r),
e AS (SELECT doc_id, name, list_filter(e, lambda v, i: list_position(e, v) = i) AS e FROM m WHERE len(e) > 0)"""
EMAIL_SQL = rf"""
WITH {PAGE_EMAILS},
f AS (SELECT *, e[1] AS first, string_split(e[1], '@')[-1] AS host, {TOK.format("name", 3)} AS toks, {TOK.format("name", 5)} AS t5 FROM e),
g AS (SELECT *, {TOK.format("host", 4)} AS ht, {_domain_sql("host")} AS dom, string_split(first, '@')[1] AS local FROM f)
SELECT doc_id, array_to_string(e, ';') AS emails, len(list_filter(toks, lambda t: contains(strip_accents(lower(local)), t))) > 0 AS names_person,
       coalesce(list_filter(e, lambda x: len(list_filter(toks, lambda t: contains(strip_accents(lower(string_split(x, '@')[1])), t))) > 0)[1], CASE WHEN len(e) = 1 THEN e[1] END, '') AS picked,
       len(list_filter(t5, lambda t: contains(strip_accents(lower(host)), t))) > 0 OR (length(name) = 3 AND strip_accents(lower(name)) = string_split(host, '.')[1]) AS in_domain,
       host = dom OR ends_with(host, '.' || dom) AS own,
       len(string_split(host, '.')) >= 2 AND host = {_domain_sql("('sister.' || host)")} AS above,
       contains(strip_accents(lower(name)), string_split(host, '.')[1]) OR (len(ht) > 0 AND len(list_filter(ht, lambda t: contains(strip_accents(lower(name)), t))) >=
           CASE WHEN len(ht) <= 3 THEN least(len(ht), 2) ELSE round_even(0.6 * len(ht), 0) END) AS names_org,
       CASE WHEN regexp_matches(local, '(erasmus|international|mobility)') THEN 0 WHEN local IN {ct.OFFICE_PARTS} THEN 1 ELSE 2 END AS tier FROM g
"""


def role_rules(spark: SparkSession, d: str) -> DataFrame:
    """All lines of conversations and documents by role class; how many name an office, a role, or have a broken name."""
    both = table(spark, d, "conversations").select("text").union(table(spark, d, "documents").select("text"))
    lines = both.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("x")).filter("x <> ''")
    return lines.groupBy(F.coalesce(ct.role_of(F.col("x")), F.lit("none")).alias("role")).agg(
        F.count("*").alias("n"), F.count_if(ct.is_office(F.col("x"))).alias("offices"), F.count_if(ct.states_role(F.col("x"))).alias("stated"), F.count_if(ct.broken_name(F.col("x"))).alias("broken"),
    )


def _role_sql() -> str:
    cases = " ".join(f"WHEN regexp_matches(f, '{'|'.join(f'(?:{p})' for p in ps)}') THEN '{name}'" for name, ps in ct.ROLE_CLASSES)
    return rf"""
WITH x AS (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM (SELECT text FROM conversations UNION ALL SELECT text FROM documents)),
f AS (SELECT x, strip_accents(lower(x)) AS f FROM x WHERE x <> ''), r AS (SELECT x, f, CASE {cases} ELSE 'none' END AS role FROM f)
SELECT role, count(*) AS n, count_if(regexp_matches(f, '\b(office|department|buro|sekretariat|secretariat|team|service|centre|center|reception)\b'))::BIGINT AS offices, count_if(regexp_matches(f, '{"|".join(ct.ROLE_STEMS)}') OR regexp_matches(f, '\b(?:{"|".join(ct.BUSINESS_ROLES)})\b'))::BIGINT AS stated,
       count_if(length(regexp_replace(x, '[^\p{{L}}]', '', 'g')) < 4 OR regexp_matches(x, '^\d{{5}}'))::BIGINT AS broken FROM r GROUP BY 1
"""


def person_rules(spark: SparkSession, d: str) -> DataFrame:
    """Beginnings of page titles, some words with capitals, read as a person's, and whether the page's first heading shares a telling word with it."""
    tag = lambda name: F.regexp_extract(F.coalesce("html", F.lit("")), rf"(?s)<{name}>(.*?)</{name}>", 1)
    rows = table(spark, d, "pages").select("page_id", tag("title").alias("title"), tag("h1").alias("h1"))
    return rows.select("page_id", ct.looks_like_person(F.replace(F.replace(F.substring("title", 1, 30), F.lit(" t"), F.lit(" T")), F.lit(" o"), F.lit(" O"))).alias("person"), ct.partner_line_ok(F.col("h1"), F.col("title")).alias("shared"), ct.country_named(F.lit("France"), F.col("title")).alias("named"))


PERSON_SQL = rf"""
WITH t AS (SELECT page_id, regexp_extract(coalesce(html, ''), '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(coalesce(html, ''), '(?s)<h1>(.*?)</h1>', 1) AS h1 FROM pages),
c AS (SELECT *, replace(replace(title[1:30], ' t', ' T'), ' o', ' O') AS p FROM t),
w AS (SELECT *, list_filter(string_split(trim(regexp_replace(p, '\s+', ' ', 'g')), ' '), lambda x: x <> '' AND lower(regexp_replace(x, '^[.,]+|[.,]+$', '', 'g')) NOT IN {(*ct.NAME_PARTICLES, *ct.NAME_TITLES)}) AS ws,
      {TOK.format("h1", 4)} AS t4, {TOK.format("h1", 3)} AS t3, length(regexp_replace(h1, '[^\p{{Latin}}]', '', 'g')) AS latin, length(regexp_replace(h1, '[^\p{{L}}]', '', 'g')) AS letters FROM c)
SELECT page_id, NOT regexp_matches(p, '[0-9@]') AND len(ws) >= 2 AND len(list_filter(ws, lambda x: NOT regexp_matches(x, '^(\p{{Lu}}|\P{{L}})'))) = 0
         AND len(list_filter(ws, lambda x: regexp_matches(strip_accents(lower(x)), '{"|".join(ct.ROLE_STEMS)}'))) = 0 AS person,
       2 * latin < letters OR len(list_filter(CASE WHEN len(t4) > 0 THEN t4 ELSE t3 END, lambda x: contains(strip_accents(lower(title)), x))) > 0 AS shared,
       contains(strip_accents(lower(title)), 'franc') AS named FROM w
"""


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """The links of all whole pages, absolute and once each: how many, and how many labels differ from their targets' last parts."""
    found = table(spark, d, "pages").select("page_id", pages.links(F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))).alias("l"))
    differ = F.size(F.filter("l", lambda x: x["label"] != F.substring_index(x["url"], "/", -1)))
    said = F.array_join(F.transform("l", lambda x: F.concat(x["label"], F.lit("|"), x["url"])), "\n")
    return found.select("page_id", F.size("l").cast("bigint").alias("links"), differ.cast("bigint").alias("differ"), md5(said).alias("links_md5"))


def _entities_sql(x: str) -> str:
    for name, char in pages.ENTITIES:
        x = f"replace({x}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    return x


LINKS_SQL = rf"""
WITH a AS (SELECT page_id, coalesce(url, '') AS u, unnest(regexp_extract_all(coalesce(html, ''), '{pages.ANCHOR.replace("'", "''")}')) AS a, generate_subscripts(regexp_extract_all(coalesce(html, ''), '{pages.ANCHOR.replace("'", "''")}'), 1) AS i FROM pages),
g AS (SELECT *, regexp_extract(a, '{pages.ANCHOR.replace("'", "''")}', ['x', 'y', 'z', 'label']) AS g FROM a),
h AS (SELECT page_id, u, i, trim({_entities_sql("g.x || g.y || g.z")}) AS href, trim(regexp_replace({_entities_sql("regexp_replace(g.label, '(?s)<[^>]*>', ' ', 'g')")}, '[ \t\r\n\f]+', ' ', 'g'))[1:90] AS label,
      regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) AS scheme, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS root, regexp_replace(u, '[?#].*$', '') AS path FROM g),
r AS (SELECT page_id, i, label, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN scheme || href WHEN starts_with(href, '/') THEN root || href
      WHEN starts_with(href, '?') THEN path || href ELSE (CASE WHEN path = root THEN root || '/' ELSE regexp_replace(path, '[^/]*$', '') END) || regexp_replace(href, '^\./', '') END AS url
      FROM h WHERE href <> '' AND NOT regexp_matches(href, '(?i)^(?:#|javascript:|mailto:|tel:)')),
o AS (SELECT page_id, url, min(i) AS i, arg_min(label, i) AS label FROM r GROUP BY 1, 2),
s AS (SELECT page_id, count(*) AS links, count_if(label <> string_split(url, '/')[-1])::BIGINT AS differ, string_agg(label || '|' || url, chr(10) ORDER BY i) AS said FROM o GROUP BY 1)
SELECT page_id, coalesce(links, 0)::BIGINT AS links, coalesce(differ, 0)::BIGINT AS differ, md5(coalesce(said, '')) AS links_md5 FROM pages LEFT JOIN s USING (page_id)
"""


def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of all whole pages, line by line, as digests."""
    t = table(spark, d, "pages").select("page_id", pages.page_text(F.coalesce("html", F.lit(""))).alias("t"))
    return t.select("page_id", F.char_length("t").cast("bigint").alias("n_chars"), md5(F.col("t")).alias("text_md5"))


def _page_text_sql() -> str:
    q = lambda s: s.replace("'", "''")
    x = "regexp_replace(coalesce(html, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    for name in pages.DROPPED:
        x = rf"regexp_replace({x}, '(?is)<{name}(?:\s[^>]*)?>.*?</{name}\s*>', ' ', 'g')"
    for kind, pre in (("mailto", ""), ("tel", "tel ")):
        x = f"regexp_replace({x}, '" + q(rf"(?is)<a\s[^>]*?href\s*=\s*[\"']?{kind}:([^\"'?>\s]*)[^>]*>(.*?)</a>") + rf"', '\2 <mailto>{pre}\1</mailto>', 'g')"
    x = rf"""regexp_replace({x}, '(?is)<img\s[^>]*?alt\s*=\s*"([^">]{{2,}})"[^>]*>', '[\1]', 'g')"""
    x = rf"regexp_replace({x}, '(?i)\[(?:{'|'.join(pages.GENERIC_ALT)})\]', '', 'g')"
    x = rf"regexp_replace({x}, '(?i)</t[dh]\s*>', ' | ', 'g')"
    x = rf"regexp_replace({x}, '[ \t\r\n\f]+', ' ', 'g')"
    x = f"regexp_replace({x}, '{pages.BLOCK}', chr(10), 'g')"
    x = f"replace(replace({x}, '<mailto>', chr(1)), '</mailto>', chr(2))"
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    x = f"replace(replace({_entities_sql(x)}, chr(1), '<'), chr(2), '>')"
    return f"""
WITH x AS (SELECT page_id, {x} AS x FROM pages),
t AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split(x, chr(10)), lambda s: trim(regexp_replace(s, ' +', ' ', 'g'))), lambda s: s <> ''), chr(10)) AS t FROM x)
SELECT page_id, length(t)::BIGINT AS n_chars, md5(t) AS text_md5 FROM t
"""


WEIGHTS = {"tion": 3.0, "the": 2.0, "que": 1.0}
KINDS = {"german": "ch|ein", "french": "que|eau", "spanish": "os|ado"}


def site_rules(spark: SparkSession, d: str) -> DataFrame:
    """Roots, scores and kinds of all pages by url and title, and whether a page's host is the site of its registrable domain."""
    title = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?s)<title>(.*?)</title>", 1)
    p = table(spark, d, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("u"), title.alias("title"))
    h = keys.host(F.col("u"))
    return p.select(
        "page_id", ct.site_root(F.col("u")).alias("root"), ct.link_score(F.col("title"), F.col("u"), WEIGHTS, r"login|\.zip").alias("score"), F.array_join(ct.link_types(F.col("title"), F.col("u"), KINDS), ",").alias("kinds"),
        evidence.is_official(h, keys.registrable_domain(h)).alias("official"), keys.same_site(keys.registrable_domain(h), h).alias("same"), tx.slug(F.regexp_replace("u", r"^.*/", "")).alias("slug"), tx.formula_safe(F.concat(F.lit("="), h)).alias("safe"),
        ct.template_fill(F.lit("{{host}} at {{root}}"), {"host": h, "root": ct.site_root(F.col("u"))}).alias("filled"),
    )


def _site_sql() -> str:
    terms = " + ".join(f"(CASE WHEN contains(f, '{t}') THEN {2 * w} ELSE 0 END) + (CASE WHEN contains(path, '{t}') THEN {w} ELSE 0 END)" for t, w in WEIGHTS.items())
    kinds = ", ".join(f"CASE WHEN regexp_matches(b, '{p}') THEN '{k}' END" for k, p in KINDS.items())
    return rf"""
WITH t AS (SELECT page_id, coalesce(url, '') AS u, regexp_extract(coalesce(html, ''), '(?s)<title>(.*?)</title>', 1) AS title FROM pages),
h AS (SELECT *, strip_accents(lower(title)) AS f, strip_accents(lower(title || ' ' || u)) AS b, lower(regexp_replace(u, '^[a-z]+://[^/]*', '')) AS path,
      regexp_replace(regexp_replace(regexp_replace(lower(trim(u)), '^[a-z][a-z0-9+.-]*://', ''), '[/?#:].*$', ''), '^www\.', '') AS host FROM t),
s AS (SELECT *, {_domain_sql("host")} AS dom, coalesce(nullif(regexp_extract(u, '^(https?)://', 1), ''), 'https') || '://' || host || '/' AS root, {terms} AS s FROM h)
SELECT page_id, root, CASE WHEN regexp_matches(lower(title || ' ' || u), 'login|\.zip') THEN 0.0 ELSE s + CASE WHEN s > 0 AND ends_with(path, '.pdf') THEN 2 ELSE 0 END
         - CASE WHEN regexp_matches(path, '/(19|20)\d\d/') THEN 8 ELSE 0 END - CASE WHEN regexp_matches(path, '/(news|blog|aktuell)') THEN 25 ELSE 0 END END::DOUBLE AS score,
       array_to_string(list_filter([{kinds}], lambda x: x IS NOT NULL), ',') AS kinds, host = dom OR ends_with(host, '.' || dom) AS official, host = dom OR ends_with(host, '.' || dom) AS same,
       trim(regexp_replace(lower(regexp_replace(regexp_replace(u, '^.*/', ''), '\.[A-Za-z0-9]+$', '')), '[^a-z0-9]+', '-', 'g')[1:36], '-') AS slug, '''=' || host AS safe, host || ' at ' || root AS filled FROM s
"""


def result_rules(spark: SparkSession, d: str) -> DataFrame:
    """Orders read as results: metrics, coverage, quality, changes and reuse keys, counted."""
    o = table(spark, d, "orders")
    opt = lambda good, v: F.when(good, v).otherwise("")
    contact, mail, inbox = opt(F.col("o_orderstatus") != "P", F.col("o_orderpriority")), opt(F.col("o_totalprice") > 100_000, F.lit("a@b.org")), opt(F.col("o_orderpriority").startswith("1"), F.lit("info@b.org"))
    notes = F.when(F.col("o_totalprice") < 20_000, "Website not found: x").otherwise("read")
    metrics = ct.result_metrics(contact, mail, inbox, opt(F.col("o_orderstatus") == "F", F.lit("+49")), notes, F.col("o_totalprice") < 40_000)
    stated, found = F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    text = ct.coverage_text(found, F.least(found, stated), stated * 2)
    label = ct.quality_label(contact, F.when(mail != "", "own").when(inbox != "", "office"), opt(F.col("o_orderstatus") == "F", F.lit("+49")))
    change = F.array_join(ct.change_list({"status": (F.col("o_orderstatus"), F.lit("f")), "priority": (F.col("o_orderpriority"), F.lit("1URGENT"))}), ",")
    reuse = F.array_join(ct.reuse_keys(F.lower("o_orderpriority"), F.lower("o_orderstatus"), F.concat(F.lower("o_orderstatus"), F.lit(".org"))), " ")
    return o.groupBy(label.alias("quality"), change.alias("changed"), reuse.alias("reuse")).agg(
        F.count("*").alias("n"), *[F.sum(m).cast("bigint").alias(k) for k, m in metrics.items()], F.count_if(text == "none published").alias("none_published"), F.count_if(F.contains(text, F.lit("stated"))).alias("partly"), F.sum(F.char_length(text)).cast("bigint").alias("chars"),
    )


RESULT_SQL = """
WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS contact, CASE WHEN o_totalprice > 100000 THEN 'a@b.org' ELSE '' END AS mail, CASE WHEN o_orderpriority[1] = '1' THEN 'i' ELSE '' END AS inbox,
       CASE WHEN o_orderstatus = 'F' THEN '+49' ELSE '' END AS phone, o_totalprice < 20000 AS nosite, month(o_orderdate) AS stated, dayofmonth(o_orderdate) AS found FROM orders),
p AS (SELECT *, o_totalprice < 40000 AND NOT nosite AND contact = '' AND mail = '' AND inbox = '' AS gone,
       CASE WHEN stated * 2 > found THEN least(found, stated) || ' verified of ~' || stated * 2 || ' stated (rest of the list not readable)' ELSE least(found, stated) || ' of ' || found || ' verified' END AS cov FROM o)
SELECT CASE WHEN contact <> '' AND mail <> '' THEN 'named+email' WHEN contact <> '' AND mail = '' AND inbox <> '' THEN 'named+office' WHEN contact <> '' AND phone <> '' THEN 'named+phone' WHEN mail = '' AND inbox <> '' THEN 'inbox only' ELSE 'none' END AS quality,
       array_to_string(list_filter([CASE WHEN lower(o_orderstatus) <> 'f' THEN 'status' END, CASE WHEN regexp_replace(lower(o_orderpriority), '[^a-z0-9@.]', '', 'g') <> '1urgent' THEN 'priority' END], lambda x: x IS NOT NULL), ',') AS changed,
       'n:' || lower(o_orderpriority) || '|' || lower(o_orderstatus) || ' w:' || lower(o_orderstatus) || '.org' AS reuse, count(*) AS n,
       count_if(contact <> '')::BIGINT AS with_contact, count_if(contact <> '' AND mail <> '')::BIGINT AS contact_personal, count_if(contact <> '' AND mail = '' AND inbox <> '')::BIGINT AS contact_generic, count_if(mail <> '' OR inbox <> '')::BIGINT AS with_email,
       count_if(phone <> '' AND NOT nosite)::BIGINT AS with_phone, count_if(nosite)::BIGINT AS no_website, count_if(gone)::BIGINT AS website_dead, count_if(NOT nosite AND NOT gone)::BIGINT AS with_website,
       count_if((mail <> '' OR inbox <> '' OR phone <> '') AND NOT nosite AND NOT gone)::BIGINT AS reachable, count_if(cov = 'none published')::BIGINT AS none_published, count_if(contains(cov, 'stated'))::BIGINT AS partly, sum(length(cov))::BIGINT AS chars
FROM p GROUP BY 1, 2, 3
"""


def merged_cells(spark: SparkSession, d: str) -> DataFrame:
    """Texts read as cells of several lines, with the source and the language beside them: rows made, and their digest's sum."""
    rows = _texts(spark, d).select("doc_id", F.col("t").alias("name"), F.concat_ws("\n", "lang", "source").alias("pair"), F.coalesce("lang", F.lit("")).alias("single"))
    out = importing.expand_merged(rows, "name", ["pair", "single"])
    return out.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("split").alias("split"), F.count_if(F.col("pair") == "").alias("padded"), F.sum(F.char_length("name")).cast("bigint").alias("chars"), F.max("single").alias("single"))


MERGED_SQL = """
WITH l AS (SELECT doc_id, coalesce(lang, '') AS lang, (lang IS NOT NULL)::INT + (source IS NOT NULL)::INT AS k, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, greatest(1, len(ls))::BIGINT AS n, CASE WHEN len(ls) > 1 THEN len(ls) ELSE 0 END::BIGINT AS split, CASE WHEN len(ls) > 1 AND k = 2 THEN greatest(0, len(ls) - 2) WHEN k = 0 THEN greatest(1, len(ls)) ELSE 0 END::BIGINT AS padded,
       coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0)::BIGINT AS chars, lang AS single FROM l
"""


def sheet_fill(spark: SparkSession, d: str) -> DataFrame:
    """Customers whose blank segments are filled from their nation's, by what was filled."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("").alias("segment"), F.when(F.col("c_acctbal") > 5000, F.lit("rich")).otherwise("").alias("note"))
    new = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("segment"), F.when(F.col("n_regionkey") > 1, F.lit("far")).otherwise("").alias("note"))
    return importing.fill_blanks(c, new, "c_nationkey", ["segment", "note"]).groupBy("segment", "note").agg(F.count("*").alias("n"), F.sum("filled").cast("bigint").alias("filled"))


FILL_SQL = """
WITH j AS (SELECT CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS s, CASE WHEN c_acctbal > 5000 THEN 'rich' ELSE '' END AS t, n_name, CASE WHEN n_regionkey > 1 THEN 'far' ELSE '' END AS far FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT CASE WHEN s = '' THEN n_name ELSE s END AS segment, CASE WHEN t = '' THEN far ELSE t END AS note, count(*) AS n, sum((s = '')::INT + (t = '' AND far <> '')::INT)::BIGINT AS filled FROM j GROUP BY 1, 2
"""


def register_codes(spark: SparkSession, d: str) -> DataFrame:
    """Parts as a register: per brand the union of the types' words and the largest part's name as its head's."""
    p = table(spark, d, "part").select("p_brand", F.split(F.lower("p_type"), " ").alias("tokens"), (F.col("p_size") >= 40).alias("head"), "p_name")
    out = importing.register_rows(p, "p_brand", "tokens", F.col("head"), "p_name")
    return out.select("p_brand", F.array_join("tokens", " ").alias("tokens"), "p_name")


#: Tells lines of orders apart but for equal ones.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def inherited_cells(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders with merged cells: the mode of the line above where a line has none."""
    li = table(spark, d, "lineitem").select("l_orderkey", *LINE_ORDER, F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("").alias("flag"))
    out = importing.inherit_down(li, "l_orderkey", LINE_ORDER, ["flag"])
    return out.groupBy(F.coalesce("flag", F.lit("none")).alias("flag")).agg(F.count("*").alias("n"))


def national_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Partners (lines) of customers without the national ones, counted anew."""
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("row"), F.when(F.col("l_returnflag") == "R", "National").when(F.col("l_returnflag") == "A", "Unknown").otherwise("International").alias("partner_scope"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("row"), F.when(F.col("s_acctbal") > 0, "7").otherwise("").alias("partners_found"))
    kept, parents = importing.without_national(li, s, "row")
    scopes = kept.groupBy("row").agg(F.count_if(F.col("partner_scope") == "Country not stated").alias("unstated"))
    return parents.join(scopes, "row", "left").select("row", "partners_found", F.coalesce("unstated", F.lit(0)).alias("unstated"))


def failure_counts(spark: SparkSession, d: str) -> DataFrame:
    """Users with three or more errors since their last purchase."""
    e = table(spark, d, "events").filter(F.col("event_type").isin("error", "purchase")).select("user_id", "event_id", (F.col("event_type") == "purchase").alias("ok"))
    return importing.count_failures(e, "user_id", "ok", "event_id", 3)


def sheet_parts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a sheet in parts of a thousand: first, last and number of rows of each."""
    out = importing.parts(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return out.groupBy(F.col("part").cast("bigint").alias("part")).agg(F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"), F.count("*").alias("n"))


def list_items(spark: SparkSession, d: str) -> DataFrame:
    """Lists in the lines of all documents: after a line of at most 60 characters, the longer lines."""
    lines = table(spark, d, "documents").select("source", "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n", "line"))
    found = importing.list_runs(lines, "source", F.char_length("line") <= 60, F.col("line").rlike(r"^\p{L}"), page="doc_id")
    return found.groupBy("doc_id").agg(F.count("*").alias("items"), F.count_distinct("run").alias("runs"))


LIST_SQL = r"""
WITH l AS (SELECT source, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
m AS (SELECT *, length(line) <= 60 AS h, regexp_matches(line, '^\p{L}') AND length(line) > 60 AS i FROM l),
r AS (SELECT *, sum(h::INT) OVER (PARTITION BY source, doc_id ORDER BY n) AS run FROM m),
k AS (SELECT *, max(CASE WHEN h OR i THEN n END) OVER (PARTITION BY source, doc_id, run ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM r WHERE run > 0),
b AS (SELECT *, sum(CASE WHEN i AND n - last - 1 > 6 THEN 1 ELSE 0 END) OVER (PARTITION BY source, doc_id, run ORDER BY n) AS s FROM k),
g AS (SELECT *, count(*) OVER (PARTITION BY source, doc_id, run) AS c FROM b WHERE i AND s = 0)
SELECT doc_id, count(*) AS items, count(DISTINCT run) AS runs FROM g WHERE c >= 3 GROUP BY 1
"""

QUERIES = {
    "phone_rules": (phone_rules, _phone_sql()),
    "email_rules": (email_rules, EMAIL_SQL),
    "role_rules": (role_rules, _role_sql()),
    "person_rules": (person_rules, PERSON_SQL),
    "page_links": (page_links, LINKS_SQL),
    "page_texts": (page_texts, _page_text_sql()),
    "site_rules": (site_rules, _site_sql()),
    "result_rules": (result_rules, RESULT_SQL),
    "merged_cells": (merged_cells, MERGED_SQL),
    "sheet_fill": (sheet_fill, FILL_SQL),
    "register_codes": (register_codes, "WITH t AS (SELECT p_brand, p_name, p_size, unnest(string_split(lower(p_type), ' ')) AS t FROM part) SELECT p_brand, string_agg(DISTINCT t, ' ' ORDER BY t) AS tokens, coalesce(max(CASE WHEN p_size >= 40 THEN p_name END), max(p_name)) AS p_name FROM t GROUP BY 1"),
    "inherited_cells": (inherited_cells, f"WITH f AS (SELECT last_value(CASE WHEN l_quantity > 25 THEN l_returnflag END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)} ROWS UNBOUNDED PRECEDING) AS f FROM lineitem) SELECT coalesce(f, 'none') AS flag, count(*) AS n FROM f GROUP BY 1"),
    "national_dropped": (national_dropped, "WITH k AS (SELECT l_suppkey, count_if(l_returnflag <> 'R') AS n, count_if(l_returnflag = 'A') AS u FROM lineitem GROUP BY 1) SELECT s_suppkey AS row, CASE WHEN s_acctbal > 0 THEN coalesce(n, 0)::BIGINT::VARCHAR ELSE '' END AS partners_found, coalesce(u, 0)::BIGINT AS unstated FROM supplier LEFT JOIN k ON l_suppkey = s_suppkey"),
    "failure_counts": (failure_counts, "WITH l AS (SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS last FROM events GROUP BY 1) SELECT user_id, count(*) AS failures FROM events JOIN l USING (user_id) WHERE event_type = 'error' AND (last IS NULL OR event_id > last) GROUP BY 1 HAVING count(*) >= 3"),
    "sheet_parts": (sheet_parts, "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS c FROM orders) SELECT (CASE WHEN c > 1200 THEN i // 1000 + 1 ELSE 1 END)::BIGINT AS part, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS n FROM r GROUP BY 1"),
    "list_items": (list_items, LIST_SQL),
}
