"""Queries of keys, extraction, duplicates, lookups and merges over pages, documents and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import keys
from tidewell.functions import text as tx
from tidewell.operators import matching, rollups
from tidewell.sources.tables import table

md5 = lambda c: F.md5(F.encode(c, "UTF-8"))


def text_keys(spark: SparkSession, d: str) -> DataFrame:
    """Five identity keys of every whole text, as digests."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select(
        "doc_id", md5(keys.ascii_key(t)).alias("ascii_key"), md5(keys.folded_words(t)).alias("folded_words"), md5(keys.folded_key(t)).alias("folded_key"),
        md5(keys.address_key(t)).alias("address_key"), md5(keys.word_key(t)).alias("word_key"),
    )


KEYS_SQL = r"""
WITH t AS (SELECT doc_id, lower(coalesce(text, '')) AS l, strip_accents(lower(coalesce(text, ''))) AS f FROM documents)
SELECT doc_id, md5(regexp_replace(l, '[^a-z0-9]', '', 'g')) AS ascii_key, md5(trim(regexp_replace(f, '[^a-z0-9]+', ' ', 'g'))) AS folded_words,
       md5(regexp_replace(f, '[^a-z0-9]', '', 'g')) AS folded_key, md5(regexp_replace(l, '[^a-z0-9@.]', '', 'g')) AS address_key,
       md5(trim(regexp_replace(l, '[^\p{L}\p{N}_]+', ' ', 'g'))) AS word_key FROM t
"""


def url_keys(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", keys.host(u).alias("host"), keys.url_key(u).alias("url_key"), keys.registrable_domain(keys.host(u)).alias("domain"))


URL_SQL = r"""
WITH h AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '[/?#:].*$', ''), '^www\.', '') AS host FROM pages),
l AS (SELECT *, string_split(host, '.') AS p FROM h)
SELECT page_id, host, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^www\.', ''), '/+$', '') AS url_key,
       array_to_string(p[-least(len(p), CASE WHEN p[greatest(len(p) - 1, 1)] IN ('co','com','ac','edu','gov','org','net') AND length(p[-1]) = 2 THEN 3 ELSE 2 END) :], '.') AS domain FROM l
"""


def contacts_in_text(spark: SparkSession, d: str) -> DataFrame:
    """Addresses, the first one's hash and the first d/m date of every whole text."""
    t = F.coalesce("text", F.lit(""))
    found = table(spark, d, "documents").select("doc_id", tx.emails_in(t).alias("e"), tx.day_month(t).alias("day_month"))
    return found.select("doc_id", F.array_join("e", ";").alias("emails"), keys.email_hash(F.get("e", 0)).alias("email_hash"), "day_month")


CONTACTS_SQL = rf"""
WITH f AS (SELECT doc_id, text, list_transform(regexp_extract_all(coalesce(text, ''), '<([^<>\s@]+@[^<>\s]+)>', 1), lambda x: regexp_replace(x, '[.,;:]+$', '')) AS marked,
                  list_transform(regexp_extract_all(coalesce(text, ''), '{tx.EMAIL}'), lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{"|".join(tx.ENDINGS)}))[A-Z].*$', '')) AS plain FROM documents),
m AS (SELECT doc_id, CASE WHEN len(marked) > 0 THEN marked ELSE plain END AS e, regexp_extract(coalesce(text, ''), '\b(\d{{1,2}})/(\d{{1,2}})\b', ['d', 'm']) AS g FROM f),
x AS (SELECT doc_id, list_filter(e, lambda v, i: list_position(e, v) = i) AS e, g FROM m)
SELECT doc_id, array_to_string(e, ';') AS emails, CASE WHEN len(e) > 0 THEN sha256('e:' || lower(e[1]))[1:16] END AS email_hash,
       CASE WHEN g.d = '' THEN '' ELSE lpad(g.d, 2, '0') || '/' || lpad(g.m, 2, '0') END AS day_month FROM x
"""


def repeats(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose folded text an earlier document has."""
    docs = table(spark, d, "documents").select("doc_id", md5(keys.folded_key(F.coalesce("text", F.lit("")))).alias("k"))
    return matching.first_of_key(docs, "doc_id", F.col("k")).filter("repeat_of IS NOT NULL")


REPEATS_SQL = """
WITH k AS (SELECT doc_id, regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^a-z0-9]', '', 'g') AS k FROM documents),
f AS (SELECT k, min(doc_id) AS repeat_of FROM k GROUP BY 1)
SELECT doc_id, repeat_of FROM k JOIN f USING (k) WHERE repeat_of < doc_id
"""


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    """Documents that share their text's key, or their first line's key within a source; not transitive."""
    t = F.coalesce("text", F.lit(""))
    rows = table(spark, d, "documents").select("doc_id", md5(keys.ascii_key(t)).alias("whole"), md5(F.concat_ws("|", "source", keys.ascii_key(F.get(F.split(t, "\n"), 0)))).alias("head"))
    out = matching.duplicate_groups(rows, "doc_id", ["whole", "head"])
    return out.select("doc_id", F.array_join("groups", " ").alias("groups"))


GROUPS_SQL = """
WITH r AS (SELECT doc_id, md5(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]', '', 'g')) AS w,
                  md5(concat_ws('|', source, regexp_replace(lower(string_split(coalesce(text, ''), chr(10))[1]), '[^a-z0-9]', '', 'g'))) AS h FROM documents),
k AS (SELECT DISTINCT doc_id, 'w' || w AS k FROM r UNION SELECT doc_id, 'h' || h FROM r),
g AS (SELECT DISTINCT list_sort(list(doc_id)) AS m, sum(('0x' || md5(doc_id::VARCHAR)[1:15])::BIGINT::HUGEINT) AS s FROM k GROUP BY k HAVING count(*) > 1),
n AS (SELECT m, m[1] AS least, row_number() OVER (PARTITION BY m[1] ORDER BY len(m), s) AS k FROM g)
SELECT doc_id, string_agg(least::VARCHAR || '.' || k, ' ' ORDER BY least, k) AS groups FROM (SELECT unnest(m) AS doc_id, least, k FROM n) GROUP BY 1
"""


def order_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Of every order the customer's last earlier order of at most 180 days before."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return matching.last_within(o, "o_custkey", "o_orderdate", "o_orderkey", 180)


REUSE_SQL = """
WITH p AS (SELECT o_orderkey, o_orderdate, lag(o_orderkey) OVER w AS k, lag(o_orderdate) OVER w AS seen FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_orderkey, CASE WHEN datediff('day', seen::DATE, o_orderdate::DATE) <= 180 THEN k END AS earlier FROM p
"""


def row_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Every line's row by the first source that knows its key: a placed log, then suppliers, then parts."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    placed = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("o"), F.col("o_custkey")).alias("row"))
    sup = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("s"), F.col("s_nationkey")).alias("row"))
    part = table(spark, d, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("p"), F.col("p_size")).alias("row"))
    out = matching.cascade(li, [(placed, "l_orderkey", "row"), (sup, "l_suppkey", "row"), (part, "l_partkey", "row")], "row_id")
    return out.groupBy("row_id", "row_id_from").agg(F.count("*").alias("n"))


CASCADE_SQL = """
WITH j AS (SELECT 'o' || o_custkey AS a, 's' || s_nationkey AS b, 'p' || p_size AS c FROM lineitem
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON o_orderkey = l_orderkey
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON p_partkey = l_partkey)
SELECT coalesce(a, b, c) AS row_id, CASE WHEN a IS NOT NULL THEN 1 WHEN b IS NOT NULL THEN 2 WHEN c IS NOT NULL THEN 3 ELSE 0 END AS row_id_from, count(*) AS n FROM j GROUP BY 1, 2
"""


def register_match(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items whose words of six or more letters all stand in a document of one source of a language, and of no other's."""
    words = lambda t: F.array_distinct(F.filter(F.split(keys.folded_words(F.coalesce(t, F.lit(""))), " "), lambda w: F.char_length(w) >= 6))
    lang = F.coalesce("lang", F.lit(""))
    langs = table(spark, d, "documents").select(lang.alias("lang")).distinct()  # a few
    names = table(spark, d, "benchmark").select(F.col("item_id").alias("name_id"), words(F.col("text")).alias("tokens")).crossJoin(F.broadcast(langs))
    names = names.filter(F.size("tokens") > 0).withColumn("name_id", F.concat_ws("-", "name_id", "lang"))
    register = table(spark, d, "documents").select(F.col("doc_id").alias("entry_id"), F.col("source").alias("grp"), lang.alias("lang"), words(F.col("text")).alias("tokens"))
    return matching.unique_containment(names, register, "lang")


REGISTER_SQL = r"""
WITH n AS (SELECT item_id || '-' || lang AS name_id, lang, list_filter(string_split(trim(regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 6) AS w
           FROM benchmark, (SELECT DISTINCT coalesce(lang, '') AS lang FROM documents)),
m AS (SELECT name_id, lang, list_filter(w, lambda v, i: list_position(w, v) = i) AS want FROM n),
d AS (SELECT doc_id, source, coalesce(lang, '') AS lang, string_split(trim(regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents)
SELECT name_id, min(source) AS grp FROM m JOIN d ON m.lang = d.lang AND list_has_all(d.w, m.want) WHERE len(want) > 0 GROUP BY 1 HAVING count(DISTINCT source) = 1
"""


def run_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Quality as the labels have it and as the length of a document suggests, side by side as two runs."""
    la = table(spark, d, "labels")
    a = la.select("doc_id", F.col("quality").alias("v"))
    b = table(spark, d, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("v"))
    return matching.compare_runs(a, b, "doc_id", "v").groupBy("verdict").agg(F.count("*").alias("n"))


COMPARE_SQL = """
SELECT CASE WHEN b.v IS NULL THEN 'only a' WHEN a.v IS NULL THEN 'only b' WHEN a.v = b.v THEN 'same' ELSE 'different' END AS verdict, count(*) AS n
FROM (SELECT doc_id, quality AS v FROM labels) a FULL JOIN (SELECT doc_id, (n_chars > 1000)::INT AS v FROM documents) b ON a.doc_id = b.doc_id GROUP BY 1
"""


def part_name_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Lines of one order whose parts' types share tokens, counted by brand of the lower line."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", F.split(F.lower("p_type"), " ").alias("t"))
    a = li.join(p, "l_partkey").select("l_orderkey", "l_linenumber", "p_brand", "t")
    b = a.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("t").alias("u"))
    both = a.join(b, ["l_orderkey", "l_linenumber"])
    return both.groupBy("p_brand").agg(F.count("*").alias("pairs"), F.count_if(matching.token_agreement(F.col("t"), F.col("u"))).alias("agree"))


AGREE_SQL = """
WITH a AS (SELECT l_orderkey, l_linenumber, p_brand, string_split(lower(p_type), ' ') AS t FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT a.p_brand, count(*) AS pairs, count_if(len(list_intersect(a.t, b.t)) >= least(2, len(list_distinct(a.t)), len(list_distinct(b.t))))::BIGINT AS agree
FROM a JOIN a b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 GROUP BY 1
"""


def recheck_credit(spark: SparkSession, d: str) -> DataFrame:
    """Customers lacking a flag by segment, and how many later orders supply it, the first one only."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("metric"), F.lit(1).alias("n"))
    finds = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_custkey").alias("k"), F.col("c_mktsegment").alias("metric"), "o_orderdate", "o_orderkey")
    return matching.credit_once(rows, finds, "k", "metric", ["o_orderdate", "o_orderkey"])


CREDIT_SQL = """
SELECT c_mktsegment AS metric, count(*)::BIGINT AS lacking, count_if(c_custkey IN (SELECT o_custkey FROM orders))::BIGINT AS credited FROM customer GROUP BY 1
"""


def shared_values(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders that at most three suppliers claim, by supplier."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    return matching.shared_suppressed(li, "l_orderkey", "l_suppkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))


SHARED_SQL = """
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 3) GROUP BY 1
"""


def never_worse(spark: SparkSession, d: str) -> DataFrame:
    """Results of customers by open orders as old run and by others as new run, merged so that nothing gets worse."""
    o = table(spark, d, "orders")
    run = lambda status: o.filter(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.max("o_orderpriority").alias("contact"), F.count("*").alias("items"))
    return matching.never_worse(run("O"), run("F"), "o_custkey", "contact", "items")


WORSE_SQL = """
WITH r AS (SELECT o_custkey, o_orderstatus AS s, max(o_orderpriority) AS c, count(*) AS n FROM orders GROUP BY 1, 2), o AS (SELECT * FROM r WHERE s = 'O'), n AS (SELECT * FROM r WHERE s = 'F')
SELECT coalesce(o.o_custkey, n.o_custkey) AS o_custkey, coalesce(n.c, o.c) AS contact, greatest(coalesce(o.n, 0), coalesce(n.n, 0)) AS items,
       n.c IS NOT NULL AND n.c IS DISTINCT FROM o.c AS changed FROM o FULL JOIN n ON o.o_custkey = n.o_custkey
"""


def partner_scopes(spark: SparkSession, d: str) -> DataFrame:
    """Scopes of the pairs of supplier's and customer's nations over all lines."""
    n = table(spark, d, "nation").select("n_nationkey", keys.comparable(F.col("n_name")).alias("n_name"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("theirs"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("ours"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_returnflag")
    full = li.join(s, "l_suppkey").join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").join(c, "o_custkey")
    kind = F.when(F.col("l_returnflag") == "R", "network").otherwise("school")
    theirs = F.when(F.col("l_returnflag") == "A", F.col("theirs")).when(F.col("l_suppkey") % 2 == 0, "N/A").otherwise(F.col("theirs"))
    pairs = full.groupBy(kind.alias("kind"), theirs.alias("theirs"), "ours").agg(F.count("*").alias("n"))  # a few hundred, before anything is judged
    return pairs.groupBy(tx.partner_scope(F.col("kind"), F.col("theirs"), F.col("ours")).alias("scope")).agg(F.sum("n").alias("n"))


SCOPE_SQL = """
WITH f AS (SELECT l_returnflag = 'R' AS net, CASE WHEN l_returnflag <> 'A' AND l_suppkey % 2 = 0 THEN '' ELSE lower(ns.n_name) END AS t, lower(nc.n_name) AS o
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ns ON ns.n_nationkey = s_nationkey JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation nc ON nc.n_nationkey = c_nationkey)
SELECT CASE WHEN t = '' THEN CASE WHEN net THEN 'International' ELSE 'Unknown' END WHEN t = o THEN 'National' ELSE 'International' END AS scope, count(*)::BIGINT AS n FROM f GROUP BY 1
"""


def hash_shards(spark: SparkSession, d: str) -> DataFrame:
    """Customers by CRC-32 shard of their name; digests of the name's keys."""
    c = rollups.hash_shards(table(spark, d, "customer"), F.col("c_name"), 16)
    return c.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct(keys.phone_hash(F.col("c_name"))).alias("phones"))


QUERIES = {
    "text_keys": (text_keys, KEYS_SQL),
    "url_keys": (url_keys, URL_SQL),
    "contacts_in_text": (contacts_in_text, CONTACTS_SQL),
    "repeats": (repeats, REPEATS_SQL),
    "duplicate_groups": (duplicate_groups, GROUPS_SQL),
    "order_reuse": (order_reuse, REUSE_SQL),
    "row_cascade": (row_cascade, CASCADE_SQL),
    "register_match": (register_match, REGISTER_SQL),
    "run_comparison": (run_comparison, COMPARE_SQL),
    "part_name_agreement": (part_name_agreement, AGREE_SQL),
    "recheck_credit": (recheck_credit, CREDIT_SQL),
    "shared_values": (shared_values, SHARED_SQL),
    "never_worse": (never_worse, WORSE_SQL),
    "partner_scopes": (partner_scopes, SCOPE_SQL),
    "hash_shards": (hash_shards, None),
}
