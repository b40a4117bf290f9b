"""Results of research runs: building rows, merging, checking and choosing, as joins and partial sums."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.keys import registrable_domain
from tidewell.functions.text import attempt_categories, day_month


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def full_name(first: Column, last: Column) -> Column:
    """First and last name joined, blanks skipped."""
    return F.concat_ws(" ", F.nullif(F.btrim(first), F.lit("")), F.nullif(F.btrim(last), F.lit("")))


def attempt_rows(long: DataFrame, ident: str, column: str, text: str) -> DataFrame:
    """ident, column, text, category, all_matches, date_dm, date_from, needs_review for the cells of a long sheet that aren't blank.

    White space is collapsed. The date is the text's, else that of a heading that is a date.
    """
    cell = long.select(ident, column, F.btrim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", " ")).alias("text")).filter("text <> ''")
    hits = cell.withColumn("hits", attempt_categories(F.col("text"))).withColumn("own", day_month(F.col("text")))
    head = F.when(F.btrim(F.col(column)).rlike(r"^\d{1,2}/\d{1,2}$"), day_month(F.col(column))).otherwise("")
    first = F.get("hits", 0)
    return hits.select(
        ident, column, "text", first.alias("category"), F.array_join("hits", "|").alias("all_matches"),
        F.when(F.col("own") != "", F.col("own")).otherwise(head).alias("date_dm"),
        F.when(F.col("own") != "", "text").when(head != "", "column_header").otherwise("").alias("date_from"),
        F.when((F.size("hits") > 1) | first.isin("other", "speaker_unclear"), "yes").otherwise("").alias("needs_review"),
    )


def clean_report(attempts: DataFrame, category: str = "category", review: str = "needs_review", answered: tuple[str, ...] = ()) -> DataFrame:
    """A row per category: attempts and those to review; counts before any shuffle."""
    return attempts.groupBy(category).agg(F.count("*").alias("attempts"), F.count_if(F.col(review) == "yes").alias("to_review"))


def flag_counts(rows: DataFrame, flags: str) -> DataFrame:
    """How often each flag stands, without what it says in brackets."""
    return rows.select(F.explode(flags).alias("f")).groupBy(F.regexp_replace("f", r"\(.*$", "").alias("flag")).agg(F.count("*").alias("n"))


def merge_results(rows: DataFrame, results: DataFrame, repeats: DataFrame, key: str = "row_id", first: str = "first_id") -> DataFrame:
    """Rows with the result of their own, or of the row that they repeat; rows with neither are left out.

    repeats: key and first (the row repeated). repeat_of tells whose result a row took; details belong to rows without it.
    """
    own = rows.join(results, key, "left_semi").select("*", F.lit(None).cast(rows.schema[key].dataType).alias("repeat_of"))
    again = rows.join(repeats.select(key, F.col(first).alias("repeat_of")), key).join(results.select(key), key, "left_anti")
    both = own.unionByName(again).withColumn("__from", F.coalesce("repeat_of", key))
    return both.join(results.withColumnRenamed(key, "__from"), "__from").drop("__from")


def detail_rows(merged: DataFrame, items: str, key: str = "row_id") -> DataFrame:
    """A row for each item of a result, with its place; repeats take the result but give no details."""
    return merged.filter("repeat_of IS NULL").select(key, F.posexplode(items).alias("place", "item"))


def verified_first(rows: DataFrame, key: str, verified: Column, k: int | None = None) -> DataFrame:
    """The verified rows, numbered by the number in their id; the first k if asked for."""
    number = F.regexp_extract(F.col(key).cast("string"), r"(\d+)", 1).cast("bigint")
    out = rows.filter(verified).withColumn("number", number).orderBy("number", key)
    return out.limit(k) if k else out


def newest(rows: DataFrame, at: str, ident: str, k: int) -> DataFrame:
    """The k newest rows: a top-k, which each task cuts before anything is shuffled."""
    return rows.orderBy(F.col(at).desc(), ident).limit(k)


def union_of_passes(passes: list[DataFrame], key: str) -> DataFrame:
    """Rows of several passes, a later pass wins per key."""
    every = [p.withColumn("__pass", F.lit(i)) for i, p in enumerate(passes)]
    out = every[0]
    for p in every[1:]:
        out = out.unionByName(p)
    rest = [c for c in passes[0].columns if c != key]
    return out.groupBy(key).agg(F.max_by(F.struct(*rest), "__pass").alias("__r")).select(key, "__r.*")


def keyed_snapshot(state: DataFrame, configured: DataFrame, key: str) -> DataFrame:
    """State of keys that are still configured; written sorted by the key by whoever stores it."""
    return state.join(configured.select(key).distinct(), key, "left_semi")


def upload_rows(rows: DataFrame, template: dict[str, Column]) -> DataFrame:
    """Exactly the template's columns, in its order, as text; null is blank."""
    return rows.select(*[F.coalesce(c.cast("string"), F.lit("")).alias(name) for name, c in template.items()])


def lead_groups(leads: DataFrame, key: str, values: str, status: str, order: str) -> DataFrame:
    """Per key the distinct values of all its leads, how many leads, and the first one's status. Sets are partial before the shuffle."""
    each = leads.select(key, F.explode_outer(values).alias("v"), status, order)
    return each.groupBy(key).agg(F.sort_array(F.collect_set("v")).alias(values), F.count_distinct(order).alias("leads"), F.min_by(status, order).alias(status))


def reuse_index(results: list[DataFrame], keys: str, value: str) -> DataFrame:
    """key and value: the last batch that has a key wins. results come in order of their batches."""
    every = None
    for i, r in enumerate(results):
        part = r.select(F.explode(keys).alias("key"), F.col(value), F.lit(i).alias("__b"))
        every = part if every is None else every.union(part)
    return every.groupBy("key").agg(F.max_by(value, F.struct("__b", value)).alias(value))


def reuse_lookup(rows: DataFrame, index: DataFrame, ident: str, keys: str, value: str) -> DataFrame:
    """ident and the value of the row's first key that the index knows."""
    each = rows.select(ident, F.posexplode(keys).alias("__i", "key"))
    return each.join(index, "key").groupBy(ident).agg(F.min_by(value, "__i").alias(value))


def best_match(candidates: DataFrame, name: str, entry: str, parts: list[Column], least: Column) -> DataFrame:
    """name, entry and ambiguous: the best candidate by the parts of its score in order; ambiguous if another entry ties in all of them."""
    scored = candidates.filter(least).select(name, entry, F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]).alias("score")).distinct()
    top = scored.groupBy(name).agg(F.max("score").alias("score"))
    tied = scored.join(top, [name, "score"])
    return tied.groupBy(name).agg(F.min(entry).alias(entry), (F.count("*") > 1).alias("ambiguous"))


def fill_from(primary: DataFrame, secondary: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The primary's values, its blanks filled from the secondary, rows of both."""
    a, b = primary.select(key, *[F.col(c).alias(f"__a_{c}") for c in cols]), secondary.select(key, *[F.col(c).alias(f"__b_{c}") for c in cols])
    return a.join(b, key, "full").select(key, *[F.coalesce(F.nullif(F.col(f"__a_{c}"), F.lit("")), F.nullif(F.col(f"__b_{c}"), F.lit("")), F.lit("")).alias(c) for c in cols])


def fan_out(found: DataFrame, key: str, also: str, value: str, most: int = 3) -> DataFrame:
    """key and value for a find's own key and those it names as well; values that more than most keys claim are dropped."""
    each = found.select(F.explode(F.array_union(F.array(key), F.col(also))).alias(key), value).distinct()
    wide = each.groupBy(value).agg(F.count("*").alias("k")).filter(F.col("k") > most).select(value)
    return each.join(wide, value, "left_anti").select(key, value)


def first_positions(rows: DataFrame, key: str, position: str) -> DataFrame:
    """key and position: the first row of each key, which links point to."""
    return rows.groupBy(key).agg(F.min(position).alias(position))


def hidden_batches(batches: DataFrame, name: str = "name", rebuild_of: str = "rebuild_of", done: str = "done") -> DataFrame:
    """Batches not to be shown: the old one if its rebuild is done, else the rebuild."""
    rebuilt = batches.filter(~blank(F.col(rebuild_of)))
    return rebuilt.select(F.when(F.col(done), F.col(rebuild_of)).otherwise(F.col(name)).alias(name)).distinct()


def wrong_retracted(rows: DataFrame, wrong: DataFrame, key: str, cell: str) -> DataFrame:
    """Rows whose cell is cleared where it still holds the value that was found wrong for the key; retracted says so."""
    bad = wrong.select(key, F.col(cell).alias("__wrong")).distinct()
    hit = rows.join(bad, (rows[key] == bad[key]) & (rows[cell] == bad["__wrong"]), "left").drop(bad[key])
    return hit.withColumn("retracted", F.col("__wrong").isNotNull()).withColumn(cell, F.when(F.col("retracted"), "").otherwise(F.col(cell))).drop("__wrong")


def batches_of(rows: DataFrame, order: str, name: str, size: int) -> DataFrame:
    """rows with batch: parts of a fixed size by order, named name-p1, name-p2 and so on, or just name if one is enough.

    Places come from parts(), so no task sorts all rows.
    """
    from .importing import parts

    cut = parts(rows, order, size, size)
    several = rows.limit(size + 1).count() > size
    return cut.withColumn("batch", F.concat(F.lit(f"{name}-p"), F.col("part")) if several else F.lit(name)).drop("part")


def inbox_new(files: DataFrame, seen: DataFrame, at: str = "at") -> DataFrame:
    """Files (name, md5 and when they came) to pick up: neither checksum nor name known, of equal checksums or names the first."""
    fresh = files.join(seen.select("md5"), "md5", "left_anti").join(seen.select("name"), "name", "left_anti")
    one = fresh.groupBy("md5").agg(F.min(F.struct(at, "name")).alias("f")).select("md5", f"f.{at}", "f.name")
    return one.groupBy("name").agg(F.min(F.struct(at, "md5")).alias("f")).select("name", "f.md5", f"f.{at}")


def missing_fields(fields: dict[str, Column]) -> Column:
    """Struct of what is missing."""
    return F.struct(*[blank(c).alias(f"no_{k}") for k, c in fields.items()])


def reusable(site: Column, notes: Column, failures: tuple[str, ...]) -> Column:
    """A result with a website whose notes don't begin with a failure."""
    bad = F.lit(False)
    for f in failures:
        bad = bad | F.coalesce(notes.startswith(f), F.lit(False))
    return ~blank(site) & ~bad


def method_label(source: Column, mode: Column) -> Column:
    """How a result was read, as the sheet says it."""
    return F.when(source == "none", "not read").when(mode == "rules", "rules-only (lower accuracy)").when(mode.isin("claude_cli", "claude_api", "gemini", "agent"), "AI-read").otherwise(F.coalesce(mode, F.lit("")))


def count_cell(searched: Column, found: Column, verified: Column, noun: str) -> Column:
    """not searched, none published, none confirmed, or the number with its noun."""
    many = F.when(verified == 1, F.lit(f"1 {noun}")).otherwise(F.concat(verified.cast("string"), F.lit(f" {noun}s")))
    return F.when(~searched, "not searched").when(found == 0, "none published").when(verified == 0, "none confirmed").otherwise(many)


def merge_gap(last_seconds: Column, floor: float = 8.0) -> Column:
    """Seconds between merges: four times the last one's, the floor at least."""
    return F.greatest(F.lit(floor), 4 * F.coalesce(last_seconds, F.lit(0.0)))


def searchable(name: Column) -> Column:
    """A name worth a search: four letters or more."""
    return F.char_length(F.regexp_replace(name, r"[^\p{L}]", "")) >= 4


def query_name(name: Column) -> Column:
    """A name for a search: what stands before a spaced dash, without a legal form at its end."""
    return F.btrim(F.regexp_replace(F.regexp_replace(name, r"\s+[-–]\s.*$", ""), r"(?i)[,\s]+(?:gmbh|ltd|llc|inc|s\.?a|s\.?r\.?l|b\.?v|e\.?v|plc|ag)\.?$", ""))


def group_of(batch: Column, name: Column) -> Column:
    """retail by the batch, education by the name, else other."""
    return F.when(F.contains(F.lower(batch), F.lit("retail")), "retail").when(F.lower(name).rlike(r"school|universit|college|lyc|gymnas|institut|academ|schule|escuela"), "education").otherwise("other")


# Local parts of an office; public domains of education and of free mail, as parts of a domain.
OFFICE_LOCAL = (
    "erasmus international internacional internazional mobility mobilit relint ri@ info office secret segreter sekretar kontakt contact admin direc "
    "dirig post mail school schule escola escuela scuola ecole lycee college skola skole koulu szkola scoala"
).split() + ["ce\\."]
EDU_MAIL = (
    "istruzione.it pec.it ac- educa edu.gva.es edu.xunta juntadeandalucia.es educarex.es meb.k12.tr meb.gov.tr edu. .edu schule school skola skole koulu kommune kommun "
    "gov. cat ensino escola scoala szkola"
).split()
FREE_MAIL = (
    "gmail. hotmail. yahoo. outlook. live. libero.it gmx. web.de wp.pl o2.pl orange.fr wanadoo.fr free.fr abv.bg mail.ru seznam.cz t-online.de tiscali.it icloud."
).split()


def pick_official(emails: Column, host: Column) -> Column:
    """The office's address: the first on the site's own domain, else the first of a public education domain that is no free mail, else none.

    Addresses are looked at in order, those for international matters before others, and offices before persons.
    """
    local, at = (lambda e: F.lower(F.substring_index(e, "@", 1))), (lambda e: F.lower(F.substring_index(e, "@", -1)))
    order = lambda e, i: F.struct((~local(e).rlike("erasmus|internation|mobilit")).alias("a"), (~local(e).rlike("|".join(OFFICE_LOCAL))).alias("b"), i.alias("i"), e.alias("e"))
    has = lambda x, parts: x.rlike("|".join(re.escape(p) for p in parts))
    ranked = F.transform(F.array_sort(F.transform(emails, order)), lambda x: x["e"])
    own = F.filter(ranked, lambda e: at(e).endswith(registrable_domain(F.lower(host))))
    edu = F.filter(ranked, lambda e: has(at(e), EDU_MAIL) & ~has(at(e), FREE_MAIL))
    return F.coalesce(F.get(own, 0), F.get(edu, 0), F.lit(""))


def quota_message(text: Column) -> Column:
    """Struct daily and seconds: whether a refusal is for the day, and how long it asks to wait."""
    wait = F.regexp_extract(text, r"(?i)retry (?:in|after) (\d+(?:\.\d+)?)\s*s", 1)
    return F.struct(text.rlike(r"(?i)per ?day|daily").alias("daily"), F.nullif(wait, F.lit("")).cast("double").alias("seconds"))


def next_daily_reset(now: Column) -> Column:
    """The next 08:05 (UTC)."""
    today = F.date_trunc("day", now) + F.expr("INTERVAL '08:05' HOUR TO MINUTE")
    return F.when(now < today, today).otherwise(today + F.expr("INTERVAL 1 DAY"))


def paid_usage(events: DataFrame, order: str, usd: str, limit: float, block: int = 10_000) -> DataFrame:
    """Per event the micro-dollars spent before it by day, and whether it may still be paid for.

    order is numeric and tells events apart. A day is cut into blocks of it: sums within a block, and running sums over the blocks' totals, so
    no task holds a day.
    """
    micro = F.round(F.col(usd) * 1_000_000).cast("bigint")
    cut = events.withColumns({"__b": F.floor(F.col(order) / block), "__m": micro})
    over = Window.partitionBy("day").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy("day", "__b").agg(F.sum("__m").alias("__s")).select("day", "__b", F.coalesce(F.sum("__s").over(over), F.lit(0)).alias("__o"))
    inside = F.coalesce(F.sum("__m").over(Window.partitionBy("day", "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = cut.withColumn("__i", inside).join(before, ["day", "__b"]).withColumn("spent", F.col("__o") + F.col("__i"))
    return out.withColumn("allowed", F.col("spent") + F.col("__m") <= int(limit * 1_000_000)).drop("__b", "__m", "__o", "__i")
