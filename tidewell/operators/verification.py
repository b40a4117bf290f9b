"""Results held against the pages that they cite, and which results are to be read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.contacts import broken_name
from tidewell.functions.keys import host, url_key
from tidewell.functions.text import comparable_in, email_in_text, phone_in_text, quote_in_text

from .evidence import is_official


def contact_notes(contacts: DataFrame, pages: DataFrame, ident: str) -> DataFrame:
    """ident, verified (true, false, or null where the cited page was not read) and note.

    contacts: ident, name, email, phone, source_url, evidence_quote, email_source_url (null or the source's: the same page) and official
    (the site); pages: url, text and uncertified (its certificate could not be verified), a row for each key of an address. The quote and
    the name must stand on the source, which must be on the own domain; number and address too, the address on the page that it was read from,
    which, if another, needs the address itself to be on the own domain.
    """
    page = pages.select(url_key(F.col("url")).alias("k"), "text", "uncertified")
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    got = contacts.withColumns({"s_k": url_key(F.coalesce("source_url", F.lit(""))), "e_k": url_key(F.coalesce(F.when(has("email_source_url"), F.col("email_source_url")), F.col("source_url"), F.lit("")))})
    # What the source tells is read where it meets it; no text goes further.
    text = F.col("text")
    told = got.join(page.withColumnRenamed("k", "s_k"), "s_k", "left").select(
        *[F.col(c) for c in got.columns], F.col("uncertified").alias("s_bad"), text.isNull().alias("lost"), quote_in_text(F.col("evidence_quote"), text).alias("quoted"), comparable_in(F.col("name"), text).alias("named"),
        F.when(has("email"), email_in_text(F.col("email"), text)).alias("mailed"), F.when(has("phone"), phone_in_text(F.col("phone"), text)).alias("phoned"),
    )
    other = F.col("e_k") != F.col("s_k")
    # An address of another page asks that page; the other contacts keep a key of no page's, so they lie as they lay.
    told = told.withColumn("__k", F.when(other & has("email"), F.concat(F.lit("e"), F.col("e_k"))).otherwise(F.concat(F.lit("s"), F.col("s_k"))))
    told = told.join(page.select(F.concat(F.lit("e"), "k").alias("__k"), F.col("text").alias("e_text")), "__k", "left")
    mailed = F.when(other, email_in_text(F.col("email"), F.coalesce("e_text", F.lit("")))).otherwise(F.col("mailed"))
    site = host(F.coalesce("official", F.lit("")))
    wrong = F.array_compact(
        F.array(
            F.when(~F.col("quoted"), "quote not on page"),
            F.when(~F.col("named"), "name not on page"),
            F.when(has("email") & ~mailed, "email not on page"),
            F.when(other & ~is_official(F.substring_index(F.coalesce("email", F.lit("")), "@", -1), site), "email is not on the institute's own domain"),
            F.when(has("phone") & ~F.col("phoned"), "phone not on page"),
            F.when(~is_official(host(F.col("source_url")), site), "source not on the institute's own domain"),
        )
    )
    judged = told.select(*[c for c in told.columns if c != "e_text"], wrong.alias("wrong"))
    good = F.concat(F.lit("name"), F.when(has("email"), ", email").otherwise(""), F.when(has("phone"), ", phone").otherwise(""), F.lit(" found on page"), F.when(F.coalesce("s_bad", F.lit(False)), " (site certificate could not be verified)").otherwise(""))
    none, lost = ~has("name"), F.col("lost")
    verified = F.when(none | ~has("source_url"), False).when(lost, F.lit(None).cast("boolean")).otherwise(F.size("wrong") == 0)
    note = F.when(none, "no contact found").when(~has("source_url"), "no source URL given").when(lost, "cited page was not read by the fetcher (cannot check)").when(F.size("wrong") > 0, F.array_join("wrong", "; ")).otherwise(good)
    return judged.select(ident, verified.alias("verified"), note.alias("note"))


def needs_recheck(name: Column, site: Column, contact: Column, notes: Column, rechecked: Column, rounds: int, websites: bool) -> Column:
    """Whether a result is to be read again in a round: with a website but no contact; or, where websites are looked for, without a website.

    A search that was unavailable is no verdict: such a result is read again in any round. A broken name is not worth a search.
    """
    said, clean = F.coalesce(notes, F.lit("")), ~broken_name(F.coalesce(name, F.lit("")))
    no_site, alone = said.startswith("Website not found"), F.coalesce(contact, F.lit("")) == ""
    done = F.coalesce(rechecked, F.lit(0)) >= rounds
    if websites:
        return (no_site & F.contains(said, F.lit("search unavailable")) & clean) | (~done & no_site & alone & clean)
    return ~done & (F.coalesce(site, F.lit("")) != "") & alone & ~no_site


def set_aside(results: DataFrame, needs: Column, rechecked: str, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Results that stay, and those that are set aside, marked with the round so that it sets them aside no second time."""
    marked = results.withColumn("__again", F.coalesce(needs, F.lit(False)))
    return marked.filter("NOT __again").drop("__again"), marked.filter("__again").withColumn(rechecked, F.lit(rounds)).drop("__again")
