"""Numbered evidence lines, budgets, windows of lines, and the checks of claims against pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.text import email_in_text, phone_in_text, quote_in_text

LINE_COST = 8


def clean_lines(text: Column) -> Column:
    """Lines with white space collapsed, of three or more characters, cut at 500."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(F.regexp_replace(x, r"[ \t\r\f\x0b]+", " ")))
    return F.transform(F.filter(lines, lambda x: F.char_length(x) >= 3), lambda x: F.substring(x, 1, 500))


def numbered_lines(pages: DataFrame, entity: str, page: str, score: str, text: str = "text") -> DataFrame:
    """entity, page, n, line: pages by falling score, each line of an entity once (whatever its case), numbered through.

    A line that repeats is kept where it comes first. Repeats are found by a minimum per line, not by
    gathering; the numbers are the lines of the pages before, which are sums over pages, and the place in the page.
    """
    lines = pages.select(entity, page, score, F.posexplode(clean_lines(F.col(text))).alias("pos", "line"))
    place = F.struct((-F.col(score)).alias("s"), F.col(page).alias("p"), F.col("pos").alias("o"))
    first = lines.groupBy(entity, F.lower("line").alias("k")).agg(F.min_by(F.struct(page, "pos", "line", score), place).alias("l"))
    kept = first.select(entity, "l.*")
    pages_before = Window.partitionBy(entity).orderBy(F.col(score).desc(), page).rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept.groupBy(entity, page, score).agg(F.count("*").alias("__c"))
    ahead = sizes.select(entity, F.col(page).alias("__page"), F.col(score).alias("__score"), F.coalesce(F.sum("__c").over(pages_before), F.lit(0)).alias("__o"))
    place = F.row_number().over(Window.partitionBy(entity, page, score).orderBy("pos"))
    placed = kept.withColumn("__i", place).join(ahead.withColumnRenamed(entity, "__entity"), F.col(entity).eqNullSafe(F.col("__entity")) & F.col(page).eqNullSafe(F.col("__page")) & F.col(score).eqNullSafe(F.col("__score")))
    return placed.select(entity, page, score, "pos", "line", (F.col("__o") + F.col("__i")).alias("n"))


def within_budget(lines: DataFrame, entity: str, page: str, score: str, budget: int = 90_000, least: int = 4_000) -> DataFrame:
    """The lines that fit: every page has a quota, spare characters go to pages in order of score.

    The quota is the page's size, at most the larger of least and its equal share. A page ends before the
    first line that would overflow; later short lines don't come back. lines as numbered_lines gives them.
    """
    cost = F.char_length("line") + LINE_COST
    sizes = lines.groupBy(entity, page, score).agg(F.sum(cost).alias("size"))
    whole = Window.partitionBy(entity)
    order = whole.orderBy(F.col(score).desc(), page)
    quota = F.least("size", F.greatest(F.lit(least), F.floor(F.lit(budget) / F.count("*").over(whole))))
    q = sizes.withColumn("quota", quota).withColumn("spare", F.lit(budget) - F.sum("quota").over(whole)).withColumn("short", F.col("size") - F.col("quota"))
    taken = F.coalesce(F.sum("short").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    q = q.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("short"), F.col("spare") - taken))).select(entity, page, (F.col("quota") + F.col("extra")).alias("room"))
    run = F.sum(cost).over(Window.partitionBy(entity, page).orderBy("pos"))
    return lines.withColumn("used", run).join(q, [entity, page]).filter("used <= room").drop("used", "room")


def slices_with_hits(lines: DataFrame, entity: str, hit: Column, size: int = 140, least: int = 4) -> DataFrame:
    """entity, slice, hits: slices of so many lines by number that hold enough hits."""
    part = F.floor((F.col("n") - 1) / size)
    return lines.groupBy(entity, part.alias("slice")).agg(F.count_if(hit).alias("hits")).filter(F.col("hits") >= least)


def near_lines(lines: DataFrame, entity: str, page: str, width: int = 2) -> DataFrame:
    """lines with near: the lines up to width before and after on the same page, in order."""
    w = Window.partitionBy(entity, page).orderBy("n").rowsBetween(-width, width)
    return lines.withColumn("near", F.collect_list("line").over(w))


def is_official(source_host: Column, own_host: Column) -> Column:
    """The source's host is the own one or a part of it, or the other way round."""
    return F.coalesce((source_host == own_host) | source_host.endswith(F.concat(F.lit("."), own_host)) | own_host.endswith(F.concat(F.lit("."), source_host)), F.lit(False))


def claim_verified(text: Column, quote: Column, official: Column) -> Column:
    """True, false, or null where the page was not read."""
    return F.when(F.coalesce(quote, F.lit("")) == "", False).when(text.isNull(), F.lit(None).cast("boolean")).otherwise(quote_in_text(quote, text) & official)


def contact_problems(text: Column, name: Column, email: Column, phone: Column, quote: Column, official: Column) -> Column:
    """What a page doesn't bear out of a contact, in a fixed order."""
    return F.array_compact(
        F.array(
            F.when(~quote_in_text(quote, text), "quote not on page"),
            F.when(~F.contains(F.lower(text), F.lower(name)), "name not on page"),
            F.when((email != "") & ~email_in_text(email, text), "email not on page"),
            F.when((phone != "") & ~phone_in_text(phone, text), "phone not on page"),
            F.when(~official, "source not on the institute's own domain"),
        )
    )
