"""Tabs of a workbook as tables: columns in the reader's order, names of tabs, and a tab for each institution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reordered(df: DataFrame, first: list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """The columns named first in that order, then the others as they are; with labels, under those, else their name in words with capitals."""
    order = [c for c in first if c in df.columns] + [c for c in df.columns if c not in first]
    return df.select(*[F.col(f"`{c}`").alias(labels.get(c, c.replace("_", " ").strip().title())) if labels is not None else F.col(f"`{c}`") for c in order])


def clean_title(key: Column, name: Column) -> Column:
    """Key and name without the marks that a tab's name can't have, at most 31 characters."""
    plain = F.btrim(F.regexp_replace(F.regexp_replace(F.concat_ws(" ", key, name), r"[\[\]:*?/\\']", " "), r"\s+", " "))
    return F.coalesce(F.nullif(F.btrim(F.substring(plain, 1, 31)), F.lit("")), key)


def tab_titles(rows: DataFrame, key: str, name: str, order: str, taken: list[str]) -> DataFrame:
    """key and title: unique whatever the case. The first row of a title keeps it, if no tab has it already; the others get the end of their key behind a shorter one, or, where that is taken too, their key."""
    lower = [t.lower() for t in taken]
    t = rows.select(F.col(key).alias("key"), F.col(order).alias("__o"), clean_title(F.col(key), F.col(name)).alias("title"))
    nth = F.row_number().over(Window.partitionBy(F.lower("title")).orderBy("__o", "key"))
    t = t.withColumn("kept", (nth == 1) & ~F.lower("title").isin(*lower, ""))
    second = F.substring(F.concat(F.substring("title", 1, 27), F.lit(" "), F.right("key", F.lit(3))), 1, 31)
    t = t.withColumn("second", F.when(~F.col("kept"), second))
    again = F.row_number().over(Window.partitionBy(F.lower("second")).orderBy("__o", "key"))
    firsts = t.filter("kept").select(F.lower("title").alias("__t")).withColumn("__held", F.lit(True))
    t = t.withColumn("again", again).join(firsts, F.lower("second") == F.col("__t"), "left")
    free = (F.col("again") == 1) & F.col("__held").isNull() & ~F.lower("second").isin(*lower, "")
    return t.select(F.col("key").alias(key), F.when(F.col("kept"), F.col("title")).when(free, F.col("second")).otherwise(F.col("key")).alias("title"))


def institution_tabs(institutions: DataFrame, sections: list[tuple[str, DataFrame, list[tuple[str, str]]]], key: str, name: str, order: str, taken: list[str], back: str = "Back to all institutes") -> DataFrame:
    """title, line and cells of a tab for each institution that has an item: its name, a way back, and for each section with items its heading with their
    number, its labels and its items by order.

    sections: heading (with {n}), items (key, order and fields) and the pairs of field and label that are shown; a blank field is an empty cell.
    """
    width = max(len(view) for _, _, view in sections)
    pad = lambda cells: F.array(*cells, *[F.lit("")] * (width - len(cells)))
    used = None
    for _, items, _ in sections:
        used = items.select(key) if used is None else used.union(items.select(key))
    inst = institutions.join(used.distinct(), key, "left_semi")
    titles = tab_titles(inst, key, name, order, taken)
    base = titles.join(inst.select(key, F.col(name).alias("__name")), key)
    part = lambda df, section, row, at, cells: df.select("title", F.lit(section).alias("section"), F.lit(row).alias("row"), at.alias("at"), cells.alias("cells"))
    zero = F.lit(0).cast("bigint")
    out = part(base, 0, 0, zero, pad([F.coalesce("__name", F.col(key))])).union(part(base, 0, 1, zero, pad([F.lit(back)])))
    for k, (heading, items, view) in enumerate(sections, 1):
        counted = items.groupBy(key).agg(F.count("*").alias("__n")).join(titles, key)
        text = F.concat(F.lit(heading.split("{n}")[0]), F.col("__n"), F.lit(heading.split("{n}")[1]))
        out = out.union(part(counted, k, 0, zero, pad([]))).union(part(counted, k, 1, zero, pad([text]))).union(part(counted, k, 2, zero, pad([F.lit(label) for _, label in view])))
        cells = [F.coalesce(F.col(f).cast("string"), F.lit("")) if f else F.lit("") for f, _ in view]
        out = out.union(part(items.join(titles, key).withColumn("__at", F.col(order).cast("bigint")), k, 3, F.col("__at"), pad(cells)))
    line = F.row_number().over(Window.partitionBy("title").orderBy("section", "row", "at", "cells"))
    return out.select("title", line.alias("line"), "cells")
