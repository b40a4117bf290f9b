"""Importing free sheets: merged cells, headerless columns, parts, inherited cells, registers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.text import cell_kind, name_like


def expand_merged(rows: DataFrame, name: str, others: list[str]) -> DataFrame:
    """A row for each line of a name of several lines; other cells are paired by place, single values reused.

    Every row of a split cell has split = true. Cells of several lines beside a name of one line are
    joined by "; ".
    """
    lines = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), "\n"), lambda x: F.btrim(x)), lambda x: x != "")
    n = F.size(lines(name))
    at = F.posexplode_outer(lines(name)).alias("__i", "__name")
    flat = rows.select("*", n.alias("__n"), at)

    def cell(c: str) -> Column:
        v = lines(c)
        return F.when(F.col("__n") <= 1, F.array_join(v, "; ")).when(F.size(v) == 1, F.get(v, 0)).otherwise(F.coalesce(F.get(v, F.col("__i")), F.lit("")))

    keep = [c for c in rows.columns if c not in (name, *others)]
    return flat.select(*keep, F.coalesce("__name", F.lit("")).alias(name), *[cell(c).alias(c) for c in others], (F.col("__n") > 1).alias("split"))


def guess_name_column(cells: DataFrame, institution: str) -> DataFrame:
    """Of a sheet without headers, given as row, col and cell: the columns with their scores, best first by place.

    Half the share of name-like cells, the share that hold a word of the pattern, half the share of
    distinct cells; at least two in five must be name-like.
    """
    like = F.avg(name_like(F.col("cell")).cast("int"))
    scored = cells.groupBy("col").agg(like.alias("like"), (0.5 * like + F.avg(F.lower("cell").rlike(institution).cast("int")) + 0.5 * F.count_distinct("cell") / F.count("*")).alias("score"))
    place = F.row_number().over(Window.orderBy(F.col("score").desc(), "col"))
    return scored.filter("like >= 0.4").withColumn("place", place)


def blank_header(cells: Column) -> Column:
    """Whether a column without a heading holds names: three in five cells are text of 12 or more characters."""
    long = F.size(F.filter(cells, lambda c: (cell_kind(c) == "text") & (F.char_length(c) >= 12)))
    return 5 * long >= 3 * F.size(cells)


def _range_of(x: Column, bounds: list, before: int = 0) -> Column:
    """How many of the sorted bounds x reaches, by halving: a few comparisons a row."""
    if not bounds:
        return F.lit(before)
    mid = len(bounds) // 2
    return F.when(x < bounds[mid], _range_of(x, bounds[:mid], before)).otherwise(_range_of(x, bounds[mid + 1 :], before + mid + 1))


def parts(rows: DataFrame, ident: str, size: int = 1000, limit: int = 1200, ranges: int = 200) -> DataFrame:
    """rows with part: sheets of over limit rows in parts of size, by the order of a numeric ident.

    The rows are dealt into ranges by bounds that are fixed once; places come from counts per range, so no
    single task sorts the whole sheet, and a repeated task numbers its rows alike.
    """
    bounds = sorted(set(rows.approxQuantile(ident, [k / ranges for k in range(1, ranges)], 0.001)))
    ranged = rows.withColumn("__p", _range_of(F.col(ident), bounds))
    counts = ranged.groupBy("__p").agg(F.count("*").alias("__c"))
    before = F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__p", before.alias("__o"), F.sum("__c").over(Window.partitionBy()).alias("__all"))  # a row for each range
    at = F.col("__o") + F.row_number().over(Window.partitionBy("__p").orderBy(ident)) - 1
    return ranged.join(F.broadcast(offsets), "__p").withColumn("part", F.when(F.col("__all") > limit, F.floor(at / size) + 1).otherwise(1)).drop("__p", "__o", "__all")


def inherit_down(rows: DataFrame, group: str, order: list[str], cols: list[str]) -> DataFrame:
    """Empty cells take the value of the row above, within the group. The columns of the order must tell all rows of a group apart."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.last(F.nullif(F.col(c), F.lit("")), ignorenulls=True).over(w) for c in cols})


def register_rows(rows: DataFrame, code: str, tokens: str, head: Column, value: str) -> DataFrame:
    """One row per code: the union of the tokens, and the head office's value if it has one, else any."""
    return rows.groupBy(code).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(tokens)))).alias(tokens), F.coalesce(F.max(F.when(head, F.col(value))), F.max(value)).alias(value))


def fill_blanks(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Old rows whose blank cells take the new values; what is there is never overwritten. filled counts them."""
    other = new.select(key, *[F.col(c).alias(f"__{c}") for c in cols])
    gain = lambda c: ((F.coalesce(F.col(c), F.lit("")) == "") & (F.coalesce(F.col(f"__{c}"), F.lit("")) != "")).cast("int")
    joined = old.join(other, key, "left").withColumn("filled", sum((gain(c) for c in cols), F.lit(0)))
    return joined.select(*[F.when(gain(c) == 1, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in old.columns], "filled")


def without_national(partners: DataFrame, parents: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Partners that are not national, and their parents with partners_found counted anew where it was given."""
    kept = partners.filter(F.col("partner_scope") != "National").withColumn("partner_scope", F.when(F.col("partner_scope") == "Unknown", "Country not stated").otherwise(F.col("partner_scope")))
    n = kept.groupBy(key).agg(F.count("*").cast("string").alias("__n"))
    found = F.when(F.coalesce("partners_found", F.lit("")) == "", F.col("partners_found")).otherwise(F.coalesce("__n", F.lit("0")))
    return kept, parents.join(n, key, "left").withColumn("partners_found", found).drop("__n")


def sitemap_urls(files: DataFrame, xml: str = "xml") -> DataFrame:
    """Addresses in sitemaps, plain or in CDATA."""
    found = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), F.lit(1))
    return files.select(F.explode(found).alias("url")).distinct()


def list_runs(lines: DataFrame, entity: str, heading: Column, item: Column, misses: int = 6, least: int = 3, page: str = "page", n: str = "n") -> DataFrame:
    """Items of lists: after a heading the lines of its page that are items, until more than so many others in a row.

    Islands by windows: a run begins at a heading; the items of a run count while the number of lines
    since the last item or the heading stays within misses; runs of fewer than least items don't count.
    """
    w = Window.partitionBy(entity, page).orderBy(n)
    marked = lines.withColumn("__h", heading).withColumn("__i", item & ~heading).withColumn("run", F.sum(F.col("__h").cast("int")).over(w)).filter("run > 0")
    r = Window.partitionBy(entity, page, "run").orderBy(n)
    last = F.max(F.when(F.col("__h") | F.col("__i"), F.col(n))).over(r.rowsBetween(Window.unboundedPreceding, -1))
    broken = marked.withColumn("__b", F.when(F.col("__i") & (F.col(n) - last - 1 > misses), 1).otherwise(0)).withColumn("__s", F.sum("__b").over(r))
    good = broken.filter("__i AND __s = 0")
    return good.withColumn("items", F.count("*").over(Window.partitionBy(entity, page, "run"))).filter(F.col("items") >= least).drop("__h", "__i", "__b", "__s")


def count_failures(attempts: DataFrame, key: str, ok: str, order: str, most: int = 3) -> DataFrame:
    """Keys that failed so many times since their last success."""
    last = attempts.groupBy(key).agg(F.max(F.when(F.col(ok), F.col(order))).alias("__last"))
    since = attempts.join(last, key).filter(~F.col(ok) & (F.col("__last").isNull() | (F.col(order) > F.col("__last"))))
    return since.groupBy(key).agg(F.count("*").alias("failures")).filter(F.col("failures") >= most)
