"""Duplicates, lookups and merges between runs and registers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_groups(rows: DataFrame, ident: str, keys: list[str]) -> DataFrame:
    """Groups of two or more rows that share a value of one of the keys; not transitive.

    Columns ident and groups: the sorted names of the row's groups. A group is named by its least row and its
    number among the groups with that least row, a few at most, as a row has few keys. Groups of different keys
    with the same members are one. Members are compared by their count and the sum of 60 bits of their MD5,
    so no group is gathered.
    """
    long = rows.select(ident, F.explode(F.array_compact(F.array(*[F.when(F.coalesce(F.col(k).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}:"), F.col(k).cast("string"))) for k in keys]))).alias("key")).distinct()
    mark = F.conv(F.substring(F.md5(F.encode(F.col(ident).cast("string"), "UTF-8")), 1, 15), 16, 10).cast("decimal(38,0)")
    groups = long.groupBy("key").agg(F.count("*").alias("n"), F.sum(mark).alias("s"), F.min(ident).alias("least")).filter("n > 1")
    named = groups.select("least", "n", "s").distinct().withColumn("k", F.row_number().over(Window.partitionBy("least").orderBy("n", "s")))
    name = F.concat_ws(".", F.col("least").cast("string"), F.col("k").cast("string"))
    member = long.join(groups, "key").select(ident, "least", "n", "s").distinct().join(named, ["least", "n", "s"])
    return member.groupBy(ident).agg(F.transform(F.sort_array(F.collect_list(F.struct("least", "k", name.alias("name")))), lambda g: g["name"]).alias("groups"))


def first_of_key(rows: DataFrame, ident: str, key: Column) -> DataFrame:
    """ident and repeat_of: for rows with a key that an earlier row has, the first such row; blank keys never repeat."""
    keyed = rows.select(F.col(ident), key.alias("__k"))
    first = keyed.filter(F.coalesce("__k", F.lit("")) != "").groupBy("__k").agg(F.min(ident).alias("first"))
    return keyed.join(first, "__k", "left").select(ident, F.when(F.col("first") < F.col(ident), F.col("first")).alias("repeat_of"))


def last_within(rows: DataFrame, key: str, at: str, ident: str, days: int) -> DataFrame:
    """ident, earlier: of each row the latest earlier row of its key at most so many days back, else null."""
    w = Window.partitionBy(key).orderBy(at, ident)
    prev, prev_at = F.lag(ident).over(w), F.lag(at).over(w)
    return rows.select(ident, F.when(F.datediff(at, prev_at) <= days, prev).alias("earlier"))


def cascade(rows: DataFrame, sources: list[tuple[DataFrame, str, str]], out: str) -> DataFrame:
    """rows with out: the value of the first source that has the row's key; then the source's number, 0 for none.

    sources: table, key column (the same name in rows), value column. The first row of a key by value counts.
    """
    for k, (src, key, value) in enumerate(sources):
        rows = rows.join(src.groupBy(key).agg(F.min(value).alias(f"__v{k}")), key, "left")
    names = [f"__v{k}" for k in range(len(sources))]
    rank = F.lit(0)
    for k in reversed(range(len(names))):
        rank = F.when(F.col(names[k]).isNotNull(), k + 1).otherwise(rank)
    return rows.withColumn(out, F.coalesce(*names)).withColumn(f"{out}_from", rank).drop(*names)


def unique_containment(names: DataFrame, register: DataFrame, block: str) -> DataFrame:
    """Names whose tokens all stand in the tokens of a register entry of the same block, where just one group fits.

    names: name_id, tokens, block. register: entry_id, grp, tokens, block. Entries are found through the
    rarest token of a name in its block, so only entries that share it are compared; the arrays of tokens are
    fetched for those alone.
    """
    tokens = register.select(block, "entry_id", F.explode(F.array_distinct("tokens")).alias("t"))
    common = tokens.groupBy(block, "t").agg(F.count("*").alias("n"))
    each = names.select("name_id", block, F.explode(F.array_distinct("tokens")).alias("t"))
    rare = each.join(common, [block, "t"], "left").fillna(0, ["n"])
    rare = rare.groupBy("name_id", block).agg(F.min(F.struct("n", "t")).alias("r")).select("name_id", block, "r.n", "r.t").filter("n > 0")
    proposed = rare.join(tokens, [block, "t"]).select("name_id", "entry_id", block)
    fit = proposed.join(names.select("name_id", block, F.col("tokens").alias("want")), ["name_id", block]).join(register.select(block, "entry_id", "grp", F.col("tokens").alias("all")), [block, "entry_id"])
    fit = fit.filter(F.size(F.array_except("want", "all")) == 0)
    return fit.groupBy("name_id").agg(F.min("grp").alias("grp"), F.count_distinct("grp").alias("k")).filter("k = 1").drop("k")


def compare_runs(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Side by side: both, only in one, equal or not."""
    left, right = a.select(key, F.col(value).alias("a")), b.select(key, F.col(value).alias("b"))
    verdict = F.when(F.col("a").isNull() & F.col("b").isNull(), "neither").when(F.col("b").isNull(), "only a").when(F.col("a").isNull(), "only b").when(F.col("a") == F.col("b"), "same").otherwise("different")
    return left.join(right, key, "full").withColumn("verdict", verdict)


def token_agreement(a: Column, b: Column) -> Column:
    """Whether two names share as many tokens as the shorter has, two at most."""
    return F.size(F.array_intersect(a, b)) >= F.least(F.lit(2), F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))


def credit_once(rows: DataFrame, finds: DataFrame, key: str, metric: str, order: list[str]) -> DataFrame:
    """Per metric how many rows lacked it and how many of these the finds supply: the first find of a key counts.

    rows: key, metric, n (how many rows of that key lack it). finds: key, metric and the order columns.
    """
    first = finds.withColumn("__r", F.row_number().over(Window.partitionBy(key, metric).orderBy(*order))).filter("__r = 1")
    lack = rows.groupBy(key, metric).agg(F.sum("n").alias("n"))
    return lack.join(first.select(key, metric, F.lit(1).alias("f")), [key, metric], "left").groupBy(metric).agg(F.sum("n").alias("lacking"), F.sum(F.coalesce("f", F.lit(0)) * F.least("n", F.lit(1))).cast("bigint").alias("credited"))


def shared_suppressed(rows: DataFrame, value: str, owner: str, limit: int = 3) -> DataFrame:
    """Rows without those whose value more than limit owners claim. Two passes of sums; no group is gathered."""
    wide = rows.groupBy(value).agg(F.count_distinct(owner).alias("k")).filter(F.col("k") > limit)
    return rows.join(wide.select(value), value, "left_anti")


def never_worse(old: DataFrame, new: DataFrame, key: str, contact: str, items: str) -> DataFrame:
    """The better of two results: a new contact wins, the longer list stays, what is missing is kept."""
    both = old.select(key, F.col(contact).alias("oc"), F.col(items).alias("oi")).join(new.select(key, F.col(contact).alias("nc"), F.col(items).alias("ni")), key, "full")
    return both.select(key, F.coalesce("nc", "oc").alias(contact), F.greatest(F.coalesce("oi", F.lit(0)), F.coalesce("ni", F.lit(0))).alias(items), (F.col("nc").isNotNull() & ~F.col("nc").eqNullSafe(F.col("oc"))).alias("changed"))


def reuse_verified(now: Column, before: Column, same_value: Column, same_source: Column) -> Column:
    """A check that can't be made now (null) keeps an earlier yes if value and source are unchanged."""
    return F.when(now.isNull() & F.coalesce(before & same_value & same_source, F.lit(False)), True).otherwise(now)
