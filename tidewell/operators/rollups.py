"""Conditional roll-ups for dashboards and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dashboard(rows: DataFrame, day: str, batch: str, metrics: dict[str, Column]) -> DataFrame:
    """One vector of metrics in total, per day and per batch. One scan: grouping sets of partial sums."""
    flat = rows.select(F.col(day).alias("day"), F.col(batch).alias("batch"), *[m.alias(k) for k, m in metrics.items()])
    grouped = flat.groupingSets([[], [F.col("day")], [F.col("batch")]], F.col("day"), F.col("batch"))
    sums = [F.sum(F.col(k).cast("bigint")).alias(k) for k in metrics]
    level = F.when((F.grouping("day") == 1) & (F.grouping("batch") == 1), "total").when(F.grouping("batch") == 1, "day").otherwise("batch")
    return grouped.agg(level.alias("level"), *sums)


def with_headings(rows: DataFrame, group: str, order: Column, label: str) -> DataFrame:
    """Rows of each group under a heading row that counts them: group, is_heading, label, n."""
    heads = rows.groupBy(group).agg(F.count("*").alias("n")).select(group, F.lit(True).alias("is_heading"), F.col(group).cast("string").alias(label), "n")
    return heads.unionByName(rows.select(group, F.lit(False).alias("is_heading"), order.cast("string").alias(label), F.lit(1).cast("bigint").alias("n")))


def best_of(rows: DataFrame, by: str, prefer: Column, score: str, position: str, value: str) -> DataFrame:
    """The preferred row's value, else any: highest score, first position on ties."""
    return rows.groupBy(by).agg(F.max_by(value, F.struct(prefer.cast("int"), F.col(score), -F.col(position))).alias(value))


def buckets(score: Column) -> Column:
    """high, medium, low or none."""
    return F.when(score.isNull(), "none").when(score >= 0.75, "high").when(score >= 0.5, "medium").otherwise("low")


def blocks(rows: DataFrame, by: str, position: str) -> DataFrame:
    """First and last position and the number of rows of each key."""
    return rows.groupBy(by).agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("n"))


def round_robin(cands: DataFrame, group: str, kind: str, score: str, ident: str, k: int) -> DataFrame:
    """The first k of a group in turns over its kinds: each kind's best, then each kind's second best, and so on."""
    turn = F.row_number().over(Window.partitionBy(group, kind).orderBy(F.col(score).desc(), ident))
    place = F.row_number().over(Window.partitionBy(group).orderBy("turn", kind))
    return cands.withColumn("turn", turn).filter(F.col("turn") <= k).withColumn("place", place).filter(F.col("place") <= k)


def coordinators(rows: DataFrame, by: str, amount: str, kind: str, at: str) -> DataFrame:
    """Per coordinator the projects, their total, the kinds in order and the latest date."""
    return rows.groupBy(by).agg(
        F.count("*").alias("projects"), F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("total"),
        F.array_join(F.sort_array(F.collect_set(kind)), ", ").alias("kinds"), F.date_format(F.max(at), "yyyy-MM-dd").alias("latest"),
    )


def spend_by_month(rows: DataFrame, at: str, amount: str) -> DataFrame:
    """month, spent: exact sums in cents."""
    return rows.groupBy(F.date_format(at, "yyyy-MM").alias("month")).agg(F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("spent"))


def best_phone(rows: DataFrame, site: str, phone: str, trust: Column, at: str) -> DataFrame:
    """Per site the number of most trust, then the most frequent, the earliest, the least."""
    each = rows.groupBy(site, phone).agg(F.max(trust).alias("trust"), F.count("*").alias("n"), F.min(at).alias("first"))
    return each.groupBy(site).agg(F.max_by(phone, F.struct("trust", "n", -F.unix_micros(F.col("first").cast("timestamp")), -F.col(phone))).alias(phone))


def search_worklist(rows: DataFrame, by: str, needs: Column, ident: str) -> DataFrame:
    """Per key whether any row needs a check, the first row and all rows."""
    return rows.groupBy(by).agg(F.bool_or(needs).alias("needs"), F.min(ident).alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(ident)), lambda x: x.cast("string")), ";").alias("all_keys"))


def attempts_long(rows: DataFrame, idents: list[str], columns: list[str]) -> DataFrame:
    """A row for each of the columns of attempts: idents, sheet_column, value."""
    return rows.select(*idents, *columns).unpivot(idents, columns, "sheet_column", "value")


def ranked_contacts(rows: DataFrame, by: str, band: Column, ident: str, top: int = 3) -> DataFrame:
    """The first few contacts of each key by band, then ident, with a confidence that falls with the rank."""
    w = Window.partitionBy(by).orderBy(band, ident)
    ranked = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.withColumn("confidence", F.bround(F.least(F.lit(0.95), F.greatest(F.lit(0.3), 1.0 - 0.25 * F.col("rank"))), 2))


def missing_from(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """rows whose key other doesn't have."""
    return rows.join(other.select(key), key, "left_anti")


def hash_shards(rows: DataFrame, value: Column, shards: int) -> DataFrame:
    """rows with shard: the CRC-32 of the value, which stays the same on every run."""
    return rows.withColumn("shard", F.crc32(value.cast("binary")) % shards)


def round_robin_kinds(cands: DataFrame, group: str, ident: str, score: str, kinds: str, turns: list[str], k: int) -> DataFrame:
    """The first k of a group where a candidate may be of several kinds: in turns each kind takes its best that is still free, then the rest by score.

    At most k are taken, so a kind's first k and the group's first k are all that can be: what a group gathers is bounded by
    (kinds + 1) * k, and one fold over the turns chooses among them. Ties go by ident.
    """
    best = F.struct((-F.col(score)).alias("s"), F.col(ident).alias("id"))
    each = cands.select(group, best.alias("c"), F.explode(F.array_append(F.array_intersect(kinds, F.array(*map(F.lit, turns))), F.lit(""))).alias("kind"))
    place = F.row_number().over(Window.partitionBy(group, "kind").orderBy("c"))
    lists = each.withColumn("__n", place).filter(F.col("__n") <= k).groupBy(group).agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == t, F.col("c")))), lambda c: c["id"]).alias(f"__k{i}") for i, t in enumerate([*turns, ""])])

    def turn(chosen: Column, kind: Column) -> Column:
        free = F.lit(None)
        for i in range(len(turns) + 1):
            own = F.get(F.filter(F.col(f"__k{i}"), lambda c: ~F.array_contains(chosen, c)), 0)
            free = F.when(kind == i, own).otherwise(free)
        return F.when((F.size(chosen) < k) & free.isNotNull(), F.array_append(chosen, free)).otherwise(chosen)

    steps = F.array(*[F.lit(i) for _ in range(k) for i in range(len(turns))], *[F.lit(len(turns))] * k)
    empty = F.array().cast(f"array<{cands.schema[ident].dataType.simpleString()}>")
    return lists.select(group, F.posexplode(F.aggregate(steps, empty, turn)).alias("place", ident)).withColumn("place", F.col("place") + 1)
