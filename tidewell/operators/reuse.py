"""Earlier results for new rows: the last one that was known at the time, by keys in order of precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(index: DataFrame, asked: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """key, at and value: for each key and day that is asked, the index's last value of that day or before; without one, no row.

    index: key, at (a date) and value (orderable; the greatest of a day counts); asked: key and at. Both are one row a key and
    day first, so a hot key has no more rows than days; one sorted union and a last value follow, no range join.
    """
    known = index.groupBy(key, at).agg(F.max(value).alias(value)).select(key, at, value, F.lit(False).alias("__asks"))
    ask = asked.select(key, at).distinct().select(key, at, F.lit(None).cast(index.schema[value].dataType).alias(value), F.lit(True).alias("__asks"))
    w = Window.partitionBy(key).orderBy(at, "__asks").rowsBetween(Window.unboundedPreceding, 0)
    return known.unionByName(ask).withColumn(value, F.last(value, ignorenulls=True).over(w)).filter(F.col("__asks") & F.col(value).isNotNull()).drop("__asks")


def reuse_as_of(rows: DataFrame, index: DataFrame, max_age_days: int = 180) -> DataFrame:
    """row_id, batch, result and at of the earlier result that each row may take over; rows without one are absent.

    rows: row_id, keys (in order of precedence), batch (its own) and day; index: key, batch, result, at (a date; null is ageless and
    older than all) and good (whether the result may be reused). Of each key the last result known on the day counts, and
    only that: if it is of the row's own batch, over max_age_days old or not good, the next key is asked.
    """
    entry = index.select("key", F.coalesce("at", F.lit("0001-01-01").cast("date")).alias("day"), F.struct("batch", "result", F.col("at").alias("scraped"), "good").alias("hit"))
    asked = rows.select("row_id", F.col("batch").alias("own"), "day", F.posexplode("keys").alias("i", "key"))
    found = asked.join(as_of(entry, asked, "key", "day", "hit"), ["key", "day"])
    young = F.col("hit.scraped").isNull() | (F.datediff("day", F.col("hit.scraped")) <= max_age_days)
    fit = found.filter((F.col("hit.batch") != F.col("own")) & young & F.col("hit.good"))
    return fit.groupBy("row_id").agg(F.min_by("hit", "i").alias("h")).select("row_id", "h.batch", "h.result", F.col("h.scraped").alias("at"))
