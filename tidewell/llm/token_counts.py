"""Exact token totals, quantiles and truncated totals from the histogram of encoded lengths.

Documents are counted by encoded length. Suffix sums over the lengths answer, for any context limit L:
how many documents are longer, how many tokens are lost to a cut at L, and how many remain. Between two
lengths that occur, the truncated total is linear in L, so the table answers every limit.

The sums are made in two levels: lengths are grouped into spans of ``span``, each span is summed within
itself, and the few totals of spans (longest length / span) are summed in turn.

Defined results for odd input: a null text is the empty text of length zero; documents of equal length
fall in one row; repeated rows count each; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle


def length_table(lengths: DataFrame, length_col: str = "n_tokens", span: int = 1024) -> DataFrame:
    """One row per encoded length, with suffix sums.

    Columns: n_tokens; n_docs of that length; docs_longer; docs_up_to (that length or less);
    total_up_to (tokens of those); truncated_total (tokens if every document is cut at n_tokens);
    total_tokens and total_docs of the corpus.
    """
    counts = lengths.groupBy(F.col(length_col).cast("bigint").alias("n_tokens")).agg(F.count("*").alias("n_docs")).withColumn("part", F.floor(F.col("n_tokens") / span))
    counts = settle(counts, "lengths")  # read twice: else the documents would be encoded twice
    parts = counts.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    after = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    parts = parts.select(
        "part",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    within = Window.partitionBy("part").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.join(parts, "part").select(
        "n_tokens",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(within), F.lit(0)) + F.col("d_after")).alias("docs_longer"),
        (F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")).over(within), F.lit(0)) + F.col("t_after")).alias("t_longer"),
        "total_docs",
        "total_tokens",
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_longer",
        (F.col("total_docs") - F.col("docs_longer")).alias("docs_up_to"),
        (F.col("total_tokens") - F.col("t_longer")).alias("total_up_to"),
        (F.col("total_tokens") - F.col("t_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_total"),
        "total_docs",
        "total_tokens",
    )


def truncated_total(table: DataFrame, limits: list[int]) -> DataFrame:
    """limit, kept_tokens, cut_docs for each context limit, from a length_table."""
    asked = table.sparkSession.createDataFrame([(x,) for x in limits], "limit long")
    sums = asked.join(table, F.col("n_tokens") > F.col("limit"), "left").groupBy("limit").agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("cut_docs"), F.coalesce(F.sum(F.col("n_docs") * (F.col("n_tokens") - F.col("limit"))), F.lit(0)).alias("cut_tokens")
    )
    total = table.agg(F.coalesce(F.max("total_tokens"), F.lit(0)).alias("total"))
    return sums.crossJoin(F.broadcast(total)).select("limit", (F.col("total") - F.col("cut_tokens")).alias("kept_tokens"), "cut_docs")


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the least length that at least that share of the documents doesn't exceed."""
    asked = table.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return asked.join(table, F.col("docs_up_to") >= F.col("share") * F.col("total_docs"), "left").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
