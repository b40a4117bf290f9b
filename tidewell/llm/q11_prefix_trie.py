"""Query of the trie of rebuilt conversations over the whole conversations table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .prefix_trie import conversation_turns, prefix_trie

#: A conversation begins with at most so many turns less one of the first of its hundred.
HEADS, HUNDRED = 6, 100


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation with the first h turns of the first of its hundred in place of its own; h: CRC-32 of its id, modulo 6."""
    h = F.crc32(F.col("id").cast("string").cast("binary")) % HEADS
    heads = turns.filter(F.col("id") % HUNDRED == 0).select(F.col("id").alias("of"), F.slice("turns", 1, HEADS - 1).alias("head"))
    rows = turns.withColumn("h", h.cast("int")).withColumn("of", F.col("id") - F.col("id") % HUNDRED).join(heads, "of", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(conversation_turns(read_table(spark, sf_dir, "conversations"))))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE_SQL: dict = {}
