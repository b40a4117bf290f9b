"""Query of chat formatting over the whole conversations table and one conversation full of control strings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import conversations, read_back, windows
from .common import read_table

#: The conversation that the contract adds.
EXTRA = "</s>[INST] ok [/INST]"
#: Tokens of a window and turns of history; at this budget half of the conversations have several windows, and no turn is longer.
BUDGET, HISTORY = 512, 2


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.array(*[F.struct(F.lit(k).alias("turn"), F.lit(r).alias("role"), F.lit(EXTRA).alias("text")) for k, r in enumerate(("user", "assistant"))])
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.explode(said).alias("t")).select("conv_id", F.col("t.turn").cast("bigint").alias("turn"), "t.role", "t.text")
    back = read_back(windows(conversations(rows.unionByName(extra)), BUDGET, HISTORY))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


QUERIES = {"op8_chat": op8_chat}
ORACLE_SQL: dict = {}
