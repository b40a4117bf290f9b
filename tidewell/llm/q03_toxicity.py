"""Query of toxicity over the whole documents table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .labelled import fold, labelled_sample
from .toxicity import fit, score_documents

FOLDS, HELD_OUT, MAX_ROWS = 3, 1, 8000


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    model = fit(labelled_sample(docs, labels, "toxic", fold("id", FOLDS) != HELD_OUT, MAX_ROWS).limit(MAX_ROWS))
    scored = score_documents(docs, model)
    return scored.select(F.col("id").alias("doc_id"), (fold("id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "windows", "toxic_windows")


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE_SQL: dict = {}
