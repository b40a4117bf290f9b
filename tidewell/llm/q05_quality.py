"""Query of quality scores over the whole documents table."""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .labelled import fold, labelled_sample
from .quality_classifier import FEATURES, fit, measure, score_documents

FOLDS, HELD_OUT, MAX_ROWS = 4, 2, 20_000


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = labelled_sample(docs, read_table(spark, sf_dir, "labels"), "quality", fold("id", FOLDS) != HELD_OUT, MAX_ROWS)
    rows = measure(sample, "id", "text", ("label",)).limit(MAX_ROWS).toArrow().sort_by("id")
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    trees = fit(x, np.array(rows["label"].to_pylist(), float))
    scored = score_documents(docs, trees)
    return scored.select(F.col("id").alias("doc_id"), (fold("id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op5_quality": op5_quality}
ORACLE_SQL: dict = {}
