"""Queries of BPE encoding and of token counts over the whole documents table."""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .common import read_table
from .token_counts import length_table


def vocabulary(path: str | None = None) -> tuple[str, str]:
    """The vocabulary file (by default the public one that is installed) and its pattern of words."""
    import public_tokenizers

    return os.fspath(path or public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(read_table(spark, sf_dir, "documents"), *vocabulary(), decode=True)
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(read_table(spark, sf_dir, "documents"), *vocabulary(), ids=False)
    return length_table(coded)


QUERIES = {"op6_bpe": op6_bpe, "op7_token_counts": op7_token_counts}
ORACLE_SQL: dict = {}
