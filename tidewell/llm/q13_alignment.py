"""Query of the alignment of two public tokenizers over the whole documents table."""

import os

from pyspark.sql import DataFrame, SparkSession

from .alignment import align_documents
from .common import read_table


def vocabularies() -> tuple[str, str]:
    """The files of the byte-level vocabulary and of the pieces."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path("byte_bpe_50k.json")), os.fspath(public_tokenizers.path("piece_bpe_32k.model"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"), *vocabularies()).withColumnRenamed("id", "doc_id")


QUERIES = {"op13_alignment": op13_alignment}
ORACLE_SQL: dict = {}
