"""The corpus pipeline: stages that each work on all the documents their predecessor kept.

Quality rules, near-dedup by shingles of five words, benchmark decontamination, personal data, BPE coding. Every stage but
the last returns the columns of its documents; the last adds n_tokens, ids and decoded, in place of columns of these names.

Defined results for odd input: null texts are rejected by the quality rules; rows without an id are
deduplicated by equal texts alone; rows with one id and unlike texts are documents of their own; repeated rows
leave one; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.bpe import add_codes
from tidewell.llm.common import read_table, settle
from tidewell.llm.decontamination import drop_contaminated
from tidewell.llm.near_copies import node_of, representatives
from tidewell.llm.pii import redact
from tidewell.llm.q06_bpe import vocabulary
from tidewell.llm.quality_rules import clean_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules reject; the others go on without their failing lines."""
    return clean_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity of 0.8 or more) stays, that of the least id.

    Operator 1 links by fingerprints of five words, near_copies.py adds the links beyond its bits; both are
    verified. A row stays if its id and text are those of its group's representative; of rows alike in both, one.
    """
    kept = representatives(docs).select(F.col("id").alias("__id"), F.col("node").alias("__kept"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("__id"), node_of("text").alias("__kept"), row)
    named = keyed.join(kept, ["__id", "__kept"], "left_semi").dropDuplicates(["__id", "__kept"]).select("row.*")
    return named.unionByName(docs.filter("doc_id IS NULL").dropDuplicates(["text"]))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of a benchmark item occurs."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in place of personal data."""
    return redact(docs)


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds n_tokens, the packed ids and the text that they decode to."""
    return add_codes(docs, *vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", bpe_coding),
]
#: Positions, spans and tokens can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, f"stage-{k}")
    return docs
