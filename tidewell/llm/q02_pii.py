"""Query of personal data over the whole documents table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .pii import find, ordered, written


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(written("base"), 256).alias("base_sha256"),
        written(ordered(F.concat("base", "added"))).alias("spans"),
    )


QUERIES = {"op2_pii": op2_pii}
ORACLE_SQL: dict = {}
