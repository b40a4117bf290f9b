"""Query of the quartile digests over the whole documents table."""

from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .quartile_digest import with_neighbours


def op12_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbours(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op12_digest": op12_digest}
ORACLE_SQL: dict = {}
