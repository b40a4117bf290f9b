"""Query of main texts over the whole pages table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .html_text import main_text


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(read_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


QUERIES = {"op9_html": op9_html}
ORACLE_SQL: dict = {}
