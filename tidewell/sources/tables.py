"""Scans: tables by name, and sheets with a byte order mark, quoted line breaks and free headers."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_sheet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A comma-separated sheet, all cells text, missing cells null. Without the file: no rows, the columns given."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or []]))
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def header_key(name: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]", "", plain.lower())


def rename_by_aliases(df: DataFrame, aliases: dict[str, list[str]], required: str) -> DataFrame:
    """Columns under their canonical names: of each list the first alias that heads a column wins."""
    heads = {header_key(c): c for c in reversed(df.columns)}
    found = {to: heads[header_key(a)] for to, names in aliases.items() for a in reversed(names) if header_key(a) in heads}
    if required not in found:
        raise ValueError(f"no column for {required}")
    return df.select(*[F.col(f"`{found[to]}`").alias(to) if to in found else F.lit(None).cast("string").alias(to) for to in aliases])


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of the rows of a key the last one by order."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return df.withColumn("__n", last).filter("__n = 1").drop("__n")


def read_json_archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, gzip or not; lines that don't parse are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_sheet(df: DataFrame, path: str) -> None:
    """Overwrite a sheet: nulls become empty cells."""
    df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns]).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_if_changed(df: DataFrame, old: DataFrame, path: str, ignore: tuple[str, ...] = ("generated_at",)) -> bool:
    """Write only if the payload differs from the old one, the ignored columns aside."""
    keep = [c for c in df.columns if c not in ignore]
    a, b = df.select(keep), old.select(keep)
    changed = not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty())
    if changed:
        df.write.mode("overwrite").parquet(path)
    return changed
