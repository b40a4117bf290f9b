"""Folders of results: one JSON file a row, of several runs, read as one keyed table; and work that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def parsed(rows: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """rows with the record that their text holds as columns, and _bad: the text where it holds none."""
    record = F.from_json(F.col(text), f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    names = [f.name for f in rows.sparkSession.createDataFrame([], schema).schema]
    others = [c for c in rows.columns if c != text]
    return rows.select(*others, record.alias("__r"), text).select(*others, *[F.col("__r")[c].alias(c) for c in names], F.when(F.col("__r").isNull() | F.col("__r._bad").isNotNull(), F.coalesce(F.col(text), F.lit(""))).alias("_bad"))


def read_results(spark: SparkSession, folders: list[str], schema: str, pattern: str = r"(r[^/]*)\.json(?:\.gz)?$") -> DataFrame:
    """The result of each key (a file's name without ending), from the first of the folders that has it: the current run, the one before, the archive.

    source is the folder's place. Files that don't parse count as absent, so that an older result
    stands in; folders that don't exist are passed over; gzip is read by its ending.
    """
    out = None
    for k, folder in enumerate(folders):
        if not _there(spark, f"{folder}/*.json*"):
            continue
        key = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)
        rows = spark.read.text(f"{folder}/*.json*", wholetext=True).select(key.alias("key"), F.lit(k).alias("source"), "value")
        part = parsed(rows, schema).filter("_bad IS NULL AND key <> ''").drop("_bad")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"key string, source int, {schema}")
    values = [c for c in out.columns if c not in ("key", "source")]
    return out.groupBy("key").agg(F.min_by(F.struct("source", *values), "source").alias("r")).select("key", "r.*")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines, gzip or not; lines that don't parse, such as one that a stopped run left half written, are left out. Without a file, none."""
    if not _there(spark, path):
        return spark.createDataFrame([], schema)
    return parsed(spark.read.text(path), schema).filter("_bad IS NULL").drop("_bad")


def left_to_do(work: DataFrame, done: DataFrame, key: str, share: int = 0, shares: int = 1) -> DataFrame:
    """Work whose key no line of the results has, of one of several shares by the key's CRC-32, which is the same on every run."""
    mine = work.filter(F.crc32(F.col(key).cast("string").cast("binary")) % shares == share)
    return mine.join(done.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
