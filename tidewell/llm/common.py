"""Helpers that the text operators share: scratch tables, word splitting, let-binding."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where that setting is absent a temporary folder is made, but only if the master is local (tests, a
    laptop); on a cluster each machine would have another one, so that is an error.
    """
    global _own_dir
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="tidewell-")
    return _own_dir


#: Rows of a file of a scratch table whose size is known.
FILE_ROWS = 250_000


def settle(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: a durable cut of the lineage.

    Where it is known that df has at most so many rows, small ones, they go to as few files as they need.
    """
    spark = df.sparkSession
    if rows is not None and (files := -(-rows // FILE_ROWS) or 1) < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(files)
    path = os.path.join(shared_dir(spark), f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidewell_path = path
    return out


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: str):
    """Within, Arrow batches hold at most so many bytes: what is written there keeps a small part of a partition in memory at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(df: DataFrame | None) -> None:
    """Remove a table that settle() wrote, once nothing reads it any more."""
    path = getattr(df, "_tidewell_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def join_unique(left: DataFrame, right: DataFrame, key: str, heavy: int = 1_000_000) -> DataFrame:
    """left joined on key with right, which has a column c, how many rows of left have the key, and each key once.

    Keys of more than ``heavy`` rows, at most rows / heavy of them, are broadcast, so that none is a hot
    partition; the others are shuffled. The column c is gone.
    """
    hot = right.filter(F.col("c") > heavy).drop("c")
    rest = right.filter(F.col("c") <= heavy).drop("c")
    if hot.isEmpty():
        return left.join(rest, key)
    hot = settle(hot, "hot-keys")
    few = F.broadcast(hot.select(key))
    return left.join(F.broadcast(hot), key).unionByName(left.join(few, key, "left_anti").join(rest, key))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """The runs of [^\\x20\\x09-\\x0D] in text, in order; none for null or blank text."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_CHARS))
    return let(core, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WHITE)))
