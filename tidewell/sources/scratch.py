"""Durable cuts of lineage for operators that go in rounds: tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Unset, a temporary folder, but only where driver and executors are one machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="tidewell-rounds-"))
    return _own[0]


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as Parquet in the shared folder, read back; ``cleared`` removes it."""
    path = f"{scratch_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def cleared(df: DataFrame | None) -> None:
    """Removes a table that ``written`` made, once nothing reads it any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
