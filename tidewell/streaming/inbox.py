"""Inboxes: files that come into a folder are read once, and what they hold is appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.sources.folders import parsed


def inbox_stream(spark: SparkSession, folder: str, schema: str, files: int = 1000) -> DataFrame:
    """New JSON files of a folder as a stream, with the file's name; text that doesn't parse is kept in _bad."""
    read = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files).load(folder)
    return parsed(read.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("came"), "value"), schema)


def append_once(stream: DataFrame, log: str, checkpoint: str, make=lambda df: df, bad: str | None = None) -> StreamingQuery:
    """Appends each micro-batch to the log under its own number; a batch that is repeated after a failure replaces what it wrote before.

    make turns the good rows of a batch into rows of the log; rows that didn't parse go, as they are, to the folder bad, or nowhere. Stops when the
    inbox is empty; the next run goes on from the checkpoint.
    """

    def write(batch: DataFrame, number: int) -> None:
        good = batch.filter("_bad IS NULL").drop("_bad") if "_bad" in batch.columns else batch
        make(good).write.mode("overwrite").parquet(f"{log}/batch={number}")
        if bad and "_bad" in batch.columns:
            batch.filter("_bad IS NOT NULL").select("file", "_bad").write.mode("overwrite").parquet(f"{bad}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_log(spark: SparkSession, log: str, key: str | None = None) -> DataFrame:
    """All rows of a log; with a key, the first row of each (by batch and file), as a file may be put in twice."""
    rows = spark.read.option("mergeSchema", True).parquet(log)
    if key is None:
        return rows
    one = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct("batch", "file")).alias("r"))
    return one.select("r.*")
