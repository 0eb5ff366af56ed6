"""Access logs as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DEFAULT_LOG = "data/access.log"


def _places() -> list[Column]:
    """The file a line is in, and where the split of it begins that one task reads in order."""
    return [F.col("_metadata.file_path").alias("log_file"), F.col("_metadata.file_block_start").alias("log_block")]


def read_log(spark: SparkSession, path: str | list[str] = DEFAULT_LOG) -> DataFrame:
    """One row per line of a file, folder or glob, plain or gzipped, and its place; raises where nothing is there."""
    return spark.read.text(path).select("value", *_places())


def stream_log(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of files as they appear in a folder, and their places."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select("value", *_places())
