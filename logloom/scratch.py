"""Intermediate tables in the folder the executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of `path` and the path on it."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return fs.exists(hpath)


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors reach: `spark.checkpoint.dir` or else the context's checkpoint folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/") if configured else None


def side_by_side(*steps: Callable[[], None]) -> None:
    """Run independent chains of jobs at once: one fills the executors the others leave idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(step)) for step in steps]:
            done.result()


class Scratch:
    """A folder of written tables that outlives lost executors.

    `keep` computes a DataFrame once and returns it as a scan of the written
    files, so that several consumers share one pass over the input and each of
    them still prunes columns and pushes filters down.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        folder = folder or shared_folder(spark)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        self.spark = spark
        self.folder = f"{folder}/logloom-{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        return f"{self.folder}/{label}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, label: str = "table", **options: str) -> DataFrame:
        """`df` as written files; `options` go to the Parquet writer."""
        path = self.path(label)
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def part(self) -> Scratch:
        """A scratch folder within this one, for tables that can be dropped before the others."""
        return Scratch(self.spark, self.folder)

    def release(self, table: DataFrame) -> None:
        """Delete the files of one table that `keep` returned; call it when nothing built on it is still to run."""
        for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
            fs, hpath = hadoop_path(self.spark, path)
            fs.delete(hpath, True)

    def drop(self) -> None:
        """Delete the folder; call it when nothing built on its tables is still to run."""
        fs, hpath = hadoop_path(self.spark, self.folder)
        fs.delete(hpath, True)
