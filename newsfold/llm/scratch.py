"""Intermediate tables below the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of its own only on ``local`` masters without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="newsfold-llm-")


class Scratch:
    """Tables of one run, each written once below one fresh folder and read back.

    A table that is read back has no lineage, so a lost executor costs at most the tasks that ran on it.
    ``drop`` removes single tables as soon as nothing reads them any more. What the returned frame of an operator
    still reads stays until the caller clears the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def keep(self, df: DataFrame, table: str, **options: str) -> DataFrame:
        df.write.options(**options).parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        for table in tables:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
