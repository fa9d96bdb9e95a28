"""Spreading small inputs over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def split_bytes(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128MB").lower()
    units = {"kb": 2**10, "mb": 2**20, "gb": 2**30, "k": 2**10, "m": 2**20, "g": 2**30, "b": 1}
    unit = next((unit for unit in units if text.endswith(unit)), "")
    return int(text.removesuffix(unit)) * units.get(unit, 1)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition ``df`` by ``keys`` if it is too small to give every core a split of its own.

    A file with one row group is one task, however many cores wait and however costly each row is.
    The size is Spark's own estimate of the scan; an input with a split per core and more is
    returned as it is, so at most one split per core is ever moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, *keys) if size < cores * split_bytes(df) else df
