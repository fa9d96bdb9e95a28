"""Session settings every job here relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configured(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names; a scratch folder without one on a ``local`` master only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="newsfold-checkpoint-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch
