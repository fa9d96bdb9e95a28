"""Distinct texts by digest, written once in buckets of it."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfold.llm.scratch import Scratch


def text_digest() -> Column:
    """16 bytes that name a text; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256), 1, 32))


@contextmanager
def distinct_texts(scratch: Scratch, docs: DataFrame):
    """``digest, copies, text`` of the distinct texts of ``docs``, as a table in buckets of the digest.

    Copies are folded map-side first, so a text with a third of all rows reaches its bucket once per task. Joins with
    the table on ``digest`` (and a hash-join hint on their other side) leave the texts where they lie. It is dropped
    at the end of the block.
    """
    spark = docs.sparkSession
    table, buckets = f"distinct_texts_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(text_digest().alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.groupBy("digest").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    texts.write.bucketBy(buckets, "digest").option("path", scratch.path("texts")).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
        scratch.drop("texts")
