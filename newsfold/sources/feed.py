"""Raw feeds to one row per record with its file and place in it.

A feed row is ``file, block, line, refused`` and ``record``, or ``value`` for a record that is still
JSON text. Rows of a file are ordered by block, then line. A file that is refused as a whole gives
one row with ``refused`` set and no record; every other row is one element of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NOT_AN_ARRAY = "a batch must be a JSON array"

_LOCAL_ROW = (1 << 33) - 1


@dataclass(frozen=True)
class Feed:
    rows: DataFrame
    #: Whether ``line`` is the record's index in its file; for split line files it only gives the order.
    indexed: bool = True
    #: Whether ``line`` has no gaps within a file and block.
    gapless: bool = False

    def placed(self) -> DataFrame:
        """``file, line, refused, record, part, block, row``: parts in order, and the place in each without gaps.

        A reader that counts the rows of each split knows the places already, so nothing moves: a part is a split. Other
        rows are ranged by their place first. JSON text is then parsed after the shuffle, so that the sample for the
        ranges is a plain scan.
        """
        if self.gapless:
            return parsed(self.rows.withColumns({"part": F.col("file"), "row": F.col("line")}))
        place = ["file", "block", "line"]
        ranged = self.rows.repartitionByRange(*place).sortWithinPartitions(*place)
        numbered = ranged.withColumns(
            {
                "part": F.lit(""),
                "block": F.spark_partition_id().cast("bigint"),
                "row": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_ROW)),
            }
        )
        return parsed(numbered)


def parsed(rows: DataFrame) -> DataFrame:
    """Feed rows with ``record``; text that is no JSON is a malformed record."""
    return rows.withColumn("record", F.try_parse_json("value")).drop("value") if "value" in rows.columns else rows


def array_documents(texts: DataFrame) -> Feed:
    """Feed of ``file, value``, one whole JSON document per row.

    Elements are values of their own, so the size of one is bounded (128 MiB) and not that of the array.
    """
    looks_like_array = F.col("value").rlike(r"^[ \t\r\n]*\[")
    elements = F.when(looks_like_array, F.from_json("value", "array<variant>"))
    rows = texts.select("file", elements.alias("elements")).select(
        "file", F.col("elements").isNull().alias("refused"), F.posexplode_outer("elements").alias("line", "record")
    )
    # An empty array has no elements; a refused document keeps its row.
    return Feed(
        rows.where("refused OR line IS NOT NULL").select(
            "file", F.lit(0).cast("bigint").alias("block"), F.coalesce("line", F.lit(0)).cast("bigint").alias("line"), "refused", "record"
        )
    )


def read_array_files(spark: SparkSession, path: str) -> Feed:
    """Files that each hold one JSON array, as posted.

    A file is one task and one string, which Spark bounds at 2 GiB; a larger file fails the job. Send such
    feeds as lines: :func:`read_line_files`.
    """
    texts = spark.read.text(path, wholetext=True)
    return array_documents(texts.select(F.col("_metadata.file_path").alias("file"), "value"))


def line_documents(lines: DataFrame) -> Feed:
    """Feed of ``file, block_start, value``, one record per row in line order.

    A split starts at byte ``block_start`` of its file and its lines are read in order, so split, then row
    within the task, is their order whatever splits a task reads. Empty lines are skipped.
    """
    rows = lines.where(F.length("value") > 0).select(
        "file",
        F.col("block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_ROW)).alias("line"),
        F.lit(False).alias("refused"),
        "value",
    )
    return Feed(rows, indexed=False, gapless=True)


def text_lines(reader: DataFrame) -> DataFrame:
    """``file, block_start, value`` of a text scan, batch or stream."""
    return reader.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value"
    )


def read_line_files(spark: SparkSession, path: str) -> Feed:
    """One record per line: the form for large feeds, split over tasks by Spark where it isn't compressed."""
    return line_documents(text_lines(spark.read.text(path)))


def read_parquet_files(spark: SparkSession, path: str) -> Feed:
    """Records as rows of Parquet files with the feed's field names as columns."""
    table = spark.read.parquet(path)
    rows = table.select(
        F.col("_metadata.file_path").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("_metadata.row_index").alias("line"),
        F.lit(False).alias("refused"),
        F.to_json(F.struct(*table.columns)).alias("value"),
    )
    return Feed(rows, gapless=True)


def record_of(columns: list[str] | list[Column]) -> Column:
    """Columns as one JSON record; a null column is an absent field."""
    return F.try_parse_json(F.to_json(F.struct(*columns)))


#: Parts whose first numbers are sent to every task; more are joined as a table.
SENT_PARTS = 100_000


def part_starts(rows: DataFrame, first_seq: int) -> DataFrame:
    """``part, block, first, start, size, gapless`` of the parts of written rows of :meth:`Feed.placed`, in order.

    ``start`` is the number of a part's first row: the sum of the sizes before it. One narrow row per part, that is per split of the
    input, is ordered by a single task; no record moves.
    """
    span = F.max("row") - F.min("row") + 1
    sizes = rows.groupBy("part", "block").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("size"), (span == F.count(F.lit(1))).alias("gapless")
    )
    before = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.lit(first_seq)
    return sizes.withColumn("start", start.cast("bigint"))


def with_arrival_numbers(rows: DataFrame, starts: DataFrame, first_seq: int) -> tuple[DataFrame, int]:
    """Add ``arrival_seq`` to written rows of :meth:`Feed.placed`, and the first number after them.

    Files in name order, then the place in them, all above earlier batches and without gaps. ``starts`` are the stored
    :func:`part_starts` of the rows.
    """
    about = starts.agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("rows"), F.every("gapless").alias("gapless")).first()
    if about["parts"] and not about["gapless"]:
        raise ValueError("a feed that is read as gapless has gaps")
    listed = starts.select("part", "block", "first", "start")
    if about["parts"] <= SENT_PARTS:
        listed = F.broadcast(listed)
    numbered = rows.join(listed, ["part", "block"]).withColumn("arrival_seq", F.col("start") + F.col("row") - F.col("first"))
    return numbered.drop("start", "first"), first_seq + (about["rows"] or 0)
