"""WARC replicas and their fixity audit by Merkle trees.

A replica is a table ``file, content``: WARC files, as ``spark.read.format("binaryFile")`` reads them or as
``warc_files`` packs pages. Every record is hashed; a leaf of a file's tree covers the records that start in one range
of ``RANGE_BYTES`` of the file, in order, and each level above joins 64 neighbours, up to the file and over the
files to one root. An audit compares the roots of two replicas and, level by level, only children of nodes that differ,
so it reads the records of damaged ranges alone.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.llm.scratch import Scratch

FILE_BYTES = 8 << 20
RANGE_BYTES = 64 << 10
FANOUT_BITS = 6
#: Levels up to one file (16 GiB at most) and on to one root over some 16 million files.
FILE_LEVELS = 3
ROOT_LEVELS = 7

#: A row group for each file: by default a writer holds 100 rows before it looks at their size, and a reader holds a row
#: group. Without the contents' dictionary and least and greatest values, which a writer holds up to the footer.
FILE_TABLE = {
    "parquet.block.row.count.limit": "1",
    "parquet.enable.dictionary#content": "false",
    "parquet.column.statistics.enabled#content": "false",
}
#: Vectored reads hold a row group's html twice, as one range and as the buffer it is read through.
PAGE_TABLE = {"parquet.hadoop.vectored.io.enabled": "false"}
#: An Arrow batch to Python ends after the file or the page that fills it.
BATCH_BYTES = 4 << 20

FILES = "file string, content binary"
RECORDS = "file string, at bigint, length bigint, record_id string, digest string"


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of ``BATCH_BYTES`` or so meanwhile: a batch is held some times over on its way to Python."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def warc_record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """One resource record; a null url or body is empty, a null id reads ``null``."""
    body = (html or "").encode()
    name = "null" if page_id is None else str(page_id)
    target = "".join(c for c in (url or "") if c not in "\r\n")
    head = (
        "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
        f"WARC-Record-ID: <urn:page:{name}>\r\nWARC-Target-URI: {target}\r\n"
        f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def warc_files(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``file, content``: the rows of ``page_id, url, html`` as WARC files of about ``file_bytes``, named apart; write it before use."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, number = [], 0, 0
        partition = TaskContext.get().partitionId()

        def closed() -> pa.RecordBatch:
            # Equal files differ in place: the partition and the number in it. The hash tells packs that are put together apart.
            whole = b"".join(parts)
            name = f"{partition:06d}-{number:06d}-{hashlib.sha256(whole).hexdigest()[:16]}.warc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([whole], pa.binary())], ["file", "content"])

        for batch in batches:
            for page, url, html in zip(*(batch.column(name).to_pylist() for name in ("page_id", "url", "html"))):
                parts.append(warc_record(page, url, html))
                size += len(parts[-1])
                if size >= file_bytes:
                    yield closed()
                    parts, size, number = [], 0, number + 1
        if parts:
            yield closed()

    return pages.select("page_id", "url", "html").mapInArrow(pack, FILES)


def parse(content: memoryview) -> Iterator[tuple[int, int, str | None]]:
    """``(offset, length, record id)`` of each record. What can't be read up to the next record start is one record."""
    raw, at = bytes(content), 0
    while at < len(raw):
        head = raw.find(b"\r\n\r\n", at)
        fields = dict(line.split(b": ", 1) for line in raw[at : max(head, at)].split(b"\r\n")[1:] if b": " in line)
        size = fields.get(b"Content-Length", b"")
        end = head + 4 + int(size) + 4 if head >= 0 and raw.startswith(b"WARC/", at) and size.isdigit() else -1
        if end < 0 or end > len(raw) or raw[end - 4 : end] != b"\r\n\r\n":
            following = raw.find(b"\r\n\r\nWARC/", at)
            end = following + 4 if following >= 0 else len(raw)
            yield at, end - at, None
        else:
            yield at, end - at, fields.get(b"WARC-Record-ID", b"").decode("utf-8", "replace") or None
        at = end


def records(replica: DataFrame) -> DataFrame:
    """``file, at, length, record_id, digest`` of every record, read from the files' bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                content = memoryview(batch.column("content")[row].as_buffer() or b"") if batch.column("content")[row].is_valid else memoryview(b"")
                name = batch.column("file")[row].as_py()
                out = [(name, at, size, key, hashlib.sha256(content[at : at + size]).hexdigest()) for at, size, key in parse(content)]
                if out:
                    kinds = pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [f.split()[0] for f in RECORDS.split(", ")])

    return replica.select("file", "content").mapInArrow(read, RECORDS)


def _node(level: int) -> list[Column]:
    """The key of the node of a record at a level: a range of its file, or a bucket of files by their name's hash."""
    if level <= FILE_LEVELS:
        return [F.col("file"), F.shiftright(F.col("range"), FANOUT_BITS * level)]
    bits = FANOUT_BITS * (ROOT_LEVELS - level)
    return [F.lit(""), F.shiftrightunsigned(F.xxhash64("file"), 64 - bits) if bits else F.lit(0).cast("bigint")]


def tree(found: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Levels of nodes ``file, key, digest`` from the ranges to the root; ``parent_file, parent_key`` name the node above.

    Buckets of files are split by hash bits, so a node of the upper levels has about 64 children.
    """
    ranged = found.withColumn("range", (F.col("at") / RANGE_BYTES).cast("bigint"))
    levels = []
    rows = ranged.select("file", "range", F.struct("at", "length", "digest").alias("item"))
    for level in range(ROOT_LEVELS + 1):
        file, key = _node(level)
        keyed = rows.select(file.alias("node_file"), key.cast("bigint").alias("key"), "file", "range", "item")
        joined = F.sha2(F.to_json(F.array_sort(F.collect_list("item"))), 256)
        nodes = keyed.groupBy("node_file", "key").agg(joined.alias("digest"), F.min("file").alias("file"), F.min("range").alias("range"))
        above = _node(level + 1) if level < ROOT_LEVELS else [F.lit(""), F.lit(0)]
        nodes = nodes.select("node_file", "key", "digest", "file", "range", above[0].alias("parent_file"), above[1].cast("bigint").alias("parent_key"))
        levels.append(scratch.keep(nodes, f"{name}-{level}"))
        rows = levels[-1].select("file", "range", F.struct(F.col("node_file").alias("at"), F.col("key").alias("length"), "digest").alias("item"))
    return levels


def mismatching_ranges(ours: list[DataFrame], theirs: list[DataFrame], scratch: Scratch) -> DataFrame:
    """``file, range`` of the leaves that differ or are missing on one side; empty if the roots agree."""
    opened = ours[-1].select("node_file", "key").unionByName(theirs[-1].select("node_file", "key"))
    for level in range(ROOT_LEVELS, -1, -1):
        one, two = ours[level], theirs[level]
        if level < ROOT_LEVELS:
            above = opened.select(F.col("node_file").alias("parent_file"), F.col("key").alias("parent_key"))
            one, two = (side.join(above, ["parent_file", "parent_key"], "left_semi") for side in (one, two))
        one, two = one.select("node_file", "key", F.col("digest").alias("one")), two.select("node_file", "key", F.col("digest").alias("two"))
        differ = one.join(two, ["node_file", "key"], "full").where("NOT (one <=> two)").select("node_file", "key")
        opened = scratch.keep(differ, f"differ-{level}")
        if opened.isEmpty():
            break
    return opened.select(F.col("node_file").alias("file"), F.col("key").alias("range"))


def audit(replica: DataFrame, other: DataFrame) -> DataFrame:
    """``file, at, length, record_id, digest, status`` of every record of ``replica`` and of those only ``other`` has.

    ``status`` is ``intact``, ``differs`` (the other replica has other bytes there), ``missing`` (it has none there) or
    ``added`` (only it has one). Both replicas are read twice, to hash their records and once for the result; empty
    replicas give no rows. Files are told apart by name.
    """
    scratch = Scratch(replica.sparkSession, "warc-audit")
    with small_batches(replica.sparkSession):
        ours, theirs = scratch.keep(records(replica), "ours"), scratch.keep(records(other), "theirs")
    ranges = mismatching_ranges(tree(ours, scratch, "our-tree"), tree(theirs, scratch, "their-tree"), scratch)

    def hit(found: DataFrame) -> DataFrame:
        return found.withColumn("range", (F.col("at") / RANGE_BYTES).cast("bigint")).join(ranges, ["file", "range"], "left_semi").drop("range")

    one, two = hit(ours), hit(theirs).select("file", "at", F.col("length").alias("l2"), F.col("record_id").alias("r2"), F.col("digest").alias("d2"))
    status = F.when(F.col("d2").isNull(), "missing").when(F.col("digest").isNull(), "added").when(F.col("digest") == F.col("d2"), "intact").otherwise("differs")
    damaged = one.join(two, ["file", "at"], "full").select(
        "file", "at", F.coalesce("length", "l2").alias("length"), F.coalesce("record_id", "r2").alias("record_id"), F.coalesce("digest", "d2").alias("digest"), status.alias("status")
    )
    damaged = scratch.keep(damaged.where("status != 'intact'"), "damaged")
    whole = ours.join(damaged.select("file", "at"), ["file", "at"], "left_anti").withColumn("status", F.lit("intact"))
    return whole.unionByName(damaged)


def with_damage(replica: DataFrame, every: int) -> DataFrame:
    """The replica after one bit in the middle of every record whose id is a multiple of ``every`` has flipped."""

    def damage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist()):
                raw = bytearray(content)
                for at, size, key in parse(memoryview(content)):
                    number = (key or "").removeprefix("<urn:page:").removesuffix(">")
                    if number.isdigit() and int(number) % every == 0:
                        raw[at + size - 5 if size > 5 else at] ^= 1
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([bytes(raw)], pa.binary())], ["file", "content"])

    return replica.mapInArrow(damage, FILES)


def audited_pages(pages: DataFrame, damage_every: int) -> DataFrame:
    """Pack pages as a replica, keep a second one with known damage, and audit them: ``page_id`` and the audit's columns."""
    scratch = Scratch(pages.sparkSession, f"warc-{uuid.uuid4().hex[:8]}")
    with small_batches(pages.sparkSession):
        replica = scratch.keep(warc_files(pages), "replica", **FILE_TABLE)
        other = scratch.keep(with_damage(replica, damage_every), "other", **FILE_TABLE)
    number = F.regexp_extract("record_id", "^<urn:page:(-?[0-9]+)>$", 1)
    return audit(replica, other).withColumn("page_id", F.when(number != "", number.cast("bigint")))
