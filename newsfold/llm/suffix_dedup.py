"""Removal of repeated byte strings by refining buckets of sampled suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Sorting all suffixes would move
every text many times over, so buckets are refined for a sample that loses no repeat, and by digests that name a
bucket by the bytes it stands for:

- **q-gram buckets.** Every window of ``LENGTH`` bytes is pointed at by one suffix inside it, the leftmost with the
  least q-gram hash. Equal windows choose alike, wherever they stand, so they meet in one q-gram bucket at the same
  offset. A text has about one such suffix in 170 bytes. A bucket of one suffix is done.
- **Refinement.** A suffix stands for a range of window offsets. Its bucket is refined by the bytes that all these
  windows share (``core``) and by those they cover together (``span``). If the span is repeated, all its bytes go. If
  the core is unique, no window of the range is repeated. Otherwise the range is split in four and each part is refined
  by its longer cores, and so on with the parts that stay open, down to single windows. A split reads the
  members of a bucket only, never pairs of them; it hashes their bytes again and uses no bucket of a later offset.

Texts are grouped by digest first; of equal texts with ``LENGTH`` bytes every byte goes, and one of them stands for
them all in the buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfold.llm.blocks import blocks
from newsfold.llm.distinct import distinct_texts, text_digest
from newsfold.llm.scratch import Scratch

LENGTH = 400
GRAM = 64
PARTS = 4
#: Window starts handled at once in one very long text.
CHUNK_BYTES = 2 << 20

ANCHORS = "digest binary, gram bigint, at bigint, low int, high int, span binary"
TESTED = "digest binary, at bigint, low int, high int, first int, last int, witness boolean, span binary, core binary"
ITEM = ["digest", "at", "low", "high", "first", "last"]
RESULT = "digest binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` (a power of two) bytes from each position on; the last ones run over the end."""
    table = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)  # fixed seed: the same everywhere
    hashes = table[data]
    step = 1
    with np.errstate(over="ignore"):
        while step < GRAM:
            hashes *= _MULTIPLIER
            hashes ^= hashes >> np.uint64(29)
            later = hashes.copy()
            later[:-step] = hashes[step:]
            later ^= np.uint64(step)
            later *= np.uint64(0xBF58476D1CE4E5B9)
            hashes += later
            step *= 2
        hashes *= _MULTIPLIER
        hashes ^= hashes >> np.uint64(31)
    return hashes


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def pointed(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of windows that point at the same suffix: ``text, gram hash, suffix, first window, last window``.

    Positions count from the start of ``data``, which has at most 2^23 bytes.
    """
    nothing = np.zeros(0, np.int64)
    if len(data) < length:
        return nothing, nothing, nothing, nothing, nothing
    hashes = gram_hashes(data)
    # The upper 41 bits are compared; then the position, so that the leftmost of equal ones is least.
    keys = (hashes & np.uint64(~((1 << 23) - 1) & (1 << 64) - 1)) | np.arange(len(data), dtype=np.uint64)
    least = sliding_minimum(keys[: len(data) - GRAM + 1], length - GRAM + 1)
    inside = np.zeros(len(least) + 1, dtype=np.int32)
    long = np.diff(offsets) >= length
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - length + 1] -= 1
    windows = np.flatnonzero(np.cumsum(inside[:-1]))
    suffix = (least[windows] & np.uint64((1 << 23) - 1)).astype(np.int64)
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (suffix[1:] != suffix[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    suffix = suffix[first]
    text = np.searchsorted(offsets, suffix, "right") - 1
    return text, hashes[suffix].view(np.int64), suffix, windows[first], windows[last]


def chunks(data: np.ndarray, offsets: np.ndarray, length: int, size: int | None = None):
    """``(bytes, offsets, first byte)``: a block, or a longer single text in pieces that share ``length - 1`` bytes."""
    size = size or CHUNK_BYTES
    if len(data) <= size:
        yield data, offsets, 0
        return
    for start in range(0, max(1, len(data) - length + 1), size - length):
        part = data[start : start + size - 1]
        yield part, np.array([0, len(part)]), start


def runs(data: np.ndarray, offsets: np.ndarray, length: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """What ``pointed`` gives for the whole block, chunk by chunk; a suffix whose windows lie in several chunks comes once."""
    held = None
    for part, parts, start in chunks(data, offsets, length, size):
        text, gram, suffix, first, last = pointed(part, parts, length)
        found = [text, gram, suffix + start, first + start, last + start]
        if held is not None:
            if len(suffix) and found[2][0] == held[2][0]:
                found[3][0] = held[3][0]
            else:
                yield tuple(held)
        held = [column[-1:] for column in found]
        yield tuple(column[:-1] for column in found)
    if held is not None:
        yield tuple(held)


def digest(data: memoryview, start: int, end: int) -> bytes:
    return xxhash.xxh3_128_digest(data[start:end])


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """The pointed suffixes of every text, with the digest of the span of all offsets where the text has it whole."""
    widest, size = length - GRAM, CHUNK_BYTES

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block, offsets in blocks(batches, "text", size):
            names = rows.column("digest").to_pylist()
            whole = memoryview(np.ascontiguousarray(block))
            for text, gram, suffix, first, last in runs(block, offsets, length, size):
                begin, end = suffix - widest, suffix + length
                fits = (begin >= offsets[:-1][text]) & (end <= offsets[1:][text])
                spans = [digest(whole, a, b) if ok else None for a, b, ok in zip(begin.tolist(), end.tolist(), fits.tolist())]
                at = suffix - offsets[:-1][text]
                columns = [pa.array([names[t] for t in text.tolist()], pa.binary()), pa.array(gram), pa.array(at)]
                columns += [pa.array((suffix - last).astype(np.int32)), pa.array((suffix - first).astype(np.int32)), pa.array(spans, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "gram", "at", "low", "high", "span"])

    return texts.select("digest", "text").mapInArrow(find, ANCHORS)


def refined(texts: DataFrame, opened: DataFrame, width: int, length: int) -> DataFrame:
    """Parts ``width`` offsets wide of the open ranges, with the digests of their spans and cores."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = memoryview(batch.column("text")[row].as_buffer())
                name, out = batch.column("digest")[row].as_py(), []
                for item in batch.column("items")[row].as_py():
                    at, low, high = item["at"], item["low"], item["high"]
                    for first in range(item["first"], item["last"] + 1, width):
                        last = min(first + width - 1, item["last"])
                        if first > high or last < low:
                            continue
                        fits = at - last >= 0 and at - first + length <= len(text)
                        # A single window has its span alone; else it would count itself twice.
                        core = digest(text, at - first, at - last + length) + last.to_bytes(2, "little") if first < last else None
                        span = digest(text, at - last, at - first + length) + last.to_bytes(2, "little") if fits else None
                        out.append((name, at, low, high, first, last, item["witness"], span, core))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)

    kinds = [pa.binary(), pa.int64(), *[pa.int32()] * 4, pa.bool_(), pa.binary(), pa.binary()]
    names = [field.split()[0] for field in TESTED.split(", ")]
    items = opened.groupBy("digest").agg(F.collect_list(F.struct(*ITEM[1:], "witness")).alias("items"))
    return texts.select("digest", "text").join(items.hint("shuffle_hash"), "digest").mapInArrow(split, TESTED)


def widths(length: int) -> list[int]:
    """Widths of the ranges of offsets, from all offsets to single ones."""
    out = [length - GRAM + 1]
    while out[-1] > 1:
        out.append(-(-out[-1] // PARTS))
    return out


def removed_ranges(scratch: Scratch, texts: DataFrame, length: int) -> DataFrame:
    """``digest, start, end`` of ranges of bytes to remove; they overlap.

    A range whose span is repeated is settled, but others may repeat a part of it. So one of the suffixes with an equal
    span stays as a witness while an open range shares its core.
    """
    found = scratch.keep(anchors(texts, length), "anchors")
    # Written, so that the join after it is dealt anew and a frequent gram can be split over tasks.
    shared = scratch.keep(found.groupBy("gram").count().where("count > 1").select("gram"), "shared")
    first, *rest = widths(length)
    tested = found.join(shared, "gram", "left_semi").select(
        *ITEM[:4], F.lit(0).alias("first"), F.lit(first - 1).alias("last"), F.lit(False).alias("witness"), "span", F.unhex(F.hex("gram")).alias("core")
    )
    tested = scratch.keep(tested, "tested-0")
    scratch.drop("anchors")
    ranges = []
    for step, width in enumerate([*rest, 0], 1):
        spans = tested.where("span IS NOT NULL").groupBy("span").agg(F.count("*").alias("n"), F.min(F.struct(*ITEM, "core")).alias("one"))
        spans = scratch.keep(spans.where("n > 1").select("span", "one"), f"spans-{step}")
        flagged = tested.join(spans.select("span", F.lit(True).alias("settled")), "span", "left").fillna(False, ["settled"])
        start, end = F.col("at") - F.col("last"), F.col("at") - F.col("first") + length
        covered = flagged.where("settled AND NOT witness").select("digest", start.alias("start"), end.alias("end"))
        ranges.append(scratch.keep(covered, f"ranges-{step}"))
        if not width:
            break
        rest_of = scratch.keep(flagged.where("NOT settled").select(*ITEM, "witness", "core"), f"rest-{step}")
        witnesses = spans.select("one.*", F.lit(True).alias("witness")).select(rest_of.columns)
        members = rest_of.unionByName(witnesses)
        cores = members.groupBy("core").agg(F.count("*").alias("n"), F.min("witness").alias("only_witnesses"))
        cores = scratch.keep(cores.where("n > 1 AND NOT only_witnesses").select("core"), f"cores-{step}")
        wanted = members.join(cores, "core", "left_semi").drop("core")
        tested = scratch.keep(refined(texts, wanted, width, length), f"tested-{step}")
        scratch.drop(f"tested-{step - 1}", f"rest-{step}", f"spans-{step}")
    out = ranges[0]
    for more in ranges[1:]:
        out = out.unionByName(more)
    return out


def without_ranges(texts: DataFrame, ranges: DataFrame, length: int, with_text: bool) -> DataFrame:
    """What is left of each text: ``RESULT``; ``kept`` has the remaining whole characters if ``with_text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                text = memoryview(batch.column("text")[row].as_buffer())
                copies, spans = batch.column("copies")[row].as_py(), batch.column("spans")[row].as_py()
                if copies > 1 and len(text) >= length:
                    spans = [{"start": 0, "end": len(text)}]
                kept, at, runs = [], 0, 0
                for span in sorted(spans or [], key=lambda span: span["start"]):
                    if span["start"] > at or not runs:
                        kept.append(text[at : span["start"]])
                        runs += 1
                    at = max(at, span["end"])
                kept.append(text[at:])
                left = b"".join(kept)
                chars = left.decode("utf-8", "ignore") if with_text else None
                out.append((batch.column("digest")[row].as_py(), len(text), len(text) - len(left), runs, hashlib.sha256(left).hexdigest(), chars))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)

    kinds = [pa.binary(), *[pa.int64()] * 3, pa.string(), pa.string()]
    names = [field.split()[0] for field in RESULT.split(", ")]
    spans = ranges.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return texts.join(spans.hint("shuffle_hash"), "digest", "left").select("digest", "copies", "text", "spans").mapInArrow(cut, RESULT)


def removed(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``RESULT`` of every distinct text. The texts are shuffled once and then read where they lie."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    with distinct_texts(scratch, docs) as texts:
        return scratch.keep(without_ranges(texts, removed_ranges(scratch, texts, length), length, with_text), "result")


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text`` of every row; ``text`` has the remaining whole characters.

    Null counts as empty. Repeated rows are copies of each other like any other equal texts. Other columns are ignored.
    """
    result = removed(docs, length, with_text=True).withColumnRenamed("kept", "text")
    return docs.select("doc_id", text_digest().alias("digest")).join(result, "digest").drop("digest")


def clean_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` with the remaining text; a null text stays null.

    A character that is cut by a removed range loses its remaining bytes, too.
    """
    names = docs.columns
    plain = docs.toDF(*(name if name == "text" else f"column_{at}" for at, name in enumerate(names)))
    result = removed(plain, length, with_text=True).select(F.col("digest").alias("of_digest"), "kept")
    keys = plain.withColumn("of_digest", text_digest()).withColumn("absent", F.isnull("text")).drop("text")
    left = keys.join(result, "of_digest").withColumn("text", F.when(~F.col("absent"), F.col("kept")))
    return left.select(*plain.columns).toDF(*names)
