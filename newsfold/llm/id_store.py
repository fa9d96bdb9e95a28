"""Token ids as raw payload shards with a minimal perfect hash index over document keys.

A store is a folder of three Parquet tables:

- ``shards``: ``part, shard, first, keys, sizes, payload``. The payload is the ids of consecutive documents as raw
  little-endian integers, 16 bits wide where the vocabulary allows and 32 otherwise; ``keys`` and ``sizes`` have each document's key and
  number of ids; ``first`` counts the ids before it in its part. Parts are ascending ranges of doc_id.
- ``parts``: ``part, base``, the ids before each part.
- ``index``: one row per segment of keys, a minimal perfect hash in levels of bit arrays and, by slot, fingerprint,
  shard and position in it. A key costs the same few probes however large the store is.

A key is a doc_id and, for repeated doc_ids, the number of its occurrence (from 0). A null doc_id is a key like any other
and sorts first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsfold.llm.blocks import blocks
from newsfold.llm.tokens import little_endian, worker_encoder

END_ID = 2
#: Ids of one shard, unless a single document has more.
SHARD_IDS = 1 << 20
#: Keys of one segment of the index, on average.
SEGMENT_KEYS = 8192
#: Bits of a level for each key that is still to be placed.
LEVEL_BITS = 2

SHARDS = "part int, shard bigint, first bigint, keys binary, sizes binary, payload binary"
INDEX = "segment int, keys bigint, levels array<binary>, fingerprints binary, shards binary, places binary"
FOUND = "doc_id bigint, occurrence bigint, shard bigint, place bigint"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, absent: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(np.where(absent, 0, doc_id).astype(np.int64).view(np.uint64), 1) + absent.astype(np.uint64), 2) ^ mixed(
            occurrence.astype(np.uint64), 3
        )


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of the levels. A key that is alone at its bit is placed there, the others go to the next level."""
    levels = []
    while len(keys):
        if len(levels) > 200:
            raise ValueError("keys repeat")
        size = LEVEL_BITS * len(keys)
        at = (mixed(keys, 10 + len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    return levels


def slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for keys that surely are not in the index."""
    found = np.full(len(keys), -1, dtype=np.int64)
    rest, before = np.arange(len(keys)), 0
    for level, alone in enumerate(levels):
        at = (mixed(keys[rest], 10 + level) % np.uint64(len(alone))).astype(np.int64)
        here = alone[at]
        found[rest[here]] = before + np.cumsum(alone)[at[here]] - 1
        before += int(alone.sum())
        rest = rest[~here]
    return found


def write_store(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int = END_ID, segment_keys: int = SEGMENT_KEYS) -> None:
    """Encode all texts (null: empty), end each with ``end_id``, and write the store to a new folder.

    Repeated rows are stored each. Documents are dealt into ranges of doc_id before they are encoded, so texts are
    shuffled once and ids never.
    """
    spark = docs.sparkSession
    width = np.dtype("<u2") if max(vocabulary, end_id + 1) <= 1 << 16 else np.dtype("<u4")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, byte_level=True)
        part, shard, first = None, 0, 0
        keys: list = []
        sizes: list[int] = []
        parts: list[bytes] = []

        def closed() -> pa.RecordBatch:
            nonlocal shard, first
            whole = np.array([key or 0 for key in keys], "<i8").tobytes() + bytes(key is None for key in keys)
            row = [part], [(part << 32) + shard], [first], [whole], [np.array(sizes, "<i8").tobytes()], [b"".join(parts)]
            shard, first = shard + 1, first + sum(sizes)
            keys.clear(), sizes.clear(), parts.clear()
            kinds = pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
            names = "part", "shard", "first", "keys", "sizes", "payload"
            return pa.RecordBatch.from_arrays([pa.array(value, kind) for value, kind in zip(row, kinds)], names)

        for rows, data, offsets in blocks(batches, "text"):
            ids, at = encoder.block(data, offsets)
            part = rows.column("part")[0].as_py()
            for row, key in enumerate(rows.column("doc_id").to_pylist()):
                own = np.append(ids[at[row] : at[row + 1]], end_id).astype(width)
                if sizes and sum(map(len, parts)) // width.itemsize + len(own) > SHARD_IDS:
                    yield closed()
                keys.append(key)
                sizes.append(len(own))
                parts.append(own.tobytes())
        if sizes:
            yield closed()

    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    ordered = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id")
    ordered.withColumn("part", F.spark_partition_id()).mapInArrow(shards, SHARDS).write.option("compression", "zstd").parquet(f"{folder}/shards")

    stored = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    totals = stored.groupBy("part").agg(F.sum(F.length("payload") / width.itemsize).cast("bigint").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.lit(width.itemsize).alias("width")).write.parquet(
        f"{folder}/parts"
    )
    _write_index(stored, folder, segment_keys)


def shard_rows(stored: DataFrame) -> DataFrame:
    """``doc_id, shard, place``: the documents of each shard in order, from its directory."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, keys in zip(batch.column("shard").to_pylist(), batch.column("keys").to_pylist()):
                count = len(keys) // 9
                ids, absent = np.frombuffer(keys, "<i8", count), np.frombuffer(keys, np.uint8, count, 8 * count)
                columns = [pa.array(ids, mask=absent.astype(bool)), pa.array(np.full(count, shard)), pa.array(np.arange(count))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "place"])

    return stored.select("shard", "keys").mapInArrow(rows, "doc_id bigint, shard bigint, place bigint")


def with_occurrence(rows: DataFrame, *order: str) -> DataFrame:
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)).cast("bigint") - 1)


def _segment(segments: int):
    return F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(segments)).cast("int")


def _hashes(rows: pd.DataFrame) -> np.ndarray:
    absent = rows["doc_id"].isna().to_numpy()
    return key_hash(rows["doc_id"].fillna(0).to_numpy(np.int64), absent, rows["occurrence"].to_numpy())


def _write_index(stored: DataFrame, folder: str, segment_keys: int) -> None:
    keys = with_occurrence(shard_rows(stored), "shard", "place")
    total = stored.agg(F.sum(F.length("keys") / 9)).first()[0] or 0
    segments = max(1, -(-int(total) // segment_keys))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = _hashes(rows)
        levels = build_hash(hashes)
        order = np.argsort(slots(levels, hashes))
        packed = [len(level).to_bytes(8, "little") + np.packbits(level).tobytes() for level in levels]
        prints = mixed(hashes[order], 99).astype("<u4").tobytes()
        shard, place = (rows[name].to_numpy()[order].astype("<i8").tobytes() for name in ("shard", "place"))
        return pd.DataFrame([(rows["segment"].iloc[0], len(rows), packed, prints, shard, place)], columns=[n.split()[0] for n in INDEX.split(", ")])

    dealt = keys.withColumn("segment", _segment(segments))
    dealt.groupBy("segment").applyInPandas(build, INDEX).withColumn("segments", F.lit(segments)).write.parquet(f"{folder}/index")


def find(keys: DataFrame, folder: str) -> DataFrame:
    """``doc_id, occurrence, shard, place`` of the keys that the index of a store holds.

    A foreign key is refused by its fingerprint, but for one in 2^32.
    """
    index = keys.sparkSession.read.parquet(f"{folder}/index")
    held = index.select("segments").first()
    segments = held[0] if held else 1

    def probe(rows: pd.DataFrame, segment: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or segment.empty:
            return pd.DataFrame(columns=[name.split()[0] for name in FOUND.split(", ")])
        row, hashes = segment.iloc[0], _hashes(rows)
        levels = [np.unpackbits(np.frombuffer(raw, np.uint8, offset=8), count=int.from_bytes(raw[:8], "little")).astype(bool) for raw in row["levels"]]
        at = slots(levels, hashes)
        known = at >= 0
        known[known] = np.frombuffer(row["fingerprints"], "<u4")[at[known]] == mixed(hashes[known], 99).astype(np.uint32)
        out = rows.loc[known, ["doc_id", "occurrence"]].reset_index(drop=True)
        for name in ("shard", "place"):
            out[name] = np.frombuffer(row[name + "s"], "<i8")[at[known]]
        return out

    dealt = keys.select(F.col("doc_id").cast("bigint").alias("doc_id"), "occurrence").withColumn("segment", _segment(segments))
    return dealt.groupBy("segment").cogroup(index.groupBy("segment")).applyInPandas(probe, FOUND)


def read_payload(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, place, start, n_tokens, ids_crc32`` of every stored document, from the raw payloads."""
    parts = spark.read.parquet(f"{folder}/parts")
    stored = spark.read.schema(SHARDS).parquet(f"{folder}/shards").drop("keys").join(parts, "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["sizes"], "<i8")
                ids = np.frombuffer(row["payload"], f"<u{row['width']}")
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums = [zlib.crc32(little_endian(ids[a:b])) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                columns = [np.full(len(sizes), row["shard"]), np.arange(len(sizes)), row["base"] + row["first"] + ends[:-1], sizes, np.array(sums, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "place", "start", "n_tokens", "ids_crc32"])

    return stored.mapInArrow(digest, "shard bigint, place bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(keys: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the given keys (``doc_id, occurrence``) by the index and the payloads."""
    return find(keys, folder).join(read_payload(keys.sparkSession, folder), ["shard", "place"]).drop("shard", "place", "occurrence")


def document_ids(spark: SparkSession, folder: str, doc_id: int, occurrence: int = 0) -> list[int]:
    """The ids of one document: one segment of the index, one shard. Empty for a key the store doesn't hold."""
    key = spark.createDataFrame([(doc_id, occurrence)], "doc_id bigint, occurrence bigint")
    place = find(key, folder).first()
    if place is None:
        return []
    width = spark.read.parquet(f"{folder}/parts").first()["width"]
    row = spark.read.schema(SHARDS).parquet(f"{folder}/shards").where(F.col("shard") == place["shard"]).first()
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], "<i8"))])
    return np.frombuffer(row["payload"], f"<u{width}")[ends[place["place"]] : ends[place["place"] + 1]].tolist()
