"""Best-fit packing of token sequences by bulk-synchronous rounds.

A round matches all waiting pieces with all open sequences at once: both are sorted by size, the pieces are swept from
the largest down, and each takes its successor, the smallest gap that holds it. Where several pieces want the gaps of
one size, the rank in the sorted order decides; who loses waits for the next round, which sees the updated gaps. A
piece that no gap holds opens a sequence.

Sizes are whole numbers up to the capacity, and what a sequence can still take depends on its gap alone. So a sorted
run of pieces (or gaps) is a size and a range of ranks, and a round is a merge of two lists of runs: the sweep needs
the counts by size, at most ``capacity`` numbers however many pieces there are, and not the pieces. Executors count
and rank the pieces; the rounds yield runs "pieces of this size with these ranks go to these sequences at this
offset"; executors then place every piece by its size and rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsfold.llm.blocks import blocks
from newsfold.llm.scratch import Scratch
from newsfold.llm.tokens import little_endian, worker_encoder

CAPACITY = 2048
END_ID = 0

#: Rows that one task ranks at a time, roughly; pieces of one size are dealt over as many tasks as that takes.
RANKED_ROWS = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's ids and the end id, cut where above capacity.

    A null or empty text is the end id alone. Repeated rows are packed once each; other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, byte_level=False)
        for rows, data, offsets in blocks(batches, "text"):
            ids, at = encoder.block(data, offsets)
            out: list[tuple] = []
            for row, doc in enumerate(rows.column("doc_id").to_pylist()):
                raw = bytes(little_endian(ids[at[row] : at[row + 1]])) + end_id.to_bytes(4, "little")
                for piece, start in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[start : start + 4 * capacity]
                    out.append((doc, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class Gaps:
    """Open sequences as runs of consecutive sequence numbers, by gap; gaps are kept in order for successor search."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, deque] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap not in self.runs:
            bisect.insort(self.sizes, gap)
            self.runs[gap] = deque()
        self.runs[gap].append((first, count))

    def take(self, gap: int, most: int) -> tuple[int, int]:
        first, count = self.runs[gap].popleft()
        if count > most:
            self.runs[gap].appendleft((first + most, count - most))
        elif not self.runs[gap]:
            del self.runs[gap]
            self.sizes.remove(gap)
        return first, min(most, count)


def rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Runs ``(length, first rank, first sequence, offset)`` that place ``counts[length]`` pieces of every length.

    A run lasts to the next one of its length. Rounds repeat until nothing waits.
    """
    waiting = {size: count for size, count in counts.items() if count}
    placed = dict.fromkeys(waiting, 0)
    gaps, plan, sequences = Gaps(), [], 0

    def place(size: int, first: int, count: int, gap: int) -> None:
        plan.append((size, placed[size], first, capacity - gap))
        placed[size] += count
        waiting[size] -= count
        if not waiting[size]:
            del waiting[size]
        if gap > size:
            updated.append((gap - size, first, count))

    while waiting:
        updated: list[tuple[int, int, int]] = []
        largest = gaps.sizes[-1] if gaps.sizes else 0
        # No gap holds these and none ever will: as many open sequences as their volume takes, the largest first.
        stuck = [(size, waiting[size]) for size in sorted(waiting, reverse=True) if size > largest]
        volume = -(-sum(size * count for size, count in stuck) // capacity)
        for size, count in stuck:
            seeds = count if 2 * size > capacity else min(count, volume)
            volume -= seeds
            if seeds > 0:
                place(size, sequences, seeds, capacity)
                sequences += seeds
        for size in sorted(waiting, reverse=True):
            while size in waiting and (at := bisect.bisect_left(gaps.sizes, size)) < len(gaps.sizes):
                gap = gaps.sizes[at]
                first, count = gaps.take(gap, waiting[size])
                place(size, first, count, gap)
        for gap, first, count in updated:
            gaps.add(gap, first, count)
    return plan


def with_rank(pieces: DataFrame, size: str, *keys: str) -> DataFrame:
    """``rank`` from 0 among the rows of one size. A frequent size is dealt over salts and never meets in one task."""
    total = pieces.count()
    salts = max(1, -(-total // RANKED_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*keys), F.lit(salts)))
    before = Window.partitionBy(size).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy(size, "salt").agg(F.count("*").alias("n"))
    firsts = firsts.select(size, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(size, "salt").orderBy(*keys)
    ranked = salted.withColumn("within", F.row_number().over(within) - 1)
    return ranked.join(firsts, [size, "salt"]).withColumn("rank", F.col("first") + F.col("within")).drop("salt", "within", "first")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to pieces with ``doc_id, piece, length`` of 1 to ``capacity``.

    Sequences are filled from 0 without gaps between pieces. No rows give no rows. ``pieces`` is read more than once,
    so pass a written table.
    """
    by_length = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    if any(row["length"] is None or not 1 <= row["length"] <= capacity for row in by_length):
        raise ValueError(f"lengths go from 1 to {capacity}")
    plan = sorted(rounds({row["length"]: row["count"] for row in by_length}, capacity))
    table = np.array(plan, dtype=np.int64).reshape(-1, 4)
    runs = {int(size): table[table[:, 0] == size, 1:] for size in np.unique(table[:, 0])}
    ranked = with_rank(pieces, "length", "doc_id", "piece")
    schema = ranked.withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = (batch.column(name).to_numpy() for name in ("length", "rank"))
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                own = sizes == size
                first, start, where = runs[int(size)].T
                at = np.searchsorted(first, ranks[own], "right") - 1
                sequence[own] = start[at] + ranks[own] - first[at]
                offset[own] = where[at]
            columns = [*batch.columns, pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema).drop("rank")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each is packed to."""
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.keep(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
