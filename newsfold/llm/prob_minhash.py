"""Near-duplicate classes of texts by ProbMinHash over weighted word shingles.

The similarity of two texts is the probability Jaccard index of their ``SHINGLE_WORDS``-word shingles, weighted by how
often each occurs: the sum over common shingles i of 1 / sum_j max(a_j / a_i, b_j / b_i), which is the plain Jaccard
index where no shingle repeats. A text with fewer words is one shingle; a text without words is like its exact copies
only.

- **Signature.** The arrivals of each shingle are a Poisson process with its weight as rate; each arrival hits a random
  register, and a register keeps the shingle that hits it first. Two texts agree in a register with the probability
  above. A shingle's process ends when it is later than the latest register of its text.
- **Bands.** ``BANDS`` bands of ``ROWS`` registers; texts at 0.8 share no band once in 37,000 pairs.
- **Verification** is exact, on the texts of pairs that agree in about as many registers. In a bucket of a band every member
  is held against a pivot from the largest class; then the pivot leaves, and buckets whose members are not yet in one class
  go on for ``ABSORBING_ROUNDS`` with ``PIVOT_GROWTH`` times as many pivots. Members of one class are never compared again.
- **Rare shingles** settle what is still open, without loss. Let o and o' be the shares of two texts' shingles, by weight, that
  are common. Their similarity is at most 1 / (1/o + 1/o' - 1): the sum over j for a common shingle i is at least
  1/p_i + (1 - o') / q_i for the normalised weights p and q, and the inverse of that is concave and homogeneous in (p_i, q_i).
  So for similar texts 1/o + 1/o' <= 1 + 1/``least``. Shingles are ordered by the number of open texts that have them; what
  comes before the first common one is not common, so texts meet at a shingle only if the shares left from there on keep to that
  bound. Nor do they have more shingles in common than either has left there, so the one that has less left bounds both shares:
  a text of which a few words too many are its own meets none of a group that else is like it. Of the pairs found, those go on
  to the texts whose counts of shingles by hash cell keep to the bound, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfold.llm.blocks import blocks, flat, pieces, words
from newsfold.llm.distinct import distinct_texts, text_digest
from newsfold.llm.scratch import Scratch

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
#: Members that are held against one copy of their pivot's text.
PIVOT_SHARE = 256
PIVOT_GROWTH = 4
ABSORBING_ROUNDS = 2
DEVIATIONS = 5
#: Open texts of one shingle that meet the pivots in one task.
SHINGLE_SHARE = 4096
CELLS = 256

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every shingle, for texts with the words ``at[i]`` to ``at[i + 1]``."""
    count = np.diff(at)
    shingles = np.where(count >= SHINGLE_WORDS, count - SHINGLE_WORDS + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), shingles)
    first = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + at[:-1][text]
    return first, text


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and number of occurrences of every distinct shingle of each text."""
    starts, ends, at = words(data, offsets)
    coded = pieces(data, starts, ends).dictionary_encode()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    hashes = known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.uint64)
    first, text = windows(at)
    ends_at = at[1:][text]
    shingle = np.zeros(len(first), dtype=np.uint64)
    for step in range(SHINGLE_WORDS):
        word = first + step
        inside = word < ends_at
        shingle = _mixed(shingle + _GOLDEN)
        shingle[inside] ^= hashes[word[inside]]
    shingle = _mixed(shingle)
    codes, _ = pd.factorize(_mixed(shingle + text.astype(np.uint64) * _GOLDEN))
    size = int(codes.max()) + 1 if len(codes) else 0
    one = np.zeros(size, dtype=np.int64)
    one[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return text[one], shingle[one], np.bincount(codes, minlength=size).astype(np.float64)


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """The shingle that hits each register first, ``texts`` rows of ``registers``; zeros for a text without shingles."""
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, dtype=np.uint64)
    state, time = shingle.copy(), np.zeros(len(shingle))
    while len(text):
        state = _mixed(state + _GOLDEN)
        time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        register = text * registers + (_mixed(state ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, register, time)
        won = first[register] == time
        kept[register[won]] = shingle[won]
        latest = first.reshape(texts, registers).max(axis=1)
        early = time < latest[text]
        text, shingle, weight, state, time = text[early], shingle[early], weight[early], state[early], time[early]
    return kept.reshape(texts, registers)


def band_hashes(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of each row."""
    out = np.broadcast_to(_mixed(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN), (len(kept), bands)).copy()
    for row in range(rows):
        out = _mixed((out + _GOLDEN) ^ kept[:, row::rows])
    return out.view(np.int64)


def banded(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``digest, bands, sketch``: the band hashes of every text with words, and a byte of each register."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, "text"):
            text, shingle, weight = shingles(data, offsets)
            with np.errstate(over="ignore"):
                kept = signatures(text, shingle, weight, part.num_rows, bands * rows)
                found = band_hashes(kept, bands, rows)
            filled = np.unique(text)
            sketch = pa.array([row.tobytes() for row in (kept[filled] & np.uint64(255)).astype(np.uint8)], pa.binary())
            values = pa.array(found[filled].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, bands), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([part.column("digest").take(pa.array(filled)), lists, sketch], ["digest", "bands", "sketch"])

    return texts.select("digest", "text").mapInArrow(sign, "digest binary, bands array<bigint>, sketch binary")


def beside(pairs: DataFrame, table: DataFrame, column: str, hint: str | None = None) -> DataFrame:
    """``digest, pivot`` with ``column`` of the member and, as ``pivot_<column>``, of the pivot.

    Members' values move once, to their pivot; the value of a pivot with many members is dealt over salts. ``hint`` is
    for joins with a table in buckets of the digest, whose rows then stay where they lie.
    """
    hinted = (lambda df: df.hint(hint)) if hint else (lambda df: df)
    table = table.select("digest", column)
    shares = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / PIVOT_SHARE).cast("int").alias("salts"))
    pivots = table.join(hinted(shares.withColumnRenamed("pivot", "digest")), "digest")
    pivots = pivots.select(
        F.col("digest").alias("pivot"), F.col(column).alias(f"pivot_{column}"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    members = pairs.select("digest", "pivot").join(shares, "pivot").withColumn("salt", F.pmod(F.xxhash64("digest"), F.col("salts")).cast("int"))
    members = table.join(hinted(members), "digest")
    return members.join(pivots, ["pivot", "salt"]).select("digest", "pivot", column, f"pivot_{column}")


def promising(pairs: DataFrame, sketches: DataFrame, least: float, registers: int) -> DataFrame:
    """``pairs`` without those whose registers agree so rarely that a similarity of ``least`` is out of the question.

    The bound is ``DEVIATIONS`` standard deviations below ``least``, so a similar pair is lost once in some 250,000.
    """
    bound = registers * least - DEVIATIONS * (registers * least * (1 - least)) ** 0.5

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (flat(batch.column(name))[0].reshape(-1, registers) for name in ("sketch", "pivot_sketch"))
                yield batch.select(["digest", "pivot"]).filter(pa.array((one == two).sum(axis=1) >= bound))

    return beside(pairs, sketches, "sketch").mapInArrow(agree, "digest binary, pivot binary")


def profile(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """A row of bytes for each text: its numbers of distinct shingles and of all, and distinct ones by hash cell, up to 255."""
    sums = np.stack([np.bincount(text, minlength=texts), np.bincount(text, weights=weight, minlength=texts)], axis=1).astype("<i8")
    cells = np.zeros(texts * CELLS, dtype=np.uint8)
    filled, n = np.unique(text * CELLS + (_mixed(shingle) % np.uint64(CELLS)).astype(np.int64), return_counts=True)
    cells[filled] = np.minimum(n, 255)
    return np.concatenate([sums.view(np.uint8).reshape(texts, 16), cells.reshape(texts, CELLS)], axis=1)


def possible(one: np.ndarray, two: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of profiles may belong to texts with a similarity of ``least`` or more; no such pair is missed."""
    (distinct, total), (distinct_two, total_two) = (np.ascontiguousarray(rows[:, :16]).view("<i8").T for rows in (one, two))
    common = np.minimum(one[:, 16:], two[:, 16:])
    most = common.sum(axis=1, dtype=np.int64)
    with np.errstate(divide="ignore"):
        inverse = np.maximum(1, total / (most + total - distinct)) + np.maximum(1, total_two / (most + total_two - distinct_two))
    return (inverse <= 1 + 1 / least + 1e-9) | (common == 255).any(axis=1)


def described(texts: DataFrame) -> DataFrame:
    """``digest, profile, total, spare, shingles, weights`` of every text: its distinct shingles and how often each occurs.

    ``total`` is the sum of the weights, ``spare`` what it has beyond one for each distinct shingle.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, "text"):
            text, shingle, weight = shingles(data, offsets)
            rows = pa.array(list(map(bytes, profile(text, shingle, weight, part.num_rows))), pa.binary())
            ends = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (shingle.view(np.int64), weight.astype(np.int64))]
            total = np.bincount(text, weights=weight, minlength=part.num_rows).astype(np.int64)
            sums = [pa.array(total), pa.array(total - np.bincount(text, minlength=part.num_rows))]
            yield pa.RecordBatch.from_arrays([part.column("digest"), rows, *sums, *lists], names)

    schema = "digest binary, profile binary, total bigint, spare bigint, shingles array<bigint>, weights array<bigint>"
    names = [field.split()[0] for field in schema.split(", ")]
    return texts.select("digest", "text").mapInArrow(describe, schema)


def rare_shingles(about: DataFrame, least: float) -> DataFrame:
    """``digest, shingle, inverse, left, total, spare``: the shingles of each text at which a similar one may first be met.

    They come in order of the number of texts that have them; ``inverse`` is 1 / (1 - the share that comes before) and
    ``left`` the number of shared shingles from this one on. Shingles of one text only lead to nobody and aren't moved
    to be ordered: what is not shared comes first.
    """
    weighted = F.explode(F.arrays_zip("shingles", "weights")).alias("s")
    rows = about.select("digest", "total", "spare", weighted)
    rows = rows.select("digest", "total", "spare", F.col("s.shingles").alias("shingle"), F.col("s.weights").alias("weight"))
    shared = about.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
    of_text = Window.partitionBy("digest")
    ordered = of_text.orderBy("texts", "shingle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("total") - F.sum("weight").over(of_text) + F.sum("weight").over(ordered) - F.col("weight")
    left = F.count("*").over(of_text) - F.count("*").over(ordered) + 1
    rows = rows.join(shared, "shingle").withColumns({"before": before / F.col("total"), "left": left}).where(F.col("before") <= 1 - least + 1e-9)
    return rows.select("digest", "shingle", (1 / (1 - F.col("before"))).alias("inverse"), "left", "total", "spare")


def inverse_share(inverse: str, left: Column, total: str, spare: str) -> Column:
    """The least 1 / (the common share) of a text of whose shingles ``left`` are common at most; each other one weighs 1 or more."""
    return F.greatest(F.col(inverse), F.col(total) / (left + F.col(spare)))


def rare_pairs(scratch: Scratch, labelled: DataFrame, about: DataFrame, least: float) -> DataFrame:
    """``digest, pivot``: all pairs with different labels that may be similar by their rare shingles and profiles.

    At a shingle, the members outside its largest class are pivots; the others are dealt over salts.
    """
    rows = scratch.keep(rare_shingles(about, least).join(labelled, "digest"), "rare")
    sizes = rows.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    most = sizes.groupBy("shingle").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"), F.count("*").alias("labels"))
    salts = F.ceil(F.col("all") / SHINGLE_SHARE).cast("int")
    most = most.where("labels > 1").select("shingle", F.col("most.label").alias("major"), salts.alias("salts"))
    rows = scratch.keep(rows.join(most, "shingle"), "rare-opened")
    members = rows.withColumn("salt", F.pmod(F.xxhash64("digest"), F.col("salts")).cast("int"))
    pivots = rows.where("label != major").select(
        "shingle",
        F.col("digest").alias("pivot"),
        F.col("label").alias("pivot_label"),
        *(F.col(name).alias(f"pivot_{name}") for name in ("inverse", "left", "total", "spare")),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    left = F.least("left", "pivot_left")
    both = inverse_share("inverse", left, "total", "spare") + inverse_share("pivot_inverse", left, "pivot_total", "pivot_spare")
    within = (F.col("label") != F.col("pivot_label")) & (both <= 1 + 1 / least + 1e-9)
    pairs = members.join(pivots, ["shingle", "salt"]).where(within).select("digest", "pivot")
    pairs = pairs.withColumns({"low": F.least("digest", "pivot"), "high": F.greatest("digest", "pivot")}).dropDuplicates(["low", "high"])
    pairs = scratch.keep(pairs.select("digest", "pivot"), "rare-pairs")
    width = CELLS + 16

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (flat(batch.column(name))[0].reshape(-1, width) for name in ("profile", "pivot_profile"))
                yield batch.select(["digest", "pivot"]).filter(pa.array(possible(one, two, least)))

    return scratch.keep(beside(pairs, about, "profile").mapInArrow(check, "digest binary, pivot binary"), "rare-likely")


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The probability Jaccard index of each pair of texts, exactly."""
    pairs = len(left)
    (one, ends_one), (two, ends_two) = flat(left), flat(right)
    data, offsets = np.concatenate([one, two]), np.concatenate([ends_one, ends_two[1:] + ends_one[-1]])
    starts, ends, at = words(data, offsets)
    coded = pieces(data, starts, ends).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    first, text = windows(at)
    keys, size, base = text % pairs, max(1, pairs), len(coded.dictionary) + 1
    for step in range(SHINGLE_WORDS):
        word = np.minimum(first + step, len(code) - 1)
        more = np.where(first + step < at[1:][text], code[word], 0)
        if size * base >= 1 << 62:
            keys, distinct = pd.factorize(keys)
            size = len(distinct)
        keys, size = keys.astype(np.int64) * base + more, size * base
    keys, distinct = pd.factorize(keys)
    pair = np.zeros(len(distinct), dtype=np.int64)
    pair[keys] = text % pairs
    a = np.bincount(keys[text < pairs], minlength=len(distinct)).astype(float)
    b = np.bincount(keys[text >= pairs], minlength=len(distinct)).astype(float)
    with np.errstate(divide="ignore"):
        order = np.lexsort((a / b, pair))
    a, b, pair = a[order], b[order], pair[order]
    bounds = np.searchsorted(pair, np.arange(pairs + 1))
    sum_a, sum_b = np.concatenate([[0], np.cumsum(a)]), np.concatenate([[0], np.cumsum(b)])
    both = np.flatnonzero((a > 0) & (b > 0))
    own = pair[both]
    # Shingles from this one on in the order have the larger a-ratio, those before the larger b-ratio.
    parts = (sum_a[bounds[own + 1]] - sum_a[both]) / a[both] + (sum_b[both] - sum_b[bounds[own]]) / b[both]
    return np.bincount(own, weights=1 / parts, minlength=pairs)


def verified(texts: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The rows of ``pairs`` (``digest, pivot``) whose texts are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            sizes = np.diff(flat(batch.column("text"))[1]) + np.diff(flat(batch.column("pivot_text"))[1])
            while at < batch.num_rows:
                to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 8 << 20, "right")))
                part = batch.slice(at, to - at)
                good = similarities(part.column("text"), part.column("pivot_text")) >= least - 1e-12
                yield part.select(["digest", "pivot"]).filter(pa.array(good))
                at = to

    return beside(pairs, texts, "text", "shuffle_hash").mapInArrow(check, "digest binary, pivot binary")


def merged_labels(scratch: Scratch, labels: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``digest, label`` after the labels joined by ``edges`` (``one, two``) are one; the least label stands for all.

    Each pass every label moves to its least neighbour and edges are drawn between the new labels, until none is left.
    Labels are digests, so their order is random and long chains fall apart in few passes.
    """
    step = 0
    while not edges.isEmpty():
        both = edges.select("one", "two").union(edges.select(F.col("two").alias("one"), F.col("one").alias("two")))
        moves = both.groupBy("one").agg(F.min("two").alias("to")).where("to < one")
        moves = scratch.keep(moves, f"{name}-moves-{step}")
        source, target = moves.select(F.col("one").alias("label"), "to"), moves.select(F.col("one").alias("two"), F.col("to").alias("two_to"))
        labels = labels.join(source, "label", "left").select("digest", F.coalesce("to", "label").alias("label"))
        labels = scratch.keep(labels, f"{name}-labels-{step}")
        edges = edges.join(moves, "one", "left").join(target, "two", "left")
        edges = edges.select(F.coalesce("to", "one").alias("one"), F.coalesce("two_to", "two").alias("two"))
        edges = scratch.keep(edges.where("one != two").distinct(), f"{name}-edges-{step}")
        step += 1
    return labels


def similar_labels(scratch: Scratch, texts: DataFrame, least: float, bands: int, rows: int) -> DataFrame:
    """``digest, label`` of the texts that share a band with another; similar ones have one label."""
    signed = scratch.keep(banded(texts, bands, rows), "bands")
    members = signed.select("digest", F.explode("bands").alias("bucket"))
    # Written, so that the join after it is dealt anew and a frequent bucket can be split over tasks.
    shared = scratch.keep(members.groupBy("bucket").count().where("count > 1").select("bucket"), "shared")
    members = scratch.keep(members.join(shared, "bucket", "left_semi"), "members-0")
    labels = scratch.keep(members.select("digest").distinct().withColumn("label", F.col("digest")), "labels-0")
    checked = None

    def merged(likely: DataFrame, step: int) -> DataFrame:
        good = scratch.keep(verified(texts, likely, least), f"good-{step}")
        one, two = labels.select("digest", F.col("label").alias("one")), labels.select(F.col("digest").alias("pivot"), F.col("label").alias("two"))
        edges = scratch.keep(good.join(one, "digest").join(two, "pivot").select("one", "two").where("one != two").distinct(), f"edges-{step}")
        scratch.drop(f"good-{step}")
        return merged_labels(scratch, labels, edges, f"merge-{step}")

    for step in range(ABSORBING_ROUNDS + 1):
        labelled = scratch.keep(members.join(labels, "digest"), f"labelled-{step}")
        sizes = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"))
        major = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels"))
        major = scratch.keep(major.where("labels > 1").select("bucket", F.col("most.label").alias("major")), f"major-{step}")
        opened = scratch.keep(labelled.join(major, "bucket"), f"opened-{step}")
        scratch.drop(f"labelled-{step}")
        if opened.isEmpty():
            return labels
        if step == ABSORBING_ROUNDS:
            break
        # A few members of the largest class take in what resembles them.
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("digest"))
        pivots = opened.where("label = major").withColumn("rank", rank).where(F.col("rank") <= PIVOT_GROWTH**step)
        pivots = scratch.keep(pivots.select("bucket", F.col("digest").alias("pivot"), F.col("label").alias("pivot_label")), f"pivots-{step}")
        pairs = opened.join(pivots, "bucket").where("label != pivot_label").select("digest", "pivot")
        pairs = pairs.withColumns({"low": F.least("digest", "pivot"), "high": F.greatest("digest", "pivot")}).dropDuplicates(["low", "high"])
        if checked is not None:
            pairs = pairs.join(checked, ["low", "high"], "left_anti")
        pairs = scratch.keep(pairs, f"pairs-{step}")
        labels = merged(scratch.keep(promising(pairs.select("digest", "pivot"), signed, least, bands * rows), f"likely-{step}"), step)
        members = opened.join(pivots.select("bucket", F.col("pivot").alias("digest")), ["bucket", "digest"], "left_anti").select("bucket", "digest")
        done = pairs.select("low", "high")
        checked = done if checked is None else checked.unionByName(done)

    labelled = scratch.keep(opened.select("digest", "label").distinct(), "open")
    about = texts.select("digest", "text").join(labelled.select("digest").hint("shuffle_hash"), "digest")
    about = scratch.keep(described(about), "profiles")
    return merged(rare_pairs(scratch, labelled, about, least), ABSORBING_ROUNDS)


def _by_text(docs: DataFrame, least: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, digest`` of all rows, and for every distinct text its class: ``digest, first.{absent, doc_id, digest}``."""
    scratch = Scratch(docs.sparkSession, "minhash")
    names = docs.select("doc_id", text_digest().alias("digest"))
    with distinct_texts(scratch, docs) as texts:
        labels = similar_labels(scratch, texts, least, bands, rows)
    first = F.min(F.struct(F.isnull("doc_id").alias("absent"), "doc_id", "digest"))
    by_text = names.groupBy("digest").agg(first.alias("own")).join(labels, "digest", "left")
    by_text = by_text.withColumn("label", F.coalesce("label", "digest"))
    of_label = by_text.groupBy("label").agg(F.min("own").alias("first"))
    return names, scratch.keep(by_text.join(of_label, "label").select("digest", "first"), "classes")


def classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id`` of every row: the least doc_id of its class of exact and near copies.

    Classes are the connected components of links between texts with a similarity of ``least`` or more. Null counts as
    empty; texts without words are in a class with equal texts only. A class is named null only if all its doc_ids are.
    Repeated rows are copies. Other columns are ignored.
    """
    names, by_text = _by_text(docs, least, bands, rows)
    return names.join(by_text, "digest").select("doc_id", F.col("first.doc_id").alias("class_id"))


def keep_one_each(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The row of ``docs`` with the least doc_id of each class, with all its columns (whatever their names).

    If several rows have that doc_id and text, one of them stays.
    """
    names = docs.columns
    plain = docs.toDF(*(name if name in ("doc_id", "text") else f"column_{at}" for at, name in enumerate(names)))
    _, by_text = _by_text(plain, least, bands, rows)
    kept = by_text.select(F.col("first.doc_id").alias("of_doc"), F.col("first.digest").alias("of_digest")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest"))
    rows_left = plain.withColumn("digest", text_digest()).join(kept, same, "left_semi").dropDuplicates(["doc_id", "digest"])
    return rows_left.select(*plain.columns).toDF(*names)
