"""Toxicity by compression: windows of a text under a dictionary of toxic and one of ordinary text.

Both zstandard dictionaries are learned from labelled texts. The toxic one holds the beginnings of words that mark toxic
texts, by the likelihood ratio of how many texts of either label hold them. The ordinary one holds the words of ordinary
texts that resemble those, which a match with a part of a toxic word would take for toxic ones. A window that the toxic dictionary
makes shorter than the ordinary one speaks for toxic text; how many bytes shorter, and how often, is turned into a
probability that is calibrated on other labelled texts than those the dictionaries come from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfold.llm.blocks import blocks, gather
from newsfold.llm.scratch import Scratch

#: About how many labelled rows of each label are learned from; more are thinned by a hash of their id.
SAMPLE_ROWS = 8_000
#: Beginnings of words in the toxic dictionary, their least likelihood ratio statistic and least share of toxic texts;
#: words in the ordinary one.
TOXIC_STARTS, LEAST_RATIO, LEAST_SHARE, ORDINARY_WORDS = 96, 30.0, 0.01, 32
#: Candidates that the toxic beginnings are picked from.
CANDIDATES = 4096
#: Characters of a beginning, with the space before it, and bytes of a word that counts.
SHORTEST, LONGEST, LONGEST_WORD = 5, 12, 40
#: Characters that make an ordinary word resemble a toxic beginning, and the shortest match of the compressor in bytes.
PART = 5
#: Bytes after which a window ends with the word; literals of up to 63 bytes are stored as they are, so that only
#: matches change the length of a window of ordinary words.
WINDOW = 40
#: Lead of every window and end of both dictionaries: one match that all windows share.
LEAD = bytes(range(1, 9)) + bytes(range(14, 18))
#: End of every window: the compressor looks for no match in the last bytes, so these are no part of the text.
TAIL = bytes(range(18, 26))
#: Bytes saved from which a window counts, one share each.
STEPS = (1, 2, 3, 4, 5, 6, 8, 10)
#: Probability from which a text is called toxic.
CUT = 0.3

SCORED = "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT, n_windows BIGINT, n_toxic_windows BIGINT"

#: ASCII as it is compressed: letters in lower case, digits; all else is a space. Bytes of other letters stay.
_CLASS = np.full(256, 0x20, dtype=np.uint8)
_CLASS[0x80:] = np.arange(0x80, 0x100)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A)):
    _CLASS[_first : _last + 1] = np.arange(_first, _last + 1)


def held_out() -> Column:
    """Whether a row's label is never learned; a null id isn't held out, and has no label."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Both dictionaries, and weights of the calibrated probability; without weights every score is ``prior``."""

    toxic: bytes = LEAD
    ordinary: bytes = LEAD
    weights: tuple[float, ...] = ()
    prior: float = 0.0

    def probability(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.prior)
        return np.round(1 / (1 + np.exp(-np.clip(features @ np.array(self.weights), -30, 30))), 9)


def dictionary(entries: list[str]) -> bytes:
    """Content of a dictionary: the first entries nearest to its end, then the lead."""
    return "".join(reversed(entries)).encode() + b" " + LEAD


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_FAST,
        window_log=14,
        hash_log=12,
        chain_log=6,
        search_log=1,
        min_match=PART,
        target_length=0,
        write_checksum=0,
        write_content_size=0,
        write_dict_id=0,
    )
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def normal_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of lower-case texts with one space around each: a text begins and ends with one. Bytes and row offsets."""
    sizes = np.diff(offsets)
    spaced = np.full(len(data) + 2 * len(sizes), 0x20, dtype=np.uint8)
    starts = offsets[:-1] + 2 * np.arange(len(sizes))
    at = np.arange(len(data)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
    spaced[at] = _CLASS[data]
    space = spaced == 0x20
    again = space.copy()
    again[1:] &= space[:-1]
    again[:1] = False
    again[starts] = False
    kept = np.concatenate([[0], np.cumsum(~again)])
    return spaced[~again], kept[np.append(starts, len(spaced))]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the windows of normal texts, each from a space to a space, and each row's offsets into them.

    A window ends at the first space ``WINDOW`` bytes or more after a multiple of that from the row's start.
    """
    sizes = np.diff(offsets)
    steps = np.maximum(1, -(-(sizes - 1) // WINDOW))
    row = np.repeat(np.arange(len(sizes)), steps)
    step = np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps)
    spaces = np.flatnonzero(data == 0x20)
    last = offsets[row + 1] - 1
    begin = spaces[np.searchsorted(spaces, np.minimum(offsets[row] + step * WINDOW, last))]
    fresh = begin < last
    fresh[1:] &= (begin[1:] != begin[:-1]) | (row[1:] != row[:-1])
    begin, row, last = begin[fresh], row[fresh], last[fresh]
    end = np.append(begin[1:], 0)
    ends_row = np.append(row[1:] != row[:-1], True)[: len(row)]
    end = np.where(ends_row, last, end[: len(row)])
    return begin, end + 1 - begin, np.searchsorted(row, np.arange(len(sizes) + 1))


def lengths(packer: zstandard.ZstdCompressor, data: np.ndarray, places: np.ndarray) -> np.ndarray:
    packed = packer.multi_compress_to_buffer(zstandard.BufferWithSegments(data.tobytes(), places.tobytes()))
    return np.fromiter(map(len, packed), dtype=np.int64, count=len(packed))


def saved(packers: tuple, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """By how many bytes the toxic dictionary makes each window shorter than the ordinary one does."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    ends = np.frombuffer(LEAD + TAIL, dtype=np.uint8)
    width = len(ends)
    pieces = np.empty((len(starts), 3), dtype=np.int64)
    pieces[:, 0], pieces[:, 1], pieces[:, 2] = 0, starts + width, len(LEAD)
    long = np.empty_like(pieces)
    long[:, 0], long[:, 1], long[:, 2] = len(LEAD), sizes, len(TAIL)
    out = gather(np.concatenate([ends, data]), pieces.ravel(), long.ravel())
    whole = sizes + width
    places = np.stack([np.cumsum(whole) - whole, whole], axis=1).astype(np.uint64)
    toxic, ordinary = packers
    return lengths(ordinary, out, places) - lengths(toxic, out, places)


def features(gains: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: a constant, the number of windows, what the best one saves, and for each step how many windows and what share save as much."""
    counts = np.diff(offsets)
    filled = np.flatnonzero(counts)
    most = np.zeros(len(counts))
    if len(filled):
        most[filled] = np.maximum.reduceat(gains, offsets[filled])
    columns = [np.ones(len(counts)), np.log1p(counts), np.clip(most, 0, STEPS[-1])]
    for step in STEPS:
        passed = np.concatenate([[0], np.cumsum(gains >= step)])
        many = passed[offsets[1:]] - passed[offsets[:-1]]
        columns += [np.log1p(many), np.log((many + 0.1) / (counts + 30))]
    return np.stack(columns, axis=1)


def _measured(rows: pa.RecordBatch, packers: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, number of windows and number of those that save bytes, of the texts of a block."""
    text = rows.column("text")
    lower = pc.utf8_lower(pc.fill_null(text, ""))
    data = np.frombuffer(lower.buffers()[2] or b"", dtype=np.uint8)
    wide = pa.types.is_large_string(lower.type)
    at = np.frombuffer(lower.buffers()[1], dtype=np.int64 if wide else np.int32)[lower.offset : lower.offset + len(lower) + 1].astype(np.int64)
    normal, offsets = normal_bytes(data[at[0] : at[-1]], at - at[0])
    starts, sizes, ends = windows(normal, offsets)
    gains = saved(packers, normal, starts, sizes)
    speaking = np.concatenate([[0], np.cumsum(gains > 0)])
    return features(gains, ends), np.diff(ends), speaking[ends[1:]] - speaking[ends[:-1]]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_windows, n_toxic_windows`` of every row, from its text alone.

    A null or empty text has no windows, and the score that the model gives to such a text. Repeated rows are scored
    each; other columns are ignored. One narrow stage.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = compressor(model.toxic), compressor(model.ordinary)
        for rows, _, _ in blocks(batches, "text"):
            found, many, speaking = _measured(rows, packers)
            probability = model.probability(found)
            columns = [rows.column("doc_id"), rows.column("held_out"), *map(pa.array, (probability, (probability >= CUT).astype(np.int32), many, speaking))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "n_windows", "n_toxic_windows"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out().alias("held_out"))
    return rows.mapInArrow(judge, SCORED)


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """``toxic, share, calibrates, text`` of labelled rows that aren't held out, about ``most`` of each label.

    Rows are thinned by a hash of their id, ``share`` is the part that is left, and ``calibrates`` tells the third of
    them that calibrates from the others, which make dictionaries. Labels that are null or belong to no id are none; of several labels of
    one id the toxic one counts.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(~held_out() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    share = F.lit(1.0)
    for label, count in counts.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1.0, most / count))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(1 << 20)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0
    chosen = known.withColumns({"share": share, "calibrates": calibrates}).where(place < F.col("share"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # At most some 2 * ``most`` narrow rows, so no text is shuffled.
    return texts.join(F.broadcast(chosen), "doc_id").select("toxic", "share", "calibrates", F.coalesce("text", F.lit("")).alias("text"))


def _starts(word: Column) -> Column:
    """Beginnings of a word with the space before it, and the word with a space at both ends."""
    spaced = F.concat(F.lit(" "), word, F.lit(" "))
    sizes = F.sequence(F.least(F.lit(SHORTEST), F.length(spaced)), F.least(F.lit(LONGEST), F.length(spaced)))
    return F.transform(sizes, lambda size: F.substring(spaced, F.lit(1), size))


def _parts(word: Column) -> Column:
    """Runs of ``PART`` characters of a word with a space at each end."""
    spaced = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(spaced) - (PART - 1))), lambda at: F.substring(spaced, at, F.lit(PART)))


def _unnested(units: list[str]) -> list[str]:
    """Units in order, without those that begin another one taken before or that begin with one."""
    taken: list[str] = []
    for unit in units:
        if not any(unit.startswith(other) or other.startswith(unit) for other in taken):
            taken.append(unit)
    return taken


def dictionary_words(texts: DataFrame) -> tuple[list[str], list[str]]:
    """Entries of the toxic and of the ordinary dictionary, each from a space on, at most so many as the parameters say.

    ``texts`` has ``toxic, text``. Beginnings are counted once per text, and once for all texts whose five-word
    shingles have the same least hash, so that a text with many near copies counts about once. Of equal ratios the longer one is
    taken, and none that begins another one taken.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda word: F.octet_length(word).between(1, LONGEST_WORD))
    shingles = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - 4))
    least = F.array_min(F.transform(shingles, lambda at: F.xxhash64(F.slice("words", at, 5))))
    listed = texts.select("toxic", words.alias("words")).withColumn("least", least)
    listed = listed.groupBy("least").agg(F.max_by(F.struct("toxic", F.array_distinct("words").alias("words")), F.struct("toxic", F.size("words"))).alias("one")).select("one.*")
    n_toxic, n_ordinary = listed.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not n_toxic or not n_ordinary:
        return [], []

    def counted(units: Column) -> DataFrame:
        each = listed.select("toxic", F.explode(units).alias("unit"))
        return each.groupBy("unit").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") != 1).alias("b"))

    def likelihood(hits: Column, all_rows: int, rate: Column) -> Column:
        rest = F.lit(all_rows) - hits
        return F.when(hits > 0, hits * F.log(rate)).otherwise(0.0) + F.when(rest > 0, rest * F.log(1 - rate)).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    pooled = (a + b) / F.lit(n_toxic + n_ordinary)
    apart = likelihood(a, n_toxic, a / F.lit(n_toxic)) + likelihood(b, n_ordinary, b / F.lit(n_ordinary))
    ratio = 2 * (apart - likelihood(a, n_toxic, pooled) - likelihood(b, n_ordinary, pooled))
    starts = counted(F.array_distinct(F.flatten(F.transform("words", _starts))))
    marked = starts.where((a >= F.lit(max(3.0, LEAST_SHARE * n_toxic))) & (a / F.lit(n_toxic) > b / F.lit(n_ordinary))).select("unit", F.round(ratio, 6).alias("ratio"))
    found = marked.where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), F.desc(F.length("unit")), "unit").limit(CANDIDATES).collect()
    toxic = _unnested([row.unit for row in found])[:TOXIC_STARTS]
    if not toxic:
        return [], []
    parts = sorted({unit[at : at + PART] for unit in toxic for at in range(len(unit) + 1 - PART)})
    held = F.exists(F.array(*map(F.lit, toxic)), lambda unit: F.concat(F.lit(" "), F.col("unit"), F.lit(" ")).startswith(unit))
    alike = counted(F.col("words")).where((b > 0) & F.arrays_overlap(_parts(F.col("unit")), F.array(*map(F.lit, parts)))).where(~held)
    return toxic, [f" {row.unit}" for row in alike.orderBy(F.desc("b"), "unit").limit(ORDINARY_WORDS).collect()]


def calibrated(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray, penalty: float = 0.03) -> tuple[float, ...]:
    """Weights of a logistic model by Newton's method, with a small penalty that keeps them finite."""
    weights = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (weight * (p - toxic)) + penalty * weights
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + penalty * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(weights.tolist())


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Model:
    """A model from the labels of rows that aren't held out.

    Two thirds of a bounded sample make the dictionaries, one third calibrates; the driver gets the words of the
    dictionaries, and a short row of numbers per calibrating text. Without rows of both labels the score is the share
    of toxic rows among those there are.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    texts = scratch.keep(sample(docs, labels, most), "sample")
    toxic, ordinary = dictionary_words(texts.where("NOT calibrates"))
    first = Model(dictionary(toxic), dictionary(ordinary))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = compressor(first.toxic), compressor(first.ordinary)
        for rows, _, _ in blocks(batches, "text"):
            found, _, _ = _measured(rows, packers)
            measured = pa.array(found.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column("toxic"), rows.column("share"), measured], ["toxic", "share", "features"])

    rows = texts.where("calibrates").select("toxic", "share", "text").mapInArrow(measure, "toxic INT, share DOUBLE, features ARRAY<DOUBLE>")
    rows = sorted(rows.collect())
    scratch.drop("sample")
    label = np.array([row.toxic == 1 for row in rows], dtype=np.float64)
    if not toxic or not 0 < label.sum() < len(label):
        return Model(first.toxic, first.ordinary, (), float(label.mean()) if len(label) else 0.0)
    weight = np.array([1 / row.share for row in rows])
    return Model(first.toxic, first.ordinary, calibrated(np.array([row.features for row in rows]), label, weight / weight.mean()))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`score` of all ``docs`` by a model fitted on ``labels``."""
    return score(docs, fit(docs, labels))
