"""Quality rules whose limits come from the corpus: mergeable quantile sketches for each language and source.

A sketch is the number of values in each bucket of a logarithmic scale, so merging is adding whole numbers: the order of
tasks and merges changes nothing, and a quantile is off by a share of ``RELATIVE_ERROR`` at most.

Each measure of a document is held against a fence around the quartiles of its own (language, source): ``WIDTH`` times
the quartile range beyond the quartile, and a tolerance for the grain of a ratio of small counts. Junk in up to a
quarter of a group doesn't move its quartiles. Shares that are zero in most documents, and that the base rules bound,
have their fence at the ``TAIL`` quantile at least. Quantiles of a group of n documents count by n / (n + ``PRIOR_ROWS``), and
those of its language, which are blended alike with those of all documents, for the rest; so limits move smoothly as
a group grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfold.llm.blocks import SPACE, blocks, pieces, words
from newsfold.llm.scratch import Scratch

WINDOW_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WIDTH = 3.0
TAIL = 0.95
#: A group's quantiles weigh as much as its language's at so many documents.
PRIOR_ROWS = 20
RELATIVE_ERROR = 0.005
#: Fences of at most so many groups (about 100 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 50_000

_GROWTH = (1 + RELATIVE_ERROR) / (1 - RELATIVE_ERROR)
_ZERO = -(1 << 30)
RANKS = {"q1": 0.25, "q3": 0.75, "tail": TAIL}

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Measure:
    """A ratio of two counts; ``low`` and ``high`` say which sides have a fence, ``tolerance`` is added to its distance."""

    name: str
    above: str
    below: str
    low: bool
    high: bool
    tolerance: float
    tail: bool = False

    def column(self) -> Column:
        return F.col(self.above) / F.greatest(F.col(self.below), F.lit(1))


MEASURES = [
    Measure("word_length", "word_chars", "n_words", True, True, 0.25),
    Measure("symbol_rate", "n_symbols", "n_words", False, True, 0.02),
    Measure("dup_line_share", "n_dup_lines", "n_lines", False, True, 0.05, tail=True),
    Measure("repeat_share", "n_repeat_words", "n_words", False, True, 0.02, tail=True),
]


def _joined(keys: np.ndarray, size: int, more: np.ndarray, base: int) -> tuple[np.ndarray, int]:
    """Whole numbers that are equal where both parts are, and what they are below."""
    if size * base >= 1 << 62:
        keys, distinct = pd.factorize(keys)
        size = len(distinct)
    return keys.astype(np.int64) * base + more, size * base


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every text of a block."""
    texts = len(offsets) - 1
    starts, ends, at = words(data, offsets)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    out = {"n_words": np.diff(at), "word_chars": per_text(~SPACE[data] & ((data & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOL[data])}

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]))
    filled = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    text_of_line = np.searchsorted(offsets, line_starts, "right") - 1
    coded = pieces(data, line_starts, line_ends).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    again = pd.Series(text_of_line * (len(coded) + 1) + coded).duplicated().to_numpy()
    out["n_lines"] = np.bincount(text_of_line, minlength=texts)
    out["n_dup_lines"] = np.bincount(text_of_line[again], minlength=texts)

    text_of_word = np.repeat(np.arange(texts), out["n_words"])
    spoken = pieces(data, starts, ends).dictionary_encode()
    code, base = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(spoken.dictionary))
    first = np.arange(max(0, len(code) - WINDOW_WORDS + 1))
    first = first[text_of_word[first] == text_of_word[first + WINDOW_WORDS - 1]]
    keys, size = text_of_word[first].astype(np.int64), max(1, texts)
    for step in range(WINDOW_WORDS):
        keys, size = _joined(keys, size, code[first + step], base)
    twice = first[pd.Series(keys).duplicated(keep=False).to_numpy()]
    cover = np.zeros(len(code) + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW_WORDS, -1)
    out["n_repeat_words"] = np.bincount(text_of_word[np.cumsum(cover[:-1]) > 0], minlength=texts)
    return {name: out[name].astype(np.int64) for name in COUNTS}


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the counts of ``text`` (null: no words) of every row; one narrow stage."""
    schema = ", ".join([*(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep), *(f"{name} bigint" for name in COUNTS)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            found = counts(data, offsets)
            yield pa.RecordBatch.from_arrays([*map(rows.column, keep), *map(pa.array, found.values())], [*keep, *found])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(measure, schema)


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


def sketched(fit: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: a sketch of each measure (by its place in ``MEASURES``) for each group.

    Values are counted map-side, so a group with a third of all rows costs no more than another.
    """

    def bucket(value: Column) -> Column:
        return F.when(value > 0, F.ceil(F.log(value) / F.log(F.lit(_GROWTH)))).otherwise(_ZERO).cast("int")

    found = F.explode(F.array(*(F.struct(F.lit(at).alias("measure"), bucket(m.column()).alias("bucket")) for at, m in enumerate(MEASURES))))
    rows = fit.select("lang", "source", found.alias("found")).select("lang", "source", "found.*")
    return rows.groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """``keys``, the number of documents ``<prefix>n`` and ``<prefix><measure>_<rank>`` for each of ``RANKS``, of merged sketches."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    value = F.when(F.col("bucket") == _ZERO, 0.0).otherwise(2 * F.pow(F.lit(_GROWTH), "bucket") / (1 + _GROWTH))
    merged = merged.withColumns({"total": F.sum("n").over(group), "upto": upto, "value": value})
    out = [F.max("total").alias(prefix + "n")]
    for at, measure in enumerate(MEASURES):
        for name, rank in RANKS.items():
            reached = (F.col("measure") == at) & (F.col("upto") >= F.ceil(rank * F.col("total")))
            out.append(F.min(F.when(reached, F.col("value"))).alias(f"{prefix}{measure.name}_{name}"))
    return merged.groupBy(*keys).agg(*out)


def _blended(name: str, rank: str) -> Column:
    """A quantile of all documents, of the language and of the group, each taking its share from the one before."""
    out = None
    for prefix in ("a_", "l_", "g_"):
        own, n = F.col(f"{prefix}{name}_{rank}"), F.col(prefix + "n")
        out = own if out is None else (n * own + PRIOR_ROWS * out) / (n + PRIOR_ROWS)
    return out


def fences(counted: DataFrame) -> DataFrame:
    """``lang, source`` and, for each measure, ``<name>_low`` and ``<name>_high`` (null: no limit).

    Nothing but sketches is shuffled. Documents that fail the base rules don't count.
    """
    sketches = Scratch(counted.sparkSession, "quality").keep(sketched(counted.where(~base_failed())), "sketches")
    own = quantiles(sketches, ["lang", "source"], "g_")
    lang = quantiles(sketches, ["lang"], "l_").withColumnRenamed("lang", "of_lang")
    overall = quantiles(sketches, [], "a_")  # one row
    rows = own.join(lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left").join(F.broadcast(overall), how="left")

    out = [F.col("lang"), F.col("source")]
    for measure in MEASURES:
        low, high = (_blended(measure.name, rank) for rank in ("q1", "q3"))
        reach = WIDTH * (high - low) + measure.tolerance
        most = F.greatest(high + reach, _blended(measure.name, "tail") + measure.tolerance) if measure.tail else high + reach
        out.append((low - reach if measure.low else F.lit(None).cast("double")).alias(measure.name + "_low"))
        out.append((most if measure.high else F.lit(None).cast("double")).alias(measure.name + "_high"))
    return rows.select(*out)


def judged(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept``. A group without limits (all its documents fail the base rules) has no fence."""
    limits = limits.withColumnRenamed("lang", "of_lang").withColumnRenamed("source", "of_source")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    rows = counted.withColumn("base_failed", base_failed()).join(limits, same, "left")
    within = F.lit(True)
    for measure in MEASURES:
        low, high = (F.col(f"{measure.name}_{side}") for side in ("low", "high"))
        within = within & F.coalesce(measure.column() >= low, F.lit(True)) & F.coalesce(measure.column() <= high, F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & within).drop("of_lang", "of_source", *(c for c in limits.columns if c not in ("of_lang", "of_source")))


def _joinable(limits: DataFrame) -> DataFrame:
    return F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS else limits


def assess(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every row: ``doc_id, lang, source``, the counts, ``base_failed, kept``.

    Null and empty texts have no words and fail the base rules. Null languages and sources are groups of their own.
    Repeated rows are judged each. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    counted = scratch.keep(with_counts(docs, ["doc_id", "lang", "source"]), "counts")
    return judged(counted, _joinable(scratch.keep(fences(counted), "fences")))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns (whatever their names).

    The texts are read twice, for the sketches and for the filter, and not shuffled (with up to ``BROADCAST_GROUPS``
    groups).
    """
    scratch = Scratch(docs.sparkSession, "quality")
    limits = scratch.keep(fences(with_counts(docs, ["lang", "source"])), "fences")
    names = docs.columns
    plain = docs.toDF(*(name if name in ("text", "lang", "source") else f"column_{at}" for at, name in enumerate(names)))
    kept = judged(with_counts(plain, plain.columns), _joinable(limits)).where("kept")
    return kept.select(*plain.columns).toDF(*names)
