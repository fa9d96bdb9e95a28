"""Keyword search over a positional inverted index.

The index holds one row per word and mention: where the word stands in ``search_text``, and the columns that filters,
counts and the order of the listing need. A search reads the rows of its own words only, gathers them by mention and
decides there which terms hold; phrases are adjacent positions. No text is read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.operators.filters import Filters
from newsfold.operators.keywords import Term, read_keywords

#: Columns of a mention that the index carries, for filters, counts and order.
CARRIED = ("id", "source_slug", "published_at")
#: Bytes of text whose postings make one file: few enough for one task to sort their rows in memory.
FILE_BYTES = 32 << 20


@dataclass(frozen=True)
class Layout:
    """Words are dealt to ``buckets`` folders by hash, and each folder to ``parts`` files by mention.

    Both grow with the square root of the text, without a cap: a word that every mention holds is spread over
    ``parts`` files, and a search for one word opens one folder.
    """

    buckets: int = 1
    parts: int = 1

    @classmethod
    def of_bytes(cls, text_bytes: int, least_files: int = 1) -> Layout:
        files = max(1, -(-text_bytes // FILE_BYTES))
        buckets = max(1, round(files**0.5))
        return cls(buckets, -(-max(files, least_files) // buckets))

    def bucket(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self.buckets)).cast("int")


def occurrences(mentions: DataFrame, *more: str) -> DataFrame:
    """``token, pos`` of every word of every mention, with the carried columns and ``more``."""
    words = F.split(F.trim("search_text"), " ")
    return mentions.select(*CARRIED, *more, F.posexplode(words).alias("pos", "token")).where("token <> ''")


def gathered(each: DataFrame, *more: str) -> DataFrame:
    """One row per word and mention, with its ``positions`` in order."""
    return each.groupBy("token", *CARRIED, *more).agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def _dealt(mentions: DataFrame, layout: Layout, *more: str) -> DataFrame:
    """One row per mention and bucket that has words of it: ``bucket``, ``words`` with one space between, and their ``at``.

    So the words of a mention move together, a few bytes each, instead of one row per word. Equal words are neighbours, in the
    order of their places.
    """
    words = F.split(F.trim("search_text"), " ")
    keyed = F.transform(words, lambda word, at: F.struct(layout.bucket(word).alias("bucket"), word.alias("word"), at.alias("at")))
    rows = mentions.select(*CARRIED, *more, F.sort_array(keyed).alias("keyed")).withColumn("buckets", F.col("keyed.bucket"))
    # Words lie in order of their bucket; each bucket's words begin where it first occurs.
    firsts = F.transform(F.array_distinct("buckets"), lambda bucket: F.array_position("buckets", bucket).cast("int"))
    rows = rows.withColumn("firsts", firsts).withColumn("ends", F.array_append(F.slice("firsts", 2, F.size("firsts")), F.size("buckets") + 1))
    runs = F.arrays_zip(F.array_distinct("buckets").alias("bucket"), F.col("firsts").alias("first"), F.col("ends").alias("end"))
    rows = rows.select(*CARRIED, *more, "keyed", F.explode(runs).alias("run"))
    own = F.slice("keyed", F.col("run.first"), F.col("run.end") - F.col("run.first"))
    return rows.select(*CARRIED, *more, F.col("run.bucket").alias("bucket"), own.alias("own")).select(
        *CARRIED, *more, "bucket", F.array_join("own.word", " ").alias("words"), F.col("own.at").alias("at")
    )


def _own_words(moved: DataFrame, *kept: str) -> DataFrame:
    """One row per word of each row of :func:`_dealt`, with its ``positions``; equal words are neighbours, so nothing is grouped."""
    rows = moved.select(*kept, F.split("words", " ").alias("word"), "at")
    new = F.filter(F.transform("word", lambda _, nth: nth), lambda nth: (nth == 0) | (F.get("word", nth) != F.get("word", nth - 1)))
    rows = rows.withColumn("firsts", new)
    rows = rows.withColumn("ends", F.array_append(F.slice("firsts", 2, F.size("firsts")), F.size("word")))
    runs = F.arrays_zip(F.col("firsts").alias("first"), F.col("ends").alias("end"))
    rows = rows.select(*kept, "word", "at", F.explode(runs).alias("run"))
    positions = F.slice("at", F.col("run.first") + 1, F.col("run.end") - F.col("run.first"))
    return rows.select(*kept, F.get("word", F.col("run.first")).alias("token"), positions.alias("positions")).where("token <> ''")


def text_bytes(texts: DataFrame, column: str = "search_text") -> int:
    return texts.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def write_postings(mentions: DataFrame, path: str, *more: str, size: int | None = None) -> Layout:
    """Store the postings of ``mentions`` below ``path``; returns how they are laid out.

    One shuffle, by bucket of the word and part of the mention; words become rows where they arrive. Only if rows of ``mentions``
    share all carried columns are their places put together.
    ``size`` says how many bytes of text there are about, where that is known without computing ``mentions`` once more.
    """
    layout = Layout.of_bytes(text_bytes(mentions) if size is None else size, int(mentions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = F.pmod(F.xxhash64("id"), F.lit(layout.parts)).cast("int")
    # A task for each bucket and part, so that no two of them fall into one by hash.
    moved = _dealt(mentions, layout, *more).withColumn("part", part)
    moved = moved.repartitionById(layout.buckets * layout.parts, F.col("bucket") * layout.parts + F.col("part"))
    rows = _own_words(moved, "bucket", "part", *CARRIED, *more)
    keys = [*CARRIED, *more]
    if not mentions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        rows = rows.groupBy("token", *keys, "bucket", "part").agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
    rows.drop("part").sortWithinPartitions("bucket", "token", "id").write.partitionBy("bucket").option("compression", "zstd").parquet(path)
    return layout


def read_postings(spark: SparkSession, path: str, *more: str) -> DataFrame:
    """What :func:`write_postings` stored; ``more`` are whole numbers."""
    kept = "".join(f", {name} INT" for name in more)
    schema = f"token STRING, id BIGINT, source_slug STRING, published_at TIMESTAMP{kept}, positions ARRAY<INT>, bucket INT"
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Segment:
    """Postings of some mentions; with a layout only the folders of the words asked for are opened."""

    rows: DataFrame
    layout: Layout | None = None

    def of(self, words: list[str]) -> DataFrame:
        found = self.rows.where(F.col("token").isin(words))
        if self.layout is not None:
            found = found.where(F.col("bucket").isin([self.layout.bucket(F.lit(word)) for word in words]))
        return found.select("token", *CARRIED, "positions")


@dataclass(frozen=True)
class KeywordIndex:
    """The postings of some mentions, and these mentions for searches that only exclude words.

    Each mention is in one segment.
    """

    segments: list[Segment]
    mentions: DataFrame

    def matches(self, filters: Filters) -> DataFrame:
        """``id, source_slug, published_at`` of the mentions that fit all ``filters``.

        Outlet and dates reach the scan of the postings. One word alone needs no shuffle; of several, the rows of a
        mention meet under its id, one per word at most. Positions are read for words of phrases only.
        """
        plain = replace(filters, q=None)
        if filters.q is None:
            return plain.apply(self.mentions.select(*CARRIED))
        groups = read_keywords(filters.q)
        terms = [term for group in groups for term in group]
        words = sorted({word for term in terms for word in term.words})
        if not words:
            return self.mentions.select(*CARRIED).where(F.lit(False))
        found = plain.apply(reduce(DataFrame.unionByName, [segment.of(words) for segment in self.segments]))
        if len(words) == 1 and not any(term.negated or len(term.words) > 1 for term in terms):
            return found.select(*CARRIED)
        adjacent = {word for term in terms if len(term.words) > 1 for word in term.words}
        places = {word: f"at_{number}" for number, word in enumerate(words)}

        def place(word: str) -> Column:
            here = F.col("token") == word
            return F.first(F.when(here, F.col("positions")), ignorenulls=True) if word in adjacent else F.max(F.when(here, F.lit(1)))

        by_mention = found.groupBy(*CARRIED).agg(*(place(word).alias(name) for word, name in places.items()))
        holds = _holds(groups, {word: F.col(name) for word, name in places.items()})
        if all(any(not term.negated for term in group) for group in groups):
            return by_mention.where(holds).select(*CARRIED)
        # A group of nothing but exclusions holds for mentions without any of the words, too.
        everyone = plain.apply(self.mentions.select(*CARRIED))
        return everyone.join(by_mention.select("id", *places.values()), "id", "left").where(holds).select(*CARRIED)


def _moved(place: Column, by: int) -> Column:
    return F.transform(place, lambda at: at - by)


def _stands(term: Term, places: dict[str, Column]) -> Column:
    """Whether a term stands in a mention; a null place means that the word does not."""
    first, *rest = (places[word] for word in term.words)
    if not rest:
        return first.isNotNull()
    starts = reduce(F.array_intersect, [_moved(place, by) for by, place in enumerate(rest, 1)], first)
    return F.coalesce(F.size(starts) > 0, F.lit(False))


def _holds(groups: list[list[Term]], places: dict[str, Column]) -> Column:
    def one(term: Term) -> Column:
        return ~_stands(term, places) if term.negated else _stands(term, places)

    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, map(one, group)) for group in groups])
