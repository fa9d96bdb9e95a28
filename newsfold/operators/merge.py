"""Duplicate fold, upsert and sources dimension.

Every merge rule is associative over arrival order, so one fold serves three uses: records of
a batch, partial rows of several batches, and stored rows together with newer partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfold.functions.keys import words_only
from newsfold.schemas import MENTIONS, STORED_MENTIONS

# Kept from the earliest row that has a value.
FIRST_NON_NULL = ("external_id", "url", "canonical_url", "title", "author")


def as_rows(normalized: DataFrame, batch_time: Column) -> DataFrame:
    """Each normalised record as a mention row seen once."""
    return normalized.select(
        F.col("arrival_seq").cast("bigint").alias("id"),
        *[name for name in MENTIONS.names[1:13]],
        F.lit(1).cast("bigint").alias("times_seen"),
        batch_time.alias("first_seen_at"),
        batch_time.alias("updated_at"),
    )


#: Short texts of a folded row that may come from other rows than its content.
SHORT = ("source_slug", *FIRST_NON_NULL, "published_at_raw")
#: Above every id; a rank is a whole number that orders by a first value, then by id.
_IDS = "10000000000000000000BD"
_LAST_ID = "9223372036854775807BD"


def _ranked(first: Column, second: Column) -> Column:
    return (first.cast("decimal(19,0)") * F.expr(_IDS) + second.cast("decimal(20,0)")).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    return F.pmod(rank, F.expr(_IDS)).cast("bigint")


def winners(rows: DataFrame) -> DataFrame:
    """What numbers and dates say about each ``dedupe_key``: its merged counts and dates, and which rows its texts come from.

    Every value has a fixed width, so this is a hash aggregate, map-side first: a key with a large share of all rows is one
    partial row per task. ``of_<column>`` is the id of the row that gives a column; ``deliveries`` counts rows.
    """
    seq, moment = F.col("id"), F.unix_micros("published_at")
    last = F.expr(_LAST_ID)
    fullness = _ranked(F.coalesce(F.length("content_clean"), F.lit(-1)) + 1, last - seq.cast("decimal(19,0)"))
    firsts = [F.min(F.when(F.col(name).isNotNull(), seq)).alias(f"of_{name}") for name in (*FIRST_NON_NULL, "published_at_raw")]
    grouped = rows.groupBy("dedupe_key").agg(
        F.min(seq).alias("id"),
        *firsts,
        F.max(fullness).alias("fullness"),
        F.min(F.when(moment.isNotNull(), _ranked(moment, seq))).alias("earliness"),
        F.min("published_at").alias("published_at"),
        F.max("engagement").alias("engagement"),
        F.sum("times_seen").alias("times_seen"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("updated_at").alias("updated_at"),
        F.count(F.lit(1)).alias("deliveries"),
    )
    return grouped.withColumns(
        {"of_content": (last - _id_of(F.col("fullness")).cast("decimal(19,0)")).cast("bigint"), "of_earliest": _id_of(F.col("earliness"))}
    ).drop("fullness", "earliness")


def fold_rows(rows: DataFrame) -> DataFrame:
    """One row per ``dedupe_key``; a lower ``id`` is the older row, and an id names one row.

    Numbers and dates are folded first and say which rows the texts of a key come from. Keys with a single row, mostly nearly
    all, pass through a join with the keys that have several; of those only the rows that give something are looked at,
    and content is taken from one of them. No content is sorted or aggregated. ``rows`` is read three times, the second
    time without content, so it should be stored rather than computed.
    """
    merged = winners(rows).where("deliveries > 1").drop("deliveries")
    roles = ["id", *(f"of_{name}" for name in (*FIRST_NON_NULL, "published_at_raw")), "of_earliest"]
    keyed = merged.select("dedupe_key", F.array_distinct(F.array_compact(F.array(*roles))).alias("givers"))
    given = rows.select("dedupe_key", "id", *SHORT).join(keyed.hint("shuffle_hash"), "dedupe_key").where(F.array_contains("givers", F.col("id")))
    texts = given.groupBy("dedupe_key").agg(F.collect_list(F.struct("id", *SHORT)).alias("texts"))
    known = merged.join(texts.hint("shuffle_hash"), "dedupe_key")

    def text_of(name: str, giver: str) -> Column:
        return F.get(F.filter("texts", lambda text: text["id"] == F.col(giver)), F.lit(0))[name]

    folded = {"source_slug": text_of("source_slug", "id")} | {name: text_of(name, f"of_{name}") for name in FIRST_NON_NULL}
    folded["published_at_raw"] = F.coalesce(text_of("published_at_raw", "of_earliest"), text_of("published_at_raw", "of_published_at_raw"))
    numbers = ("id", "published_at", "engagement", "times_seen", "first_seen_at", "updated_at")
    folded |= {name: F.col(name) for name in numbers}
    several = known.select("dedupe_key", "of_content", F.struct(*(column.alias(name) for name, column in folded.items())).alias("folded"))
    joined = rows.select(*MENTIONS.names).join(several.hint("shuffle_hash"), "dedupe_key", "left")
    kept = joined.where(F.col("of_content").isNull() | (F.col("of_content") == F.col("id")))
    one = F.col("of_content").isNull()
    return kept.select(
        *(F.when(one, F.col(name)).otherwise(F.col("folded")[name]).alias(name) if name in folded else F.col(name) for name in MENTIONS.names)
    )


def merge_into(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert folded ``batch`` rows into ``state``; both hold one row per key, ``state`` is older."""
    old, new = state.alias("old"), batch.alias("new")

    def o(name: str) -> Column:
        return F.col(f"old.{name}")

    def n(name: str) -> Column:
        return F.col(f"new.{name}")

    known, arrived = o("dedupe_key").isNotNull(), n("dedupe_key").isNotNull()
    earlier = n("published_at").isNotNull() & (o("published_at").isNull() | (n("published_at") < o("published_at")))
    fuller = ~known | (arrived & (F.length(n("content_clean")) > F.length(o("content_clean"))))
    merged = {
        "published_at": F.least(o("published_at"), n("published_at")),
        "published_at_raw": F.when(earlier, n("published_at_raw")).otherwise(
            F.coalesce(o("published_at_raw"), n("published_at_raw"))
        ),
        "engagement": F.greatest(o("engagement"), n("engagement")),
        "content_raw": F.when(fuller, n("content_raw")).otherwise(o("content_raw")),
        "content_clean": F.when(fuller, n("content_clean")).otherwise(o("content_clean")),
        "times_seen": F.coalesce(o("times_seen"), F.lit(0)) + F.coalesce(n("times_seen"), F.lit(0)),
        "updated_at": F.coalesce(n("updated_at"), o("updated_at")),
    }
    kept = {name: F.coalesce(o(name), n(name)) for name in MENTIONS.names if name not in merged}
    columns = kept | merged
    return old.join(new, F.col("old.dedupe_key") == F.col("new.dedupe_key"), "full_outer").select(
        *[columns[name].alias(name) for name in MENTIONS.names]
    )


def overlay(state: DataFrame, newer: DataFrame) -> DataFrame:
    """Stored ``state`` with ``newer`` rows (any number per key) folded in, without regrouping all of it.

    Only stored rows whose key occurs in ``newer`` are folded again; the rest pass through, with
    filters and column pruning still reaching their scan. Both joins carry keys only on the right,
    and Spark broadcasts that side when its size is under the broadcast threshold.
    """
    untouched = state.join(newer.select("dedupe_key").distinct(), "dedupe_key", "left_anti")
    return untouched.select(*STORED_MENTIONS.names).unionByName(overlaid(state, newer))


def touched_rows(state: DataFrame, newer: DataFrame) -> DataFrame:
    """The rows of ``state`` whose key occurs in ``newer``."""
    return state.join(newer.select("dedupe_key").distinct(), "dedupe_key", "left_semi")


def overlaid(state: DataFrame, newer: DataFrame) -> DataFrame:
    """The rows that ``newer`` adds to ``state`` or changes in it, folded."""
    touched = touched_rows(state, newer).select(*MENTIONS.names)
    return with_search_text(fold_rows(touched.unionByName(newer.select(*MENTIONS.names))))


def with_search_text(mentions: DataFrame, *more: str) -> DataFrame:
    """Add the words of title then content, one space around each, for keyword filters; keeps the columns ``more``."""
    text = F.concat_ws(" ", F.col("title"), F.col("content_clean"))
    return mentions.withColumn("search_text", F.concat(F.lit(" "), words_only(text), F.lit(" "))).select(
        *STORED_MENTIONS.names, *more
    )


def batch_sources(normalized: DataFrame, batch_time: Column) -> DataFrame:
    """One row per slug of a batch; its first record names it."""
    named = F.min_by(F.struct("display_name", "platform"), "arrival_seq").alias("named")
    return (
        normalized.groupBy(F.col("source_slug").alias("slug"))
        .agg(named)
        .select("slug", "named.display_name", "named.platform", batch_time.alias("created_at"))
    )


def merge_sources(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The newest batch's spelling wins; platform and creation time stay as stored."""
    old, new = stored.alias("old"), batch.alias("new")
    return old.join(new, F.col("old.slug") == F.col("new.slug"), "full_outer").select(
        F.coalesce("old.slug", "new.slug").alias("slug"),
        F.coalesce("new.display_name", "old.display_name").alias("display_name"),
        F.coalesce("old.platform", "new.platform").alias("platform"),
        F.coalesce("old.created_at", "new.created_at").alias("created_at"),
    )


def inserted_and_merged(stored_keys: DataFrame, batch: DataFrame) -> DataFrame:
    """One row ``inserted, merged`` for folded ``batch`` rows against the keys stored before it.

    ``stored_keys`` may repeat a key.
    """
    keys = batch.select("dedupe_key")
    known = stored_keys.join(keys, "dedupe_key", "left_semi").distinct().withColumn("known", F.lit(True))
    new = F.count_if(F.col("known").isNull())
    return (
        batch.select("dedupe_key", "times_seen")
        .join(known, "dedupe_key", "left")
        .agg(new.alias("inserted"), (F.coalesce(F.sum("times_seen"), F.lit(0)) - new).alias("merged"))
    )
