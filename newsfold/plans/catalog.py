"""Registered queries: the library's operators over the supplied tables, whole."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsfold import schemas
from newsfold.functions import dates
from newsfold.functions.keys import fingerprint, with_dedupe_key
from newsfold.functions.numbers import engagement_count
from newsfold.functions.outlets import with_outlet
from newsfold.functions.text import plain_text
from newsfold.functions.urls import canonical_url, url_host
from newsfold.operators import keyword_index, keywords, merge, normalize, search, stats
from newsfold.operators.filters import ArgumentProblems, Filters
from newsfold.plans import feeds
from newsfold.session import checkpoint_dir, configured
from newsfold.sources import folders
from newsfold.sources.feed import Feed, array_documents
from newsfold.sources.scan import spread
from newsfold.sources.store import CommitRefused, MentionStore
from newsfold.streaming.ingest_stream import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCH_TIME = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)
LATE_TIME = dt.datetime(2024, 2, 1, 6, tzinfo=dt.UTC)
WINDOW_START = dt.datetime(2024, 1, 9, 16, tzinfo=dt.UTC)
WINDOW_END = dt.datetime(2024, 1, 20, 16, tzinfo=dt.UTC)
# Documents are dated by events of the same number, which fall into the first days.
FIRST_DAY = {"since": dt.datetime(2024, 1, 1, 16, tzinfo=dt.UTC), "until": dt.datetime(2024, 1, 2, 16, tzinfo=dt.UTC)}

# Columns of a stored mention without the batch times, dates as text.
MERGED = [
    "dedupe_key",
    "id",
    "source_slug",
    "external_id",
    "url",
    "canonical_url",
    "author",
    "content_raw",
    "content_clean",
    "published_at",
    "published_at_raw",
    "engagement",
    "times_seen",
]


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configured(spark), folder)

    QUERIES[build.__name__] = run
    return build


def now() -> Column:
    return F.timestamp_millis(F.lit(round(BATCH_TIME.timestamp() * 1000)))


def plain(mentions: DataFrame) -> DataFrame:
    return mentions.withColumn("published_at", dates.iso_utc(F.col("published_at"))).select(*MERGED)


def ranked(page: DataFrame) -> DataFrame:
    """Number the rows of one page, at most a hundred."""
    return page.withColumn("rank", F.row_number().over(Window.orderBy(*search.display_order())))


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/newsfold-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once for several uses, and safe
    when executors are lost."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# --- pages: URL, outlet and text steps ----------------------------------------------------------


@query
def page_host(spark, folder):
    return feeds.table(spark, folder, "pages").select("page_id", url_host(F.col("url")).alias("host"))


@query
def page_canonical_url(spark, folder):
    pages = feeds.table(spark, folder, "pages")
    return pages.select("page_id", canonical_url(F.col("url")).alias("canonical_url"))


@query
def page_outlet(spark, folder):
    pages = feeds.table(spark, folder, "pages").select(
        "page_id", url_host(F.col("url")).alias("host"), F.regexp_extract("url", r"://([^./]+)", 1).alias("label")
    )
    return with_outlet(pages, "label", "host", feeds.PAGE_OUTLETS).drop("host", "label")


@query
def page_text(spark, folder):
    pages = spread(feeds.table(spark, folder, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", plain_text(F.col("html")).alias("text"))


def page_mentions_normalized(spark, folder):
    return normalize.normalize_records(feeds.page_records(spark, folder), feeds.PAGE_OUTLETS)


@query
def page_normalized(spark, folder):
    return page_mentions_normalized(spark, folder).select(
        F.col("arrival_seq").alias("page_id"),
        "source_slug",
        "external_id",
        "canonical_url",
        "title",
        "dedupe_key",
        F.concat_ws(",", "warnings").alias("warnings"),
    )


@query
def page_count_by_outlet(spark, folder):
    """Pages per outlet after duplicates are merged."""
    normalized = staged(page_mentions_normalized(spark, folder), "pages")
    mentions = merge.fold_rows(merge.as_rows(normalized, now()))
    return stats.count_by_source(mentions, merge.batch_sources(normalized, now()))


@query
def page_renormalized(spark, folder):
    """Clean content recomputed from the stored raw content."""
    normalized = staged(page_mentions_normalized(spark, folder), "pages")
    folded = merge.fold_rows(merge.as_rows(normalized, now()))
    return normalize.renormalize_text(folded).select("dedupe_key", "content_clean")


# --- documents: keys and merging ----------------------------------------------------------------


def document_keys(spark, folder):
    """Documents with language as outlet and text as content."""
    documents = spread(feeds.table(spark, folder, "documents"), "doc_id")
    return with_dedupe_key(
        documents.select(
            "doc_id",
            "source",
            "n_chars",
            F.col("lang").alias("source_slug"),
            F.lit(None).cast("string").alias("title"),
            F.col("text").alias("content_clean"),
            F.lit(None).cast("string").alias("canonical_url"),
            F.lit(None).cast("string").alias("external_id"),
        )
    )


@query
def doc_fingerprint(spark, folder):
    documents = spread(feeds.table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    return documents.select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


@query
def doc_dedupe_key(spark, folder):
    return document_keys(spark, folder).select("doc_id", "dedupe_key")


def document_rows(spark, folder):
    """Documents as mention rows: character count as engagement, crawler as author."""
    filled = {
        "id": F.col("doc_id"),
        "author": F.when(F.col("source") != "src3", F.col("source")),
        "content_raw": F.col("content_clean"),
        "engagement": F.col("n_chars"),
        "times_seen": F.lit(1).cast("bigint"),
        "first_seen_at": now(),
        "updated_at": now(),
    }
    rows = document_keys(spark, folder).withColumns(filled)
    missing = {field.name: F.lit(None).cast(field.dataType) for field in schemas.MENTIONS if field.name not in rows.columns}
    return rows.withColumns(missing)


MERGED_DOCUMENT = ["dedupe_key", "id", "source_slug", "author", "content_clean", "engagement", "times_seen"]


@query
def doc_merge(spark, folder):
    rows = staged(document_rows(spark, folder).select(*schemas.MENTIONS.names), "rows")
    return merge.fold_rows(rows).select(*MERGED_DOCUMENT)


def two_deliveries(spark, folder):
    """Documents of the first ten crawlers arrive before those of the others."""
    late = F.regexp_extract("source", "[0-9]+", 0).cast("int") >= 10
    rows = staged(document_rows(spark, folder).withColumn("late", late), "deliveries")
    rows = rows.withColumn("id", F.col("id") + F.when(F.col("late"), F.lit(10**12)).otherwise(F.lit(0)))
    return (rows.where(condition).select(*schemas.MENTIONS.names) for condition in (~F.col("late"), F.col("late")))


@query
def doc_upsert_two_batches(spark, folder):
    first, second = two_deliveries(spark, folder)
    return merge.merge_into(merge.fold_rows(first), merge.fold_rows(second)).select(*MERGED_DOCUMENT)


@query
def doc_overlay_two_batches(spark, folder):
    first, second = two_deliveries(spark, folder)
    state = staged(merge.with_search_text(merge.fold_rows(first)), "state")
    return merge.overlay(state, second).select(*MERGED_DOCUMENT)


@query
def doc_upsert_counts(spark, folder):
    """Inserted and merged records of the second delivery."""
    first, second = two_deliveries(spark, folder)
    return merge.inserted_and_merged(first.select("dedupe_key"), merge.winners(second))


# --- documents: search --------------------------------------------------------------------------


def document_mentions(spark, folder):
    """Documents as stored mentions, dated by the event of the same number."""
    documents = spread(feeds.table(spark, folder, "documents").drop("lang"), "doc_id")
    moments = feeds.table(spark, folder, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("published_at"))
    rows = documents.join(moments, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("source_slug"),
        F.col("text").alias("content_clean"),
        "published_at",
        F.col("n_chars").alias("engagement"),
    )
    missing = {
        field.name: F.lit(None).cast(field.dataType) for field in schemas.MENTIONS if field.name not in rows.columns
    }
    return merge.with_search_text(rows.withColumns(missing))


def document_sources(spark, folder):
    named = feeds.table(spark, folder, "documents").select(F.col("source").alias("slug")).distinct()
    return named.select(
        "slug",
        F.concat(F.lit("Crawler "), F.regexp_extract("slug", "[0-9]+", 0)).alias("display_name"),
        F.lit("other").alias("platform"),
    )


#: Keyword indexes written in this application, by the folder of the tables they are of.
_INDEXES: dict[tuple[str, str], tuple[str, keyword_index.Layout]] = {}


def document_index(spark, folder) -> keyword_index.KeywordIndex:
    """The stored keyword index of the documents, written once per application and folder of tables."""
    mentions = document_mentions(spark, folder)
    key = spark.sparkContext.applicationId, folder
    if key not in _INDEXES or not folders.children(spark, _INDEXES[key][0]):
        path = run_folder(spark, "index")
        size = keyword_index.text_bytes(feeds.table(spark, folder, "documents"), "text")
        _INDEXES[key] = path, keyword_index.write_postings(mentions, path, size=size)
    path, layout = _INDEXES[key]
    return keyword_index.KeywordIndex([keyword_index.Segment(keyword_index.read_postings(spark, path), layout)], mentions)


def found_ids(spark, folder, words):
    return document_index(spark, folder).matches(Filters(q=words)).select(F.col("id").alias("doc_id"))


@query
def doc_search_word(spark, folder):
    return found_ids(spark, folder, "WITH")


@query
def doc_search_all_words(spark, folder):
    return found_ids(spark, folder, "the with & from")


@query
def doc_search_phrase(spark, folder):
    return found_ids(spark, folder, '"of the"')


@query
def doc_search_not(spark, folder):
    return found_ids(spark, folder, 'the -with -"of the"')


@query
def doc_search_or(spark, folder):
    return found_ids(spark, folder, "und from or la des")


@query
def doc_search_compound(spark, folder):
    return found_ids(spark, folder, "of-the")


@query
def doc_search_punctuation(spark, folder):
    """Nothing but punctuation matches nothing, in no outlet; a word next to it counts as if it were alone."""
    index = document_index(spark, folder)
    per_outlet = index.mentions.groupBy("source_slug").agg(F.count(F.lit(1)).alias("documents"))
    for name, words in (("none", "?! &&& ..."), ("some", "the ?! ...")):
        found = index.matches(Filters(q=words)).groupBy("source_slug").agg(F.count(F.lit(1)).alias(name))
        per_outlet = per_outlet.join(found, "source_slug", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return per_outlet


@query
def doc_search_all_filters(spark, folder):
    filters = Filters(q="the", source="src7", **FIRST_DAY)
    return document_index(spark, folder).matches(filters).select(F.col("id").alias("doc_id"))


@query
def doc_index(spark, folder):
    """Documents and places per word of the stored index."""
    (segment,) = document_index(spark, folder).segments
    return segment.rows.groupBy("token").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.size("positions")).alias("places"))


@query
def doc_index_search(spark, folder):
    """Phrases, exclusions and alternatives in one request, and a request of exclusions alone."""
    index = document_index(spark, folder)
    asked = ['"of the" -with or "la de" or und from', '-the -la -"der die"']
    found = [index.matches(Filters(q=words)).select(F.lit(at).alias("request"), F.col("id").alias("doc_id")) for at, words in enumerate(asked)]
    return found[0].unionByName(found[1])


def search_page(spark, folder, limit, offset, **filters):
    request = search.SearchRequest(Filters(**filters), limit, offset)
    index = document_index(spark, folder) if request.filters.q else None
    page = ranked(search.page_of(document_mentions(spark, folder), request, index))
    outlet = document_sources(spark, folder)
    return page.join(outlet, F.col("source_slug") == F.col("slug")).select(
        "rank",
        F.col("id").alias("doc_id"),
        F.col("source_slug").alias("slug"),
        F.col("display_name").alias("name"),
        dates.iso_utc(F.col("published_at")).alias("published_at"),
        "engagement",
    )


@query
def doc_search_page(spark, folder):
    return search_page(spark, folder, 20, 0, q="the")


@query
def doc_search_third_page(spark, folder):
    return search_page(spark, folder, 25, 50)


@query
def doc_search_past_end(spark, folder):
    """The last page, which is shorter than its limit, and nothing after it."""
    total = feeds.table(spark, folder, "documents").count()
    return search_page(spark, folder, 20, max(0, total - 7)).unionByName(search_page(spark, folder, 20, total))


@query
def doc_search_problems(spark, folder):
    """Wrong requests, a listing and a count per outlet, with all their problems at once; those of the first outlet have wrong dates, too."""
    outlets = sorted(row.slug for row in document_sources(spark, folder).select("slug").collect())
    found = []
    for outlet in outlets:
        dated = outlet == outlets[0]
        listing = {"limit": outlet, "offset": "-1", "q": "the"} | ({"since": outlet} if dated else {})
        counts = {"group_by": outlet} | ({"since": "2024-02-01", "until": "2024-01-30"} if dated else {})
        for name, read, request in (("list", search.read_search_request, listing), ("counts", stats.read_stats_request, counts)):
            try:
                read(spark, **request)
            except ArgumentProblems as problems:
                found += [(outlet, name, problem) for problem in problems.problems]
    return spark.createDataFrame(found, "outlet string, request string, problem string")


@query
def event_deep_page(spark, folder):
    """A page so deep that it is located by counts; undated events come last."""
    events = feeds.table(spark, folder, "events")
    undated = F.col("event_type") == "error"
    rows = events.select(
        F.col("event_id").alias("id"),
        F.when(~undated, F.date_trunc("HOUR", F.col("ts").cast("timestamp"))).alias("published_at"),
        F.col("event_type").alias("source_slug"),
    )
    for name in search.PAGE_COLUMNS:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    # The offset follows the table: past nine tenths of its rows.
    offset = int(events.count() * 0.9)
    request = search.SearchRequest(Filters(), 50, offset)
    return ranked(search.page_of(rows, request)).select("rank", "id", dates.iso_utc(F.col("published_at")).alias("published_at"))


def metadata(spark, folder, limit, offset, **filters):
    request = search.SearchRequest(Filters(**filters), limit, offset)
    index = document_index(spark, folder) if request.filters.q else None
    return search.search_metadata(document_mentions(spark, folder), request, index).drop("note", "sort")


@query
def doc_search_metadata(spark, folder):
    return metadata(spark, folder, 20, 40, q="the", **FIRST_DAY)


@query
def doc_search_past_end_metadata(spark, folder):
    return metadata(spark, folder, 20, 10**8, source="src7")


@query
def doc_count_by_source(spark, folder):
    index = document_index(spark, folder)
    return stats.count_by_source(index.mentions, document_sources(spark, folder), Filters(q="the"), index)


@query
def doc_summary_tiles(spark, folder):
    request = search.SearchRequest(Filters(q="the"), 20, 0)
    index = document_index(spark, folder)
    return stats.summary_tiles(index.mentions, request, index)


@query
def doc_display_rows(spark, folder):
    request = search.SearchRequest(Filters(), 100, 0)
    page = search.search(document_mentions(spark, folder), document_sources(spark, folder), request)
    return search.display_rows(page).select("id", "shown_time", "outlet", "heading", "engagement")


@query
def list_equals_stats(spark, folder):
    """The listing's total and both sums of counts, per filter set."""
    sets = {
        "none": Filters(),
        "word": Filters(q="the"),
        "outlet": Filters(source="src7"),
        "dates": Filters(**FIRST_DAY),
        "all": Filters(q="of -with", source="src1", since=FIRST_DAY["since"]),
    }
    return stats.totals(document_mentions(spark, folder), document_sources(spark, folder), sets)


# --- events: dates, counts, days ----------------------------------------------------------------


def events_normalized(spark, folder):
    return normalize.normalize_records(feeds.event_records(spark, folder))


@query
def event_dates(spark, folder):
    fields = normalize.project_fields(feeds.event_records(spark, folder))
    read = dates.read_published(F.col("published_at_kind"), F.col("published_at_number"), F.col("published_at_text"))
    return fields.select("arrival_seq", read.alias("read")).select(
        F.col("arrival_seq").alias("event_id"),
        dates.iso_utc(dates.published_at(F.col("read"))).alias("published_at"),
        dates.published_shape(F.col("read")).alias("date_shape"),
    )


@query
def event_date_shape_census(spark, folder):
    return normalize.date_shape_census(events_normalized(spark, folder))


@query
def event_engagement(spark, folder):
    fields = normalize.project_fields(feeds.event_records(spark, folder))
    count = engagement_count(
        F.when(F.col("engagement_kind") == "number", F.col("engagement_number")),
        F.when(F.col("engagement_kind") == "string", F.col("engagement_text")),
    )
    return fields.select(F.col("arrival_seq").alias("event_id"), count.alias("engagement"))


@query
def event_field_kinds(spark, folder):
    """JSON kinds of the two loosely typed fields over the feed."""
    fields = normalize.project_fields(feeds.event_records(spark, folder))
    return fields.groupBy("published_at_kind", "engagement_kind").agg(F.count(F.lit(1)).alias("records"))


@query
def event_warning_census(spark, folder):
    return normalize.warning_rows(events_normalized(spark, folder)).groupBy("warning").agg(F.count(F.lit(1)).alias("records"))


@query
def event_merged(spark, folder):
    """Events folded per source and user: largest count, earliest date with its raw text, deliveries."""
    folded = merge.fold_rows(merge.as_rows(staged(events_normalized(spark, folder), "events"), now()))
    return plain(folded).select("dedupe_key", "id", "external_id", "published_at", "published_at_raw", "engagement", "times_seen")


def event_mentions(spark, folder):
    """Events as mentions; errors have no date."""
    undated = F.col("event_type") == "error"
    return feeds.table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(~undated, F.col("ts").cast("timestamp")).alias("published_at"),
        F.col("event_type").alias("source_slug"),
    )


@query
def event_by_local_day(spark, folder):
    return stats.count_by_day(event_mentions(spark, folder))


@query
def event_by_local_day_filtered(spark, folder):
    return stats.count_by_day(event_mentions(spark, folder), Filters(since=WINDOW_START, until=WINDOW_END))


@query
def event_range_filter(spark, folder):
    kept = Filters(since=WINDOW_START, until=WINDOW_END).apply(event_mentions(spark, folder))
    return kept.groupBy("source_slug").agg(F.count(F.lit(1)).alias("mentions"), F.min("id").alias("first_id"))


@query
def event_stats_metadata(spark, folder):
    filters = Filters(since=WINDOW_START)
    groups = stats.count_by_day(event_mentions(spark, folder), filters)
    return stats.stats_metadata(groups, filters, "day").select("group_by", "timezone", "total", "from", "to")


# --- feeds: admission and whole ingest ----------------------------------------------------------


@query
def conversation_admission(spark, folder):
    """User turns pass as records, bare text is split off with its position."""
    _, bad = normalize.split_malformed(feeds.conversation_records(spark, folder))
    return bad.select("conv_id", "turn")


@query
def conversation_admitted(spark, folder):
    good, _ = normalize.split_malformed(feeds.conversation_records(spark, folder))
    return normalize.normalize_records(good).select("conv_id", "turn", "source_slug", "content_clean")


@query
def array_feed(spark, folder):
    """Elements of posted arrays with their positions; refused batches give one row each."""
    rows = array_documents(feeds.line_arrays(spark, folder)).rows
    return rows.select(
        F.col("file").cast("bigint").alias("doc_id"),
        F.col("line").alias("pos"),
        F.col("refused").cast("int").alias("refused"),
        F.try_variant_get("record", "$.content", "string").alias("content"),
    )


def feed_normalized(spark, folder):
    return normalize.normalize_records(feeds.document_records(spark, folder))


@query
def feed_mentions(spark, folder):
    """The document feed normalised and folded: every merge rule at once."""
    return plain(merge.fold_rows(merge.as_rows(staged(feed_normalized(spark, folder), "feed"), now())))


@query
def page_merged(spark, folder):
    """Pages folded per duplicate key; their titles come from the first page that has one."""
    normalized = staged(page_mentions_normalized(spark, folder), "pages")
    folded = merge.fold_rows(merge.as_rows(normalized, now()))
    return folded.select("dedupe_key", "id", "title", "content_clean", "url", "canonical_url", "external_id", "times_seen")


@query
def feed_warning_census(spark, folder):
    return normalize.warning_rows(feed_normalized(spark, folder)).groupBy("warning").agg(F.count(F.lit(1)).alias("records"))


@query
def feed_sources(spark, folder):
    return merge.batch_sources(feed_normalized(spark, folder), now()).select("slug", "display_name", "platform")


@query
def feed_count_by_source(spark, folder):
    normalized = staged(feed_normalized(spark, folder), "feed")
    mentions = merge.fold_rows(merge.as_rows(normalized, now()))
    return stats.source_choices(mentions, merge.batch_sources(normalized, now()))


@query
def feed_count_by_day(spark, folder):
    return stats.count_by_day(merge.winners(merge.as_rows(feed_normalized(spark, folder), now())))


def delivered(spark, folder, late: bool) -> Feed:
    """The document feed of the first ten crawlers, or of the others."""
    records = feeds.document_records(spark, folder)
    is_late = F.regexp_extract("crawler", "[0-9]+", 0).cast("int") >= 10
    return numbered_feed(records.where(is_late if late else ~is_late), "documents", F.col("arrival_seq"))


def numbered_feed(records: DataFrame, file: str, line: Column) -> Feed:
    return Feed(
        records.select(
            F.lit(file).alias("file"),
            F.lit(0).cast("bigint").alias("block"),
            line.cast("bigint").alias("line"),
            F.lit(False).alias("refused"),
            "record",
        )
    )


def stored_in_two_batches(spark, folder, compacted: bool = False) -> MentionStore:
    store = MentionStore(spark, run_folder(spark, "tables"), indexed=False)
    for late in (False, True):
        store.ingest(delivered(spark, folder, late), LATE_TIME if late else BATCH_TIME)
        if compacted:
            store.compact()
    return store


@query
def store_search(spark, folder):
    """A search over stored tables and their index, while the second batch is still a delta."""
    store = MentionStore(spark, run_folder(spark, "tables"))
    store.ingest(delivered(spark, folder, False), BATCH_TIME)
    store.compact()
    snapshot = store.ingest(delivered(spark, folder, True), LATE_TIME)
    found = snapshot.index().matches(Filters(q='the -with or "de la" or -und -of -la'))
    return found.select("id", "source_slug", dates.iso_utc(F.col("published_at")).alias("published_at"))


@query
def stream_replay(spark, folder):
    """A micro-batch that a stream sends again counts once, another one with the same records counts."""
    store = MentionStore(spark, run_folder(spark, "replayed"), indexed=False)
    for batch_id in (0, 0, 1, 1, 0):
        snapshot = store.ingest(delivered(spark, folder, True), BATCH_TIME, stream="feed", batch_id=batch_id)
    return snapshot.mentions().select("dedupe_key", "times_seen", F.lit(snapshot.manifest.batch_no).cast("bigint").alias("batches"))


@query
def store_merge_on_read(spark, folder):
    """Two batches in stored tables, the second still a delta when read."""
    return plain(stored_in_two_batches(spark, folder).snapshot().mentions())


@query
def store_compacted(spark, folder):
    """The same two batches, compacted into a new base."""
    return plain(stored_in_two_batches(spark, folder, compacted=True).snapshot().base())


@query
def store_report(spark, folder):
    snapshot = stored_in_two_batches(spark, folder).snapshot()
    return snapshot.report().select(*schemas.REPORT.names)


@query
def store_warnings(spark, folder):
    snapshot = stored_in_two_batches(spark, folder).snapshot()
    return snapshot.warnings().groupBy("batch_no", "warning").agg(F.count(F.lit(1)).alias("records"))


@query
def store_errors(spark, folder):
    """Malformed conversation turns in the error table of their batch."""
    records = feeds.conversation_records(spark, folder)
    feed = numbered_feed(records, "turns", F.col("turn") + F.col("conv_id") * 1_000_000)
    store = MentionStore(spark, run_folder(spark, "errors"))
    return store.ingest(feed, BATCH_TIME).errors().select("batch_no", "file", "pos")


@query
def stream_ingest(spark, folder):
    """Line files picked up by a stream and kept as one table.

    Spark names the written files, so only columns that no arrival order changes are returned.
    """
    root = run_folder(spark, "stream")
    feeds.document_records(spark, folder).select(F.to_json("record").alias("value")).write.text(f"{root}/lines")
    store = MentionStore(spark, f"{root}/tables")
    start_ingest(store, f"{root}/lines", f"{root}/checkpoint", lines=True, once=True).awaitTermination()
    mentions = store.snapshot().mentions()
    return plain(mentions).select("dedupe_key", "source_slug", "published_at", "engagement", "times_seen")


@query
def store_sources(spark, folder):
    """Outlets after two batches: the newest name, the first batch's time."""
    sources = stored_in_two_batches(spark, folder).snapshot().sources()
    return sources.withColumn("created_at", dates.iso_utc(F.col("created_at")))


@query
def store_batch_times(spark, folder):
    mentions = stored_in_two_batches(spark, folder, compacted=True).snapshot().mentions()
    return mentions.select("dedupe_key", *(dates.iso_utc(F.col(name)).alias(name) for name in ("first_seen_at", "updated_at")))


@query
def store_replay(spark, folder):
    """The first batch sent twice adds no rows."""
    store = MentionStore(spark, run_folder(spark, "replay"))
    for moment in (BATCH_TIME, LATE_TIME):
        snapshot = store.ingest(delivered(spark, folder, False), moment)
    seen = snapshot.mentions().agg(F.sum("times_seen").alias("times_seen"))
    return snapshot.report().where("batch_no = 2").select("received", "inserted", "merged").join(seen)


@query
def store_lost_race(spark, folder):
    """A writer that commits second is refused, changes nothing, and sends its batch again."""
    root = run_folder(spark, "race")
    store, rival = MentionStore(spark, root), MentionStore(spark, root)
    commit = store._commit
    store._commit = lambda manifest: (rival.ingest(delivered(spark, folder, False), BATCH_TIME), commit(manifest))[1]
    try:
        store.ingest(delivered(spark, folder, True), LATE_TIME)
    except CommitRefused:
        store._commit = commit
        store.ingest(delivered(spark, folder, True), LATE_TIME)
    snapshot = store.snapshot()
    return snapshot.mentions().select("dedupe_key", "times_seen", F.lit(snapshot.manifest.batch_no).cast("bigint").alias("batches"))


@query
def doc_search_request(spark, folder):
    """A request as it comes: an outlet in other letters, a bare last day, the note and the order kept."""
    request = search.read_search_request(spark, q=" the ", source=" SRC7 ", since="2024-01-02", until="2024-01-02", limit="5")
    index = document_index(spark, folder)
    about = search.search_metadata(index.mentions, request, index)
    return about.select("total", "returned", "q", "source", "from", "to", "sort", "note")


@query
def doc_search_only_punctuation(spark, folder):
    """Matches of queries with and without words, over the whole table at once."""
    asked = ["the", "the ???", "???", '-" "', "!! or .."]
    words = F.col("search_text")
    counts = document_mentions(spark, folder).agg(*(F.count_if(keywords.keyword_filter(q, words)).alias(f"q{at}") for at, q in enumerate(asked)))
    rows = F.array(*(F.struct(F.lit(q).alias("q"), F.col(f"q{at}").alias("matches")) for at, q in enumerate(asked)))
    return counts.select(F.inline(rows))


def event_fields(spark, folder, **fields: Column) -> DataFrame:
    events = feeds.table(spark, folder, "events")
    whole = F.to_variant_object(F.struct(*(column.alias(name) for name, column in fields.items())))
    return normalize.normalize_records(events.select(F.col("event_id").alias("arrival_seq"), whole.alias("record")))


@query
def event_date_years(spark, folder):
    """Dates moved over two centuries; years outside 2000 to 2100 are unreadable."""
    moved = F.col("ts") + F.make_ym_interval(((F.col("event_id") % 9 - 4) * 25).cast("int"), F.lit(0))
    rows = event_fields(spark, folder, published_at=F.date_format(moved, "yyyy-MM-dd'T'HH:mm:ss'Z'"), title=F.lit("t"))
    return rows.select(F.col("arrival_seq").alias("event_id"), dates.iso_utc(F.col("published_at")).alias("published_at"), "date_shape")


@query
def event_unlabelled(spark, folder):
    """Outlets of records without a label, with a blank one, and with one that isn't listed."""
    label = F.when(F.col("event_type") == "view", F.lit(" ")).when(F.col("event_type") != "click", F.col("event_type"))
    rows = event_fields(spark, folder, source=label, title=F.lit("t"))
    kinds = F.filter("warnings", lambda code: code.startswith("SOURCE"))
    return rows.select(F.col("arrival_seq").alias("event_id"), "source_slug", F.array_join(kinds, ",").alias("warning"))


@query
def doc_numeric_entities(spark, folder):
    """Characters sent as decimal and hexadecimal entities."""
    first = F.concat(F.lit("&#"), F.ascii(F.left("text", F.lit(1))), F.lit("; "))
    sent = F.concat(first, F.col("source"), F.lit(" &#xE9; &#128512;"))
    return feeds.table(spark, folder, "documents").select("doc_id", plain_text(sent).alias("text"))
