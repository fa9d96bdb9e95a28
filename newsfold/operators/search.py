"""Filtered listing in a total order, by pages, with an exact total."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.functions import dates
from newsfold.operators.filters import ArgumentProblems, Filters, read_filters, whole_number
from newsfold.operators.keyword_index import KeywordIndex

SORT_ORDER = "published_at DESC NULLS LAST, id DESC"
LIMIT_DEFAULT = 20
LIMIT_MAX = 100
OFFSET_MAX = 2**53 - 1
NO_TEXT_HEADING = "(no text)"

# Rows one task may take to skip an offset; deeper pages are located by counts first.
SKIP_ROWS = 5_000

PAGE_COLUMNS = [
    "id",
    "source_slug",
    "external_id",
    "title",
    "content_clean",
    "url",
    "author",
    "published_at",
    "engagement",
    "times_seen",
]


@dataclass(frozen=True)
class SearchRequest:
    filters: Filters
    limit: int = LIMIT_DEFAULT
    offset: int = 0


def read_search_request(spark: SparkSession, limit=None, offset=None, **filters: str | None) -> SearchRequest:
    """Check all arguments (``q, source, since, until, limit, offset``) and report every problem at once."""
    problems: list[str] = []
    checked = read_filters(spark, problems, **filters)
    count = whole_number(limit, "limit", 1, LIMIT_MAX, LIMIT_DEFAULT, problems)
    skip = whole_number(offset, "offset", 0, OFFSET_MAX, 0, problems)
    if problems:
        raise ArgumentProblems(problems)
    return SearchRequest(checked, count, skip)


def display_order(published_at: str = "published_at", id_column: str = "id") -> list[Column]:
    return [F.desc_nulls_last(published_at), F.desc(id_column)]


def _micros(moment: int) -> Column:
    return F.timestamp_micros(F.lit(moment))


#: Microseconds of a day, a second, a millisecond and one: each splits one group of the level before into at most
#: some 86,400 groups, whatever the number of rows (days: as many as the table's dates span).
_STEPS = (dates.DAY_SECONDS * 1_000_000, 1_000_000, 1_000, 1)
_ID_SHIFTS = (48, 32, 16, 0)


def _seek(rows: DataFrame, offset: int) -> tuple[DataFrame, int]:
    """Narrow ``rows`` to a suffix of the display order that starts at most one group before ``offset``.

    Returns the rows from the start of that group on, and how many of them are still to be skipped. Each round is a
    grouped count over the key columns of one group, which literal bounds on date or id pick out of the scan. Dated
    rows come first, then undated ones.
    """
    dated, undated = F.col("published_at").isNotNull(), F.col("published_at").isNull()
    n_dated = rows.where(dated).count()
    remaining, group, later = offset, rows.where(dated), undated
    micros = F.unix_micros("published_at")
    if offset >= n_dated:
        remaining, group, later = offset - n_dated, rows.where(undated), F.lit(False)
    else:
        for step in _STEPS:
            found, remaining = _group_at(group, F.floor(micros / step) if step > 1 else micros, remaining)
            if found is None:
                return rows.where(F.lit(False)), 0
            low, high = _micros(found * step), _micros((found + 1) * step)
            # What comes after the group in the order are earlier instants and undated rows.
            group = rows.where((F.col("published_at") >= low) & (F.col("published_at") < high))
            later = (F.col("published_at") < low) | undated
            if remaining <= SKIP_ROWS:
                return rows.where((F.col("published_at") < high) | undated), remaining
    at_instant, low_id = group, None
    for shift in _ID_SHIFTS:
        found, remaining = _group_at(group, F.shiftright("id", shift), remaining)
        if found is None:
            return rows.where(F.lit(False)), 0
        low_id, high_id = found << shift, ((found + 1) << shift) - 1
        group = at_instant.where(F.col("id").between(low_id, high_id))
        if remaining <= SKIP_ROWS:
            break
    here = undated if offset >= n_dated else (F.col("published_at") >= low) & (F.col("published_at") < high)
    return rows.where((here & (F.col("id") <= high_id)) | later), remaining


def _group_at(rows: DataFrame, key: Column, skip: int) -> tuple[int | None, int]:
    """The group, from the highest key down, that holds the row after ``skip`` rows, and what is to be skipped in it."""
    counts = rows.groupBy(key.cast("bigint").alias("at")).count()
    for at, count in counts.orderBy(F.desc("at")).collect():
        if skip < count:
            return at, skip
        skip -= count
    return None, 0


def page_keys(mentions: DataFrame, request: SearchRequest, index: KeywordIndex | None = None) -> DataFrame:
    """``id, micros`` of the rows of one page, in order, from the filter and sort columns or the index alone."""
    matched = request.filters.matched(mentions, index)
    offset = request.offset
    if offset > SKIP_ROWS:
        matched, offset = _seek(matched, offset)
    ordered = matched.select("id", "published_at").orderBy(*display_order())
    page = ordered.offset(offset).limit(request.limit) if offset else ordered.limit(request.limit)
    return page.select("id", F.unix_micros("published_at").alias("micros"))


def page_of(mentions: DataFrame, request: SearchRequest, index: KeywordIndex | None = None) -> DataFrame:
    """The rows of one page, in order, as stored columns.

    First the keys of the page, at most a hundred, then their rows by literal bounds on id and date.
    The scan for the texts can so skip every file and row group outside the page.
    """
    keys = page_keys(mentions, request, index).collect()
    if not keys:
        return mentions.select(*PAGE_COLUMNS).where(F.lit(False))
    dated = [micros for _, micros in keys if micros is not None]
    when = F.col("published_at").isNull() if len(dated) < len(keys) else F.lit(False)
    if dated:
        first, last = (F.timestamp_micros(F.lit(bound)) for bound in (min(dated), max(dated)))
        when = when | F.col("published_at").between(first, last)
    rows = mentions.where(when & F.col("id").isin([key for key, _ in keys]))
    return rows.select(*PAGE_COLUMNS).orderBy(*display_order()).limit(request.limit)


def shaped(page: DataFrame, sources: DataFrame) -> DataFrame:
    """What readers get: the source as a struct, cleaned content only, the date as UTC text.

    The join meets at most one page of rows, not the table.
    """
    outlet = sources.select(F.col("slug").alias("source_slug"), "display_name", "platform")
    return (
        page.join(outlet, "source_slug")
        .orderBy(*display_order())
        .select(
            "id",
            F.struct(
                F.col("source_slug").alias("slug"), F.col("display_name").alias("name"), F.col("platform")
            ).alias("source"),
            "external_id",
            "title",
            F.col("content_clean").alias("content"),
            "url",
            "author",
            dates.iso_utc(F.col("published_at")).alias("published_at"),
            "engagement",
            "times_seen",
        )
    )


def search(mentions: DataFrame, sources: DataFrame, request: SearchRequest, index: KeywordIndex | None = None) -> DataFrame:
    return shaped(page_of(mentions, request, index), sources)


def search_metadata(mentions: DataFrame, request: SearchRequest, index: KeywordIndex | None = None) -> DataFrame:
    """One row: limits, exact total (also past the last page), and the filters as applied."""
    offset, limit = F.lit(request.offset).cast("bigint"), F.lit(request.limit).cast("bigint")
    total = request.filters.matched(mentions, index).agg(F.count(F.lit(1)).alias("total"))
    returned = F.greatest(F.lit(0), F.least(limit, F.col("total") - offset))
    return total.select(
        limit.alias("limit"),
        offset.alias("offset"),
        "total",
        returned.alias("returned"),
        (offset + returned < F.col("total")).alias("has_more"),
        F.lit(SORT_ORDER).alias("sort"),
        *request.filters.described(),
    )


def display_rows(shaped_page: DataFrame) -> DataFrame:
    """Heading, local time and author line of a shaped page for people to read."""
    text = F.coalesce(
        F.nullif(F.col("title"), F.lit("")), F.nullif(F.col("content"), F.lit("")), F.lit(NO_TEXT_HEADING)
    )
    when = F.coalesce(dates.local_display_time(F.col("published_at").try_cast("timestamp")), F.lit("no date"))
    both = F.coalesce(F.col("title"), F.lit("")) != ""
    return shaped_page.select(
        "id",
        when.alias("shown_time"),
        F.col("source.name").alias("outlet"),
        text.alias("heading"),
        F.when(both, F.nullif(F.col("content"), F.lit(""))).alias("snippet"),
        "author",
        "engagement",
        "times_seen",
    )
