"""Counts per outlet and per local day under the shared filters, and the summary tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.functions import dates
from newsfold.operators.filters import ArgumentProblems, Filters, given, read_filters
from newsfold.operators.keyword_index import KeywordIndex
from newsfold.operators.search import SearchRequest, page_of

# Fixed value: the label of the last bucket.
NO_DAY_LABEL = "tanpa tanggal"
GROUPINGS = ("source", "day")


def read_stats_request(spark: SparkSession, group_by: str | None = None, **filters: str | None) -> tuple[Filters, str]:
    """Check ``q, source, since, until, group_by`` and report every problem at once."""
    problems: list[str] = []
    checked = read_filters(spark, problems, **filters)
    grouping = (given(group_by) or "").lower()
    if not grouping:
        problems.append("group_by is required: source or day")
    elif grouping not in GROUPINGS:
        problems.append(f'group_by="{group_by}" is not known: source or day')
    if problems:
        raise ArgumentProblems(problems)
    return checked, grouping


def count_by_source(
    mentions: DataFrame, sources: DataFrame, filters: Filters = Filters(), index: KeywordIndex | None = None
) -> DataFrame:
    """``source, name, platform, total``, largest first.

    Mentions are counted by slug before the join, so the join sees one row per outlet and a dominant
    outlet is already one partial count per task.
    """
    counted = filters.matched(mentions, index).groupBy(F.col("source_slug").alias("slug")).agg(
        F.count(F.lit(1)).alias("total")
    )
    return (
        counted.join(sources.select("slug", "display_name", "platform"), "slug")
        .select(F.col("slug").alias("source"), F.col("display_name").alias("name"), "platform", "total")
        .orderBy(F.desc("total"), F.asc("source"))
    )


def count_by_day(mentions: DataFrame, filters: Filters = Filters(), index: KeywordIndex | None = None) -> DataFrame:
    """``day, label, total``, newest first; undated mentions are a group of their own at the end."""
    return (
        filters.matched(mentions, index)
        .groupBy(dates.local_day(F.col("published_at")).alias("day"))
        .agg(F.count(F.lit(1)).alias("total"))
        .select("day", F.coalesce("day", F.lit(NO_DAY_LABEL)).alias("label"), "total")
        .orderBy(F.desc_nulls_last("day"))
    )


def stats(
    mentions: DataFrame, sources: DataFrame, filters: Filters, grouping: str, index: KeywordIndex | None = None
) -> DataFrame:
    by_source = grouping == "source"
    return count_by_source(mentions, sources, filters, index) if by_source else count_by_day(mentions, filters, index)


def stats_metadata(groups: DataFrame, filters: Filters, grouping: str) -> DataFrame:
    """One row: the total as the sum of ``groups``, the grouping, and the filters as applied."""
    return groups.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total")).select(
        F.lit(grouping).alias("group_by"),
        F.lit(dates.REPORT_ZONE if grouping == "day" else None).cast("string").alias("timezone"),
        "total",
        *filters.described(),
    )


def totals(mentions: DataFrame, sources: DataFrame, sets: dict[str, Filters]) -> DataFrame:
    """``filters, part, total``: for several filter sets at once the listing's total and the sums of both counts.

    One scan of the mentions: matches of every set are counted by outlet and day, and that table, as many rows as there are outlets
    times days, is added up over nothing (``list``), over outlets (``source``) and over days (``day``).
    """
    names = {f"n_{at}": name for at, name in enumerate(sets)}
    day = dates.local_day(F.col("published_at")).alias("day")
    hits = [F.count_if(filters.predicate()).alias(column) for column, filters in zip(names, sets.values())]
    counted = mentions.groupBy("source_slug", day).agg(*hits)
    listed = sources.select(F.col("slug").alias("source_slug"), F.lit(True).alias("known")).distinct()
    counted = counted.join(listed, "source_slug", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    keys = [F.col("source_slug"), F.col("known"), F.col("day")]
    groups = counted.groupingSets([[], keys[:2], keys[2:]], *keys).agg(
        *(F.sum(column).alias(column) for column in names), F.grouping_id().alias("level")
    )
    part = F.when(F.col("level") == 7, "list").when(F.col("level") == 1, "source").otherwise("day")
    # Counts per outlet name their outlet, so an unknown one is not in them.
    groups = groups.where("level <> 1 OR known").groupBy(part.alias("part")).agg(*(F.sum(column).alias(column) for column in names))
    every = sources.sparkSession.createDataFrame([("list",), ("source",), ("day",)], "part string")
    rows = F.array(*(F.struct(F.lit(name).alias("filters"), F.coalesce(column, F.lit(0)).alias("total")) for column, name in names.items()))
    return every.join(groups, "part", "left").select("part", F.inline(rows)).select("filters", "part", "total")


def source_choices(mentions: DataFrame, sources: DataFrame) -> DataFrame:
    """Outlets to pick from; unfiltered, so the choice does not shrink with the filters."""
    return count_by_source(mentions, sources)


def summary_tiles(mentions: DataFrame, request: SearchRequest, index: KeywordIndex | None = None) -> DataFrame:
    """``tile, value``: total, outlets and dated local days under the filters, engagement of the page.

    The first three come from one scan, grouped by outlet and day; undated mentions count in the
    total and in their outlet but are no day.
    """
    day = dates.local_day(F.col("published_at")).alias("day")
    groups = request.filters.matched(mentions, index).groupBy("source_slug", day).agg(F.count(F.lit(1)).alias("total"))
    tiles = groups.agg(
        F.sum("total").alias("total"),
        F.count_distinct("source_slug").alias("sources"),
        F.count_distinct("day").alias("days"),
    ).unpivot([], ["total", "sources", "days"], "tile", "value")
    page = page_of(mentions, request, index).agg(F.sum("engagement").alias("value"))
    return tiles.unionByName(page.select(F.lit("page_engagement").alias("tile"), "value")).select(
        "tile", F.coalesce("value", F.lit(0)).cast("bigint").alias("value")
    )
