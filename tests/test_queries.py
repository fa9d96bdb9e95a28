"""Registered queries against their SQL on the smallest supplied tables, where those are present."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from newsfold.plans import catalog
from tests.check_queries import compare

FOLDER = Path("/root/testdata/sf0.001")
QUICK = [
    "page_normalized",
    "page_outlet",
    "doc_merge",
    "doc_overlay_two_batches",
    "doc_upsert_counts",
    "doc_search_not",
    "doc_search_page",
    "doc_summary_tiles",
    "event_dates",
    "event_merged",
    "event_by_local_day_filtered",
    "array_feed",
    "feed_mentions",
    "store_report",
]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not FOLDER.exists(), reason="supplied tables are not here")
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    got, expected = compare(spark, str(FOLDER), name, entry.queries()[name], entry.oracle_sql()[name])
    assert got == expected


@pytest.mark.skipif(not FOLDER.exists(), reason="supplied tables are not here")
def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["source", "name", "platform", "total"] and frame.count() > 0


def test_filters_over_normalised_rows_stay_small(spark, normalized, feed_records):
    """A pushed-down filter must not multiply the normalisation inside it."""
    from tests.helpers import normalize_values

    frame = normalize_values(spark, feed_records).where("date_shape = 'tidak-ada' AND dedupe_key > ''")
    plan = frame.select("arrival_seq")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000
    assert frame.count() == 1
