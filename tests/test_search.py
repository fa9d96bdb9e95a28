"""Filters, listing, pages and counts over the feed file."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from newsfold import schemas
from newsfold.operators import keyword_index, keywords, search, stats
from newsfold.operators.filters import ArgumentProblems, Filters, read_filters


def listing(spark, tables, **arguments):
    request = search.read_search_request(spark, **arguments)
    return search.search(*tables, request).collect(), search.search_metadata(tables[0], request).first()


def ids(spark, tables, **arguments):
    return [row["external_id"] for row in listing(spark, tables, **arguments)[0]]


@pytest.fixture(scope="module")
def with_undated(spark, tables):
    mentions, sources = tables
    extra = spark.createDataFrame(
        [(9_000, "thestar", "Undated trial story", "trial text", "undated-key", 1, " undated trial story trial text ")],
        "id bigint, source_slug string, title string, content_clean string, dedupe_key string, times_seen bigint, "
        "search_text string",
    )
    return mentions.unionByName(extra, allowMissingColumns=True).select(*schemas.STORED_MENTIONS.names).cache(), sources


def test_everything_in_order(spark, tables):
    rows, about = listing(spark, tables)
    assert (about["total"], about["returned"], about["has_more"], about["limit"], about["offset"]) == (
        11,
        11,
        False,
        20,
        0,
    )
    moments = [row["published_at"] for row in rows]
    assert moments[:-1] == sorted(moments[:-1], reverse=True) and moments[-1] is None
    assert about["sort"] == "published_at DESC NULLS LAST, id DESC"
    assert rows[0].asDict(recursive=True)["source"] == {"slug": "nst", "name": "New Straits Times", "platform": "news"}
    assert "content_raw" not in rows[0].asDict()


def test_pages_neither_skip_nor_repeat(spark, tables):
    whole = ids(spark, tables, limit=50)
    walked = [name for offset in (0, 4, 8) for name in ids(spark, tables, limit="4", offset=str(offset))]
    assert walked == whole and len(set(whole)) == 11
    first, last, past = [listing(spark, tables, limit=4, offset=offset)[1] for offset in (0, 8, 70)]
    assert (first["has_more"], first["returned"]) == (True, 4)
    assert (last["has_more"], last["returned"]) == (False, 3)
    assert (past["total"], past["returned"], past["has_more"]) == (11, 0, False)
    assert ids(spark, tables, offset=70) == []


def test_deep_pages_equal_a_plain_sort(spark, tables, monkeypatch):
    monkeypatch.setattr(search, "SKIP_ROWS", 3)
    moment = dt.datetime(1969, 12, 31, 12, tzinfo=dt.UTC)
    rows = []
    for at in range(300):
        # A third shares one instant, a third has none, the rest spreads over microseconds and days around 1970.
        when = [moment, None, moment + dt.timedelta(microseconds=at % 7, days=at % 5 - 2)][at % 3]
        rows.append((at * 70_000, "s", when))
    mentions = spark.createDataFrame(rows, "id bigint, source_slug string, published_at timestamp")
    for name in set(search.PAGE_COLUMNS) - {"id", "source_slug", "published_at"}:
        mentions = mentions.withColumn(name, F.lit(None).cast("string"))
    mentions = mentions.cache()
    expected = [row["id"] for row in mentions.orderBy(*search.display_order()).collect()]
    for offset in (4, 99, 150, 205, 299, 300, 10**9):
        page = search.page_of(mentions, search.SearchRequest(Filters(), 5, offset))
        assert [row["id"] for row in page.collect()] == expected[offset : offset + 5], offset


def test_page_keys_need_no_full_sort_and_no_texts(spark, tables, tmp_path):
    tables[0].write.parquet(str(tmp_path / "mentions"))
    stored = spark.read.parquet(str(tmp_path / "mentions"))
    keys = search.page_keys(stored, search.SearchRequest(Filters(), 5, 5))
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<id:bigint,published_at:timestamp>" in plan
    rows = search.page_of(stored, search.SearchRequest(Filters(), 2, 0))
    scan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in scan or "GreaterThanOrEqual(published_at" in scan


KEYWORDS = [
    ("ferry", {"b-1"}),
    ("SOLAR", {"s-7"}),
    ("festival", {"t-8", "mk-11", "x-12"}),
    ("river rowers", {"mk-11", "x-12"}),
    ("drain", set()),
    ("drains", {"n-13"}),
    ('"leaning tower"', {"t-8"}),
    ('"tower leaning"', set()),
    ("2.75", {"n-13"}),
    ("sundays-finally", {"tw-5"}),
    ("library -finally", {"mk-3"}),
    ('festival -"nine states"', {"t-8", "x-12"}),
    ("durian or monsoon", {"ig-7", "n-13"}),
    ("cat OR library noon", {"fb-9", "mk-3"}),
    ("kopi ;;; ((", {"fb-9"}),
    ("zeppelin", set()),
    ("(( ;;;", set()),
    ('"', set()),
]


@pytest.mark.parametrize("query,expected", KEYWORDS)
def test_keywords(spark, tables, query, expected):
    rows = tables[0].where(keywords.keyword_filter(query, F.col("search_text"))).select("external_id").collect()
    assert {row[0] for row in rows} == expected


def test_keyword_reading():
    def read(query):
        return [[(" ".join(t.words), t.negated) for t in group] for group in keywords.read_keywords(query)]

    assert read("a or b c") == [[("a", False)], [("b", False), ("c", False)]]
    assert read("or a or") == [[("or", False), ("a", False), ("or", False)]]
    assert read("a or or b") == [[("a", False)], [("or", False), ("b", False)]]
    assert read("order a") == [[("order", False), ("a", False)]]
    assert read('a -"b c" - d --e') == [[("a", False), ("b c", True), ("d", True), ("e", False)]]
    assert read('x"y z') == [[("x", False), ("y z", False)]]
    assert read("a or ???") == [[("a", False)]]
    assert read(" - ") == []


QUERIES = [query for query, _ in KEYWORDS] + ["-festival", "-festival or solar", '-"solar panels"', "???", '"panels solar"', "the the", '"the the"']


@pytest.fixture(scope="module")
def index(spark, with_undated, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings") / "index")
    layout = keyword_index.write_postings(with_undated[0], path)
    return keyword_index.KeywordIndex([keyword_index.Segment(keyword_index.read_postings(spark, path), layout)], with_undated[0])


@pytest.mark.parametrize("query", QUERIES)
def test_index_gives_the_same_mentions(with_undated, index, query):
    for more in ({}, {"source": "nst"}, {"since": dt.datetime(2025, 6, 8, tzinfo=dt.UTC)}):
        filters = Filters(q=query, **more)
        expected = {(row.id, row.source_slug, row.published_at) for row in filters.apply(with_undated[0]).collect()}
        assert {tuple(row) for row in index.matches(filters).collect()} == expected


def test_index_layouts_agree(spark, with_undated, tmp_path, monkeypatch):
    expected = sorted(map(tuple, keyword_index.gathered(keyword_index.occurrences(with_undated[0])).collect()))
    for size in (50, 300, 10**9):
        monkeypatch.setattr(keyword_index, "FILE_BYTES", size)
        path = str(tmp_path / str(size))
        layout = keyword_index.write_postings(with_undated[0], path)
        rows = keyword_index.read_postings(spark, path)
        assert (layout.buckets > 1) == (size < 10**9)
        assert sorted(map(tuple, rows.drop("bucket").collect())) == expected
        found = keyword_index.Segment(rows, layout).of(["festival", "solar"])
        assert {row.token for row in found.collect()} <= {"festival", "solar"} and found.count() > 0


def test_rows_with_equal_carried_columns_share_their_postings(spark, tmp_path):
    rows = [(None, "a", " x y x "), (None, "a", " y "), (1, "a", " x "), (1, "b", " x x "), (2, "a", "  "), (3, None, None)]
    named = spark.createDataFrame(rows, "id bigint, source_slug string, search_text string").withColumn("published_at", F.lit(None).cast("timestamp"))
    layout = keyword_index.write_postings(named, str(tmp_path / "index"))
    stored = keyword_index.read_postings(spark, str(tmp_path / "index")).drop("bucket")
    assert layout.buckets == 1
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, keyword_index.gathered(keyword_index.occurrences(named)).collect()))


def test_postings_of_one_task_fit_its_memory(spark, tmp_path, with_undated):
    """One task for each bucket and part, of 32 MB of text at most; rows are sorted once and not aggregated."""
    layout = keyword_index.Layout.of_bytes(6 << 30)
    assert layout.buckets * layout.parts >= 192
    with_undated[0].write.parquet(str(tmp_path / "mentions"))
    stored = spark.read.schema(schemas.STORED_MENTIONS).parquet(str(tmp_path / "mentions"))
    moved = keyword_index._own_words(keyword_index._dealt(stored, layout), "bucket", *keyword_index.CARRIED)
    assert "Aggregate" not in moved._jdf.queryExecution().executedPlan().toString()
    words = {(row.token, row.id): row.positions for row in moved.collect()}
    assert words == {(row.token, row.id): row.positions for row in keyword_index.gathered(keyword_index.occurrences(with_undated[0])).collect()}


def test_texts_are_read_for_a_page_only(spark, with_undated, tmp_path, index):
    with_undated[0].write.parquet(str(tmp_path / "mentions"))
    stored = spark.read.schema(schemas.STORED_MENTIONS).parquet(str(tmp_path / "mentions"))
    over = keyword_index.KeywordIndex(index.segments, stored)
    request = search.SearchRequest(Filters(q='"solar panels" -festival or -rowers', source="nst"), 5, 0)
    plans = [search.page_keys(stored, request, over), search.search_metadata(stored, request, over), stats.count_by_day(stored, request.filters, over)]
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "search_text" not in plan and "content" not in plan and "title" not in plan
        assert "IsNotNull(source_slug), EqualTo(source_slug,nst)" in plan
    one = search.page_keys(stored, search.SearchRequest(Filters(q="solar"), 5, 0), over)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in one and "positions" not in one
    assert re.search(r"PartitionFilters: \[[^]]*bucket#", one)


def test_outlet_by_slug_or_name(spark, tables):
    expected = ids(spark, tables, source="nst")
    assert expected == ["n-13", "n-4"]
    for spelling in ("New Straits Times", " new  STRAITS times "):
        assert ids(spark, tables, source=spelling) == expected
    assert ids(spark, tables, source="Teluk Intan Post") == ["t-8"] and ids(spark, tables, source="unheard-of") == []


def test_date_bounds(spark, tables):
    assert ids(spark, tables, since="2025-06-08", until="2025-06-08") == ["t-8", "x-12", "mk-11"]
    assert ids(spark, tables, since="04/06/2025", until="04/06/2025") == []
    assert ids(spark, tables, since="2025-06-08T05:00:00Z", until="2025-06-08T15:15:00Z") == ["x-12"]
    rows, _ = listing(spark, tables, since="2025-06-05", until="2025-06-06")
    assert rows and all("2025-06-04T16:00:00.000Z" <= r["published_at"] < "2025-06-06T16:00:00.000Z" for r in rows)
    assert "s-7" not in [r["external_id"] for r in rows]


def test_undated_rows_drop_out_only_under_a_date_bound(spark, with_undated):
    rows, about = listing(spark, with_undated, q="trial")
    assert len(rows) == 1 and rows[0]["published_at"] is None and about["note"] is None
    rows, about = listing(spark, with_undated, q="trial", since="2025-01-01")
    assert rows == [] and about["note"]
    assert {row["external_id"] for row in listing(spark, with_undated)[0][-2:]} == {None, "fb-9"}


def test_all_filters_together(spark, tables):
    arguments = dict(q="solar or library", source="Malaysia Kini", since="2025-06-05", until="2025-06-05", limit="3")
    assert ids(spark, tables, **arguments) == ["mk-3"]
    about = listing(spark, tables, **arguments)[1]
    assert (about["q"], about["source"], about["from"], about["to"]) == (
        "solar or library",
        "malaysiakini",
        "2025-06-04T16:00:00.000Z",
        "2025-06-05T16:00:00.000Z",
    )


def test_problems_are_reported_together(spark):
    with pytest.raises(ArgumentProblems) as found:
        search.read_search_request(spark, since="some day", limit="101", offset="-3")
    assert len(found.value.problems) == 3
    with pytest.raises(ArgumentProblems, match="empty range"):
        search.read_search_request(spark, since="2025-06-09", until="2025-06-02")
    with pytest.raises(ArgumentProblems, match="whole number"):
        search.read_search_request(spark, limit="ten")
    for grouping in (None, "", "author"):
        with pytest.raises(ArgumentProblems, match="group_by"):
            stats.read_stats_request(spark, group_by=grouping)
    assert stats.read_stats_request(spark, group_by=" Day ")[1] == "day"
    problems = []
    assert read_filters(spark, problems, q=" ", source="", since=None) == Filters() and problems == []


def test_counts_per_outlet(spark, tables):
    rows = stats.count_by_source(*tables).collect()
    assert [(row["source"], row["total"]) for row in rows] == [
        ("malaysiakini", 2),
        ("nst", 2),
        ("bernama", 1),
        ("facebook", 1),
        ("instagram", 1),
        ("teluk-intan-post", 1),
        ("thestar", 1),
        ("twitter", 1),
        ("unknown", 1),
    ]
    assert rows[1]["name"] == "New Straits Times" and rows[5]["platform"] == "other"
    assert stats.source_choices(*tables).collect() == rows


def test_counts_per_local_day(spark, tables, with_undated):
    rows = stats.count_by_day(tables[0]).collect()
    days = ["2025-06-09", "2025-06-08", "2025-06-07", "2025-06-06", "2025-06-05", "2025-06-03", None]
    assert [(row["day"], row["total"]) for row in rows] == list(zip(days, (1, 3, 2, 1, 2, 1, 1), strict=True))
    last = stats.count_by_day(with_undated[0]).collect()[-1]
    assert (last["day"], last["label"], last["total"]) == (None, stats.NO_DAY_LABEL, 2)


def test_list_and_counts_agree_for_every_filter(spark, with_undated):
    for arguments in (
        {},
        {"q": "festival"},
        {"q": "trial"},
        {"source": "Bernama"},
        {"since": "2025-06-07"},
        {"until": "2025-06-06"},
        {"q": "library or solar", "source": "thestar", "since": "2025-06-01", "until": "2025-06-30"},
        {"q": ";;;"},
    ):
        total = listing(spark, with_undated, **arguments)[1]["total"]
        for grouping in stats.GROUPINGS:
            filters, checked = stats.read_stats_request(spark, group_by=grouping, **arguments)
            about = stats.stats_metadata(stats.stats(*with_undated, filters, checked), filters, checked).first()
            assert about["total"] == total, (arguments, grouping)
            assert (about["timezone"] is not None) == (grouping == "day")


def test_summary_tiles(spark, with_undated):
    request = search.read_search_request(spark, limit=2)
    tiles = {row["tile"]: row["value"] for row in stats.summary_tiles(with_undated[0], request).collect()}
    assert tiles == {"total": 12, "sources": 9, "days": 6, "page_engagement": 17}
    empty = search.read_search_request(spark, q="zeppelin")
    tiles = {row["tile"]: row["value"] for row in stats.summary_tiles(with_undated[0], empty).collect()}
    assert set(tiles.values()) == {0}


def test_display_rows(spark, with_undated):
    shown = {row["id"]: row for row in search.display_rows(search.search(*with_undated, search.SearchRequest(Filters(), 100))).collect()}
    assert (shown[9_000]["shown_time"], shown[9_000]["heading"]) == ("no date", "Undated trial story")
    by_heading = {row["heading"]: row for row in shown.values()}
    assert by_heading["Library opens on Sundays"]["shown_time"] == "05 Jun, 00:00"
    assert by_heading["Durian season & long queues at the Raub stalls"]["snippet"] is None


def test_totals_of_several_filter_sets_take_one_scan(spark, with_undated, tmp_path):
    mentions, sources = with_undated
    mentions.write.parquet(str(tmp_path / "mentions"))
    stored = spark.read.schema(schemas.STORED_MENTIONS).parquet(str(tmp_path / "mentions"))
    sets = {"all": Filters(), "word": Filters(q="solar -rowers"), "outlet": Filters(source="nst"), "dated": Filters(since=dt.datetime(2025, 6, 8, tzinfo=dt.UTC)), "none": Filters(q="???")}
    fewer = sources.where("slug <> 'nst'")
    for known in (sources, fewer):
        expected = {}
        for name, filters in sets.items():
            expected[name, "list"] = search.search_metadata(mentions, search.SearchRequest(filters)).first()["total"]
            expected[name, "source"] = stats.stats_metadata(stats.count_by_source(mentions, known, filters), filters, "source").first()["total"]
            expected[name, "day"] = stats.stats_metadata(stats.count_by_day(mentions, filters), filters, "day").first()["total"]
        found = stats.totals(stored, known, sets)
        assert {(row.filters, row.part): row.total for row in found.collect()} == expected
        assert found._jdf.queryExecution().optimizedPlan().toString().count("search_text") and found.inputFiles()
        assert found._jdf.queryExecution().sparkPlan().toString().count("parquet") == 1
    assert {row.total for row in stats.totals(stored.where("id < 0"), sources, sets).collect()} == {0}
