"""Normalisation steps, table style: (input, expected)."""

import datetime as dt

from pyspark.sql import functions as F

from newsfold.functions.text import blank_to_null, decode_entities
from newsfold.functions.urls import canonical_url, url_host
from newsfold.operators.normalize import date_shape_census, renormalize_text, split_malformed, warning_rows
from tests.helpers import normalized_rows, record_rows

TEXTS = [
    ("<p>He called it &quot;done&quot; twice.</p>", 'He called it "done" twice.'),
    ("<h2>Tide table</h2><script type=x>var t = '<p>no</p>';</script>", "Tide table"),
    ("keep &lt;iframe src=q&gt;hidden&lt;/iframe&gt; going", "keep going"),
    ("<blockquote>left</blockquote><blockquote>right</blockquote>", "left right"),
    ("7 < 9 and 9 > 7", "7 < 9 and 9 > 7"),
    ("Nothing to strip here.", "Nothing to strip here."),
    ("k&nbsp;l \u200bm\ufeffn\u3000o", "k l m n o"),
    ("&amp;lt;i&amp;gt;", "&lt;i&gt;"),
    ("&#75;&#x4C;&#X4d;&AMP;&unheard;&#0;&#xDFFF;&#99999999999;&#x110000;", "KLM&&unheard;&#0;&#xDFFF;&#99999999999;&#x110000;"),
    ("&#127754; &copy; &hellip;", "\U0001f30a &copy; …"),
    ("q<STYLE media=a>i{}</style >r<iframe src=b>s</iframe>t", "q r t"),
    ("up</script>middle<script>down", "up middle down"),
    ("m<!-- n\n<i> -->o", "m o"),
    ("<h3>alpha</h3><h3>beta</h3>", "alpha beta"),
    ("<td>8</td><em>9</em><u>0</u>", "8 90"),
    ("<p2>k<c_d>l<c-_d>m", "k<c_d>lm"),
    ("r<em or not>s", "rs"),
    ("<x-y_>k", "k"),
    ("<pö>k", "k"),
    ("", ""),
    (None, ""),
    (81, ""),
]


def test_html_to_text(spark):
    rows = normalized_rows(spark, [{"content": html} for html, _ in TEXTS])
    assert [row["content_clean"] for row in rows] == [text for _, text in TEXTS]


def test_entities_are_decoded_in_one_pass(spark):
    frame = spark.createDataFrame([("&amp;amp;#65; & &lt",)], "t string")
    assert frame.select(decode_entities(F.col("t"))).first()[0] == "&amp;#65; & &lt"


def test_blank_is_null(spark):
    frame = spark.createDataFrame([(None,), ("",), ("   ",), (" ​",), ("  Bank  Negara ",)], "t string")
    assert [row[0] for row in frame.select(blank_to_null(F.col("t"))).collect()] == [None] * 4 + ["Bank Negara"]


ENGAGEMENTS = [
    ("1,204", 1204),
    ("3,402", 3402),
    (" 1_000 ", 1000),
    ("1'000", 1000),
    ("1.204", 1),
    ("2.5", 3),
    (412, 412),
    (0, 0),
    (1.5, 2),
    (1.49, 1),
    (None, None),
    ("banyak", None),
    ("", None),
    (".5", None),
    (-5, None),
    ("-5", None),
    (True, None),
    ([1], None),
    (1e30, None),
]


def test_engagement(spark):
    rows = normalized_rows(spark, [{"engagement": value} for value, _ in ENGAGEMENTS])
    assert [row["engagement"] for row in rows] == [count for _, count in ENGAGEMENTS]
    unreadable = ["ENGAGEMENT_UNREADABLE" in row["warnings"] for row in rows]
    assert unreadable == [count is None and value is not None for value, count in ENGAGEMENTS]


# The shapes and instants that the date rules prescribe.
DATES = [
    ("2026-08-10T08:15:00Z", "2026-08-10T08:15:00", "iso-dengan-zona"),
    ("2026-08-11T14:02:33+08:00", "2026-08-11T06:02:33", "iso-dengan-zona"),
    ("2026-08-11T14:02:33+0800", "2026-08-11T06:02:33", "iso-dengan-zona"),
    ("2026-08-11 14:02-05:30", "2026-08-11T19:32:00", "iso-dengan-zona"),
    ("2026-08-10t08:15:00.123456z", "2026-08-10T08:15:00.123000", "iso-dengan-zona"),
    ("2026-08-10 08:20:00", "2026-08-10T08:20:00", "iso-tanpa-zona"),
    (" 2026-08-10T08:20 ", "2026-08-10T08:20:00", "iso-tanpa-zona"),
    (1786435200, "2026-08-11T08:00:00", "angka-unix"),
    (1786435200000, "2026-08-11T08:00:00", "angka-unix"),
    (1786435200.5, "2026-08-11T08:00:00.500000", "angka-unix"),
    ("1786435200", "2026-08-11T08:00:00", "angka-unix"),
    ("1786435200000", "2026-08-11T08:00:00", "angka-unix"),
    ("2026-08-11", "2026-08-10T16:00:00", "tanggal-saja"),
    ("11/08/2026", "2026-08-10T16:00:00", "hari-bulan-tahun"),
    ("1-8-2026", "2026-07-31T16:00:00", "hari-bulan-tahun"),
    ("25.12.2026", "2026-12-24T16:00:00", "hari-bulan-tahun"),
    ("12/25/2026", "2026-12-24T16:00:00", "hari-bulan-tahun"),
    ("2100-12-31T23:59:59Z", "2100-12-31T23:59:59", "iso-dengan-zona"),
    ("2000-01-01T00:00:00Z", "2000-01-01T00:00:00", "iso-dengan-zona"),
    (None, None, "tidak-ada"),
    ("   ", None, "tidak-ada"),
    ("minggu lalu", None, "gagal-dibaca"),
    ("31/02/2026", None, "gagal-dibaca"),
    ("13/13/2026", None, "gagal-dibaca"),
    ("00/08/2026", None, "gagal-dibaca"),
    ("2026-13-01T00:00:00Z", None, "gagal-dibaca"),
    ("2026-02-31", None, "gagal-dibaca"),
    ("2026-08-10T08:15.5Z", None, "gagal-dibaca"),
    ("1999-12-31T23:59:59Z", None, "gagal-dibaca"),
    ("2000-01-01", None, "gagal-dibaca"),
    ("2101-01-01T00:00:00Z", None, "gagal-dibaca"),
    (1786435, None, "gagal-dibaca"),
    (1e300, None, "gagal-dibaca"),
    (True, None, "gagal-dibaca"),
    ({"a": 1}, None, "gagal-dibaca"),
]


def test_dates(spark):
    rows = normalized_rows(spark, [{"published_at": value} for value, _, _ in DATES])
    instants = [row["published_at"] and row["published_at"].isoformat() for row in rows]
    assert instants == [instant for _, instant, _ in DATES]
    assert [row["date_shape"] for row in rows] == [shape for _, _, shape in DATES]


def test_absent_date_is_missing(spark):
    (row,) = normalized_rows(spark, [{}])
    assert (row["published_at"], row["date_shape"], row["published_at_raw"]) == (None, "tidak-ada", None)


def test_raw_date_is_kept_untrimmed(spark):
    rows = normalized_rows(spark, [{"published_at": v} for v in (" 11/08/2026 ", 1786435200, False, {"a": 1})])
    assert [row["published_at_raw"] for row in rows] == [" 11/08/2026 ", "1786435200", "false", '{"a":1}']


def test_dates_do_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        from newsfold.functions import dates

        read = dates.read_published(F.lit("string"), F.lit(None).cast("double"), F.lit("11/08/2026"))
        at = dates.published_at(read)
        frame = spark.range(1).select(dates.iso_utc(at), dates.local_day(at), dates.local_display_time(at))
        assert tuple(frame.first()) == ("2026-08-10T16:00:00.000Z", "2026-08-11", "11 Aug, 00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# Labels and hosts of the outlet list.
OUTLETS = [
    ("The Star", None, "thestar"),
    ("thestar", None, "thestar"),
    ("THE STAR", None, "thestar"),
    ("  the   star  ", None, "thestar"),
    ("malaysiakini ", None, "malaysiakini"),
    ("Malaysia Kini", None, "malaysiakini"),
    ("twitter", None, "twitter"),
    ("TWITTER", None, "twitter"),
    ("X", None, "twitter"),
    ("fb", None, "facebook"),
    ("Berita  Harian", None, "berita-harian"),
    (None, None, "unknown"),
    ("", None, "unknown"),
    ("???", None, "unknown"),
    (7, None, "unknown"),
    ("New Straits Times", "https://www.thestar.com.my/biz/1", "thestar"),
    (None, "https://amp.thestar.com.my/news/1", "thestar"),
    ("The Star", "https://elsewhere.example.org/x", "thestar"),
    (None, "https://notthestar.com.my/x", "unknown"),
    (None, "ftp://m.x.com/a", "twitter"),
    ("Bernama", "not a url", "bernama"),
]


def test_outlets(spark):
    rows = normalized_rows(spark, [{"source": label, "url": url} for label, url, _ in OUTLETS])
    assert [row["source_slug"] for row in rows] == [slug for _, _, slug in OUTLETS]


def test_unlisted_outlet_keeps_its_name(spark):
    row, unknown, listed = normalized_rows(spark, [{"source": " Berita \t Harian "}, {}, {"source": "ig"}])
    assert (row["display_name"], row["platform"]) == ("Berita Harian", "other")
    assert (unknown["display_name"], unknown["platform"]) == ("Tidak diketahui", "other")
    assert (listed["display_name"], listed["platform"]) == ("Instagram", "instagram")
    assert "SOURCE_UNLISTED" in row["warnings"] and "SOURCE_UNKNOWN" in unknown["warnings"]


URLS = [
    ("https://www.thestar.com.my/biz/palm?utm_source=x", "thestar.com.my", "thestar.com.my/biz/palm"),
    ("HTTP://User:pw@WWW.Example.COM:8080/A/b//?b=2&a=1&FBCLID=z&ref=q#top", "example.com", "example.com/A/b?a=1&b=2"),
    ("https://example.com", "example.com", "example.com"),
    ("https://example.com/?", "example.com", "example.com"),
    ("https://www.www.example.com/", "www.example.com", "www.example.com"),
    ("https:example.com/x", "example.com", "example.com/x"),
    ("https:\\\\example.com\\x\\y", "example.com", "example.com/x/y"),
    ("https://example.com/a b|c/é\"<>", "example.com", "example.com/a%20b|c/%C3%A9%22%3C%3E"),
    ("https://example.com/a/./b/../c/%2e%2E/d/..", "example.com", "example.com/a"),
    ("https://example.com/x?k&j=&l=a b+c%20d&m=%zz&n=é", "example.com", "example.com/x?j=&k=&l=a+b+c+d&m=%25zz&n=%C3%A9"),
    ("https://example.com/x?a=2&a=1", "example.com", "example.com/x?a=2&a=1"),
    ("https://example.com/x?reference=1&refs=2", "example.com", "example.com/x?reference=1&refs=2"),
    ("https://example.com/x?q=a=b", "example.com", "example.com/x?q=a%3Db"),
    ("https://[::1]:80/x", "[::1]", "[::1]/x"),
    ("ftp://files.example.com/x", "files.example.com", None),
    ("javascript:alert(1)", None, None),
    ("mailto:a@b.c", None, None),
    ("https://", None, None),
    ("https://exa mple.com/", None, None),
    ("https://example.com:99999/", None, None),
    ("/relative", None, None),
    (None, None, None),
]


def test_urls(spark):
    frame = spark.createDataFrame([(at, url) for at, (url, _, _) in enumerate(URLS)], "at int, url string")
    out = frame.select("at", "url", url_host(F.col("url")), canonical_url(F.col("url"))).orderBy("at")
    assert [tuple(row[1:]) for row in out.collect()] == URLS


def test_keys_follow_title_then_content_then_url_then_id(spark):
    import hashlib

    long_title = "A" * 299 + " b tail"
    rows = normalized_rows(
        spark,
        [
            {"source": "ig", "title": "Second-half, GDP!"},
            {"source": "ig", "title": "second half gdp \U0001f602", "content": "other"},
            {"source": "ig", "title": "!!!", "content": "Isi  berita"},
            {"source": "ig", "url": "https://a.example/x/"},
            {"source": "ig", "external_id": " 7 "},
            {"source": "ig"},
            {"source": "ig", "title": long_title},
        ],
    )
    material = [
        "second half gdp",
        "second half gdp",
        "isi berita",
        "url:a.example/x",
        "id:7",
        "id:",
        "a" * 299,
    ]
    expected = [hashlib.sha256(f"instagram|{text}".encode()).hexdigest() for text in material]
    assert [row["dedupe_key"] for row in rows] == expected


def test_malformed_rows_are_split_off(spark, feed_records):
    values = [feed_records[0], "text", 42, None, feed_records[3], [1], '{"a": 1}', {}]
    objects, bad = split_malformed(record_rows(spark, values))
    assert sorted(row["arrival_seq"] for row in bad.collect()) == [1, 2, 3, 5, 6]
    assert sorted(row["arrival_seq"] for row in objects.select("arrival_seq").collect()) == [0, 4, 7]


def test_warnings_of_the_feed(normalized):
    rows = {row["arrival_seq"]: row["warnings"] for row in normalized.collect()}
    assert {at for at, found in rows.items() if "CONTENT_CLEANED" in found} == {0, 1, 3, 9}
    assert rows[6] == ["DATE_MISSING"] and rows[12] == ["SOURCE_UNKNOWN"]
    assert set(rows[8]) == {"SOURCE_UNLISTED", "ENGAGEMENT_UNREADABLE"}
    assert set(rows[9]) == {"CONTENT_CLEANED", "DATE_UNREADABLE"}


def test_warnings_name_the_value_at_fault(normalized):
    rows = {(row["arrival_seq"], row["warning"]): row["value"] for row in warning_rows(normalized).collect()}
    assert rows[9, "DATE_UNREADABLE"] == "yesterday" and rows[8, "ENGAGEMENT_UNREADABLE"] == "n/a"
    assert rows[8, "SOURCE_UNLISTED"] == "Teluk Intan Post" and rows[6, "DATE_MISSING"] is None


def test_date_shape_census(normalized):
    counts = {row["date_shape"]: row["records"] for row in date_shape_census(normalized).collect()}
    assert counts == {
        "iso-dengan-zona": 8,
        "iso-tanpa-zona": 1,
        "angka-unix": 1,
        "hari-bulan-tahun": 1,
        "tanggal-saja": 1,
        "gagal-dibaca": 1,
        "tidak-ada": 1,
    }


def test_text_is_recomputed_from_raw(spark, tables):
    mentions, _ = tables
    spoiled = mentions.withColumn("content_clean", F.lit("spoiled"))
    again = {row["id"]: row["content_clean"] for row in renormalize_text(spoiled).collect()}
    assert again == {row["id"]: row["content_clean"] for row in mentions.collect()}


def test_published_instant_of_the_feed(normalized):
    row = normalized.where("external_id = 'mk-3'").select(F.unix_millis("published_at")).first()
    assert dt.datetime.fromtimestamp(row[0] / 1000, dt.UTC).isoformat() == "2025-06-04T16:00:00+00:00"
