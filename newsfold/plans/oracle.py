"""The registered queries again as SQL for another engine, written from the rules, not from the jobs."""

from __future__ import annotations

from newsfold.functions.text import NAMED_ENTITIES
from newsfold.functions.urls import TRACKING_PARAM
from newsfold.operators.filters import UNDATED_NOTE

WS = r"[\s\x{0B}\p{Z}\x{200B}\x{FEFF}]+"
ENTITY = r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+);"
NAMED = {name: text.replace("'", "''") for name, text in NAMED_ENTITIES.items()}
START, END = "TIMESTAMP '2024-01-09 16:00:00'", "TIMESTAMP '2024-01-20 16:00:00'"

DAY_ONE, DAY_TWO = "TIMESTAMP '2024-01-01 16:00:00'", "TIMESTAMP '2024-01-02 16:00:00'"


def sub(text: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def collapsed(text: str) -> str:
    return f"trim({sub(text, WS)}, ' ')"


def strip_tags(text: str, blocks: bool) -> str:
    for tag in ("script", "style", "iframe"):
        text = sub(text, rf"(?i)<{tag}\b[^>]*>[\s\S]*?</{tag}\s*>")
    text = sub(text, r"(?i)</?(script|style|iframe)\b[^>]*>")
    if blocks:
        text = sub(text, r"<!--[\s\S]*?-->")
        text = sub(text, r"(?i)</?(p|div|br|li|tr|td|h[1-6]|blockquote)\b[^>]*>")
    return sub(text, r"(?i)</?[a-z][a-z0-9-]*\b[^>]*>", "")


def decoded_entity(e: str) -> str:
    names = " ".join(f"WHEN '&{name};' THEN '{char}'" for name, char in NAMED.items())
    return f"CASE lower({e}) {names} ELSE {e} END"


def html_ctes(source: str, name: str) -> str:
    """CTE ``name``: the rows of ``source`` (with ``html``) plus ``text``. Numeric entities do not
    occur in the supplied pages."""
    return rf"""
    {name}_1 AS (SELECT *, {strip_tags("html", True)} AS t1 FROM {source}),
    {name}_2 AS (SELECT *, array_to_string(list_transform(list_zip(
        string_split_regex(t1, '{ENTITY}'), regexp_extract_all(t1, '{ENTITY}')),
        lambda p: concat(p[1], {decoded_entity("p[2]")})), '') AS t2 FROM {name}_1),
    {name} AS (SELECT * EXCLUDE (t1, t2), {collapsed(strip_tags("t2", False))} AS text FROM {name}_2)"""


def words_only(text: str) -> str:
    return f"trim({sub(f'lower({text})', r'[^\p{L}\p{N}]+')}, ' ')"


def fp(text: str) -> str:
    return f"trim(substring({words_only(text)}, 1, 300), ' ')"


def iso(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def day(moment: str) -> str:
    return f"strftime({moment} + INTERVAL 8 HOURS, '%Y-%m-%d')"


HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\.', '')"
KEPT = (
    "list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), "
    "lambda p: p <> '' AND NOT regexp_matches(string_split(p, '=')[1], "
    f"'{TRACKING_PARAM}')))"
)
PATH = "regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')"
CANONICAL = f"{HOST} || {PATH} || CASE WHEN len({KEPT}) > 0 THEN '?' || array_to_string({KEPT}, '&') ELSE '' END"
LABEL = "regexp_extract(url, '://([^./]+)', 1)"
SIMPLE = sub(f"lower({LABEL})", "[^a-z0-9]+")
PAGE_OUTLET = f"""
    CASE WHEN {HOST} = 'example.com' OR {HOST} LIKE '%.example.com' THEN 'example-com'
         WHEN {HOST} = 'example.net' OR {HOST} LIKE '%.example.net' THEN 'example-net'
         WHEN trim({SIMPLE}, ' ') = 'blog' THEN 'example-com'
         WHEN trim({SIMPLE}, ' ') <> '' THEN replace(trim({SIMPLE}, ' '), ' ', '-')
         ELSE 'unknown' END"""


def named_outlet(slug: str, own: str) -> tuple[str, str]:
    name = f"CASE {slug} WHEN 'example-com' THEN 'Example Com' WHEN 'example-net' THEN 'Example Net' ELSE {own} END"
    return name, f"CASE {slug} WHEN 'example-com' THEN 'news' ELSE 'other' END"


PAGE_NAME, PAGE_PLATFORM = named_outlet("source_slug", "label")

PAGES = f"""
    heads AS (SELECT page_id, regexp_extract(html, '<h1>[\\s\\S]*?</h1>') AS html FROM pages),
    {html_ctes("heads", "titles")},
    {html_ctes("pages", "bodies")},
    page_rows AS (
        SELECT b.page_id, b.html, b.text AS content, nullif(t.text, '') AS title, {LABEL} AS label,
               {PAGE_OUTLET} AS source_slug, {CANONICAL} AS canonical_url
        FROM bodies b JOIN titles t USING (page_id)),
    page_keys AS (
        SELECT *, sha256(source_slug || '|' || CASE
            WHEN coalesce({fp("title")}, '') <> '' THEN {fp("title")}
            WHEN {fp("content")} <> '' THEN {fp("content")}
            ELSE 'url:' || canonical_url END) AS dedupe_key
        FROM page_rows)"""

DOC_KEYS = f"""
    doc_keys AS (
        SELECT *, sha256(lang || '|' || CASE WHEN {fp("text")} <> '' THEN {fp("text")} ELSE 'id:' END) AS dedupe_key
        FROM documents)"""


def doc_fold(order: str) -> str:
    return f"""
    SELECT dedupe_key, min({order}) AS id, min(lang) AS source_slug,
           arg_min(source, {order}) FILTER (source <> 'src3') AS author,
           arg_max(text, (length(text), -({order}))) AS content_clean,
           max(n_chars) AS engagement, count(*) AS times_seen
    FROM doc_keys GROUP BY dedupe_key"""


LATE = "CAST(regexp_extract(source, '[0-9]+') AS INTEGER) >= 10"
LATE_ID = f"doc_id + CASE WHEN {LATE} THEN 1000000000000 ELSE 0 END"

DOC_MENTIONS = f"""
    doc_mentions AS (
        SELECT d.doc_id, d.source, d.n_chars, d.text, e.ts AS published_at, ' ' || {words_only("d.text")} || ' ' AS words
        FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id)"""

DISPLAY = "ORDER BY published_at DESC NULLS LAST, doc_id DESC"


def has(words: str) -> str:
    return f"contains(words, ' {words} ')"


def found(condition: str) -> str:
    return f"WITH {DOC_MENTIONS} SELECT doc_id FROM doc_mentions WHERE {condition}"


def doc_page(condition: str, limit: int, offset: int | str) -> str:
    return f"""
    WITH {DOC_MENTIONS},
    page AS (SELECT * FROM doc_mentions WHERE {condition} {DISPLAY} LIMIT {limit} OFFSET {offset})
    SELECT CAST(row_number() OVER ({DISPLAY}) AS INTEGER) AS rank, doc_id, source AS slug,
           'Crawler ' || regexp_extract(source, '[0-9]+') AS name, {iso("published_at")} AS published_at,
           n_chars AS engagement
    FROM page"""


def doc_metadata(condition: str, limit: int, offset: int, q: str, source: str, since: str, until: str) -> str:
    return f"""
    WITH {DOC_MENTIONS}, counted AS (SELECT count(*) AS total FROM doc_mentions WHERE {condition})
    SELECT CAST({limit} AS BIGINT) AS "limit", CAST({offset} AS BIGINT) AS "offset", total,
           greatest(0, least({limit}, total - {offset})) AS returned,
           {offset} + greatest(0, least({limit}, total - {offset})) < total AS has_more,
           CAST({q} AS VARCHAR) AS q, CAST({source} AS VARCHAR) AS source,
           CAST({since} AS VARCHAR) AS "from", CAST({until} AS VARCHAR) AS "to"
    FROM counted"""


# Dates and counts as the loosely typed feeds render them: what they must be read back as.
MIDNIGHT = "date_trunc('day', ts) - INTERVAL 8 HOURS"
SWAPPED = (
    "CASE WHEN day(ts) > 12 THEN date_trunc('day', ts) "
    "ELSE CAST(make_date(year(ts), day(ts), month(ts)) AS TIMESTAMP) END - INTERVAL 8 HOURS"
)
READ_DATE = f"""
    CASE WHEN hour(ts) < 6 OR hour(ts) BETWEEN 9 AND 11 THEN date_trunc('second', ts)
         WHEN hour(ts) < 9 THEN date_trunc('minute', ts)
         WHEN hour(ts) BETWEEN 12 AND 14 THEN date_trunc('millisecond', ts)
         WHEN hour(ts) BETWEEN 15 AND 20 THEN {MIDNIGHT}
         WHEN hour(ts) = 23 THEN {SWAPPED} END"""
RAW_DATE = """
    CASE WHEN hour(ts) < 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         WHEN hour(ts) < 6 THEN strftime(ts + INTERVAL 8 HOURS, '%Y-%m-%d %H:%M:%S') || '+08:00'
         WHEN hour(ts) < 9 THEN strftime(ts, '%Y-%m-%d %H:%M')
         WHEN hour(ts) < 12 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
         WHEN hour(ts) < 15 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
         WHEN hour(ts) < 18 THEN strftime(ts, '%Y-%m-%d')
         WHEN hour(ts) < 21 THEN day(ts) || '/' || month(ts) || '/' || year(ts)
         WHEN hour(ts) = 22 THEN 'kemarin'
         WHEN hour(ts) = 23 THEN strftime(ts, '%m-%d-%Y') END"""
SHAPE = """
    CASE WHEN ts IS NULL OR hour(ts) = 21 THEN 'tidak-ada'
         WHEN hour(ts) < 6 THEN 'iso-dengan-zona'
         WHEN hour(ts) < 9 THEN 'iso-tanpa-zona'
         WHEN hour(ts) < 15 THEN 'angka-unix'
         WHEN hour(ts) < 18 THEN 'tanggal-saja'
         WHEN hour(ts) = 22 THEN 'gagal-dibaca'
         ELSE 'hari-bulan-tahun' END"""
ROUNDED = "CAST(floor(value) + CASE WHEN value - floor(value) >= 0.5 THEN 1 ELSE 0 END AS BIGINT)"
COUNT = f"""
    CASE event_type WHEN 'click' THEN CAST(round(value * 100) AS BIGINT)
         WHEN 'purchase' THEN {ROUNDED} WHEN 'view' THEN {ROUNDED} END"""
DATE_KIND = """
    CASE WHEN hour(ts) BETWEEN 9 AND 11 THEN 'number' WHEN hour(ts) = 21 THEN 'null' ELSE 'string' END"""
COUNT_KIND = "CASE event_type WHEN 'view' THEN 'number' WHEN 'signup' THEN 'null' ELSE 'string' END"

DATED = f"""
    dated AS (
        SELECT *, {READ_DATE} AS published_at, {RAW_DATE} AS published_at_raw, {SHAPE} AS date_shape,
               {COUNT} AS engagement
        FROM events)"""

SENT = """(SELECT d.doc_id, d.lang, d.source, e.ts, e.event_type, e.value, e.user_id,
        '<p>' || replace(d.text, chr(10), '</p><p>') || '</p>' AS html
        FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id)"""

FEED = f"""
    {html_ctes(SENT, "feed_text")},
    feed_rows AS (
        SELECT doc_id, source, html AS content_raw, text AS content_clean,
               CASE lang WHEN 'en' THEN 'thestar' WHEN 'fr' THEN 'nst' WHEN 'de' THEN 'berita-harian'
                    ELSE 'twitter' END AS source_slug,
               'doc-' || doc_id AS external_id,
               CASE WHEN lang = 'es' THEN 'https://m.twitter.com/s/' || source || '/?utm_source=x&id=' || doc_id
                    WHEN event_type = 'signup' THEN 'mailto:desk@example.com' END AS url,
               CASE WHEN lang = 'es' THEN 'm.twitter.com/s/' || source || '?id=' || doc_id END AS canonical_url,
               CASE WHEN event_type <> 'error' THEN 'user ' || user_id END AS author,
               CASE WHEN ts IS NULL THEN NULL ELSE {READ_DATE} END AS published_at,
               CASE WHEN ts IS NULL THEN NULL ELSE {RAW_DATE} END AS published_at_raw,
               {SHAPE} AS date_shape,
               {COUNT} AS engagement,
               event_type
        FROM feed_text),
    feed_keys AS (
        SELECT *, row_number() OVER (ORDER BY {LATE}, doc_id) - 1 AS arrival, sha256(source_slug || '|' || CASE
            WHEN {fp("content_clean")} <> '' THEN {fp("content_clean")}
            WHEN canonical_url IS NOT NULL THEN 'url:' || canonical_url
            ELSE 'id:' || external_id END) AS dedupe_key
        FROM feed_rows)"""


def feed_fold(order: str) -> str:
    """One row per key, each rule on its own."""

    def first(name: str) -> str:
        return f"arg_min({name}, {order}) FILTER ({name} IS NOT NULL) AS {name}"

    return f"""
        SELECT dedupe_key, min({order}) AS id, min(source_slug) AS source_slug,
               {first("external_id")}, {first("url")}, {first("canonical_url")}, {first("author")},
               arg_max(content_raw, (length(content_clean), -({order}))) AS content_raw,
               arg_max(content_clean, (length(content_clean), -({order}))) AS content_clean,
               {iso("min(published_at)")} AS published_at,
               coalesce(arg_min(published_at_raw, (published_at, {order})) FILTER (published_at IS NOT NULL),
                        arg_min(published_at_raw, {order}) FILTER (published_at_raw IS NOT NULL)) AS published_at_raw,
               max(engagement) AS engagement, count(*) AS times_seen
        FROM feed_keys GROUP BY dedupe_key"""


FEED_LATE = "arrival"  # numbers of arrival have no gaps, the late batch comes after the first one
FEED_NAME = {
    "thestar": "The Star",
    "nst": "New Straits Times",
    "berita-harian": "Berita Harian",
    "twitter": "Twitter / X",
}


def feed_outlet(slug: str) -> tuple[str, str]:
    names = " ".join(f"WHEN '{key}' THEN '{name}'" for key, name in FEED_NAME.items())
    platforms = "WHEN 'berita-harian' THEN 'other' WHEN 'twitter' THEN 'twitter' ELSE 'news'"
    return f"CASE {slug} {names} END", f"CASE {slug} {platforms} END"


FEED_WARNINGS = """
        SELECT source, doc_id, unnest(list_filter([
            CASE WHEN source_slug = 'berita-harian' THEN 'SOURCE_UNLISTED' END,
            CASE WHEN url IS NOT NULL AND canonical_url IS NULL THEN 'URL_UNUSABLE' END,
            CASE WHEN content_raw <> content_clean THEN 'CONTENT_CLEANED' END,
            CASE WHEN content_clean = '' THEN 'NO_TEXT' END,
            CASE WHEN date_shape = 'tidak-ada' THEN 'DATE_MISSING' END,
            CASE WHEN date_shape = 'gagal-dibaca' THEN 'DATE_UNREADABLE' END,
            CASE WHEN event_type = 'error' THEN 'ENGAGEMENT_UNREADABLE' END], lambda w: w IS NOT NULL)) AS warning
        FROM feed_keys"""

UNDATED_EVENTS = """
    event_mentions AS (
        SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN ts END AS published_at, event_type AS source_slug
        FROM events)"""


def by_day(source: str, condition: str = "TRUE") -> str:
    return f"""
    SELECT day, coalesce(day, 'tanpa tanggal') AS label, count(*) AS total
    FROM (SELECT {day("published_at")} AS day FROM {source} WHERE {condition}) GROUP BY day"""


IN_FIRST_DAY = f"published_at >= {DAY_ONE} AND published_at < {DAY_TWO}"
IN_WINDOW = f"published_at >= {START} AND published_at < {END}"
FILTER_SETS = {
    "none": "TRUE",
    "word": has("the"),
    "outlet": "source = 'src7'",
    "dates": IN_FIRST_DAY,
    "all": f"{has('of')} AND NOT {has('with')} AND source = 'src1' AND published_at >= {DAY_ONE}",
}


def sql() -> dict[str, str]:
    page_name, page_platform = named_outlet(PAGE_OUTLET, LABEL)
    feed_name, feed_platform = feed_outlet("source_slug")
    totals = " UNION ALL ".join(
        f"SELECT '{name}' AS filters, part, count(*) FILTER ({condition}) AS total "
        f"FROM doc_mentions, (VALUES ('list'), ('source'), ('day')) parts(part) GROUP BY part"
        for name, condition in FILTER_SETS.items()
    )
    two_batches = f"WITH {DOC_KEYS} {doc_fold(LATE_ID)}"
    stored = f"WITH {FEED} {feed_fold(FEED_LATE)}"
    return {
        "page_host": f"SELECT page_id, {HOST} AS host FROM pages",
        "page_canonical_url": f"SELECT page_id, {CANONICAL} AS canonical_url FROM pages",
        "page_outlet": f"SELECT page_id, {PAGE_OUTLET} AS source_slug, {page_name} AS display_name, "
        f"{page_platform} AS platform FROM pages",
        "page_text": f"WITH {html_ctes('pages', 'bodies')} SELECT page_id, text FROM bodies",
        "page_normalized": f"""WITH {PAGES}
            SELECT page_id, source_slug, 'page-' || page_id AS external_id, canonical_url, title, dedupe_key,
                   CASE WHEN {PAGE_PLATFORM} = 'other' THEN 'SOURCE_UNLISTED,' ELSE '' END
                   || CASE WHEN html <> content THEN 'CONTENT_CLEANED,' ELSE '' END
                   || CASE WHEN title IS NULL AND content = '' THEN 'NO_TEXT,' ELSE '' END
                   || 'DATE_MISSING' AS warnings
            FROM page_keys""",
        "page_count_by_outlet": f"""WITH {PAGES}
            SELECT source_slug AS source, {named_outlet("source_slug", "min(label)")[0]} AS name,
                   {PAGE_PLATFORM} AS platform, count(DISTINCT dedupe_key) AS total
            FROM page_keys GROUP BY source_slug""",
        "page_renormalized": f"""WITH {PAGES}
            SELECT dedupe_key, arg_max(content, (length(content), -page_id)) AS content_clean
            FROM page_keys GROUP BY dedupe_key""",
        "page_merged": f"""WITH {PAGES}
            SELECT dedupe_key, min(page_id) AS id, arg_min(title, page_id) FILTER (title IS NOT NULL) AS title,
                   arg_max(content, (length(content), -page_id)) AS content_clean, arg_min(p.url, page_id) AS url,
                   arg_min(canonical_url, page_id) AS canonical_url, 'page-' || min(page_id) AS external_id, count(*) AS times_seen
            FROM page_keys JOIN (SELECT page_id, url FROM pages) p USING (page_id) GROUP BY dedupe_key""",
        "doc_fingerprint": f"SELECT doc_id, {fp('text')} AS fingerprint FROM documents",
        "doc_dedupe_key": f"WITH {DOC_KEYS} SELECT doc_id, dedupe_key FROM doc_keys",
        "doc_merge": f"WITH {DOC_KEYS} {doc_fold('doc_id')}",
        "doc_upsert_two_batches": two_batches,
        "doc_overlay_two_batches": two_batches,
        "doc_upsert_counts": f"""WITH {DOC_KEYS},
            keyed AS (SELECT dedupe_key, bool_or(NOT {LATE}) AS stored, count(*) FILTER ({LATE}) AS sent
                      FROM doc_keys GROUP BY dedupe_key)
            SELECT count(*) FILTER (NOT stored) AS inserted,
                   CAST(sum(sent) AS BIGINT) - count(*) FILTER (NOT stored) AS merged FROM keyed WHERE sent > 0""",
        "doc_search_word": found(has("with")),
        "doc_search_all_words": found(f"{has('the')} AND {has('with')} AND {has('from')}"),
        "doc_search_phrase": found(has("of the")),
        "doc_search_not": found(f"{has('the')} AND NOT {has('with')} AND NOT {has('of the')}"),
        "doc_search_or": found(f"({has('und')} AND {has('from')}) OR ({has('la')} AND {has('des')})"),
        "doc_search_compound": found(has("of the")),
        "doc_search_punctuation": f"""WITH {DOC_MENTIONS}
            SELECT source AS source_slug, count(*) AS documents, CAST(0 AS BIGINT) AS none, count(*) FILTER ({has("the")}) AS some
            FROM doc_mentions GROUP BY source""",
        "doc_search_all_filters": found(f"{has('the')} AND source = 'src7' AND {IN_FIRST_DAY}"),
        "doc_index": f"""WITH {DOC_MENTIONS},
            tokens AS (SELECT doc_id, unnest(string_split(trim(words, ' '), ' ')) AS token FROM doc_mentions)
            SELECT token, count(DISTINCT doc_id) AS documents, count(*) AS places FROM tokens WHERE token <> '' GROUP BY token""",
        "doc_index_search": f"""WITH {DOC_MENTIONS}
            SELECT 0 AS request, doc_id FROM doc_mentions
            WHERE ({has("of the")} AND NOT {has("with")}) OR {has("la de")} OR ({has("und")} AND {has("from")})
            UNION ALL SELECT 1, doc_id FROM doc_mentions WHERE NOT {has("the")} AND NOT {has("la")} AND NOT {has("der die")}""",
        "doc_search_page": doc_page(has("the"), 20, 0),
        "doc_search_third_page": doc_page("TRUE", 25, 50),
        "doc_search_past_end": doc_page("TRUE", 20, "greatest(0, (SELECT count(*) FROM documents) - 7)"),
        "doc_search_problems": """
            SELECT source AS outlet, request, replace(problem, '%', source) AS problem
            FROM (SELECT source, row_number() OVER (ORDER BY source) = 1 AS first FROM (SELECT DISTINCT source FROM documents)), (VALUES
                ('list', 'limit="%" must be a whole number', FALSE), ('list', 'offset="-1" must be a whole number', FALSE),
                ('list', 'from="%" is no date that can be read as a date (year-month-day, with a time and zone if needed)', TRUE),
                ('counts', 'empty range: from=2024-02-01 comes after to=2024-01-30', TRUE),
                ('counts', 'group_by="%" is not known: source or day', FALSE)) AS wrong(request, problem, dated) WHERE first OR NOT dated""",
        "event_deep_page": f"""
            WITH shown AS (
                SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN date_trunc('hour', ts) END AS published_at
                FROM events),
            ordered AS (SELECT *, row_number() OVER (ORDER BY published_at DESC NULLS LAST, id DESC) AS place FROM shown),
            size AS (SELECT CAST(floor(count(*) * 0.9) AS BIGINT) AS skipped FROM events)
            SELECT CAST(place - skipped AS INTEGER) AS rank, id, {iso("published_at")} AS published_at
            FROM ordered, size WHERE place > skipped AND place <= skipped + 50""",
        "doc_search_metadata": doc_metadata(
            f"{has('the')} AND {IN_FIRST_DAY}", 20, 40, "'the'", "NULL", iso(DAY_ONE), iso(DAY_TWO)
        ),
        "doc_search_past_end_metadata": doc_metadata("source = 'src7'", 20, 10**8, "NULL", "'src7'", "NULL", "NULL"),
        "doc_count_by_source": f"""WITH {DOC_MENTIONS}
            SELECT source, 'Crawler ' || regexp_extract(source, '[0-9]+') AS name, 'other' AS platform, count(*) AS total
            FROM doc_mentions WHERE {has("the")} GROUP BY source""",
        "doc_summary_tiles": f"""WITH {DOC_MENTIONS},
            matched AS (SELECT * FROM doc_mentions WHERE {has("the")}),
            page AS (SELECT * FROM matched {DISPLAY} LIMIT 20)
            SELECT 'total' AS tile, count(*) AS value FROM matched
            UNION ALL SELECT 'sources', count(DISTINCT source) FROM matched
            UNION ALL SELECT 'days', count(DISTINCT {day("published_at")}) FROM matched
            UNION ALL SELECT 'page_engagement', CAST(coalesce(sum(n_chars), 0) AS BIGINT) FROM page""",
        "doc_display_rows": f"""WITH {DOC_MENTIONS}
            SELECT doc_id AS id,
                   coalesce(strftime(published_at + INTERVAL 8 HOURS, '%d %b, %H:%M'), 'no date') AS shown_time,
                   'Crawler ' || regexp_extract(source, '[0-9]+') AS outlet,
                   coalesce(nullif(text, ''), '(no text)') AS heading, n_chars AS engagement
            FROM doc_mentions {DISPLAY} LIMIT 100""",
        "list_equals_stats": f"WITH {DOC_MENTIONS} {totals}",
        "event_dates": f"WITH {DATED} SELECT event_id, {iso('published_at')} AS published_at, date_shape FROM dated",
        "event_date_shape_census": f"WITH {DATED} SELECT date_shape, count(*) AS records FROM dated GROUP BY date_shape",
        "event_engagement": f"WITH {DATED} SELECT event_id, engagement FROM dated",
        "event_field_kinds": f"""SELECT {DATE_KIND} AS published_at_kind, {COUNT_KIND} AS engagement_kind,
            count(*) AS records FROM events GROUP BY ALL""",
        "event_warning_census": f"""WITH {DATED}
            SELECT warning, count(*) AS records FROM (
                SELECT unnest(['SOURCE_UNLISTED', 'NO_TEXT',
                    CASE date_shape WHEN 'tidak-ada' THEN 'DATE_MISSING' WHEN 'gagal-dibaca' THEN 'DATE_UNREADABLE' END,
                    CASE event_type WHEN 'error' THEN 'ENGAGEMENT_UNREADABLE' END]) AS warning FROM dated)
            WHERE warning IS NOT NULL GROUP BY warning""",
        "event_merged": f"""WITH {DATED}
            SELECT sha256(event_type || '|id:' || user_id) AS dedupe_key, min(event_id) AS id,
                   CAST(user_id AS VARCHAR) AS external_id, {iso("min(published_at)")} AS published_at,
                   coalesce(arg_min(published_at_raw, (published_at, event_id)) FILTER (published_at IS NOT NULL),
                            arg_min(published_at_raw, event_id) FILTER (published_at_raw IS NOT NULL)) AS published_at_raw,
                   max(engagement) AS engagement, count(*) AS times_seen
            FROM dated GROUP BY event_type, user_id""",
        "event_by_local_day": f"WITH {UNDATED_EVENTS} {by_day('event_mentions')}",
        "event_by_local_day_filtered": f"WITH {UNDATED_EVENTS} {by_day('event_mentions', IN_WINDOW)}",
        "event_range_filter": f"""WITH {UNDATED_EVENTS}
            SELECT source_slug, count(*) AS mentions, min(id) AS first_id
            FROM event_mentions WHERE {IN_WINDOW} GROUP BY source_slug""",
        "event_stats_metadata": f"""WITH {UNDATED_EVENTS}
            SELECT 'day' AS group_by, 'Asia/Kuala_Lumpur' AS timezone, count(*) AS total,
                   {iso(START)} AS "from", CAST(NULL AS VARCHAR) AS "to"
            FROM event_mentions WHERE published_at >= {START}""",
        "conversation_admission": "SELECT conv_id, turn FROM conversations WHERE role <> 'user'",
        "conversation_admitted": f"""
            WITH {html_ctes("(SELECT conv_id, turn, text AS html FROM conversations WHERE role = 'user')", "turns")}
            SELECT conv_id, turn, 'user' AS source_slug, text AS content_clean FROM turns""",
        "array_feed": """
            SELECT doc_id, CAST(unnest(generate_series(0, len(lines) - 1)) AS BIGINT) AS pos, 0 AS refused,
                   unnest(lines) AS content
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE lang NOT IN ('de', 'fr'))
            UNION ALL SELECT doc_id, 0, 1, NULL FROM documents WHERE lang IN ('de', 'fr')""",
        "feed_mentions": f"WITH {FEED} {feed_fold('doc_id')}",
        "feed_warning_census": f"""WITH {FEED}
            SELECT warning, count(*) AS records FROM ({FEED_WARNINGS}) GROUP BY warning""",
        "feed_sources": f"""WITH {FEED}
            SELECT DISTINCT source_slug AS slug, {feed_name} AS display_name, {feed_platform} AS platform FROM feed_keys""",
        "feed_count_by_source": f"""WITH {FEED}
            SELECT source_slug AS source, {feed_name} AS name, {feed_platform} AS platform,
                   count(DISTINCT dedupe_key) AS total FROM feed_keys GROUP BY source_slug""",
        "feed_count_by_day": f"""WITH {FEED},
            folded AS (SELECT dedupe_key, min(published_at) AS published_at FROM feed_keys GROUP BY dedupe_key)
            {by_day("folded")}""",
        "store_merge_on_read": stored,
        "store_compacted": stored,
        "store_report": f"""WITH {FEED},
            firsts AS (SELECT dedupe_key, min(CASE WHEN {LATE} THEN 2 ELSE 1 END) AS batch_no
                       FROM feed_keys GROUP BY dedupe_key),
            sent AS (SELECT CASE WHEN {LATE} THEN 2 ELSE 1 END AS batch_no, count(*) AS received
                     FROM feed_keys GROUP BY 1)
            SELECT CAST(s.batch_no AS BIGINT) AS batch_no, received,
                   (SELECT count(*) FROM firsts f WHERE f.batch_no = s.batch_no) AS inserted,
                   received - (SELECT count(*) FROM firsts f WHERE f.batch_no = s.batch_no) AS merged,
                   CAST(0 AS BIGINT) AS invalid, CAST(0 AS BIGINT) AS refused_files
            FROM sent s""",
        "store_warnings": f"""WITH {FEED}
            SELECT CAST(CASE WHEN {LATE} THEN 2 ELSE 1 END AS BIGINT) AS batch_no, warning, count(*) AS records
            FROM ({FEED_WARNINGS}) GROUP BY 1, 2""",
        "store_sources": f"""WITH {FEED}
            SELECT source_slug AS slug, {feed_name} AS display_name, {feed_platform} AS platform,
                   CASE WHEN bool_and({LATE}) THEN '2024-02-01T06:00:00.000Z' ELSE '2024-02-01T00:00:00.000Z' END AS created_at
            FROM feed_keys GROUP BY source_slug""",
        "store_batch_times": f"""WITH {FEED}
            SELECT dedupe_key,
                   CASE WHEN bool_and({LATE}) THEN '2024-02-01T06:00:00.000Z' ELSE '2024-02-01T00:00:00.000Z' END AS first_seen_at,
                   CASE WHEN bool_or({LATE}) THEN '2024-02-01T06:00:00.000Z' ELSE '2024-02-01T00:00:00.000Z' END AS updated_at
            FROM feed_keys GROUP BY dedupe_key""",
        "store_replay": f"""WITH {FEED}
            SELECT count(*) AS received, CAST(0 AS BIGINT) AS inserted, count(*) AS merged, 2 * count(*) AS times_seen
            FROM feed_keys WHERE NOT {LATE}""",
        "store_lost_race": f"""WITH {FEED}, held AS (
                SELECT dedupe_key, count(*) AS times_seen FROM feed_keys GROUP BY dedupe_key)
            SELECT dedupe_key, times_seen, CAST(2 AS BIGINT) AS batches FROM held""",
        "doc_search_request": f"""WITH {DOC_MENTIONS}, hits AS (
                SELECT count(*) AS total FROM doc_mentions WHERE {has("the")} AND source = 'src7' AND {IN_FIRST_DAY})
            SELECT total, least(total, 5) AS returned, 'the' AS q, 'src7' AS source, {iso(DAY_ONE)} AS "from", {iso(DAY_TWO)} AS "to",
                   'published_at DESC NULLS LAST, id DESC' AS sort, '{UNDATED_NOTE}' AS note FROM hits""",
        "doc_search_only_punctuation": f"""WITH {DOC_MENTIONS}
            SELECT q, count(*) FILTER (CASE q WHEN 'the' THEN {has("the")} WHEN 'the ???' THEN {has("the")}
                   WHEN '!! or ..' THEN {has("or")} ELSE FALSE END) AS matches
            FROM doc_mentions, (VALUES ('the'), ('the ???'), ('???'), ('-" "'), ('!! or ..')) AS asked(q) GROUP BY q""",
        "event_date_years": f"""WITH moved AS (
                SELECT event_id, date_trunc('second', ts) + to_years(CAST((event_id % 9 - 4) * 25 AS INTEGER)) AS moment FROM events)
            SELECT event_id, CASE WHEN year(moment) BETWEEN 2000 AND 2100 THEN {iso("moment")} END AS published_at,
                   CASE WHEN year(moment) BETWEEN 2000 AND 2100 THEN 'iso-dengan-zona' ELSE 'gagal-dibaca' END AS date_shape
            FROM moved""",
        "event_unlabelled": """SELECT event_id, CASE event_type WHEN 'view' THEN 'unknown' WHEN 'click' THEN 'unknown' ELSE event_type END AS source_slug,
                   CASE WHEN event_type IN ('view', 'click') THEN 'SOURCE_UNKNOWN' ELSE 'SOURCE_UNLISTED' END AS warning
            FROM events""",
        "doc_numeric_entities": """SELECT doc_id, trim(regexp_replace(left(text, 1) || ' ' || source || ' ' || chr(233) || ' ' || chr(128512), '\\s+', ' ', 'g')) AS text FROM documents""",
        "store_search": f"""WITH {FEED}, folded AS ({feed_fold(FEED_LATE)}),
            found AS (SELECT *, ' ' || {words_only("content_clean")} || ' ' AS words FROM folded)
            SELECT id, source_slug, published_at FROM found
            WHERE ({has("the")} AND NOT {has("with")}) OR {has("de la")} OR (NOT {has("und")} AND NOT {has("of")} AND NOT {has("la")})""",
        "stream_replay": f"""WITH {FEED}
            SELECT dedupe_key, 2 * count(*) AS times_seen, CAST(2 AS BIGINT) AS batches FROM feed_keys WHERE {LATE} GROUP BY dedupe_key""",
        "store_errors": """SELECT CAST(1 AS BIGINT) AS batch_no, 'turns' AS file, turn + conv_id * 1000000 AS pos
            FROM conversations WHERE role <> 'user'""",
        "stream_ingest": f"""WITH {FEED}
            SELECT dedupe_key, min(source_slug) AS source_slug, {iso("min(published_at)")} AS published_at,
                   max(engagement) AS engagement, count(*) AS times_seen FROM feed_keys GROUP BY dedupe_key""",
    }
