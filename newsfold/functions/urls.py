"""Host and canonical form of a URL, as column expressions over one shared set of patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsfold.functions.binding import bind
from newsfold.functions.text import rewrite_matches, trim_whitespace

# Query parameters that mark a campaign and not the article.
TRACKING_PARAM = r"(?i)^(utm_|fb_)|^(fbclid|gclid|igshid|ref|ref_src|source)$"

_HOST = r"(\[[0-9A-Fa-f:.]+\]|[^\x00-\x20/\\?#@:<>\[\]^|%\x7F]+)"
# Schemes whose slashes may be missing, doubled or backslashes.
WEB_URL = (
    r"(?s)^(?i:(https?|ftp|wss?)):[/\\]*(?:[^/\\?#]*@)?" + _HOST + r"(?::([0-9]*))?([/\\][^?#]*)?(?:\?([^#]*))?(?:#.*)?$"
)
OTHER_URL = (
    r"(?s)^(?!(?i:https?|ftp|wss?):)[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?" + _HOST + r"(?::([0-9]*))?(?:[/?#].*)?$"
)
DOT_SEGMENT = r"(?i)/(\.|%2e){1,2}(/|$)"
PATH_ESCAPED = r"[^\x21\x24-\x3B\x3D\x40-\x5F\x61-\x7A\x7C\x7E]+"


def _present(text: Column) -> Column:
    return F.when(text != "", text)


def _port_fits(port: Column) -> Column:
    return (port == "") | F.coalesce(port.try_cast("int") <= 65535, F.lit(False))


def _without_www(host: Column) -> Column:
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def url_host(url: Column) -> Column:
    """Lower-case host of any scheme without a leading ``www.``; null when there is none."""

    def host(u: Column) -> Column:
        web = F.when(_port_fits(F.regexp_extract(u, WEB_URL, 3)), _present(F.regexp_extract(u, WEB_URL, 2)))
        other = F.when(_port_fits(F.regexp_extract(u, OTHER_URL, 2)), _present(F.regexp_extract(u, OTHER_URL, 1)))
        return _without_www(F.coalesce(web, other))

    return bind(trim_whitespace(url), host)


def _resolve_dots(path: Column) -> Column:
    def step(kept: Column, segment: Column) -> Column:
        plain = F.regexp_replace(segment, r"(?i)%2e", ".")
        return (
            F.when(plain == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(plain == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    segments = F.split(F.substr(path, F.lit(2)), "/", -1)
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def _escaped_path(path: Column) -> Column:
    def escape(run: Column) -> Column:
        return F.replace(F.url_encode(run), F.lit("+"), F.lit("%20"))

    return bind(
        path, lambda p: F.when(p.rlike(PATH_ESCAPED), rewrite_matches(p, PATH_ESCAPED, escape)).otherwise(p)
    )


def _form_decoded(text: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _kept_query(query: Column) -> Column:
    def pair(part: Column, index: Column) -> Column:
        key = _form_decoded(F.regexp_extract(part, r"(?s)^([^=]*)", 1))
        value = _form_decoded(F.regexp_extract(part, r"(?s)^[^=]*=(.*)$", 1))
        return F.struct(
            F.lower(key).alias("folded"), key.alias("key"), index.alias("at"), value.alias("value")
        )

    parts = F.filter(F.split(query, "&", -1), lambda part: part != "")
    kept = F.filter(F.transform(parts, pair), lambda p: ~p["key"].rlike(TRACKING_PARAM))
    encoded = F.transform(
        F.array_sort(kept), lambda p: F.concat(F.url_encode(p["key"]), F.lit("="), F.url_encode(p["value"]))
    )
    return bind(
        F.array_join(encoded, "&"), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))
    )


def canonical_url(url: Column) -> Column:
    """Host, path without end slashes and sorted non-campaign parameters; null unless http(s)."""

    def parts(u: Column) -> Column:
        usable = u.rlike(r"(?i)^https?:") & _port_fits(F.regexp_extract(u, WEB_URL, 3))
        host, path, query = (F.regexp_extract(u, WEB_URL, group) for group in (2, 4, 5))
        return F.when(usable & (host != ""), F.struct(host.alias("host"), path.alias("path"), query.alias("query")))

    def resolved(path: Column) -> Column:
        return F.when(path.rlike(DOT_SEGMENT), _resolve_dots(path)).otherwise(path)

    def joined(p: Column) -> Column:
        path = _escaped_path(bind(F.translate(p["path"], "\\", "/"), resolved))
        query = F.when(p["query"] == "", F.lit("")).otherwise(_kept_query(p["query"]))
        return F.concat(_without_www(p["host"]), F.regexp_replace(path, "/+$", ""), query)

    return bind(bind(trim_whitespace(url), parts), joined)
