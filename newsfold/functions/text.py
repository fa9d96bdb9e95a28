"""Whitespace, blanks, HTML entities and markup, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsfold.functions.binding import bind

# The characters ECMAScript's \s matches, as a Java character class body.
JS_SPACE = r"\s\p{Z}\uFEFF"

# Entity names that are decoded. Any other name stays as it is.
NAMED_ENTITIES = {
    "amp": "&",
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": " ",
    "hellip": "…",
    "mdash": "—",
    "ndash": "–",
    "rsquo": "’",
    "lsquo": "‘",
    "rdquo": "”",
    "ldquo": "“",
}

ENTITY = r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+);"

# \b with ASCII word characters; Java's own \b also counts accented letters up to JDK 18.
_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"

# What counts as code, as a block and as any other tag.
CODE_WITH_BODY = rf"(?i)<(script|style|iframe){_EDGE}[^>]*>[\s\S]*?</\1\s*>"
CODE_TAG = rf"(?i)</?(?:script|style|iframe){_EDGE}[^>]*>"
COMMENT = r"<!--[\s\S]*?-->"
BLOCK_TAG = rf"(?i)</?(?:p|div|br|li|tr|td|h[1-6]|blockquote){_EDGE}[^>]*>"
OTHER_TAG = rf"(?i)</?[a-z][a-z0-9-]*{_EDGE}[^>]*>"


def collapse_whitespace(text: Column) -> Column:
    """Runs of blanks, NBSP, zero-width space and BOM become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, rf"[{JS_SPACE}\u200B]+", " "))


def trim_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{JS_SPACE}]+|[{JS_SPACE}]+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(collapse_whitespace(text), F.lit(""))


def rewrite_matches(text: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Replace each match by ``rewrite(match)`` in a single pass over the text."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(gaps, hits, lambda gap, hit: F.concat(gap, F.coalesce(rewrite(hit), F.lit(""))))
    return F.array_join(pieces, "")


def literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in entries.items() for part in pair])


def code_point_to_text(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _decoded_entity(entity: Column) -> Column:
    body = F.lower(F.regexp_replace(entity, r"^&|;$", ""))
    hex_digits = F.regexp_extract(body, r"^#x0*([0-9a-f]{1,6})$", 1)
    dec_digits = F.regexp_extract(body, r"^#0*([0-9]{1,7})$", 1)
    code = F.coalesce(
        F.conv(F.nullif(hex_digits, F.lit("")), 16, 10), F.nullif(dec_digits, F.lit(""))
    ).cast("bigint")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.coalesce(
        F.when(valid, code_point_to_text(code)),
        F.try_element_at(literal_map(NAMED_ENTITIES), body),
        entity,
    )


def decode_entities(text: Column) -> Column:
    """Decode once; ``&amp;lt;`` gives ``&lt;``. Unknown and impossible entities stay."""
    return bind(
        text, lambda t: F.when(F.contains(t, F.lit("&")), rewrite_matches(t, ENTITY, _decoded_entity)).otherwise(t)
    )


def _strip(text: Column, steps: list[tuple[str, str]]) -> Column:
    def stripped(markup: Column) -> Column:
        return reduce(lambda acc, step: F.regexp_replace(acc, step[0], step[1]), steps, markup)

    return bind(text, lambda t: F.when(F.contains(t, F.lit("<")), stripped(t)).otherwise(t))


def plain_text(html: Column) -> Column:
    """Text without markup, never null.

    Two passes, before and after entities are decoded: the second one takes the tags that were sent as entities.
    """
    first = [(CODE_WITH_BODY, " "), (CODE_TAG, " "), (COMMENT, " "), (BLOCK_TAG, " "), (OTHER_TAG, "")]
    again = [(CODE_WITH_BODY, " "), (CODE_TAG, " "), (OTHER_TAG, "")]
    sent = F.coalesce(html, F.lit(""))
    return collapse_whitespace(_strip(decode_entities(_strip(sent, first)), again))
