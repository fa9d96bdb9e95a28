"""Column lists of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


MENTIONS = _schema(
    ("id", T.LongType()),
    ("source_slug", T.StringType()),
    ("external_id", T.StringType()),
    ("url", T.StringType()),
    ("canonical_url", T.StringType()),
    ("title", T.StringType()),
    ("content_raw", T.StringType()),
    ("content_clean", T.StringType()),
    ("author", T.StringType()),
    ("published_at", T.TimestampType()),
    ("published_at_raw", T.StringType()),
    ("engagement", T.LongType()),
    ("dedupe_key", T.StringType()),
    ("times_seen", T.LongType()),
    ("first_seen_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

# Added on write, from title and content after duplicates are folded.
STORED_MENTIONS = T.StructType(MENTIONS.fields + [T.StructField("search_text", T.StringType())])

SOURCES = _schema(
    ("slug", T.StringType()),
    ("display_name", T.StringType()),
    ("platform", T.StringType()),
    ("created_at", T.TimestampType()),
)

ERRORS = _schema(
    ("batch_no", T.LongType()),
    ("file", T.StringType()),
    ("pos", T.LongType()),
    ("message", T.StringType()),
)

WARNINGS = _schema(
    ("batch_no", T.LongType()),
    ("file", T.StringType()),
    ("pos", T.LongType()),
    ("external_id", T.StringType()),
    ("warning", T.StringType()),
    ("value", T.StringType()),
)

REPORT = _schema(
    ("batch_no", T.LongType()),
    ("received", T.LongType()),
    ("inserted", T.LongType()),
    ("merged", T.LongType()),
    ("invalid", T.LongType()),
    ("refused_files", T.LongType()),
)
