"""Raw JSON records to normalised mention rows, in one narrow stage without shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfold.functions import dates
from newsfold.functions.binding import bind
from newsfold.functions.keys import with_dedupe_key
from newsfold.functions.numbers import engagement_count
from newsfold.functions.outlets import LISTED, OTHER_PLATFORM, UNKNOWN_SLUG, Directory, with_outlet
from newsfold.functions.text import blank_to_null, plain_text
from newsfold.functions.urls import canonical_url, url_host

TEXT_FIELDS = ("external_id", "source", "title", "content", "url", "author")
LOOSE_FIELDS = ("published_at", "engagement")

SOURCE_UNKNOWN = "SOURCE_UNKNOWN"
SOURCE_UNLISTED = "SOURCE_UNLISTED"
URL_UNUSABLE = "URL_UNUSABLE"
CONTENT_CLEANED = "CONTENT_CLEANED"
NO_TEXT = "NO_TEXT"
DATE_MISSING = "DATE_MISSING"
DATE_UNREADABLE = "DATE_UNREADABLE"
ENGAGEMENT_UNREADABLE = "ENGAGEMENT_UNREADABLE"

NORMALIZED = [
    "source_slug",
    "display_name",
    "platform",
    "external_id",
    "url",
    "canonical_url",
    "title",
    "content_raw",
    "content_clean",
    "author",
    "published_at",
    "published_at_raw",
    "date_shape",
    "engagement",
    "dedupe_key",
    "warnings",
    "engagement_raw",
]

NOT_AN_OBJECT = "every mention must be a JSON object"


def json_kind(value: Column) -> Column:
    """``string``, ``number``, ``null`` (also for an absent field), ``object`` or ``other``."""

    def kind(schema: Column) -> Column:
        return (
            F.when(schema == "VOID", "null")
            .when(schema == "STRING", "string")
            .when(schema.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), "number")
            .when(F.startswith(schema, F.lit("OBJECT<")), "object")
            .otherwise("other")
        )

    return bind(F.coalesce(F.schema_of_variant(value), F.lit("VOID")), kind)


def is_object(record: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(record), F.lit("OBJECT<")), F.lit(False))


def split_malformed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects, malformed rows with a message) of ``records``, which keep their positions."""
    flagged = is_object(F.col("record"))
    bad = records.where(~flagged).drop("record").withColumn("message", F.lit(NOT_AN_OBJECT))
    return records.where(flagged), bad


def project_fields(records: DataFrame) -> DataFrame:
    """The eight fields of ``record``: text fields are null unless JSON text, the two loosely typed
    ones come as kind, number and text."""
    kept = [name for name in records.columns if name != "record"]
    values = [
        F.variant_get(F.col("record"), f"$.{name}", "variant").alias(f"raw_{name}") for name in TEXT_FIELDS + LOOSE_FIELDS
    ]
    picked = records.select(*kept, *values)

    def raw(name: str) -> Column:
        return F.col(f"raw_{name}")

    fields = [
        F.when(json_kind(raw(name)) == "string", F.try_variant_get(raw(name), "$", "string")).alias(name)
        for name in TEXT_FIELDS
    ]
    for name in LOOSE_FIELDS:
        kind = json_kind(raw(name))
        fields += [
            kind.alias(f"{name}_kind"),
            F.when(kind == "number", F.try_variant_get(raw(name), "$", "double")).alias(f"{name}_number"),
            F.when(kind != "null", F.try_variant_get(raw(name), "$", "string")).alias(f"{name}_text"),
        ]
    return picked.select(*kept, *fields)


def _warnings() -> Column:
    def note(condition: Column, code: str) -> Column:
        return F.when(condition, F.lit(code))

    unknown = F.col("source_slug") == UNKNOWN_SLUG
    return F.array_compact(
        F.array(
            note(unknown, SOURCE_UNKNOWN),
            note(~unknown & (F.col("platform") == OTHER_PLATFORM), SOURCE_UNLISTED),
            note(F.col("url").isNotNull() & F.col("canonical_url").isNull(), URL_UNUSABLE),
            note(F.col("content_raw") != F.col("content_clean"), CONTENT_CLEANED),
            note(F.col("title").isNull() & (F.col("content_clean") == ""), NO_TEXT),
            note(F.col("date_shape") == dates.MISSING, DATE_MISSING),
            note(F.col("date_shape") == dates.UNREADABLE, DATE_UNREADABLE),
            note((F.col("engagement_kind") != "null") & F.col("engagement").isNull(), ENGAGEMENT_UNREADABLE),
        )
    )


def normalize_fields(fields: DataFrame, directory: Directory = LISTED) -> DataFrame:
    """Normalise the output of :func:`project_fields`; other columns pass through."""
    kept = [
        name
        for name in fields.columns
        if name not in TEXT_FIELDS and not name.startswith(tuple(f"{loose}_" for loose in LOOSE_FIELDS))
    ]
    number = F.when(F.col("engagement_kind") == "number", F.col("engagement_number"))
    text = F.when(F.col("engagement_kind") == "string", F.col("engagement_text"))
    typed = (
        fields.withColumnRenamed("content", "content_raw")
        .withColumns({name: blank_to_null(F.col(name)) for name in ("url", "external_id", "author")})
        .withColumn("host", url_host(F.col("url")))
        .withColumn("published_at_raw", F.col("published_at_text"))
        .withColumn("engagement_raw", F.col("engagement_text"))
        .withColumn(
            "read_date",
            dates.read_published(F.col("published_at_kind"), F.col("published_at_number"), F.col("published_at_text")),
        )
        .withColumns(
            {
                "published_at": dates.published_at(F.col("read_date")),
                "date_shape": dates.published_shape(F.col("read_date")),
            }
        )
        .withColumns(
            {
                "engagement": engagement_count(number, text),
                "canonical_url": canonical_url(F.col("url")),
                "title": F.nullif(plain_text(F.col("title")), F.lit("")),
                "content_clean": plain_text(F.col("content_raw")),
            }
        )
    )
    steps = [
        lambda df: with_outlet(df, "source", "host", directory),
        with_dedupe_key,
        lambda df: df.withColumn("warnings", _warnings()),
    ]
    return reduce(lambda df, step: step(df), steps, typed).select(*kept, *NORMALIZED)


def normalize_records(records: DataFrame, directory: Directory = LISTED) -> DataFrame:
    """Normalise ``record`` of every row; a row that is not an object comes out empty."""
    return normalize_fields(project_fields(records), directory)


def renormalize_text(mentions: DataFrame) -> DataFrame:
    """Recompute ``content_clean`` of stored mentions from ``content_raw`` after a rule change.

    Keys stay: changing them would need a new fold. Rows whose raw content was never sent keep ''.
    """
    order = mentions.columns
    return mentions.withColumn("content_clean", plain_text(F.col("content_raw"))).select(*order)


def date_shape_census(normalized: DataFrame) -> DataFrame:
    return normalized.groupBy("date_shape").agg(F.count(F.lit(1)).alias("records"))


def warning_rows(normalized: DataFrame) -> DataFrame:
    """One row per warning of each record, with the value that is at fault where there is one.

    ``explode_outer`` on purpose: for ``explode`` Spark derives a filter on the array and evaluates
    the whole normalisation once more inside it.
    """
    kept = [name for name in ("batch_no", "file", "pos", "arrival_seq", "external_id") if name in normalized.columns]
    at_fault = {
        DATE_UNREADABLE: "published_at_raw",
        ENGAGEMENT_UNREADABLE: "engagement_raw",
        URL_UNUSABLE: "url",
        SOURCE_UNLISTED: "display_name",
    }
    rows = normalized.select(*kept, *at_fault.values(), F.explode_outer("warnings").alias("warning"))
    value = F.lit(None).cast("string")
    for code, name in at_fault.items():
        value = F.when(F.col("warning") == code, F.col(name)).otherwise(value)
    return rows.where(F.col("warning").isNotNull()).select(*kept, "warning", value.alias("value"))
