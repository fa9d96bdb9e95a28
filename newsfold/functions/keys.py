"""Text fingerprint and duplicate key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfold.functions.binding import bind

# Length of a fingerprint, and what it keeps of a text.
FINGERPRINT_LENGTH = 300
NOT_LETTER_OR_DIGIT = r"[^\p{L}\p{N}]+"


def words_only(text: Column) -> Column:
    """Lower-case letters and digits, everything between them one space."""
    return F.trim(F.regexp_replace(F.lower(text), NOT_LETTER_OR_DIGIT, " "))


def fingerprint(text: Column) -> Column:
    return F.trim(F.substring(words_only(text), 1, FINGERPRINT_LENGTH))


def with_dedupe_key(df: DataFrame, out: str = "dedupe_key") -> DataFrame:
    """sha256 of the outlet and the first of title, content, URL or provider id that says anything.

    Reads ``source_slug``, ``title``, ``content_clean``, ``canonical_url`` and ``external_id``. The
    content is only fingerprinted for rows whose title gives nothing.
    """
    by_url = F.concat(F.lit("url:"), F.nullif(F.col("canonical_url"), F.lit("")))
    by_id = F.concat(F.lit("id:"), F.coalesce(F.col("external_id"), F.lit("")))

    def first_of(found: Column, otherwise: Column) -> Column:
        return bind(found, lambda f: F.when(f == "", otherwise).otherwise(f))

    from_title = F.coalesce(fingerprint(F.col("title")), F.lit(""))
    material = first_of(first_of(from_title, fingerprint(F.col("content_clean"))), F.coalesce(by_url, by_id))
    return df.withColumn(out, F.sha2(F.concat(F.col("source_slug"), F.lit("|"), material), 256))
