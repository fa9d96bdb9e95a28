"""Mention feeds over the supplied tables: messy records, rendered by Spark from real rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.functions.outlets import Directory
from newsfold.sources.scan import spread

# Hosts of the supplied pages; one top domain stays unlisted on purpose.
PAGE_OUTLETS = Directory(
    outlets=(("example-com", "Example Com", "news"), ("example-net", "Example Net", "other")),
    hosts={"example.com": "example-com", "example.net": "example-net"},
    labels={"blog": "example-com"},
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def loose_date(moment: Column) -> Column:
    """A moment as a crawler might send it: the form depends on the hour, and some hours send none."""
    hour = F.hour(moment)
    text = (
        F.when(hour < 3, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(hour < 6, F.concat(F.date_format(moment + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")))
        .when(hour < 9, F.date_format(moment, "yyyy-MM-dd HH:mm"))
        .when(hour.between(12, 14), F.unix_millis(moment.cast("timestamp")).cast("string"))
        .when(hour.between(15, 17), F.date_format(moment, "yyyy-MM-dd"))
        .when(hour.between(18, 20), F.date_format(moment, "d/M/yyyy"))
        .when(hour == 22, F.lit("kemarin"))
        .when(hour == 23, F.date_format(moment, "MM-dd-yyyy"))
    )
    seconds = F.when(hour.between(9, 11), F.unix_seconds(moment.cast("timestamp")))
    return F.coalesce(text.cast("variant"), seconds.cast("variant"))


def loose_count(kind: Column, value: Column) -> Column:
    """A count as a number, as text with separators, as decimal text, absent or as a word."""
    text = (
        F.when(kind == "click", F.format_number(value * 100, 0))
        .when(kind == "purchase", value.cast("string"))
        .when(kind == "error", F.lit("banyak"))
    )
    return F.coalesce(text.cast("variant"), F.when(kind == "view", value).cast("variant"))


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    """``arrival_seq, record``: events with loosely typed date and count."""
    events = spread(table(spark, folder, "events").drop("props"), "event_id")
    fields = F.struct(
        F.col("user_id").cast("string").alias("external_id"),
        F.col("event_type").alias("source"),
        loose_date(F.col("ts")).alias("published_at"),
        loose_count(F.col("event_type"), F.col("value")).alias("engagement"),
    )
    return events.select(F.col("event_id").alias("arrival_seq"), F.to_variant_object(fields).alias("record"))


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """``arrival_seq, crawler, record``: documents as articles of an outlet per language, dated by events.

    Both sides of the join have unique keys, so it spreads evenly whatever the data.
    """
    documents = spread(table(spark, folder, "documents").drop("n_chars"), "doc_id")
    events = table(spark, folder, "events").select(F.col("event_id").alias("doc_id"), "ts", "event_type", "value", "user_id")
    lang = F.col("lang")
    label = F.when(lang == "en", "The Star").when(lang == "fr", "NEW STRAITS TIMES").when(lang == "de", " Berita  Harian ")
    url = F.when(
        lang == "es", F.concat(F.lit("https://m.twitter.com/s/"), F.col("source"), F.lit("/?utm_source=x&id="), F.col("doc_id"))
    ).when(F.col("event_type") == "signup", F.lit("mailto:desk@example.com"))
    fields = F.struct(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("external_id"),
        label.alias("source"),
        F.lit(" ").alias("title"),
        F.concat(F.lit("<p>"), F.replace(F.col("text"), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>")).alias("content"),
        url.alias("url"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("user "), F.col("user_id"))).alias("author"),
        loose_date(F.col("ts")).alias("published_at"),
        loose_count(F.col("event_type"), F.col("value")).alias("engagement"),
    )
    return documents.join(events, "doc_id", "left").select(
        F.col("doc_id").alias("arrival_seq"), F.col("source").alias("crawler"), F.to_variant_object(fields).alias("record")
    )


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """``arrival_seq, record``: pages as articles with markup in title and content."""
    fields = F.struct(
        F.concat(F.lit(" page-"), F.col("page_id")).alias("external_id"),
        F.regexp_extract("url", r"://([^./]+)", 1).alias("source"),
        F.regexp_extract("html", r"<h1>[\s\S]*?</h1>", 0).alias("title"),
        F.col("html").alias("content"),
        F.col("url").alias("url"),
    )
    pages = spread(table(spark, folder, "pages"), "page_id")
    return pages.select(F.col("page_id").alias("arrival_seq"), F.to_variant_object(fields).alias("record"))


def conversation_records(spark: SparkSession, folder: str) -> DataFrame:
    """``conv_id, turn, record``: user turns as objects, other turns as bare JSON text."""
    whole = F.to_variant_object(F.struct(F.col("text").alias("content"), F.col("role").alias("source")))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "user", whole).otherwise(F.col("text").cast("variant")).alias("record")
    )


def line_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """``file, value``: each document as one posted batch of its lines; some are no JSON arrays."""
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.struct(line.alias("content")))
    value = (
        F.when(F.col("lang") == "de", F.to_json(F.struct("text")))
        .when(F.col("lang") == "fr", F.col("text"))
        .otherwise(F.to_json(lines))
    )
    return table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("file"), value.alias("value"))
