"""Duplicate fold and upsert against a record-by-record fold in plain Python."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from newsfold import schemas
from newsfold.operators import merge

EARLY = dt.datetime(2026, 8, 1, tzinfo=dt.UTC)


def random_rows(seed, count, keys):
    rng = random.Random(seed)

    def maybe(value):
        return value if rng.random() < 0.6 else None

    rows = []
    for at in range(count):
        dated = rng.random() < 0.5
        rows.append(
            dict(
                id=at,
                source_slug="thestar",
                external_id=maybe(f"x{at}"),
                url=maybe(f"u{at}"),
                canonical_url=maybe(f"c{at}"),
                title=maybe(f"t{at}"),
                content_raw=maybe(f"raw{at}"),
                content_clean="w" * rng.randrange(4),
                author=maybe(f"a{at}"),
                published_at=EARLY + dt.timedelta(hours=rng.randrange(3)) if dated else None,
                published_at_raw=f"r{at}" if dated else maybe(f"bad{at}"),
                engagement=maybe(rng.randrange(5)),
                # One key holds about a third of the rows.
                dedupe_key="hot" if rng.random() < 0.33 else f"k{rng.randrange(keys)}",
                times_seen=1,
                first_seen_at=EARLY,
                updated_at=EARLY,
            )
        )
    return rows


def fold_in_python(rows, start=()):
    table = {row["dedupe_key"]: dict(row) for row in start}
    for new in rows:
        old = table.get(new["dedupe_key"])
        if old is None:
            table[new["dedupe_key"]] = dict(new)
            continue
        values = [v for v in (old["engagement"], new["engagement"]) if v is not None]
        old["engagement"] = max(values, default=None)
        if new["published_at"] and (not old["published_at"] or new["published_at"] < old["published_at"]):
            old["published_at"], old["published_at_raw"] = new["published_at"], new["published_at_raw"]
        elif old["published_at_raw"] is None:
            old["published_at_raw"] = new["published_at_raw"]
        for name in merge.FIRST_NON_NULL:
            old[name] = new[name] if old[name] is None else old[name]
        if len(new["content_clean"]) > len(old["content_clean"]):
            old["content_raw"], old["content_clean"] = new["content_raw"], new["content_clean"]
        old["times_seen"] += new["times_seen"]
        old["updated_at"] = new["updated_at"]
    return table


def as_table(df):
    return {row["dedupe_key"]: row.asDict() for row in df.select(*schemas.MENTIONS.names).collect()}


def frame(spark, rows):
    return spark.createDataFrame(
        [tuple(row[name] for name in schemas.MENTIONS.names) for row in rows], schemas.MENTIONS
    )


def comparable(table):
    return {
        key: {
            name: value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value for name, value in row.items()
        }
        for key, row in table.items()
    }


def test_fold_equals_record_by_record(spark):
    for seed in range(2):
        rows = random_rows(seed, 120, 12)
        folded = merge.fold_rows(frame(spark, rows).repartition(7))
        assert as_table(folded) == comparable(fold_in_python(rows))


def test_any_split_into_batches_gives_the_same_table(spark):
    rows = random_rows(7, 150, 10)
    expected = comparable(fold_in_python(rows))
    cut_a, cut_b = 40, 97
    parts = [frame(spark, rows[:cut_a]), frame(spark, rows[cut_a:cut_b]), frame(spark, rows[cut_b:])]
    first, second, third = [merge.fold_rows(part) for part in parts]

    upserted = merge.merge_into(merge.merge_into(first, second), third)
    assert as_table(upserted) == expected

    overlaid = merge.overlay(merge.with_search_text(first), second.unionByName(third))
    assert as_table(overlaid) == expected


def test_feed_folds_to_eleven(tables):
    mentions, _ = tables
    rows = {row["external_id"]: row for row in mentions.collect()}
    assert len(rows) == 11
    ferry = rows["b-1"]
    assert (ferry["engagement"], ferry["times_seen"], ferry["author"]) == (61, 2, "S. Devi")
    assert (ferry["published_at"], ferry["published_at_raw"]) == (dt.datetime(2025, 6, 3, 1, 10), "2025-06-03T01:10:00Z")
    assert ferry["content_clean"].endswith("the last crossing is at nine.")
    solar = rows["s-7"]
    assert (solar["times_seen"], solar["published_at"], solar["published_at_raw"]) == (2, dt.datetime(2025, 6, 6, 16), "2025-06-07")
    assert solar["content_clean"].endswith("the ministry says.") and solar["engagement"] == 90
    assert (rows["n-4"]["times_seen"], rows["n-4"]["engagement"]) == (2, 301)


def test_same_story_of_two_outlets_stays_two(tables):
    mentions, _ = tables
    rows = mentions.where(F.col("title").startswith("River festival")).collect()
    assert sorted(row["source_slug"] for row in rows) == ["malaysiakini", "unknown"]


def test_sources_take_the_newest_name_and_keep_the_platform(spark):
    stored = spark.createDataFrame([("a", "Old", "news", EARLY), ("b", "B", "other", EARLY)], schemas.SOURCES)
    later = EARLY + dt.timedelta(days=1)
    batch = spark.createDataFrame([("a", "New", "other", later), ("c", "C", "news", later)], schemas.SOURCES)
    rows = {row["slug"]: row for row in merge.merge_sources(stored, batch).collect()}
    assert (rows["a"]["display_name"], rows["a"]["platform"]) == ("New", "news")
    assert rows["a"]["created_at"] == EARLY.replace(tzinfo=None)
    assert sorted(rows) == ["a", "b", "c"]


def test_first_record_of_a_batch_names_its_source(spark):
    named = spark.createDataFrame(
        [(2, "a", "Second", "other"), (1, "a", "First", "other"), (3, "b", "B", "news")],
        "arrival_seq bigint, source_slug string, display_name string, platform string",
    )
    rows = merge.batch_sources(named, F.lit(EARLY)).collect()
    assert {row["slug"]: row["display_name"] for row in rows} == {"a": "First", "b": "B"}


def test_fold_counts_before_its_shuffle_and_moves_content_once(spark):
    folded = merge.fold_rows(frame(spark, random_rows(1, 20, 3)))
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 3 and all("strategy=shuffle_hash" in line for line in joins)
    counted = merge.winners(frame(spark, random_rows(1, 20, 3)))._jdf.queryExecution().executedPlan().toString()
    assert counted.count("HashAggregate") == 2 and counted.count("Exchange hashpartitioning(dedupe_key") == 1


def test_no_text_is_sorted_or_aggregated_by_the_fold(spark, tmp_path):
    """The plan as it ran: content passes one hash join, and what is aggregated is fixed-width but for short texts of repeated keys."""
    frame(spark, random_rows(3, 300, 40)).write.parquet(str(tmp_path / "rows"))
    folded = merge.fold_rows(spark.read.schema(schemas.MENTIONS).parquet(str(tmp_path / "rows")))
    folded.write.mode("overwrite").parquet(str(tmp_path / "out"))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if re.search(r"\b(Sort|SortAggregate|ObjectHashAggregate|HashAggregate)\b", line)]
    assert steps and not any("content" in line for line in steps if "length(content_clean" not in line)
    assert not any("Sort" in line for line in steps)
    numbers = merge.winners(spark.read.schema(schemas.MENTIONS).parquet(str(tmp_path / "rows")))
    assert "SortAggregate" not in numbers._jdf.queryExecution().executedPlan().toString()


def test_a_key_with_most_rows(spark):
    """Ranks keep their order up to the largest ids and the longest contents."""
    rows = random_rows(8, 400, 2)
    assert as_table(merge.fold_rows(frame(spark, rows).repartition(9))) == comparable(fold_in_python(rows))
    big = [dict(row, id=2**63 - 60 + at, content_clean="x" * (at % 7), dedupe_key="one") for at, row in enumerate(random_rows(10, 60, 1))]
    assert as_table(merge.fold_rows(frame(spark, big))) == comparable(fold_in_python(big))
