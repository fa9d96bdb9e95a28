"""Feeds, stored tables and the streaming ingest."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from newsfold import schemas
from newsfold.operators.filters import Filters
from newsfold.sources import feed
from newsfold.sources.store import CommitRefused, MentionStore
from newsfold.streaming.ingest_stream import start_ingest
from tests.conftest import FEED_FILE

MORNING = dt.datetime(2025, 6, 10, 1, tzinfo=dt.UTC)
EVENING = dt.datetime(2025, 6, 10, 13, tzinfo=dt.UTC)


def put(folder, name, value):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value))
    return str(folder)


def report(snapshot):
    row = snapshot.report().orderBy(F.desc("batch_no")).first()
    return row["received"], row["inserted"], row["merged"], row["invalid"]


def mentions(snapshot):
    names = [name for name in schemas.STORED_MENTIONS.names if name not in ("first_seen_at", "updated_at")]
    return {row["dedupe_key"]: row.asDict() for row in snapshot.mentions().select(*names).collect()}


def test_array_files_become_numbered_elements(spark, tmp_path):
    put(tmp_path, "b 1.json", [{"a": 1}, 42, None, '{"a":1}', [1]])
    put(tmp_path, "c.json", '[{"a":1,"a":2}]')
    put(tmp_path, "empty.json", [])
    put(tmp_path, "object.json", {"a": 1})
    put(tmp_path, "broken.json", "[not json")
    rows = feed.read_array_files(spark, str(tmp_path)).rows.withColumn("text", F.to_json("record"))
    found = {(row["file"].split("/")[-1], row["line"]): (row["refused"], row["text"]) for row in rows.drop("record").collect()}
    assert found == {
        ("b%201.json", 0): (False, '{"a":1}'),
        ("b%201.json", 1): (False, "42"),
        ("b%201.json", 2): (False, "null"),
        ("b%201.json", 3): (False, '"{\\"a\\":1}"'),
        ("b%201.json", 4): (False, "[1]"),
        ("c.json", 0): (False, '{"a":2}'),
        ("object.json", 0): (True, None),
        ("broken.json", 0): (True, None),
    }


def test_arrays_above_the_size_of_one_value(spark, tmp_path):
    record = {"source": "ig", "content": "x" * (1 << 20)}
    with open(tmp_path / "large.json", "w") as file:
        file.write("[")
        for at in range(140):
            file.write(("," if at else "") + json.dumps(record | {"title": f"t{at}"}))
        file.write("]")
    rows = feed.read_array_files(spark, str(tmp_path)).rows
    found = rows.agg(F.count("*"), F.sum(F.col("refused").cast("int")), F.max("line"), F.count("record")).first()
    assert tuple(found) == (140, 0, 139, 140)


def numbered(spark, rows, tmp_path, first=5):
    rows.placed().write.parquet(str(tmp_path / "placed"))
    placed = spark.read.parquet(str(tmp_path / "placed"))
    return feed.with_arrival_numbers(placed, feed.part_starts(placed, first), first)


@pytest.mark.parametrize("splits", ["2", None])
def test_lines_are_numbered_in_order_across_splits(spark, tmp_path, splits):
    for name, count in (("x.jsonl", 4_000), ("y.jsonl", 6_000)):
        put(tmp_path / "in", name, "".join(json.dumps({"external_id": str(at)}) + "\n" for at in range(count)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    if splits:
        spark.conf.set("spark.sql.files.maxPartitionNum", splits)
    try:
        rows, following = numbered(spark, feed.read_line_files(spark, str(tmp_path / "in")), tmp_path)
        found = rows.select("arrival_seq", F.variant_get("record", "$.external_id", "int").alias("at")).orderBy("arrival_seq").collect()
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes", "maxPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{name}")
    assert [row["at"] for row in found] == [*range(4_000), *range(6_000)]
    assert [row["arrival_seq"] for row in found] == list(range(5, 10_005)) and following == 10_005


def test_batches_replay_merge_and_compaction(spark, tmp_path):
    posted = put(tmp_path / "in", "feed.json", FEED_FILE.read_text())
    store = MentionStore(spark, str(tmp_path / "tables"))
    assert store.snapshot().mentions().count() == 0

    first = store.ingest(feed.read_array_files(spark, posted), MORNING)
    assert report(first) == (14, 11, 3, 0)
    assert first.warnings().select("pos").distinct().count() == 7
    assert first.sources().count() == 9

    second = store.ingest(feed.read_array_files(spark, posted), EVENING)
    assert report(second) == (14, 0, 14, 0)
    assert len(second.manifest.deltas) == 2 and second.manifest.base == {}
    rows = mentions(second)
    assert len(rows) == 11 and sum(row["times_seen"] for row in rows.values()) == 28
    times = second.mentions().agg(F.max("first_seen_at"), F.min("updated_at")).first()
    assert tuple(times) == (MORNING.replace(tzinfo=None), EVENING.replace(tzinfo=None))
    assert {row["id"] for row in mentions(first).values()} == {row["id"] for row in rows.values()}

    compacted = store.compact()
    assert compacted.manifest.deltas == [] and mentions(compacted) == rows
    assert mentions(store.snapshot(second.manifest.version)) == rows
    kept = {name: len(list((tmp_path / "tables" / name).iterdir())) for name in ("delta", "staged")}
    store.vacuum(keep=1)
    assert kept["delta"] == 2 and not list((tmp_path / "tables" / "delta").iterdir())
    assert store.versions() == [compacted.manifest.version]
    assert mentions(store.snapshot()) == rows and store.snapshot().report().count() == 2
    orphans = store.snapshot().mentions().join(store.snapshot().sources(), F.col("source_slug") == F.col("slug"), "left_anti")
    assert orphans.count() == 0


def test_malformed_records_and_refused_files(spark, tmp_path, feed_records):
    put(tmp_path / "in", "a.json", [feed_records[0], "text", 42, None, feed_records[3]])
    put(tmp_path / "in", "b.json", {"external_id": "1"})
    snapshot = MentionStore(spark, str(tmp_path / "tables")).ingest(feed.read_array_files(spark, str(tmp_path / "in")))
    assert report(snapshot) == (5, 2, 0, 3)
    assert snapshot.report().first()["refused_files"] == 1
    errors = {(row["file"].split("/")[-1], row["pos"]) for row in snapshot.errors().collect()}
    assert errors == {("a.json", 1), ("a.json", 2), ("a.json", 3), ("b.json", None)}
    assert snapshot.mentions().count() == 2


def test_batch_splits_and_feed_formats_give_one_table(spark, tmp_path, feed_records):
    records = feed_records * 2
    whole = MentionStore(spark, str(tmp_path / "whole"))
    expected = mentions(whole.ingest(feed.read_array_files(spark, put(tmp_path / "all", "f.json", records))))

    cuts = sorted(random.Random(3).sample(range(1, 28), 2))
    parts = MentionStore(spark, str(tmp_path / "parts"), max_delta_share=0.5)
    for at, (low, high) in enumerate(zip([0, *cuts], [*cuts, 28], strict=True)):
        text = "".join(json.dumps(record) + "\n" for record in records[low:high])
        parts.ingest(feed.read_line_files(spark, put(tmp_path / f"part{at}", "f.jsonl", text)))
        last = parts.maintain()
    got = mentions(last)
    drop = lambda table: {key: {k: v for k, v in row.items() if k != "id"} for key, row in table.items()}
    assert drop(got) == drop(expected)
    order = lambda table: sorted(table, key=lambda key: table[key]["id"])
    assert order(got) == order(expected)


def test_parquet_feed(spark, tmp_path):
    table = spark.createDataFrame(
        [("1", "ig", "Satu dua", 1786435200, "7"), ("2", "ig", "satu, dua", None, "9")],
        "external_id string, source string, content string, published_at bigint, engagement string",
    )
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    snapshot = MentionStore(spark, str(tmp_path / "tables")).ingest(feed.read_parquet_files(spark, str(tmp_path / "in")))
    (row,) = snapshot.mentions().collect()
    assert (row["external_id"], row["engagement"], row["times_seen"]) == ("1", 9, 2)
    assert row["published_at"] == dt.datetime(2026, 8, 11, 8)


def test_failed_batch_leaves_nothing_and_can_be_sent_again(spark, tmp_path, monkeypatch):
    posted = put(tmp_path / "in", "feed.json", FEED_FILE.read_text())
    store = MentionStore(spark, str(tmp_path / "tables"))

    def fail(manifest):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as patched:
        patched.setattr(store, "_commit", fail)
        with pytest.raises(RuntimeError):
            store.ingest(feed.read_array_files(spark, posted))
    assert store.snapshot().mentions().count() == 0 and store.snapshot().report().count() == 0
    assert report(store.ingest(feed.read_array_files(spark, posted))) == (14, 11, 3, 0)


def test_of_two_writers_the_second_changes_nothing(spark, tmp_path):
    """Both read version 1; one commits while the other is at work."""
    store, rival = (MentionStore(spark, str(tmp_path / "tables")) for _ in range(2))
    post = lambda name, story: feed.read_array_files(spark, put(tmp_path / name, "f.json", [{"source": "ig", "title": story}]))
    store.ingest(post("zero", "before"))
    slow, fast = post("slow", "story B"), post("fast", "story A")
    commit = store._commit
    store._commit = lambda manifest: (rival.ingest(fast), commit(manifest))[1]
    with pytest.raises(CommitRefused):
        store.ingest(slow)
    store._commit = commit
    seen = store.snapshot()
    assert sorted(row["title"] for row in seen.mentions().collect()) == ["before", "story A"]
    assert report(seen) == (1, 1, 0, 0) and seen.report().count() == 2 and seen.errors().count() == 0
    again = store.ingest(slow)
    assert sorted(row["title"] for row in again.mentions().collect()) == ["before", "story A", "story B"]
    ids = [row["id"] for row in again.mentions().collect()]
    assert len(set(ids)) == 3


def test_small_batches_touch_few_buckets_and_never_the_rest(spark, tmp_path, monkeypatch):
    from newsfold.sources import store as tables

    monkeypatch.setattr(tables, "BUCKET_ROWS", 20)
    store = MentionStore(spark, str(tmp_path / "tables"), max_deltas=3)
    post = lambda name, titles: feed.read_array_files(
        spark, put(tmp_path / name, "f.json", [{"source": "ig", "title": title, "content": "c"} for title in titles])
    )
    store.ingest(post("many", [f"story {at}" for at in range(400)]))
    base = store.compact().manifest
    assert base.n_buckets == 20 and len(base.base) == 20 and base.base_rows == 400
    for at in range(6):
        store.ingest(post(f"one{at}", [f"story {at * 7}"]))
        assert store.maintain().manifest.base == base.base
    current = store.snapshot()
    assert len(current.manifest.deltas) <= 4 and current.manifest.delta_rows == 6
    touched = current.touched()
    assert 0 < len(touched) <= 6
    counted = {row["times_seen"]: row["count"] for row in current.mentions().groupBy("times_seen").count().collect()}
    assert counted == {1: 394, 2: 6}
    files = {name.split("bucket=")[1].split("/")[0] for name in current.keys({min(touched)}).inputFiles() if "bucket=" in name}
    assert files == {str(min(touched))}
    after = store.compact().manifest
    assert {b for b in base.base if after.base[b] != base.base[b]} == set(map(str, touched)) and after.base_rows == 400


def test_reports_are_put_together(spark, tmp_path, monkeypatch):
    from newsfold.sources import store as tables

    monkeypatch.setattr(tables, "SEPARATE_REPORTS", 1)
    store = MentionStore(spark, str(tmp_path / "tables"))
    for at in range(2):
        store.ingest(feed.read_array_files(spark, put(tmp_path / f"in{at}", "f.json", [{"source": "ig", "title": "t"}, 7])))
    before = [sorted(map(tuple, table.collect()), key=repr) for table in (store.snapshot().report(), store.snapshot().errors(), store.snapshot().warnings())]
    after = store.compact()
    assert len(after.manifest.reports) == 1
    assert [sorted(map(tuple, table.collect()), key=repr) for table in (after.report(), after.errors(), after.warnings())] == before


def test_stream_applies_each_micro_batch_once(spark, tmp_path):
    incoming = tmp_path / "in"
    put(incoming, "one.json", FEED_FILE.read_text())
    store = MentionStore(spark, str(tmp_path / "tables"))
    start_ingest(store, str(incoming), str(tmp_path / "checkpoint"), once=True).awaitTermination(300)
    assert report(store.snapshot()) == (14, 11, 3, 0)

    put(incoming, "two.json", FEED_FILE.read_text())
    start_ingest(store, str(incoming), str(tmp_path / "checkpoint"), once=True).awaitTermination(300)
    snapshot = store.snapshot()
    assert report(snapshot) == (14, 0, 14, 0) and snapshot.mentions().count() == 11

    # The same micro-batch once more, as after a failure between commit and checkpoint.
    last_id = snapshot.manifest.streams["feed"]
    again = store.ingest(feed.read_array_files(spark, str(incoming)), stream="feed", batch_id=last_id)
    assert again.manifest == snapshot.manifest


def test_date_filter_reaches_the_scan(spark, tmp_path):
    posted = put(tmp_path / "in", "feed.json", FEED_FILE.read_text())
    store = MentionStore(spark, str(tmp_path / "tables"))
    store.ingest(feed.read_array_files(spark, posted))
    snapshot = store.compact()
    from newsfold.operators.filters import Filters
    from newsfold.operators.stats import count_by_day

    filters = Filters(source="thestar", since=MORNING - dt.timedelta(days=5))
    plan = count_by_day(snapshot.mentions(), filters)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PushedFilters") :]
    assert "EqualTo(source_slug,thestar)" in scan and "GreaterThanOrEqua" in scan
    assert "ReadSchema: struct<source_slug:string,published_at:timestamp>" in scan


def test_index_follows_batches_and_compaction(spark, tmp_path, monkeypatch):
    """What the index finds is what a scan of the texts finds: with rows that a later batch changes, and after each compaction."""
    pick = random.Random(5)
    words = ["harbour", "tide", "crane", "salt", "pilot"]

    def batch(first, count):
        return [{"source": f"Outlet {at % 3}", "title": f"story {at}", "content": " ".join(pick.choices(words, k=pick.randint(1, 9)))} for at in range(first, first + count)]

    monkeypatch.setattr("newsfold.sources.store.BUCKET_ROWS", 5)
    store = MentionStore(spark, str(tmp_path / "tables"))

    def agree():
        snapshot = store.snapshot()
        for query in ("harbour", '"salt pilot" or story -harbour', "-tide"):
            filters = Filters(q=query)
            expected = sorted(row.id for row in filters.apply(snapshot.mentions()).collect())
            assert sorted(row.id for row in snapshot.index().matches(filters).collect()) == expected

    assert store.snapshot().index().matches(Filters(q="harbour")).count() == 0
    steps = [(0, 60), (50, 12), (60, 2)]
    for step, (first, count) in enumerate(steps):
        folder = put(tmp_path / f"in{step}", "a.json", batch(first, count))
        store.ingest(feed.read_array_files(spark, folder), MORNING)
        agree()
        if step != 1:
            store.compact()
            agree()
    assert len(store.snapshot().manifest.index) > 1
    bare = MentionStore(spark, str(tmp_path / "tables"), indexed=False)
    bare.ingest(feed.read_array_files(spark, put(tmp_path / "in9", "a.json", batch(3, 3))), MORNING)
    assert bare.compact().index() is None


def test_line_feeds_are_numbered_where_they_lie(spark, tmp_path):
    """No record moves for its number, whatever the splits, and the numbers are those of a plain count."""
    lines = [json.dumps({"source": "ig", "title": f"t{at}", "content": "c" * (at % 50)}) for at in range(400)]
    for name, part in (("a.jsonl", lines[:250]), ("b.jsonl", lines[250:251]), ("c.jsonl", lines[251:])):
        put(tmp_path / "in", name, "\n\n".join(part) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        lines_feed = feed.read_line_files(spark, str(tmp_path / "in"))
        assert "Exchange" not in lines_feed.placed()._jdf.queryExecution().executedPlan().toString()
        store = MentionStore(spark, str(tmp_path / "tables"))
        rows = store.ingest(lines_feed, MORNING).mentions().select("id", "title").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((row.id, row.title) for row in rows) == [(at, f"t{at}") for at in range(400)]
    gaps = feed.Feed(feed.read_line_files(spark, str(tmp_path / "in")).rows.where("line <> 3"), gapless=True)
    with pytest.raises(ValueError, match="gaps"):
        store.ingest(gaps, MORNING)
    assert store.snapshot().manifest.batch_no == 1


def test_compaction_deals_a_bucket_by_its_bytes(spark, tmp_path, monkeypatch):
    """A bucket of few but large rows is the work of several tasks; before, only many rows were."""
    import newsfold.sources.store as stores

    monkeypatch.setattr(stores, "TASK_BYTES", 4_000)
    noise = random.Random(2)
    records = [{"source": "ig", "title": f"t{at}", "content": noise.randbytes(400).hex()} for at in range(100)]
    store = MentionStore(spark, str(tmp_path / "tables"), indexed=False)
    put(tmp_path / "in", "a.json", records)
    rows = mentions(store.ingest(feed.read_array_files(spark, str(tmp_path / "in")), MORNING))
    compacted = store.compact()
    files = list((tmp_path / "tables" / "base").rglob("*.parquet"))
    assert len(list(compacted.manifest.base)) == 1 and len(files) > 3
    assert len(rows) == 100 and mentions(compacted) == rows


def test_stored_tables_are_kept_with_zstd(spark, tmp_path):
    store = MentionStore(spark, str(tmp_path / "tables"))
    put(tmp_path / "in", "a.json", [{"source": "ig", "title": "t", "content": "some words"}])
    store.ingest(feed.read_array_files(spark, str(tmp_path / "in")), MORNING)
    store.compact()
    for table in ("staged", "delta", "base", "index"):
        names = [file.name for file in (tmp_path / "tables" / table).rglob("*.parquet")]
        assert names and all(name.endswith(".zstd.parquet") for name in names)
