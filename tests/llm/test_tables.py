"""Vector search, WARC audit, URL verdicts and the pipeline."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsfold.llm import cover_tree, queries, url_filter, warc_audit
from tests.llm import brute


@pytest.mark.parametrize("dim, count, copies", [(8, 400, 0), (3, 120, 60), (1, 30, 25)])
def test_top_products_are_exact(llm_spark, monkeypatch, dim, count, copies):
    monkeypatch.setattr(cover_tree, "DATA_BLOCK", 37)
    monkeypatch.setattr(cover_tree, "QUERY_BLOCK", 11)
    pick = random.Random(dim)
    vectors = [(k, [pick.randint(-40, 40) + 60 * (k % 3) for _ in range(dim)]) for k in range(count)]
    vectors += [(count + k, vectors[0][1]) for k in range(copies)]
    rows = [(k, [x / 64 + 0.001 for x in v]) for k, v in vectors]
    rows += [(-20, None), (10**6, [float("nan")] * dim), (10**6 + 20, [float("inf")] * dim), (None, [0.1] * dim), (2 * 10**6, [None] * dim), rows[0], rows[0]]
    frame = llm_spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("vector", F.lit("mine"))
    got = sorted(map(tuple, cover_tree.search(frame.repartition(3), every=20, k=20).collect()))
    assert got == brute.top_products(vectors, 20, 20)


def test_few_vectors_give_short_lists(llm_spark):
    frame = llm_spark.createDataFrame([(0, [1.0, 2.0]), (20, [0.5, -1.0]), (7, [])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, cover_tree.search(frame).collect())) == [(0, 1, 7, 0), (0, 2, 20, 32 * 64 - 64 * 128), (20, 1, 7, 0), (20, 2, 0, 32 * 64 - 64 * 128)]
    assert cover_tree.search(frame.limit(0)).count() == 0


PAGES = "page_id bigint, url string, html string, file string, at string"


def pages(spark, count=40):
    rows = [(k, f"https://h{k}.example.org/en/{k}", f"<p>{k}</p>\r\n\r\nWARC/1.1 in the text" * (k % 9), "f", "a") for k in range(count)]
    rows += [(None, None, None, None, None), (count, "no address\r\n", "", "f", "a"), rows[3], rows[3], (count + 1, "http://x/", "é" * 70_000, "f", "a")]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def test_records_are_read_back(llm_spark, tmp_path):
    packed = warc_audit.warc_files(pages(llm_spark), 2000)
    packed.write.parquet(str(tmp_path / "replica"))
    replica = llm_spark.read.parquet(str(tmp_path / "replica"))
    found = warc_audit.records(replica).collect()
    by_file = defaultdict(list)
    for row in found:
        by_file[row.file].append((row.at, row.length))
    for file, content in replica.collect():
        at = 0
        for start, length in sorted(by_file[file]):
            assert start == at
            at += length
        assert at == len(content)
    assert Counter(row.record_id for row in found)["<urn:page:3>"] == 3 and len(found) == 45


def test_audit_finds_every_damage(llm_spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_audit, "FANOUT_BITS", 2)
    monkeypatch.setattr(warc_audit, "RANGE_BYTES", 300)
    warc_audit.warc_files(pages(llm_spark), 3000).write.parquet(str(tmp_path / "one"))
    replica = llm_spark.read.parquet(str(tmp_path / "one"))
    assert {row.status for row in warc_audit.audit(replica, replica).collect()} == {"intact"}
    damaged = warc_audit.with_damage(replica, 7)
    files = sorted(row.file for row in replica.select("file").collect())
    cut = damaged.where(F.col("file") != files[0]).unionByName(llm_spark.createDataFrame([("new.warc", bytearray(warc_audit.warc_record(900, "u", "h")))], warc_audit.FILES))
    rows = warc_audit.audit(replica, cut).collect()
    ours = {(r.file, r.at): r for r in warc_audit.records(replica).collect()}
    theirs = {(r.file, r.at): r for r in warc_audit.records(cut).collect()}
    expected = {key: "missing" if key not in theirs else "intact" if theirs[key].digest == row.digest else "differs" for key, row in ours.items()}
    expected |= {key: "added" for key in theirs.keys() - ours.keys()}
    assert {(r.file, r.at): r.status for r in rows} == expected
    assert {"intact", "differs", "missing", "added"} == set(expected.values())


def test_equal_files_are_told_apart(llm_spark, tmp_path):
    """A page table united with itself, and a page that fills several equal files of one partition."""
    once = pages(llm_spark).coalesce(1)
    same = llm_spark.createDataFrame([(7, "http://x/", "s" * 900, "f", "a")] * 6, PAGES).coalesce(1)
    warc_audit.warc_files(once.unionByName(once).unionByName(same), 1000).write.parquet(str(tmp_path / "one"))
    replica = llm_spark.read.parquet(str(tmp_path / "one"))
    names = [row.file for row in replica.select("file").collect()]
    assert len(set(names)) == len(names)
    warc_audit.with_damage(replica, 7).write.parquet(str(tmp_path / "two"))
    rows = warc_audit.audit(replica, llm_spark.read.parquet(str(tmp_path / "two"))).collect()
    assert len(rows) == 2 * 45 + 6
    hit = Counter(row.record_id for row in rows if row.status != "intact")
    assert hit == {"<urn:page:7>": 2 + 6} | {f"<urn:page:{k}>": 2 for k in (0, 14, 21, 28, 35)}
    assert {row.status for row in rows} == {"intact", "differs"}


def test_replicas_are_held_file_by_file(llm_spark, tmp_path, monkeypatch):
    """Row groups and batches end after the file that fills them, however many files a task packs."""
    setting, seen, keep = "spark.sql.execution.arrow.maxBytesPerBatch", {}, warc_audit.Scratch.keep

    def kept(scratch, df, table, **options):
        seen[table] = llm_spark.conf.get(setting, None)
        return keep(scratch, df, table, **options)

    monkeypatch.setattr(warc_audit.Scratch, "keep", kept)
    monkeypatch.setattr("newsfold.llm.scratch.shared_folder", lambda spark: str(tmp_path))
    body = F.expr(f"repeat(char(97 + id), if(id < 5, {warc_audit.FILE_BYTES}, 100))")
    long = llm_spark.range(0, 6, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), body.alias("html"))
    rows = warc_audit.audited_pages(long, 2).collect()
    assert {row.page_id: row.status for row in rows} == {k: "intact" if k % 2 else "differs" for k in range(6)}
    for table in ("replica", "other"):
        groups = [m.row_group(g) for m in map(pq.read_metadata, tmp_path.glob(f"warc-*/{table}/*.parquet")) for g in range(m.num_row_groups)]
        assert [group.num_rows for group in groups] == [1] * 6
        # A writer holds the least and greatest values of all its row groups, 8 MB each.
        assert all(group.column(1).path_in_schema == "content" and group.column(1).statistics is None for group in groups)
    assert {table for table, value in seen.items() if value == str(warc_audit.BATCH_BYTES)} == {"replica", "other", "ours", "theirs"}
    assert llm_spark.conf.get(setting, None) is None


def test_batches_are_small_meanwhile(llm_spark):
    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    files = llm_spark.range(0, 4, 1, 1).select(F.expr(f"cast(repeat('x', {warc_audit.BATCH_BYTES}) as binary)").alias("content"))
    with warc_audit.small_batches(llm_spark):
        assert [row.n for row in files.mapInArrow(count, "n bigint").collect()] == [1] * 4
    assert [row.n for row in files.mapInArrow(count, "n bigint").collect()] == [4]


def test_garbage_is_one_record():
    record = warc_audit.warc_record(1, "u", "h")
    assert [(at, size) for at, size, _ in warc_audit.parse(memoryview(b"junk\r\n\r\n" + record))] == [(0, 8), (8, len(record))]
    assert list(warc_audit.parse(memoryview(b""))) == [] and len(list(warc_audit.parse(memoryview(record[:-3])))) == 1


def test_audit_of_empty_replicas(llm_spark):
    nothing = llm_spark.createDataFrame([], warc_audit.FILES)
    assert warc_audit.audit(nothing, nothing).count() == 0


URLS = [
    ("http://A.Example.NET/en/1?x=/de/", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://b.example.net", "b.example.net", "", None, None),
    ("https://b.example.net/e", "b.example.net", "/e", "net/", "block"),
    ("ftp://org/fr/#t", "org", "/fr/", "org/fr/", "allow"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("x://example.com/de/://y", "example.com", "/de/://y", "example.com/de/", "block"),
    ("http://É.ORG?/fr/", "É.org", "", None, None),
    ("no address", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_hosts_paths_and_rules(llm_spark):
    frame = llm_spark.createDataFrame([(k, row[0], "p") for k, row in enumerate(URLS)], "page_id bigint, url string, path string")
    rows = sorted(url_filter.judge(frame).collect())
    for row, (_, host, path, rule, verdict) in zip(rows, URLS):
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_model_tells_addresses_apart(llm_spark):
    """Held out: hosts like those that rules block go, hosts like those they allow stay."""
    pick = random.Random(4)
    good = lambda: "".join(pick.choice(["ka", "lo", "mi", "ru"]) for _ in range(5))
    bad = lambda: "".join(pick.choice(["xq", "zv", "jx", "qq"]) for _ in range(5))
    rows = [f"http://{good()}.org/fr/{good()}" for _ in range(200)] + [f"http://{bad()}.net/a/{bad()}" for _ in range(200)]
    rows += [f"http://{good()}.info/a/{good()}" for _ in range(100)] + [f"http://{bad()}.info/a/{bad()}" for _ in range(100)]
    found = [r.verdict for r in sorted(url_filter.judge(llm_spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")).collect())]
    assert found[400:500].count("allow") >= 97 and found[500:].count("block") >= 97


def test_judging_runs_no_python(llm_spark):
    frame = llm_spark.createDataFrame([(1, "http://a.org/fr/x"), (2, "http://b.net/")], "page_id bigint, url string")
    plan = url_filter.judge(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


@pytest.fixture(scope="session")
def pipeline_folder(llm_spark, odd_docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    odd_docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_pipeline_equals_its_plain_version(llm_spark, pipeline_folder):
    pytest.importorskip("tokenizers")
    rows = [tuple(r) for r in llm_spark.read.parquet(f"{pipeline_folder}/documents.parquet").collect()]
    docs = llm_spark.read.parquet(f"{pipeline_folder}/documents.parquet")
    counts = corpus_pipeline.quality.assess(docs).where("kept").groupBy("doc_id").count().collect()
    left = {r.doc_id for r in counts}
    rows = [row for row in rows if row[0] in left]
    names = brute.near_classes([row[:2] for row in rows])
    first = {}
    for row, name in zip(rows, names):
        if row[0] == name:
            first[name] = row
    kept = sorted(first.values())
    sizes = {row[0]: size - gone for row, (size, gone, _, _) in zip(kept, brute.without_repeats([row[1] for row in kept], corpus_pipeline.PASSAGE_BYTES))}
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm_spark, out, pipeline_folder).cache()
        assert out.columns == docs.columns
    assert {r.doc_id: len((r.text or "").encode()) for r in out.collect()} == sizes
    packed = corpus_pipeline.run(llm_spark, pipeline_folder).collect()
    assert {r.doc_id for r in packed} == set(sizes)


def test_pipeline_of_an_empty_table(llm_spark, no_docs, tmp_path):
    pytest.importorskip("tokenizers")
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(llm_spark, str(tmp_path)).count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
