"""Toxicity scores, clusters and fill-in-middle examples against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsfold.llm import fill_middle, queries, simplex_clusters, toxicity
from tests.llm import brute


def test_fill_middle_equals_plain_version(odd_docs, odd_rows):
    got = Counter(map(tuple, fill_middle.transform_documents(odd_docs).collect()))
    assert got == Counter(brute.fill_middle(row[0], row[1]) for row in odd_rows)
    assert {row[2] for row in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_frames_of_any_size_give_the_same_rows(llm_spark, size):
    texts = ["", "a", "ab", "<P", "x<S>y", "é日🎉" * 9, "<<>><" * 5, "P>S>M>" * 4, "\n" * 10]
    rows = [(at, text) for at, text in enumerate(texts * 12)]
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    held = fill_middle.transformed(fill_middle.framed(docs, size))
    assert Counter(map(tuple, fill_middle.digests(held).collect())) == Counter(brute.fill_middle(*row) for row in rows)
    assert sorted(map(tuple, fill_middle.texts(held, restore=True).collect())) == rows
    outputs = {row.doc_id: row.text for row in fill_middle.texts(held).collect()}
    assert {at: hashlib.sha256(text.encode()).hexdigest() for at, text in outputs.items()} == {at: brute.fill_middle(at, text)[5] for at, text in rows}


def test_only_cut_frames_are_opened():
    text = "".join(chr(97 + k % 26) for k in range(10_000))
    frames = fill_middle.Frames.of(text, 1000)
    opened = []
    read = frames.text
    frames.text = lambda at: opened.append(at) or read(at)
    output = frames.spliced(["<P>", (0, 2500), "<S>", (7100, 10_000), "<M>", (2500, 7100)])
    assert sorted(opened) == [2, 2, 7, 7]
    assert b"".join(output.bytes()).decode() == f"<P>{text[:2500]}<S>{text[7100:]}<M>{text[2500:7100]}"
    assert [data for data in frames.data if data in output.data] == [data for at, data in enumerate(frames.data) if at not in (2, 7)]


def vector_rows(seed, count, spread, dimension=64):
    pick = np.random.default_rng(seed)
    middles = pick.normal(size=(8, dimension)) * spread
    return [(k, (middles[k % 8] + pick.normal(size=dimension)).tolist()) for k in range(count)]


@pytest.mark.parametrize("count, spread", [(700, 0.0), (500, 3.0), (9, 1.0), (1, 1.0)])
def test_clusters_equal_plain_version(llm_spark, count, spread):
    rows = vector_rows(count, count, spread)
    rows += [rows[0], rows[0], (count + 1, rows[0][1]), (None, rows[-1][1])]
    odd = [(-1, None), (-2, []), (-3, [1.0] * 63), (-4, [1.0] * 65), (-5, [None] * 64), (-6, [float("nan")] * 64), (-7, [float("inf")] + [0.0] * 63)]
    frame = llm_spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumns({"vector": F.lit("v"), "cluster": F.lit("c"), "apex": F.lit(0)})
    got = sorted((tuple(row)[:-1] for row in simplex_clusters.clusters(frame.repartition(5)).collect()), key=repr)
    assert got == sorted(brute.clusters(rows), key=repr)


def test_few_and_large_numbers(llm_spark):
    same = [(k, [0.5] * 64) for k in range(40)]
    far = [(100 + k, [(-1) ** k * 1e300] + [float(k)] * 63) for k in range(4)]
    frame = llm_spark.createDataFrame(same, "vec_id bigint, embedding array<double>")
    assert {(row.cluster, row.distance, row.inertia) for row in simplex_clusters.clusters(frame).collect()} == {(0, 0, 0)}
    assert simplex_clusters.clusters(frame.limit(0)).count() == 0
    both = simplex_clusters.clusters(llm_spark.createDataFrame(same + far, frame.schema)).collect()
    assert len(both) == 44 and all(0 <= row.distance for row in both)


@pytest.mark.parametrize("pivots", [1, 2, 9, 16, 65])
def test_bounds_hold_for_any_pivots(pivots):
    pick = np.random.default_rng(pivots)
    points = np.floor(64 * pick.normal(size=(300, 64)) * pick.choice([0.1, 1, 30], size=(300, 1))).astype(np.int64)
    centroids = points[:16] // 2
    simplex = simplex_clusters.Simplex.over(points[:200], pivots)
    apexes, own = (simplex.apexes(simplex.distances(x)) for x in (points, centroids))
    true = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    lower, upper = simplex_clusters.bounds(apexes, own)
    assert (lower <= true).all() and (true <= upper).all()
    cluster, distance, compared = simplex_clusters.nearest(points, apexes, centroids, own)
    assert (cluster == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all() and compared <= true.size


def test_pivots_on_one_line_are_few():
    line = np.outer(np.arange(16), np.ones(64, dtype=np.int64))
    assert len(simplex_clusters.Simplex.over(line).pivots) == 2
    assert len(simplex_clusters.Simplex.over(np.zeros((5, 64), dtype=np.int64)).pivots) == 1


def test_most_pairs_are_not_compared(llm_spark):
    rows = vector_rows(5, 3000, 4.0)
    rows += [(10_000 + at, row) for at, row in enumerate(np.random.default_rng(1).normal(size=(3000, 64)).tolist())]
    frame = llm_spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for kept, pivots, most in (("vec_id < 10000", 16, 0.3), ("vec_id < 10000", 65, 0.07), ("vec_id >= 10000", 65, 0.07)):
        found = simplex_clusters.clusters(frame.where(kept), pivots=pivots)
        assert found.agg(F.sum("compared")).first()[0] < most * 16 * 3000


def toxic_rows(seed, count):
    """Texts of made-up words; every fourth holds one of a few words that no other text holds, in one of its sentences."""
    pick = random.Random(seed)
    parts = ["ka", "lu", "mo", "ten", "ri", "sha", "vo", "pel", "dun", "gri"]
    bad = ["zorgfel", "quixnat", "brompty", "wexhul"]
    rows = []
    for doc in range(count):
        words = ["".join(pick.choices(parts, k=pick.randint(1, 4))) for _ in range(pick.choice([20, 60, 200, 900]))]
        toxic = doc % 4 == 0
        if toxic:
            for _ in range(1 + len(words) // 60):
                words[pick.randrange(len(words))] = pick.choice(bad) + pick.choice(["", ",", "!"])
        rows.append((doc, " ".join(words).capitalize(), int(toxic)))
    return rows


def test_toxic_texts_are_told_on_held_out_rows(llm_spark):
    rows = toxic_rows(3, 1600)
    docs = llm_spark.createDataFrame([row[:2] for row in rows], "doc_id bigint, text string").withColumns({"toxic": F.lit("x"), "score": F.lit(1), "held_out": F.lit(0)})
    labels = llm_spark.createDataFrame([(row[0], row[2], 1) for row in rows], "doc_id bigint, toxic int, quality int")
    odd = llm_spark.createDataFrame([(None, 1, 1), (3, None, 1), (10**9, 1, 0)], labels.schema)
    found = {row.doc_id: row for row in toxicity.classify(docs.repartition(4), labels.union(odd)).collect()}
    truth = {row[0]: row[2] for row in rows}
    held = [row for row in found.values() if row.held_out]
    assert {row.doc_id for row in held} == {doc for doc in truth if brute.held_out(doc)}
    assert all(row.predicted == (row.score >= 0.3) and 0 <= row.score <= 1 for row in found.values())
    caught = np.mean([row.predicted for row in held if truth[row.doc_id]])
    clean = np.mean([1 - row.predicted for row in held if not truth[row.doc_id]])
    assert caught > 0.95 and clean > 0.97


def test_held_out_labels_do_not_count(llm_spark):
    rows = toxic_rows(4, 800)
    docs = llm_spark.createDataFrame([row[:2] for row in rows], "doc_id bigint, text string")
    own = [(row[0], row[2]) for row in rows]
    other = [(doc, 1 - toxic if brute.held_out(doc) else toxic) for doc, toxic in own]
    scores = [
        {row.doc_id: row.score for row in toxicity.classify(docs, llm_spark.createDataFrame(labels, "doc_id bigint, toxic int").repartition(parts)).collect()}
        for labels, parts in ((own, 1), (other, 5))
    ]
    assert scores[0].keys() == scores[1].keys() and all(abs(scores[0][doc] - scores[1][doc]) < 1e-9 for doc in scores[0])


def test_scores_of_odd_texts(odd_docs, no_docs, llm_spark):
    labels = llm_spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.classify(no_docs, labels).count() == 0
    assert {row.score for row in toxicity.classify(odd_docs, labels).collect()} == {0.0}
    all_toxic = odd_docs.select("doc_id", F.lit(1).alias("toxic"))
    assert {row.score for row in toxicity.classify(odd_docs, all_toxic).collect()} == {1.0}
    rows = toxic_rows(6, 800)
    model = toxicity.fit(llm_spark.createDataFrame([row[:2] for row in rows], "doc_id bigint, text string"), llm_spark.createDataFrame([(row[0], row[2]) for row in rows], "doc_id bigint, toxic int"))
    scored = toxicity.score(odd_docs, model).collect()
    assert len(scored) == odd_docs.count() and all(0 <= row.score <= 1 for row in scored)
    assert len({row.score for row in scored if row.n_windows == 0}) == 1


@pytest.mark.parametrize("text", ["", " ", "a", "A b", "x" * 500, "word " * 100, "..Ab,c!! é日本 ÜB 12", "one two three four five six seven eight nine ten " * 7])
def test_windows_cover_the_normal_text(text):
    texts = [text, "", text, "other words here"]
    lower = [t.lower().encode() for t in texts]
    offsets = np.cumsum([0, *map(len, lower)])
    data, ends = toxicity.normal_bytes(np.frombuffer(b"".join(lower), dtype=np.uint8), offsets)
    for at, one in enumerate(texts):
        assert data[ends[at] : ends[at + 1]].tobytes() == brute.normal_text(one)
    starts, sizes, rows = toxicity.windows(data, ends)
    for at in range(len(texts)):
        own = [(int(starts[k]), int(starts[k] + sizes[k])) for k in range(rows[at], rows[at + 1])]
        if ends[at + 1] - ends[at] > 1:
            assert own[0][0] == ends[at] and own[-1][1] == ends[at + 1]
            assert all(a[1] - 1 == b[0] and data[b[0]] == 0x20 for a, b in zip(own, own[1:]))
        else:
            assert not own


def test_registered():
    assert {"op11_toxicity", "op12_simplex_clusters", "op13_fill_middle"} <= set(queries.QUERIES)
