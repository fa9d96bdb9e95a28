"""Quality rules, near-duplicates, repeated bytes and licences against plain versions."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsfold.llm import license_scan, prob_minhash, quality, suffix_dedup
from newsfold.llm.blocks import flat
from newsfold.llm.scratch import Scratch
from tests.llm import brute


def test_quality_counts(odd_docs, odd_rows):
    rows = quality.assess(odd_docs).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((row[0], *brute.quality_counts(row[1])) for row in odd_rows)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)


def test_fences_follow_the_group(llm_spark):
    """Symbols that are usual in one source are an outlier in another; a source too small is held against its language."""
    plain, coded = "one two three four five six seven eight nine ten eleven {}", "a & b | c & d | e & f | g & h | {}"
    rows = [(k, plain.format(k), "en", "prose") for k in range(300)] + [(1000 + k, coded.format(k), "en", "code") for k in range(300)]
    rows += [(5000, coded.format("x"), "en", "prose"), (5001, coded.format("y"), "en", "code"), (5002, plain.format("z"), "en", "tiny"), (5003, plain.format("z"), None, None)]
    kept = {r.doc_id for r in quality.assess(llm_spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).where("kept").collect()}
    assert kept == {row[0] for row in rows} - {5000}


def fence_rows(spark, groups):
    """The fences of groups of ``source: [(word_chars, n_symbols, n_dup_lines, n_repeat_words)]`` of 100 words and lines each."""
    rows = [("en", source, 100, chars, symbols, 100, dups, repeats) for source, docs in groups.items() for chars, symbols, dups, repeats in docs]
    schema = "lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
    return {row.source: row for row in quality.fences(spark.createDataFrame(rows, schema)).collect()}


def test_every_measure_s_fence_follows_the_spread(llm_spark):
    calm = [(500 + k % 5, k % 2, k % 2, k % 2) for k in range(120)]
    wild = [(400 + 4 * (k % 50), k % 15, k % 20, k % 7) for k in range(120)]
    found = fence_rows(llm_spark, {"calm": calm, "wild": wild})
    for name in ("word_length_high", "symbol_rate_high", "dup_line_share_high", "repeat_share_high"):
        assert found["calm"][name] < found["wild"][name]
    assert found["calm"].word_length_low > found["wild"].word_length_low
    assert found["calm"].repeat_share_high < 0.2 and found["calm"].dup_line_share_high < 0.33 and found["calm"].symbol_rate_high < 0.2


def test_fences_move_smoothly_as_a_group_grows(llm_spark):
    other = [(500, k % 30, 0, 0) for k in range(600)]
    at = [fence_rows(llm_spark, {"other": other, "own": [(500, 0, 0, 0)] * n})["own"].symbol_rate_high for n in (1, 50, 199, 200, 500)]
    assert at == sorted(at, reverse=True) and at[0] > at[1] > at[2] and at[2] - at[3] < 0.01


def test_quantiles_keep_their_bound_and_no_order_changes_a_verdict(llm_spark):
    sizes = [17 + (k * k * 7919) % 983 for k in range(500)]
    rows = [("en" if k % 3 else None, f"s{k % 2}", 100, size, k % 9, 100, k % 5, k % 4) for k, size in enumerate(sizes)]
    schema = "lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
    docs = llm_spark.createDataFrame(rows, schema)
    found = quality.quantiles(quality.sketched(docs), ["lang", "source"], "").collect()
    assert len(found) == 4
    for row in found:
        values = sorted(r[3] / 100 for r in rows if r[:2] == (row.lang, row.source))
        for name, rank in quality.RANKS.items():
            exact = values[-(-int(rank * 100) * len(values) // 100) - 1]
            assert abs(row[f"word_length_{name}"] - exact) <= quality.RELATIVE_ERROR * exact * 1.001
    wanted = sorted(map(str, quality.fences(docs.coalesce(1)).collect()))
    assert all(sorted(map(str, quality.fences(docs.repartition(n, "word_chars")).collect())) == wanted for n in (2, 7))


def test_quality_filter_keeps_rows_whole(odd_docs):
    kept = quality.filter_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    wanted = quality.assess(odd_docs).where("kept").groupBy("doc_id").count()
    assert Counter(r.doc_id for r in kept.collect()) == Counter({r.doc_id: r["count"] for r in wanted.collect()})


def test_profiles_miss_no_similar_pair():
    pick = random.Random(5)
    texts = []
    for _ in range(60):
        base = [f"w{pick.randrange(40 if pick.random() < 0.3 else 5000)}" for _ in range(pick.choice([8, 40, 150]))]
        for edits in (0, 1, 2, 4, 8):
            words = list(base)
            for _ in range(edits):
                words[pick.randrange(len(words))] = f"x{pick.randrange(50)}"
            texts.append(" ".join(words + base[: pick.choice([0, 0, 6, len(base)])]))
    one, two = zip(*((texts[k], texts[j]) for k in range(len(texts)) for j in range(k + 1, min(k + 8, len(texts)))))
    found = prob_minhash.similarities(pa.array(one), pa.array(two))
    rows = []
    for side in (one, two):
        text, shingle, weight = prob_minhash.shingles(*flat(pa.array(side)))
        rows.append(prob_minhash.profile(text, shingle, weight, len(side)))
    for least in (0.3, 0.5, 0.8):
        likely = prob_minhash.possible(*rows, least)
        assert (found >= least).any() and likely[found >= least].all() and not likely.all()


def test_rare_shingles_lose_no_link(llm_spark, monkeypatch):
    """Copies of one text with more and more words changed: many share all buckets and resemble none, or only a few."""
    pick, base = random.Random(3), [f"b{k}" for k in range(100)]
    rows = []
    for at in range(60):
        words = list(base)
        for place in pick.sample(range(100), pick.choice([0, 1, 2, 3, 4])):
            words[place] = f"c{pick.randrange(60)}"
        rows.append((at, " ".join(words)))
    expected = sorted(zip(range(60), brute.near_classes(rows)))
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    assert 1 < len({name for _, name in expected}) < 60
    monkeypatch.setattr(prob_minhash, "ABSORBING_ROUNDS", 0)
    monkeypatch.setattr(prob_minhash, "SHINGLE_SHARE", 20)
    assert sorted(map(tuple, prob_minhash.classes(docs, bands=40, rows=2).collect())) == expected


def met_and_similar(spark, texts, least=0.8):
    """The pairs of numbers of texts that meet by rare shingles, those that are left by the counts, and the similar ones."""
    names = [bytes([at]) for at in range(len(texts))]
    frame = spark.createDataFrame(list(zip(names, texts)), "digest binary, text string")
    scratch = Scratch(spark, "rare")
    about = scratch.keep(prob_minhash.described(frame), "about")
    likely = prob_minhash.rare_pairs(scratch, frame.select("digest", F.col("digest").alias("label")), about, least)
    met = spark.read.parquet(scratch.path("rare-pairs"))
    pairs = [(one, two) for two in range(len(texts)) for one in range(two)]
    found = prob_minhash.similarities(pa.array([texts[one] for one, _ in pairs]), pa.array([texts[two] for _, two in pairs]))
    similar = {pair for pair, value in zip(pairs, found) if value >= least}
    return *({tuple(sorted((row.digest[0], row.pivot[0]))) for row in rows.collect()} for rows in (met, likely)), similar


def test_texts_too_far_from_a_group_meet_none_of_it(llm_spark):
    """Texts with four words of their own resemble none with one; both have most of their shingles in common with others."""
    base = [f"b{k}" for k in range(150)]

    def changed(at, places):
        return " ".join(f"own{at}" if k in places else word for k, word in enumerate(base))

    group = [changed(at, {3 + 7 * at}) for at in range(20)]
    apart = [changed(20 + at, {at + 10, at + 40, at + 70, at + 100}) for at in range(20)]
    met, likely, similar = met_and_similar(llm_spark, group + apart)
    within = {(one, two) for two in range(20) for one in range(two)}
    assert similar == within and likely >= within
    assert met == within  # by the shares alone, 400 pairs more


def test_rare_shingles_of_texts_that_repeat_words(llm_spark):
    pick, texts = random.Random(5), []
    for _ in range(90):
        words = [f"p{k % 17}" for k in range(60)] + [f"q{k}" for k in range(60)]
        for _ in range(pick.choice([0, 1, 2, 3, 4])):
            at = pick.randrange(len(words))
            words[at : at + pick.choice([0, 1, 9])] = pick.choice([[f"x{pick.randrange(8)}"], [], words[:17]])
        texts.append(" ".join(words))
    texts = sorted(set(texts))
    met, likely, similar = met_and_similar(llm_spark, texts)
    assert 100 < len(similar) < len(texts) * (len(texts) - 1) / 2
    assert similar <= likely <= met


def test_near_classes(odd_docs, odd_rows):
    expected = Counter((row[0], name) for row, name in zip(odd_rows, brute.near_classes([row[:2] for row in odd_rows])))
    assert Counter(map(tuple, prob_minhash.classes(odd_docs).collect())) == expected


def test_a_chain_of_near_copies_is_one_class(llm_spark):
    """Each text resembles the next one only, so a pivot settles few links and buckets go on with others."""
    words = [f"w{k}" for k in range(100)]
    texts = []
    for step in range(12):
        words[step * 8] = f"new{step}"
        texts.append(" ".join(words))
    rows = [(k, text) for k, text in enumerate(texts)]
    found = prob_minhash.classes(llm_spark.createDataFrame(rows, "doc_id bigint, text string"), bands=40, rows=2).collect()
    assert sorted(map(tuple, found)) == list(zip(range(12), brute.near_classes(rows)))
    assert {row.class_id for row in found} == {0}


def test_one_row_of_each_class_stays(odd_docs):
    kept = prob_minhash.keep_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    names = prob_minhash.classes(odd_docs).collect()
    got = Counter(r.doc_id for r in kept.collect())
    assert {doc for doc in got if doc is not None} == {r.class_id for r in names if r.class_id is not None}
    assert all(count == 1 for count in got.values())


def test_similarity_is_the_probability_jaccard_index():
    import pyarrow as pa

    one, two = ["a b c d e f g a b c d e f", "x y", "", "a b c d e"], ["a b c d e f g h", "x y", "", "a b c d f"]
    expected = [brute.probability_jaccard(brute.shingles(a), brute.shingles(b)) for a, b in zip(one, two)]
    assert prob_minhash.similarities(pa.array(one), pa.array(two)) == pytest.approx(expected)


@pytest.mark.parametrize("length", [100, 400])
def test_repeated_bytes(odd_docs, odd_rows, length):
    expected = Counter((row[0], *left) for row, left in zip(odd_rows, brute.without_repeats([row[1] for row in odd_rows], length)))
    rows = suffix_dedup.report(odd_docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, rows.collect())) == expected


def test_repeats_within_periodic_and_mixed_texts(llm_spark):
    base = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(3000))
    texts = ["ab" * 400, "b" * 900 + "c", base, base[500:1200] + "X" + base[1300:1720], "Y" + base[499:901], base[100:499], base[:800] + base[:700], None]
    rows = list(enumerate(texts))
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, suffix_dedup.report(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert got == [(at, *left) for at, left in enumerate(brute.without_repeats(texts, 400))]


def test_a_text_longer_than_a_chunk(llm_spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 2000)
    import random

    pick = random.Random(1)
    base = "".join(pick.choice("abcdefgh ") for _ in range(9000))
    data = (base + base[3000:3600]).encode()
    import numpy as np

    array = np.frombuffer(data, np.uint8)
    whole = {(int(p), int(a)) for _, _, p, a, b in zip(*suffix_dedup.pointed(array, np.array([0, len(array)]))) for a in range(a, b + 1)}
    parts = set()
    for part, offsets, shift in suffix_dedup.chunks(array, np.array([0, len(array)]), 400):
        parts |= {(int(p) + shift, int(a) + shift) for _, _, p, first, last in zip(*suffix_dedup.pointed(part, offsets)) for a in range(first, last + 1)}
    assert parts == whole and len(whole) == len(array) - 399


def test_a_suffix_of_two_chunks_counts_once(llm_spark, monkeypatch):
    """Nothing is repeated within ``once``, wherever it is cut; in ``twice`` only the copied bytes go."""
    import random

    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1500)
    pick = random.Random(3)
    once, twice = ("".join(pick.choice("abcdefgh ") for _ in range(12_000)) for _ in range(2))
    texts = [once, twice + twice[700:2_200], twice[5_000:5_450], "", None]
    docs = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(map(tuple, suffix_dedup.report(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert got == [(at, *left) for at, left in enumerate(brute.without_repeats(texts, 400))] and got[0][2] == 0


def test_a_very_long_text_takes_little_memory():
    """Arrays of 8 bytes for each byte are made of one chunk at a time."""
    import random
    import tracemalloc

    import numpy as np

    data = np.frombuffer(random.Random(4).randbytes(6 << 20), np.uint8)
    tracemalloc.start()
    try:
        for _ in suffix_dedup.runs(data, np.array([0, len(data)]), 400, suffix_dedup.CHUNK_BYTES):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200 << 20


def test_nothing_goes_at_the_boundaries_of_a_very_long_text(llm_spark):
    import random

    text = random.Random(5).randbytes(suffix_dedup.CHUNK_BYTES + 4_000).hex()  # no 400 bytes twice, two boundaries
    row = suffix_dedup.report(llm_spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()[0]
    assert (row.n_bytes, row.n_removed, row.n_spans) == (len(text), 0, 0)


def test_cleaned_documents_keep_their_rows(odd_docs, odd_rows):
    cleaned = suffix_dedup.clean_documents(odd_docs, 100)
    assert cleaned.columns == odd_docs.columns
    rows = cleaned.collect()
    assert Counter(r.doc_id for r in rows) == Counter(row[0] for row in odd_rows)
    assert sum(r.text is None for r in rows) == sum(row[1] is None for row in odd_rows)


def test_licences(odd_docs, odd_rows):
    expected = Counter((row[0], *brute.best_licence(row[1], license_scan.TEMPLATES, license_scan.LEAST)) for row in odd_rows)
    assert Counter(map(tuple, license_scan.scan(odd_docs).collect())) == expected
    assert sum(expected[key] for key in expected if key[1] == "MIT") == 2


def test_changed_words_in_notices(llm_spark):
    text = license_scan.TEMPLATES["MIT"][2].replace("Software", "Library", 1).replace(", ", ",\n")
    row = license_scan.scan(llm_spark.createDataFrame([(1, "intro\n\n" + text), (2, text[:60])], "doc_id bigint, text string")).collect()
    assert [r.license for r in sorted(row)] == ["MIT", None] and 0.8 <= row[0].dice < 1


@pytest.mark.parametrize("around", ["{}", "This project, by Jane Doe, is {} and more words of other things follow it", "one two three " * 50 + "{} " + "four five " * 70])
def test_notices_beside_other_words(around):
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.LEAST)
    for name, texts in license_scan.TEMPLATES.items():
        for text in texts:
            if text.startswith("Redistribution") and len(text) < 200:
                continue  # the opening of both BSD licences
            assert min((-dice, found) for dice, found in scanner.notices(around.format(text)))[1] == name, text


def test_short_notices_in_a_line():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.LEAST)
    for text in ("This project is released under the MIT License.", "Copyright 2024 Jane Doe. Released under the MIT License."):
        assert scanner.notices(text) == [(1.0, "MIT")]
    assert scanner.notices("nothing of the kind is written here, under the bridge") == []


def test_empty_tables(no_docs):
    assert quality.assess(no_docs).count() == 0 and quality.filter_documents(no_docs).count() == 0
    assert prob_minhash.classes(no_docs).count() == 0 and prob_minhash.keep_one_each(no_docs).count() == 0
    assert suffix_dedup.report(no_docs).count() == 0 and suffix_dedup.clean_documents(no_docs).count() == 0
    assert license_scan.scan(no_docs).count() == 0


def test_only_documents_without_words(llm_spark):
    docs = llm_spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id bigint, text string").select("*", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"))
    assert [r.kept for r in quality.assess(docs).collect()] == [False] * 3
    assert sorted(map(tuple, prob_minhash.classes(docs).collect())) == [(1, 1), (2, 1), (3, 3)]


def test_report_carries_the_text_that_is_left(llm_spark):
    shared = " ".join(f"shared{k}" for k in range(60))
    rows = [(1, f"head {shared} tail"), (2, f"{shared} end"), (3, "alone"), (4, None)]
    found = {row.doc_id: (row.text, row.n_removed) for row in suffix_dedup.report(llm_spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1] == ("headtail", len(shared) + 2) or found[1][0].split() == ["head", "tail"]
    assert found[3] == ("alone", 0) and found[4] == ("", 0) and found[2][0].strip() == "end"
