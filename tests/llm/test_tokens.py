"""Packing, trie encoding and the id store against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from newsfold.llm import id_store, packing, trie_bpe  # noqa: E402
from newsfold.llm.scratch import Scratch  # noqa: E402

WORDS, BYTES = public.path("word_bpe_49k.json"), public.path("byte_bpe_50k.json")


def library_ids(path, texts):
    tokenizer = tokenizers.Tokenizer.from_file(path)
    return [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts], tokenizer


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_trie_ids_and_decoded_text_are_the_library_s(odd_docs, odd_rows):
    ids, tokenizer = library_ids(WORDS, [row[1] for row in odd_rows])
    expected = Counter(
        (row[0], len(own), hashlib.sha256(raw(own)).hexdigest(), hashlib.sha256(tokenizer.decode(own, skip_special_tokens=False).encode()).hexdigest())
        for row, own in zip(odd_rows, ids)
    )
    assert Counter(map(tuple, trie_bpe.encode_documents(odd_docs, WORDS).collect())) == expected


def test_trie_of_random_words():
    pick = random.Random(2)
    words = ["".join(pick.choice("etaoinshrdlu'0-_é") for _ in range(pick.randint(1, 14))) for _ in range(3000)]
    found = trie_bpe.TrieBpe(WORDS).encode(words)
    assert found == library_ids(WORDS, words)[0]


def test_pieces_and_places(odd_docs, odd_rows):
    ids, _ = library_ids(WORDS, [row[1] for row in odd_rows])
    expected = Counter()
    for row, own in zip(odd_rows, ids):
        own = [*own, 0]
        for piece, start in enumerate(range(0, len(own), 2048)):
            part = own[start : start + 2048]
            expected[row[0], piece, start, len(part), zlib.crc32(raw(part))] += 1
    rows = packing.pack_documents(odd_docs, WORDS).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by_sequence = defaultdict(list)
    for row in rows:
        by_sequence[row.sequence_id].append((row.offset, row.length))
    for parts in by_sequence.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 2048) + 1


@pytest.mark.parametrize("lengths", [[1], [5] * 41, [10, 9, 1, 1, 8, 2, 7, 3], list(range(1, 11)) * 30, [6] * 9 + [4] * 3])
def test_rounds_fill_without_gaps(lengths):
    counts = Counter(lengths)
    plan = sorted(packing.rounds(counts, 10))
    sequences = defaultdict(list)
    for at, (size, rank, first, offset) in enumerate(plan):
        end = plan[at + 1][1] if at + 1 < len(plan) and plan[at + 1][0] == size else counts[size]
        for k in range(end - rank):
            sequences[first + k].append((offset, size))
    assert Counter(size for parts in sequences.values() for _, size in parts) == counts
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 10


def test_lengths_beyond_the_capacity_are_refused(llm_spark):
    with pytest.raises(ValueError):
        packing.pack(llm_spark.createDataFrame([(1, 0, 11)], "doc_id bigint, piece int, length bigint"), 10)


def test_ranks_of_a_frequent_length(llm_spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 10)
    rows = llm_spark.range(300).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") < 250, 7).otherwise(3).alias("length"))
    found = packing.with_rank(rows, "length", "doc_id", "piece").collect()
    for length, count in ((7, 250), (3, 50)):
        assert sorted(row["rank"] for row in found if row["length"] == length) == list(range(count))


def store_of(spark, docs, monkeypatch, **bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(id_store, name, value)
    folder = Scratch(spark, "ids").path("store")
    id_store.write_store(docs, folder, BYTES, 50_257, segment_keys=16)
    return folder


def test_store_holds_the_library_s_ids(llm_spark, odd_docs, odd_rows, monkeypatch):
    folder = store_of(llm_spark, odd_docs, monkeypatch, SHARD_IDS=500)
    ids, _ = library_ids(BYTES, [row[1] for row in odd_rows])
    expected = Counter((row[0], len(own) + 1, zlib.crc32(raw([*own, 2]))) for row, own in zip(odd_rows, ids))
    rows = id_store.read_documents(id_store.with_occurrence(odd_docs.select("doc_id"), "doc_id"), folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    ordered = sorted(rows, key=lambda row: row.start)
    assert [row.start for row in ordered] == [0, *np.cumsum([row.n_tokens for row in ordered])[:-1]]
    assert [-1 if row.doc_id is None else row.doc_id for row in ordered] == sorted(-1 if row[0] is None else row[0] for row in odd_rows)


def test_keyed_access(llm_spark, odd_docs, odd_rows, monkeypatch):
    folder = store_of(llm_spark, odd_docs, monkeypatch, SHARD_IDS=500)
    ids, _ = library_ids(BYTES, [odd_rows[9][1]])
    assert id_store.document_ids(llm_spark, folder, 9) == [*ids[0], 2]
    assert id_store.document_ids(llm_spark, folder, 3, occurrence=2) == id_store.document_ids(llm_spark, folder, 3)
    assert id_store.document_ids(llm_spark, folder, 123_456) == []


def test_hash_is_minimal_and_perfect():
    keys = id_store.mixed(np.arange(5000), 5)
    levels = id_store.build_hash(keys)
    assert sorted(id_store.slots(levels, keys)) == list(range(5000))


def test_empty_tables(llm_spark, no_docs, monkeypatch):
    assert trie_bpe.encode_documents(no_docs, WORDS).count() == 0
    assert packing.pack_documents(no_docs, WORDS).count() == 0
    folder = store_of(llm_spark, no_docs, monkeypatch)
    assert id_store.read_documents(id_store.with_occurrence(no_docs.select("doc_id"), "doc_id"), folder).count() == 0
