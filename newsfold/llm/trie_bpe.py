"""BPE encoding by a depth-first walk over the trie of distinct words, and decoding.

The last token of a prefix's encoding is the only token that ends the prefix and stays apart from the last token of
what comes before it. So a node's state, the last token of its prefix, follows from the states on the path above it,
and words with a common prefix share these states. Words in sorted order visit the trie depth first; only the states
of the current path are held.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from newsfold.llm.blocks import blocks
from newsfold.llm.tokens import TextEncoder, little_endian

#: Pairs of tokens whose separation a worker remembers before it starts anew.
REMEMBERED_PAIRS = 500_000

ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + at) for at, byte in enumerate(hidden)}


class TrieBpe:
    """Ids of white-space-free units by the vocabulary and merges of a tokenizer file with an end-of-word suffix.

    Normalising and splitting of units beyond ASCII is left to the tokenizer's own components.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, self.library = described["model"], Tokenizer.from_file(path)
        self.special = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.ascii_words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
        suffix, self.to_byte = model["end_of_word_suffix"], {char: byte for byte, char in byte_characters().items()}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.spelling = {number: token for token, number in model["vocab"].items()}
        self.spelling |= {number: token for token, number in self.special.items()}
        for token, number in model["vocab"].items():
            ends = token.endswith(suffix) and token != suffix
            (self.final if ends else self.inner)[self.as_bytes(token.removesuffix(suffix) if ends else token)] = number
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.merged = {}
        for rank, (left, right) in enumerate(model["merges"]):
            left, right = model["vocab"][left], model["vocab"][right]
            self.merged[left, right] = rank, model["vocab"][self.spelling[left] + self.spelling[right]]
        self.symbols = {number: [self.inner[bytes([byte])] for byte in token] for token, number in self.inner.items()}
        for token, number in self.final.items():
            self.symbols[number] = [*(self.inner[bytes([b])] for b in token[:-1]), self.final[token[-1:]]]
        self.pairs: dict[int, bool] = {}

    def as_bytes(self, token: str) -> bytes:
        return bytes(map(self.to_byte.__getitem__, token))

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges of a short run of symbols, lowest rank first."""
        while len(symbols) > 1:
            best = min((self.merged.get(pair, (1 << 60, -1)) for pair in zip(symbols, symbols[1:])))
            if best[1] < 0:
                break
            out, at = [], 0
            while at < len(symbols):
                if at + 1 < len(symbols) and self.merged.get((symbols[at], symbols[at + 1])) == best:
                    out.append(best[1])
                    at += 2
                else:
                    out.append(symbols[at])
                    at += 1
            symbols = out
        return symbols

    def apart(self, left: int, right: int) -> bool:
        """Whether ``right`` after ``left`` (or, if that is -1, at the start) is how their text is encoded."""
        key = (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > REMEMBERED_PAIRS:
                self.pairs.clear()
            before = [] if left < 0 else [left]
            known = self.merge([*(self.symbols[left] if before else []), *self.symbols[right]]) == [*before, right]
            self.pairs[key] = known
        return known

    def last_token(self, word: bytes, end: int, states: list[tuple[int, int]], vocabulary: dict[bytes, int]) -> tuple[int, int]:
        """The token that ends ``word[:end]`` and where it begins."""
        for begin in range(max(0, end - self.longest), end):
            token = vocabulary.get(word[begin:end])
            if token is not None and self.apart(states[begin][0], token):
                return token, begin
        raise ValueError(f"the vocabulary doesn't cover {word!r}")

    def words(self, distinct: set[bytes]) -> dict[bytes, list[int]]:
        """Ids of each word."""
        found: dict[bytes, list[int]] = {}
        states, path = [(-1, 0)], b""
        for word in sorted(distinct):
            shared, most = 0, min(len(states) - 1, len(path), len(word) - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word)):
                states.append(self.last_token(word, end, states, self.inner))
            token, begin = self.last_token(word, len(word), states, self.final)
            ids = [token]
            while begin:
                token, begin = states[begin]
                ids.append(token)
            found[word] = ids[::-1]
            path = word
        return found

    def split(self, unit: str) -> list[int | bytes]:
        """Special ids and words of a unit, in order."""
        if unit.isascii() and "<|" not in unit:
            return [word.encode() for word in self.ascii_words.findall(unit.lower())]
        out: list[int | bytes] = []
        for part in self.special_pattern.split(unit):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                out += [self.as_bytes(word) for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def encode(self, units: list[str]) -> list[list[int]]:
        split = [self.split(unit) for unit in units]
        found = self.words({word for parts in split for word in parts if isinstance(word, bytes)})
        return [[i for part in parts for i in (found[part] if isinstance(part, bytes) else [part])] for parts in split]


class SpelledEncoder(TextEncoder):
    """Keeps the decoded form of each remembered unit: its tokens with a space between them."""

    def __init__(self, bpe: TrieBpe):
        self.spelling = {number: token.encode() for number, token in bpe.spelling.items()}
        super().__init__(bpe.encode)

    def forget(self) -> None:
        super().forget()
        self.spelled: list[bytes] = []

    def learn(self, units: list[bytes]) -> None:
        first, used = len(self.place), self.used
        super().learn(units)
        for ids in _runs(self.ids[used : self.used].tolist(), self.counts[first : len(self.place)].tolist()):
            self.spelled.append(b" ".join(map(self.spelling.__getitem__, ids)))


@lru_cache(maxsize=1)
def worker_encoder(tokenizer: str) -> SpelledEncoder:
    """The encoder of this Python worker, kept from task to task with the words it has met."""
    return SpelledEncoder(TrieBpe(tokenizer))


def _runs(values: list[int], counts: list[int]) -> Iterator[list[int]]:
    at = 0
    for count in counts:
        yield values[at : at + count]
        at += count


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row.

    A null or empty text has no ids and decodes to the empty text. Repeated rows are encoded each; other columns are
    ignored. One narrow stage: every worker walks the trie of the words it has not met before.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for rows, data, offsets in blocks(batches, "text"):
            at, units = encoder.places(data, offsets)
            ids, ends = encoder.ids_of(at, units)
            spelled, counts = encoder.spelled, encoder.counts[at]
            # A unit of wide white space alone has no ids, and so no place in the decoded text.
            filled = at[counts > 0].tolist()
            firsts = [0, *counts.__gt__(0).cumsum().tolist()]
            of_ids, of_text = [], []
            for row in range(rows.num_rows):
                of_ids.append(hashlib.sha256(little_endian(ids[ends[row] : ends[row + 1]])).hexdigest())
                own = filled[firsts[units[row]] : firsts[units[row + 1]]]
                of_text.append(hashlib.sha256(b" ".join(map(spelled.__getitem__, own))).hexdigest())
            columns = [rows.column("doc_id"), pa.array(ends[1:] - ends[:-1]), pa.array(of_ids), pa.array(of_text)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(digest, ENCODED)
