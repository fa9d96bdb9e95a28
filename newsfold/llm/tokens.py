"""Ids of whole texts by a public tokenizer, each distinct unit of text encoded once per worker.

A unit is a stretch of text that its tokenizer encodes in the same way wherever it stands: for a tokenizer that drops
white space a run without white space, for a byte-level one a run of white space with the run after it, both parted
before punctuation.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from newsfold.llm.blocks import SPACE, gather, pieces, words

#: Units a worker remembers before it starts anew; bounds its memory.
REMEMBERED_UNITS = 500_000

#: Characters after which white space surely starts a new unit: printable ASCII.
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_MARK = _PLAIN.copy()
_MARK[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = False
_TWO_BYTE_LEAD = np.zeros(256, dtype=bool)
_TWO_BYTE_LEAD[0xC3:0xE0] = True


def before_marks(data: np.ndarray) -> np.ndarray:
    """Positions of ASCII punctuation right after an ASCII letter, where both tokenizers' patterns part.

    None where a special token might stand, which holds such a place.
    """
    if ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
        return np.zeros(0, np.int64)
    return np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of a tokenizer that drops white space: runs without white space, parted before punctuation."""
    starts, ends, rows = words(data, offsets)
    marks = before_marks(data)
    marks = marks[~np.isin(marks, offsets)] if len(marks) else marks  # texts that touch
    if not len(marks):
        return starts, ends, rows
    starts, ends = np.sort(np.concatenate([starts, marks])), np.sort(np.concatenate([ends, marks]))
    return starts, ends, np.searchsorted(starts, offsets)


def tiles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of a byte-level tokenizer, which cover the text: white space and what follows it, parted before punctuation.

    A cut stands before ASCII white space whose predecessor is certainly no white space (printable ASCII, or a
    two-byte character other than those led by 0xC2); elsewhere the unit just gets longer.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(len(data), dtype=bool)
    space = SPACE[data]
    cut[1:] = space[1:] & _PLAIN[data[:-1]]
    wide = np.flatnonzero(space[2:] & (data[1:-1] >= 0x80)) + 2
    cut[wide[_TWO_BYTE_LEAD[data[wide - 2]]]] = True
    cut[before_marks(data)] = True
    cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


class LibraryEncoder:
    """Ids of a list of units by the tokenizers library, without truncation or padding.

    A call for every unit costs more than the merges in it, so plain units are encoded many to a text, in which each
    starts with white space, and told apart by the lengths of their tokens. A text whose tokens don't end where its
    units do, and any unit that isn't plain, is encoded unit by unit.
    """

    JOINED = 1000

    def __init__(self, path: str, byte_level: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Word units are normalised without a change of length if they are printable ASCII or Latin-1.
        self.plain = re.compile(r"[\t-\r ]+(?:.*[^\s\x00-\x1f])?" if byte_level else r"[!-~\xa1-\xff]+", re.DOTALL)
        self.ends_solid = byte_level
        self.between = "" if byte_level else " "
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        special = {number: token.content for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab()
        self.length = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():  # a character of a byte-level token stands for a byte
            self.length[number] = len(special[number].encode()) if number in special else len(token.removesuffix(suffix) if suffix else token)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, units: list[str]) -> list[list[int]]:
        ids = self.ids([self.between.join(units)])[0]
        ends = np.cumsum(self.length[ids])
        wanted = np.cumsum([len(unit.encode()) for unit in units])
        at = np.searchsorted(ends, wanted)
        if at[-1] + 1 != len(ids) or (ends[at] != wanted).any():
            return self.ids(units)
        cuts = [0, *(at + 1).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def __call__(self, units: list[str]) -> list[list[int]]:
        plain = [at for at, unit in enumerate(units) if self.plain.fullmatch(unit) and not (self.ends_solid and unit[-1].isspace())]
        found: list[list[int]] = [[]] * len(units)
        for first in range(0, len(plain), self.JOINED):
            part = plain[first : first + self.JOINED]
            for at, ids in zip(part, self.joined([units[at] for at in part])):
                found[at] = ids
        rest = sorted(set(range(len(units))).difference(plain))
        for at, ids in zip(rest, self.ids([units[at] for at in rest])):
            found[at] = ids
        return found


class TextEncoder:
    """Ids of blocks of texts; ``encode`` maps distinct units to lists of ids."""

    def __init__(self, encode, split=word_units, remembered: int = REMEMBERED_UNITS):
        self.encode, self.split, self.remembered = encode, split, remembered
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.counts = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def learn(self, units: list[bytes]) -> None:
        found = self.encode([unit.decode("utf-8") for unit in units])
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        first, total = len(self.place), int(counts.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(units) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.ids[self.used : self.used + total] = np.fromiter((i for row in found for i in row), dtype=np.int32, count=total)
        self.starts[first : first + len(units)] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + len(units)] = counts
        self.used += total
        self.place.update(zip(units, range(first, first + len(units))))

    def places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each unit's encoding, and each row's offsets into these."""
        starts, ends, rows = self.split(data, offsets)
        coded = pieces(data, starts, ends).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) + len(distinct) > self.remembered:
            self.forget()
        if new := [unit for unit in distinct if unit not in self.place]:
            self.learn(new)
        at = np.fromiter(map(self.place.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return at[codes] if len(codes) else np.zeros(0, np.int64), rows

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and each row's offsets into them."""
        return self.ids_of(*self.places(data, offsets))

    def ids_of(self, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return gather(self.ids, self.starts[at], counts), ends[rows]


@lru_cache(maxsize=1)
def worker_encoder(path: str, byte_level: bool) -> TextEncoder:
    """The encoder of this Python worker, kept from task to task with the units it has met."""
    return TextEncoder(LibraryEncoder(path, byte_level), tiles if byte_level else word_units)


def little_endian(ids: np.ndarray) -> memoryview:
    """The ids as little-endian unsigned 32-bit integers."""
    return memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
