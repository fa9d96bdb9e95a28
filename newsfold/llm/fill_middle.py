"""Fill-in-middle examples from texts held as seekable compressed frames.

A text is a run of zstandard frames, each compressed on its own, with the number of its code points up to the end of
each frame. A cut opens the one frame it falls into; all other frames move to the output as they are, and digests read
the frames one after the other. No step holds more than one frame of a text decompressed.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

FRAME_UNITS = 1 << 14
LEVEL = 1
#: Rows of one Arrow batch that a task returns.
ROWS = 512

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_FRAMES = "ARRAY<STRUCT<end: BIGINT, data: BINARY>>"
FRAMED = f"doc_id BIGINT, n BIGINT, marked BOOLEAN, frames {_FRAMES}"
TRANSFORMED = f"doc_id BIGINT, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, frames {_FRAMES}"
DIGESTED = "doc_id BIGINT, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, output_sha256 STRING, restored_sha256 STRING"

_ARROW_FRAMES = pa.list_(pa.struct([("end", pa.int64()), ("data", pa.binary())]))


class Frames:
    """A text as independent frames; ``ends`` counts the units up to the end of each."""

    def __init__(self, ends: list[int] | None = None, data: list[bytes] | None = None):
        self.ends, self.data = ends or [], data or []
        self._pack = zstandard.ZstdCompressor(level=LEVEL)
        self._open = zstandard.ZstdDecompressor()

    @classmethod
    def of(cls, text: str, size: int = FRAME_UNITS) -> Frames:
        frames = cls()
        for at in range(0, len(text), size):
            frames.add(text[at : at + size])
        return frames

    @classmethod
    def stored(cls, cells: list[dict]) -> Frames:
        return cls([cell["end"] for cell in cells], [cell["data"] for cell in cells])

    def cells(self) -> list[dict]:
        return [{"end": end, "data": data} for end, data in zip(self.ends, self.data)]

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def add(self, text: str) -> None:
        if text:
            self._append(len(text), self._pack.compress(text.encode()))

    def _append(self, units: int, data: bytes) -> None:
        self.ends.append(len(self) + units)
        self.data.append(data)

    def text(self, at: int) -> str:
        """The units of one frame."""
        return self._open.decompress(self.data[at]).decode()

    def begin(self, at: int) -> int:
        return self.ends[at - 1] if at else 0

    def bytes(self) -> Iterator[bytes]:
        """UTF-8 of the whole text, frame by frame."""
        return map(self._open.decompress, self.data)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.bytes():
            digest.update(part)
        return digest.hexdigest()

    def find(self, marker: str, start: int) -> int:
        """The unit at which ``marker`` first occurs at or after ``start``; it may lie across frames."""
        carried, first = "", start
        for at in range(bisect.bisect_right(self.ends, start), len(self.ends)):
            carried += self.text(at)[max(0, start - self.begin(at)) :]
            if (found := carried.find(marker)) >= 0:
                return first + found
            cut = max(0, len(carried) - len(marker) + 1)
            carried, first = carried[cut:], first + cut
        raise ValueError(f"no {marker} from unit {start} on")

    def spliced(self, parts: Iterable[str | tuple[int, int]]) -> Frames:
        """A new text of strings and of unit ranges of this one; only frames that a range cuts are opened."""
        out, pending = Frames(), []

        def flush() -> None:
            out.add("".join(pending))
            pending.clear()

        for part in parts:
            if isinstance(part, str):
                pending.append(part)
                continue
            start, end = part
            at = bisect.bisect_right(self.ends, start)
            while start < end:
                begin, stop = self.begin(at), min(end, self.ends[at])
                if start == begin and stop == self.ends[at]:
                    flush()
                    out._append(stop - start, self.data[at])
                else:
                    pending.append(self.text(at)[start - begin : stop - begin])
                start, at = stop, at + 1
        flush()
        return out


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that a document's form and cuts follow; a null id counts as no digits."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def transform_frames(doc_id: int | None, frames: Frames, marked: bool) -> tuple[str, int | None, int | None, Frames]:
    """Form, units of prefix and middle, and the output."""
    n, (first, second, shape, order) = len(frames), draws(doc_id)
    if not n or marked or shape % 100 >= 90:
        return PLAIN, None, None, frames
    low, high = sorted((first % (n + 1), second % (n + 1)))
    prefix, middle, suffix = (0, low), (low, high), (high, n)
    if order % 100 < 20:
        return SPM, low, high - low, frames.spliced([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return PSM, low, high - low, frames.spliced([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])


def restore_frames(form: str, output: Frames) -> Frames:
    """The text again, from the output and its form alone.

    Markers are no part of a transformed text, and none can arise across a cut, since each begins with ``<`` and ends
    with ``>``; so the first occurrence of a marker is the one that was put in.
    """
    if form == PLAIN:
        return output
    width, n = len(PREFIX), len(output)
    inner = output.find(PREFIX if form == SPM else SUFFIX, width)
    last = output.find(MIDDLE, inner + width)
    one, two, middle = (width, inner), (inner + width, last), (last + width, n)
    return output.spliced([two, middle, one] if form == SPM else [one, middle, two])


def _emitted(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``ROWS`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from batch.slice(at, ROWS).to_pylist()


def framed(docs: DataFrame, size: int = FRAME_UNITS) -> DataFrame:
    """``doc_id, n, marked, frames`` of every row: its text in frames, and whether a marker occurs in it.

    A null text counts as empty: no frames, ``n`` 0. Repeated rows stay; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("frames", _ARROW_FRAMES)])

    def pack(row: dict) -> tuple:
        text = row["text"] or ""
        frames = Frames.of(text, size)
        return row["doc_id"], len(frames), any(marker in text for marker in (PREFIX, SUFFIX, MIDDLE)), frames.cells()

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(
        lambda batches: _emitted(map(pack, _rows(batches)), schema), FRAMED
    )


def transformed(held: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, frames`` of every row of :func:`framed`: the output in frames.

    ``plain`` outputs are the text itself, with null counts. A null ``doc_id`` draws as if it had no digits.
    """
    counts = [(name, pa.int64()) for name in ("prefix_chars", "middle_chars")]
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), *counts, ("frames", _ARROW_FRAMES)])

    def transform(row: dict) -> tuple:
        form, prefix, middle, output = transform_frames(row["doc_id"], Frames.stored(row["frames"]), row["marked"])
        return row["doc_id"], row["n"], form, prefix, middle, output.cells()

    return held.select("doc_id", "n", "marked", "frames").mapInArrow(lambda batches: _emitted(map(transform, _rows(batches)), schema), TRANSFORMED)


def texts(held: DataFrame, restore: bool = False) -> DataFrame:
    """``doc_id, text``: the outputs of :func:`transformed` as strings, or the texts restored from them."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def opened(row: dict) -> tuple:
        output = Frames.stored(row["frames"])
        frames = restore_frames(row["form"], output) if restore else output
        return row["doc_id"], b"".join(frames.bytes()).decode()

    return held.select("doc_id", "form", "frames").mapInArrow(
        lambda batches: _emitted(map(opened, _rows(batches)), schema), "doc_id BIGINT, text STRING"
    )


def digests(held: DataFrame) -> DataFrame:
    """The rows of :func:`transformed` with SHA-256 of the output and of the text restored from it instead of frames."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    schema = pa.schema([*zip(names, kinds), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def digest(row: dict) -> tuple:
        output = Frames.stored(row["frames"])
        return (*(row[name] for name in names), output.sha256(), restore_frames(row["form"], output).sha256())

    return held.select(*names, "frames").mapInArrow(lambda batches: _emitted(map(digest, _rows(batches)), schema), DIGESTED)


def transform_documents(docs: DataFrame) -> DataFrame:
    """:func:`digests` of the outputs of all ``docs``; an empty table gives no rows. One narrow stage."""
    return digests(transformed(framed(docs)))
