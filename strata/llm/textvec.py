"""Vectorised text helpers shared by the operators (numpy over the UTF-8 bytes of a batch of texts).

A batch of texts becomes one byte buffer; words, lines and n-grams are index arrays into it, and any substring
is hashed in constant time from prefix sums of a 64-bit polynomial hash.  Work is linear in the bytes, and the
callers cut batches by bytes, so memory follows ``MAX_BATCH_BYTES`` and the longest single text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_BATCH_BYTES = 1 << 20

#: bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return
SPACE_BYTES = np.zeros(256, dtype=bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i in 0..n (grown on demand, kept per worker)."""
    global _POWERS
    if len(_POWERS) <= n:
        steps = np.full(n + 1, _BASE & _MASK, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def document_batches(spark) -> None:
    """Session settings for rows that hold whole texts: Arrow batches of 1,000 rows and 8 MB.

    Spark's default of 10,000 rows suits narrow rows; with texts, a task's buffers on both sides would take hundreds of
    megabytes.  Settings that the session has made itself stay.
    """
    for key, default, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
                                ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b")):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = MAX_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into runs of rows whose text column holds at most ``max_bytes`` (or one row)."""
    if batch.num_rows == 0:
        return
    sizes = np.array([0 if v is None else v for v in
                      pc.binary_length(batch.column(column)).to_pylist()], dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers are few and live long: what a batch needed goes back


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of a column as UTF-8 bytes; null is an empty text."""
    return [v if v is not None else b"" for v in column.cast(pa.binary()).to_pylist()]


def decoded(column: pa.Array) -> list[str | None]:
    """Texts of a column as strings; malformed UTF-8 is read as U+FFFD."""
    return [None if v is None else v.decode("utf-8", "replace") for v in column.cast(pa.binary()).to_pylist()]


_BLANK = re.compile(rb"[\t-\r ]")


def pieces(text: bytes, size: int = MAX_BATCH_BYTES) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes that begin with white space, so that no word is cut; a word that is
    longer stays whole."""
    start = 0
    while len(text) - start > 2 * size and (cut := _BLANK.search(text, start + size)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def word_hashes(texts: list[bytes], size: int = MAX_BATCH_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, in order.  Long texts are hashed a piece at a time, so that memory follows the
    words and not the bytes."""
    if sum(map(len, texts)) <= 2 * size:
        batch = Texts(texts)
        starts, ends, text = batch.words()
        return batch.hashes(starts, ends), text
    found, owner = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for i, text in enumerate(texts):
        for piece in pieces(text, size):
            batch = Texts([piece])
            starts, ends, _ = batch.words()
            found.append(batch.hashes(starts, ends))
            owner.append(np.full(len(starts), i))
    return np.concatenate(found), np.concatenate(owner)


class Texts:
    """A batch of texts as one buffer (texts are separated by a line feed)."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=self.n)
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1].astype(np.int64)
        self.ends = self.starts + lengths
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self._sums: np.ndarray | None = None

    def prefix_sums(self) -> np.ndarray:
        if self._sums is None:
            n = len(self.buf)
            out = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODES[self.buf] * _powers(n)[:n], out=out[1:])
            self._sums = out
        return self._sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range ``[start, end)``; equal bytes give equal hashes at any place."""
        sums, n = self.prefix_sums(), len(self.buf)
        # divided by the power of the start, so that the hash doesn't depend on the place in the batch
        raw = (sums[ends] - sums[starts]) * _inverse_powers(n)[starts]
        return mix64(raw ^ (ends - starts).astype(np.uint64))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes in each text."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.ends] - sums[self.starts]

    def spans(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes whose ``member[byte]`` is true: (start, end, text number)."""
        inside = member[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        return starts, ends, np.searchsorted(self.starts, starts, side="right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of bytes other than ASCII white space."""
        return self.spans(~SPACE_BYTES)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines cut at line feeds: (start, end, text number); an empty text is one empty line."""
        ends = np.flatnonzero(self.buf == 0x0A)
        starts = np.concatenate(([0], ends[:-1] + 1))
        return starts, ends, np.searchsorted(self.starts, starts, side="right") - 1


_INVERSE = np.ones(1, dtype=np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    """``base ** -i`` modulo 2**64 (the base is odd, so it has an inverse)."""
    global _INVERSE
    if len(_INVERSE) <= n:
        steps = np.full(n + 1, pow(_BASE & _MASK, -1, 1 << 64), dtype=np.uint64)
        steps[0] = 1
        _INVERSE = np.multiply.accumulate(steps)
    return _INVERSE


#: windows that are hashed at a time
_WINDOW_STRIDE = 1 << 20


def windows(hashes: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` consecutive words inside one text: (first word index, hash)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(text[:n] == text[width - 1:])
    out = np.zeros(len(at), dtype=np.uint64)
    for low in range(0, len(at), _WINDOW_STRIDE):
        own, to = at[low:low + _WINDOW_STRIDE], out[low:low + _WINDOW_STRIDE]
        for j in range(width):
            to *= np.uint64(0xD6E8FEB86659FD93)
            to += hashes[own + j]
        to[:] = mix64(to)
    return at, out
