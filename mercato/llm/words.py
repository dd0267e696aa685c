"""Vectorised word hashing over Arrow string batches.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``. Words, lines and
byte n-grams are named by 64-bit polynomial hashes (arithmetic modulo 2**64
over the UTF-8 bytes, finalised by a mixer), computed for all texts of a slice
with a few numpy passes. Slices hold about ``SLICE_BYTES`` bytes of text, so
the working memory does not depend on the batch; one text longer than that is
a slice by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, kept and grown by doubling."""
    if len(_POW.get("up", ())) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, b in (("up", _BASE), ("down", _INV)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _POW[name] = np.multiply.accumulate(p)
    return _POW["up"], _POW["down"]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser; different salts give independent-looking hashes."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class TextSlice:
    """Rows ``first .. first + n`` of a batch: their joined bytes and row offsets."""

    first: int
    n: int
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, n + 1 entries


def text_slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[TextSlice]:
    """Cuts a string column into slices of at most `rows` rows; a null text counts as an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(off, off[at] + slice_bytes, "right")) - 1
        end = min(max(end, at + 1), at + rows, len(texts))
        yield TextSlice(at, end - at, data[off[at]:off[end]], off[at:end + 1] - off[at])
        at = end


@dataclass
class Hasher:
    """Hashes of byte ranges of one slice from one prefix sum."""

    prefix: np.ndarray
    down: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> Hasher:
        up, down = _powers(len(data) + 1)
        prefix = np.empty(len(data) + 1, dtype=np.uint64)
        prefix[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])
        return cls(prefix, down)

    def ranges(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start], salt)


@dataclass
class Words:
    """Words of a slice in order: byte ranges, row of each, first word of each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray     # n + 1 entries: words of row r are first[r] .. first[r + 1]


def find_words(s: TextSlice) -> Words:
    if not len(s.data):
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(s.n + 1, np.int64))
    word = ~_SPACE[s.data]
    begins = np.empty(len(word), dtype=bool)
    begins[0] = word[0]
    np.logical_and(word[1:], ~word[:-1], out=begins[1:])
    inner = s.offsets[1:-1]
    inner = inner[inner < len(word)]
    begins[inner] = word[inner]                       # a word never runs over two rows
    start = np.flatnonzero(begins)
    ends = np.empty(len(word), dtype=bool)
    ends[-1] = word[-1]
    np.logical_and(word[:-1], ~word[1:], out=ends[:-1])
    last = inner[inner > 0] - 1
    ends[last] = word[last]
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, s.offsets)
    row = np.repeat(np.arange(s.n), np.diff(first))
    return Words(start, end, row, first)


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of k words inside one row (rows with fewer give none)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = (out + hashes[j:j + n]) * _BASE
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    ok = row[:n] == row[k - 1:]
    return mix(out[ok]), row[:n][ok]


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, empty ones included."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
