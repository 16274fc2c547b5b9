"""Words of Arrow text columns as numpy arrays: offsets and 64-bit hashes, no Python object per word.

``SPACED`` words are runs without ASCII white space, ``ALNUM`` words are runs of ASCII letters, digits and
non-ASCII bytes. Both classes are made of whole bytes, so UTF-8 text is cut without being decoded.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_codes = np.arange(256)
SPACED = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))
ALNUM = ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x41) & (_codes <= 0x5A)) \
    | ((_codes >= 0x61) & (_codes <= 0x7A)) | (_codes >= 0x80)
LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 0x20, _codes).astype(np.uint8)
KEEP_CASE = _codes.astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


@dataclass
class Words:
    """All words of some rows, in row order."""

    data: np.ndarray     # bytes of the rows, case already changed
    rows: int
    row: np.ndarray      # row of each word
    start: np.ndarray    # byte offsets into data
    end: np.ndarray
    first: np.ndarray    # index of each row's first word, with the total at the end
    hash: np.ndarray | None = None

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def place(self) -> np.ndarray:
        """Position of each word in its row, from 0."""
        return np.arange(len(self.row)) - self.first[self.row]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes of text; a longer row is alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, to
        at = to


def split_bytes(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, case: np.ndarray = KEEP_CASE,
                hashed: bool = True, cuts: np.ndarray | None = None) -> Words:
    """Words of rows given as bytes; ``cuts`` marks further places between bytes where a word ends."""
    data = data if case is KEEP_CASE else case[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if cuts is not None:
        edge |= cuts
    change = inside[1:] != inside[:-1]
    start = np.flatnonzero((change | edge)[:-1] & inside[1:-1]) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero((change | edge)[1:] & inside[1:-1]) + 1 if len(data) else np.zeros(0, np.int64)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = Words(data, len(offsets) - 1, row, start, end, first)
    if hashed:
        words.hash = word_hashes(data, start, end, inside[1:-1])
    return words


def split(column: pa.Array, kind: np.ndarray, case: np.ndarray = KEEP_CASE, hashed: bool = True) -> Words:
    return split_bytes(*text_bytes(column), kind, case, hashed)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Multilinear hash of each word's bytes, then mixed; ``inside`` marks the bytes of words."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    begin = np.cumsum(length)
    begin = np.concatenate([[0], begin[:-1]])
    place = np.arange(length.sum(), dtype=np.int32)
    place -= np.repeat(begin.astype(np.int32), length)
    value = (data[inside].astype(np.uint64) + np.uint64(1))
    value *= constants(int(length.max()), 17)[place]
    return mix(np.add.reduceat(value, begin))


def grams(hashes: np.ndarray, n: int, seed: int = 29) -> np.ndarray:
    """Hash of the ``n`` values from each position on; positions whose run is cut short are left out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    factors, count = constants(n, seed * 1_000 + n), len(hashes) - n + 1
    out = hashes[:count] * factors[0]
    for i in range(1, n):
        out += hashes[i:i + count] * factors[i]
    return mix(out)


def grams_of_rows(code: np.ndarray, seed: int = 29) -> np.ndarray:
    """The hash that ``grams`` gives to each row's values."""
    n = code.shape[1]
    return mix((code * constants(n, seed * 1_000 + n)[None, :]).sum(axis=1, dtype=np.uint64))


def runs_inside(words: Words, n: int) -> np.ndarray:
    """For each position with ``n`` words left in the chunk: are all of them in one row?"""
    count = max(0, len(words.row) - n + 1)
    return words.row[:count] == words.row[n - 1:n - 1 + count]


def worker_cache(name: str, make: Callable):
    """A value that a Python worker keeps between its tasks."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)
