"""Vectorised text helpers used inside Arrow tasks: blocks of rows as one byte array, word spans, hashes.

A *block* is a run of consecutive rows whose UTF-8 bytes lie in one numpy array
with an offset per row (null counts as empty).  Blocks are cut by bytes, so the
arrays derived from them stay small whatever the rows per Arrow batch; a
single row longer than the bound is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

#: Makes the points at which the word and window hashes are taken.
BASE = 0x9E3779B97F4A7C15

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (UTF-8) of an Arrow string or binary column and the offset of each row (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes of ``column``, offsets) for slices of about ``max_bytes`` bytes each."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            cut = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[cut[0] : cut[-1]], cut - cut[0]
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of word bytes; runs never cross rows."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = is_word[data]
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    full = offsets[1:] > offsets[:-1]
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def one_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of ``[\\x20\\x09-\\x0D]`` within a row becomes one space."""
    white = WHITE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    full = offsets[1:] > offsets[:-1]
    keep[offsets[:-1][full]] = True
    out = np.where(white, np.uint8(0x20), data)[keep]
    position = np.concatenate(([0], np.cumsum(keep)))
    return out, position[offsets]


#: Prime modulus of the span hashes.
PRIME = (1 << 31) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint32)
    while len(out) < n:
        out = np.concatenate((out, (out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)).astype(np.uint32)))
    return out[:n]


@lru_cache(maxsize=16)
def _kept_powers(base: int, n: int) -> np.ndarray:
    return _powers(base, n)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo PRIME; those for blocks of the usual sizes are kept."""
    return (_kept_powers if n <= 1 << 21 else _powers)(base, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit words, so that every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Hashes of arbitrary spans of one byte array from prefix sums: ``sum((byte + 1) * base**i)`` shifted to start 0.

    Two points of the polynomial modulo a prime make 62 bits.  (Modulo a power of two, some texts would collide whatever the base.)
    """

    def __init__(self, data: np.ndarray, base: int = BASE):
        n = 1 << max(10, len(data).bit_length())  # few sizes, so that the powers are kept
        value = data.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for point in (base % PRIME, (base >> 31) % PRIME):
            prefix = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(value * powers(point, n)[: len(data)] % np.uint64(PRIME), out=prefix[1:])
            self.sums.append((prefix, powers(pow(point, -1, PRIME), n)))

    def __call__(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        both = np.zeros(len(starts), np.uint64)
        for prefix, inverse in self.sums:
            raw = (prefix[ends] - prefix[starts]) % np.uint64(PRIME) * inverse[starts] % np.uint64(PRIME)
            both = (both << np.uint64(31)) | raw
        return mix(both ^ mix(np.asarray(ends - starts, np.uint64) + np.uint64(seed)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return SpanHash(data)(starts, ends, seed)


def row_bounds(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Index of the first word of each row (``n_rows + 1`` values) from the sorted row of each word."""
    return np.searchsorted(rows, np.arange(n_rows + 1))
