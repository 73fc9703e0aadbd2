"""Words of many texts at once, as numpy arrays.

A batch of texts is one run of bytes with offsets. Words are found and hashed over the
whole run, without a Python object per word. Batches are handled in slices of bounded
size; only a single text above that size makes a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: Word separators: the space and the five ASCII controls from tab to carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Everything in ASCII but letters and digits; other scripts count as letters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[0x80:] = False
for _first, _last in (b"09", b"AZ", b"az"):
    NOT_ALNUM[_first : _last + 1] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_KEYS = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@dataclass
class Texts:
    """Rows ``first..last-1`` of a batch: their bytes, and where each begins and ends."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def lowered(self) -> np.ndarray:
        return LOWER[self.data]


@dataclass
class Words:
    """Words of some texts in order: first byte, byte after the last, text, hash."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray

    def bounds(self, texts: int) -> np.ndarray:
        """Where each text's words begin; one more entry than texts."""
        return np.searchsorted(self.text, np.arange(texts + 1))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in slices of at most ``most`` bytes, or of one text. A null is
    an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, bytes_ = column.buffers()
    offsets = np.frombuffer(places, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Texts(
            first,
            last,
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


@cache
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _power(base: int, size: int) -> np.ndarray:
    return _powers(base, 1 << max(20, int(size).bit_length()))[:size]


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``sums`` for ``hashes_of``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_KEYS[data] * _power(_BASE, len(data)), out=sums[1:])
    return sums


def hashes_of(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, the same for equal bytes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts])


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> Words:
    """The maximal runs of bytes that are no separators, none across two texts."""
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    before[offsets] = False
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    return Words(starts, ends, text, hashes_of(prefix_hashes(data), starts, ends))


def totals(values: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Sum of ``values`` per text."""
    return np.bincount(text, values, texts)
