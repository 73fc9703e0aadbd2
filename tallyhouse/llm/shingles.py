"""Sets of word shingles and their MinHash signatures, for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tallyhouse.llm.words import Texts, find_words, mix

#: An entry of a signature is a hash of the least of 32-bit hashes.
_MULTIPLIERS = np.random.default_rng(20_240_502).integers(1, 2**63, 1024, dtype=np.uint64) | np.uint64(1)
_SEQUENCE = np.uint64(0xA24BAED4963EE407)


@dataclass
class ShingleSets:
    """Sorted distinct 64-bit hashes of each text's shingles, end to end."""

    hashes: np.ndarray
    bounds: np.ndarray

    def of(self, text: int) -> np.ndarray:
        return self.hashes[self.bounds[text] : self.bounds[text + 1]]


def shingle_sets(texts: Texts, words_per_shingle: int) -> ShingleSets:
    """A-Z are lower-cased, words lie between white space. A text with fewer words than a
    shingle has its whole sequence as one; a text without words has none."""
    n = len(texts.offsets) - 1
    words = find_words(texts.lowered(), texts.offsets)
    bounds = words.bounds(n)
    counts = np.diff(bounds)
    hashes = words.hashes.copy()
    text = words.text
    if words_per_shingle > 1:
        short = (counts > 0) & (counts < words_per_shingle)
        whole = _joined(words.hashes, bounds[:-1][short], counts[short], words_per_shingle)
        size = max(0, len(hashes) - words_per_shingle + 1)
        joined = np.zeros(size, np.uint64)
        for k in range(words_per_shingle):
            joined = mix(joined + hashes[k : k + size] * _SEQUENCE)
        inside = text[:size] == text[words_per_shingle - 1 :][:size]
        hashes = np.concatenate([joined[inside], whole])
        text = np.concatenate([text[:size][inside], np.flatnonzero(short)])
    order = np.argsort(hashes)
    order = order[np.argsort(text[order], kind="stable")]
    hashes, text = hashes[order], text[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[first], text[first]
    return ShingleSets(hashes, np.searchsorted(text, np.arange(n + 1)))


def _joined(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Hashes of whole sequences of fewer than ``most`` words, unlike those of shingles."""
    whole = np.full(len(starts), 1, np.uint64)
    for k in range(most - 1):
        has = counts > k
        whole[has] = mix(whole[has] + hashes[starts[has] + k] * _SEQUENCE)
    return whole


def signatures(sets: ShingleSets, length: int) -> np.ndarray:
    """One row of ``length`` 16-bit values per text; zeros for an empty set."""
    n = len(sets.bounds) - 1
    signs = np.zeros((n, length), np.uint16)
    filled = np.flatnonzero(np.diff(sets.bounds))
    if len(filled):
        starts = sets.bounds[filled]
        for k in range(length):
            values = ((sets.hashes * _MULTIPLIERS[k]) >> np.uint64(32)).astype(np.uint32)
            least = np.minimum.reduceat(values, starts)
            signs[filled, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return signs


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
