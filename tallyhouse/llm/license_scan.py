"""License notices in texts: winnowed fingerprints, then banded alignment.

Texts and templates are compared by their ASCII letters and digits (A-Z lower-cased) and all
bytes of other scripts. A template is reduced to the winnowed hashes of its runs of ``RUN``
such bytes: the least of each ``WINNOW`` neighbours. They form an inverted index from hash
to template and place, which is shipped to the tasks; a text is looked up at every
byte, so that any ``RUN + WINNOW - 1`` bytes shared with a template are found. Hits on nearby
diagonals make a candidate region, whose words are aligned with the template's in a
band around the diagonal (match 2, change or gap -1, best local score). A region
is reported if the matched words are at least ``LEAST_COVERAGE`` of the template's and no
better match of the same template overlaps it. Between such matches, what is aligned less is
chained: parts of one template in its order are added up, however far apart, as text may be
inserted into a notice. A chain that reaches the coverage is one match, from its first matched
word to its last. Chains are the longest rising runs of the template's words, found in one pass
from left to right in the order of n log n of the matched words.

The index holds one entry per few template bytes. It is shipped in blocks of at
most ``INDEX_ENTRIES``; a larger set of templates takes one pass over the texts per block.

Defined results: a null or empty text or template has no match. Templates that are shorter
than ``RUN`` bytes cannot be found. Repeated rows give repeated matches, a repeated template
gives one match per row of it. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect, bisect_left, insort
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import groupby
from math import inf
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.arrow import map_batches
from tallyhouse.llm.columns import id_and_text
from tallyhouse.llm.words import LOWER, NOT_ALNUM, Texts, find_words, hashes_of, prefix_hashes, slices

RUN, WINNOW = 12, 8
BAND_WORDS = 8
GAP_BYTES = 64
LEAST_COVERAGE = 0.75
INDEX_ENTRIES = 1 << 20
_SIEVE_BITS = 18
MATCHES = (
    "doc_id bigint, template string, coverage double, matched_words bigint, template_words bigint, "
    "first_byte bigint, last_byte bigint, text string"
)


def _run_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all runs of ``RUN`` compared bytes within one text: hash, place among the compared
    bytes; and where each compared byte stands in the data."""
    places = np.flatnonzero(~NOT_ALNUM[data])
    packed = LOWER[data[places]]
    if len(packed) < RUN:
        return np.empty(0, np.uint64), np.empty(0, np.int64), places
    starts = np.arange(len(packed) - RUN + 1)
    text = np.searchsorted(offsets, places, "right")
    starts = starts[text[starts] == text[starts + RUN - 1]]
    return hashes_of(prefix_hashes(packed), starts, starts + RUN), starts, places


def _winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the least hash of each ``WINNOW`` neighbours, of all of them if fewer."""
    if not len(hashes):
        return np.empty(0, np.int64)
    size = min(WINNOW, len(hashes))
    windows = np.lib.stride_tricks.sliding_window_view(hashes, size)
    return np.unique(windows.argmin(1) + np.arange(len(windows)))


def _words(text: bytes) -> list[tuple[int, int, bytes]]:
    data = np.frombuffer(text, np.uint8)
    words = find_words(data, np.array([0, len(data)]), NOT_ALNUM)
    return [(int(a), int(b), text[a:b].lower()) for a, b in zip(words.starts, words.ends)]


@dataclass(frozen=True)
class Index:
    """A block of the inverted index: hashes in order, template and place of each."""

    hashes: np.ndarray
    template: np.ndarray
    place: np.ndarray
    names: tuple[str, ...]
    texts: tuple[bytes, ...]
    sizes: np.ndarray

    @staticmethod
    def of(templates: list[tuple[str, str]]) -> Index:
        found, texts = [], [(text or "").encode() for _, text in templates]
        sizes = np.zeros(len(texts), np.int64)
        for number, text in enumerate(texts):
            data = np.frombuffer(text, np.uint8)
            hashes, starts, places = _run_hashes(data, np.array([0, len(data)]))
            sizes[number] = len(places)
            kept = _winnowed(hashes)
            found.append((hashes[kept], np.full(len(kept), number), starts[kept]))
        hashes, template, place = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(hashes, kind="stable")
        names = tuple(name for name, _ in templates)
        return Index(hashes[order], template[order], place[order], names, tuple(texts), sizes)

    def sieve(self) -> np.ndarray:
        sieve = np.zeros(1 << _SIEVE_BITS, bool)
        sieve[(self.hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True
        return sieve

    def regions(self, texts: Texts, sieve: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text, template, first and last byte of the places that may hold a template."""
        hashes, starts, places = _run_hashes(texts.data, texts.offsets)
        maybe = np.flatnonzero(sieve[(hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
        first = np.searchsorted(self.hashes, hashes[maybe], "left")
        times = np.searchsorted(self.hashes, hashes[maybe], "right") - first
        entries = np.arange(times.sum()) + np.repeat(first - np.cumsum(times) + times, times)
        if not len(entries):
            return
        at = np.repeat(starts[maybe], times)
        text = np.searchsorted(texts.offsets, places[at], "right") - 1
        template = self.template[entries]
        begin = at - self.place[entries]
        order = np.lexsort((begin, template, text))
        text, template, begin = text[order], template[order], begin[order]
        # Places that differ by less than half a template are one place with gaps.
        gap = np.minimum(GAP_BYTES, self.sizes[template] // 2)
        new = np.ones(len(order), bool)
        new[1:] = (
            (text[1:] != text[:-1]) | (template[1:] != template[:-1]) | (np.diff(begin) > gap[1:])
        )
        bounds = np.append(np.flatnonzero(new), len(order))
        own = np.searchsorted(places, texts.offsets)  # where each text's compared bytes begin
        for a, b in zip(bounds[:-1], bounds[1:]):
            t, size = text[a], self.sizes[template[a]]
            low = max(own[t], begin[a] - gap[a])
            high = min(own[t + 1], begin[b - 1] + size + gap[a]) - 1
            yield int(t), int(template[a]), int(places[low]), int(places[high]) + 1


@lru_cache(maxsize=4096)
def align(region: bytes, template: bytes) -> tuple[int, list[tuple[int, int, int]]]:
    """Words of the template, and per matched word its number there and its first and last
    byte in the region: the best local alignment of words whose shift stays within ``BAND_WORDS`` of the
    longer side's surplus."""
    ours, theirs = _words(region), _words(template)
    surplus = abs(len(ours) - len(theirs))
    low, high = -BAND_WORDS, BAND_WORDS
    low, high = (low, high + surplus) if len(ours) > len(theirs) else (low - surplus, high)
    # Per cell: score, matches, the matched pairs as a linked list. Rows are words of the template.
    nothing = (0, 0, None)
    before: dict[int, tuple] = {}
    best = nothing
    for i, (_, _, word) in enumerate(theirs):
        row: dict[int, tuple] = {}
        for j in range(max(0, i + low), min(len(ours), i + high + 1)):
            score, matches, pairs = before.get(j - 1, nothing)
            if ours[j][2] == word:
                cell = (score + 2, matches + 1, (i, j, pairs))
            else:
                options = (
                    (score - 1, matches, pairs),
                    *((s - 1, m, p) for s, m, p in (before.get(j, nothing), row.get(j - 1, nothing))),
                )
                cell = max(options, key=lambda c: (c[0], c[1]))
            if cell[0] <= 0:
                cell = nothing
            row[j] = cell
            if cell[:2] > best[:2]:
                best = cell
        before = row
    found, pairs = [], best[2]
    while pairs:
        i, j, pairs = pairs
        found.append((i, ours[j][0], ours[j][1]))
    return len(theirs), found[::-1]


class _Chain:
    """The most matched words that are in order in template and text, of pairs that come in the
    order of the text; of equally many those that begin last."""

    def __init__(self) -> None:
        self.numbers: list[int] = []  # least last word of the template, by length of chain
        self.ends: list[tuple] = []  # pair, and the chain before it
        self.grown: list[tuple] = []  # first byte of the pairs that made it longer, and the chain then

    def add(self, pair: tuple[int, int, int]) -> bool:
        """Whether the longest chain has grown."""
        place = bisect_left(self.numbers, pair[0])
        linked = (pair, self.ends[place - 1] if place else None)
        if place < len(self.numbers):
            self.numbers[place], self.ends[place] = pair[0], linked
            return False
        self.numbers.append(pair[0])
        self.ends.append(linked)
        self.grown.append((pair[1], linked))
        return True

    def __len__(self) -> int:
        return len(self.numbers)

    def longest(self, until: float = inf) -> list[tuple[int, int, int]]:
        """The longest chain of the pairs that begin before the byte ``until``."""
        found, linked = [], self.ends[-1] if until == inf else None
        if until < inf:
            linked = self.grown[bisect_left(self.grown, until, key=itemgetter(0)) - 1][1]
        while linked:
            found.append(linked[0])
            linked = linked[1]
        return found[::-1]


def _chains(parts: Iterable[list[tuple]], least: float) -> Iterator[list[tuple]]:
    """Chains of at least ``least`` words over the parts of one template, from left to right and
    without overlap, in one pass. A chain that is long enough is extended by what follows, up to
    where words that did not extend it make one that is long enough by itself."""
    pairs = sorted({pair for part in parts for pair in part}, key=lambda pair: (pair[1], -pair[0]))
    chain, other = _Chain(), _Chain()
    for pair in pairs:
        grown = chain.add(pair)
        if len(chain) < least or (grown and not other):
            continue
        other.add(pair)
        if len(other) >= least:
            yield chain.longest(until=other.longest()[0][1])
            chain, other = other, _Chain()
    if len(chain) >= least:
        yield chain.longest()


def _apart(edges: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether the range overlaps none of the ranges in order."""
    place = bisect(edges, (a, b))
    return (not place or edges[place - 1][1] <= a) and (place == len(edges) or b <= edges[place][0])


def _aligned(data: np.ndarray, regions: Iterable[tuple], template: bytes, least: float) -> list[tuple]:
    """Matched words, words, first and last byte of the best alignments that do not overlap
    and of the chains between them."""
    found = []
    words = 0
    for _, _, first, last in regions:
        words, pairs = align(data[first:last].tobytes(), template)
        if pairs:
            found.append([(number, first + a, first + b) for number, a, b in pairs])
    best: list[tuple] = []
    edges: list[tuple[int, int]] = []
    parts = []
    for pairs in sorted(found, key=lambda pairs: (-len(pairs), pairs[0][1])):
        a, b = pairs[0][1], pairs[-1][2]
        if len(pairs) < least * words:
            parts.append(pairs)
        elif _apart(edges, a, b):
            best.append((len(pairs), words, a, b))
            insort(edges, (a, b))
    between: dict[int, list] = {}
    for pairs in parts:
        a, b = pairs[0][1], pairs[-1][2]
        if _apart(edges, a, b):
            between.setdefault(bisect(edges, (a, b)), []).append(pairs)
    for left in between.values() if words else ():
        for chain in _chains(left, least * words):
            best.append((len(chain), words, chain[0][1], chain[-1][2]))
    return best


def scan(
    docs: DataFrame,
    templates: Mapping[str, str],
    id_column: str = "doc_id",
    text_column: str = "text",
    least_coverage: float = LEAST_COVERAGE,
    index_entries: int = INDEX_ENTRIES,
) -> DataFrame:
    """One row per match, as ``MATCHES``. Byte ranges are of the text in UTF-8. Overlapping
    matches of different templates are all reported."""
    rows = id_and_text(docs, id_column, text_column)
    blocks: list[list[tuple[str, str]]] = [[]]
    size = 0
    for name, text in templates.items():
        size += len(text or "")  # no more entries than bytes
        if size > index_entries and blocks[-1]:
            blocks.append([])
            size = len(text or "")
        blocks[-1].append((name, text))
    return reduce(DataFrame.unionByName, [_scan(rows, block, least_coverage) for block in blocks])


def _scan(rows: DataFrame, templates: list[tuple[str, str]], least_coverage: float) -> DataFrame:
    index = Index.of(templates or [("", "")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = index.sieve()
        names = [field.split()[0] for field in MATCHES.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4, pa.string()]
        for batch in batches:
            ids, found = batch.column(0), []
            for part in slices(batch.column(1)):
                pairs = groupby(index.regions(part, sieve), key=lambda region: region[:2])
                for (text, template), regions in pairs:
                    base = int(part.offsets[text])
                    for matched, words, a, b in _aligned(
                        part.data, regions, index.texts[template], least_coverage
                    ):
                        found.append((
                            ids[part.first + text].as_py(), index.names[template],
                            matched / words, matched, words, a - base, b - base,
                            part.data[a:b].tobytes().decode(),
                        ))
            columns = list(zip(*found)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return map_batches(rows, run, MATCHES)
