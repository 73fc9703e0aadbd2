"""Periodic runs in the words of a text: passages that repeat at once, four times or more.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends, at
least ``least_words`` long and at least ``least_repeats`` times its period.

Runs are read off maximal pairs. The suffixes of the text's words are put in order by prefix
doubling, their common prefixes give the LCP intervals, and these are met bottom-up, deepest
first. An interval of depth ``d`` holds the places where one sequence of ``d`` words begins, in
order, each in the class of the word to its left. Where intervals meet in their parent, two
places of different children differ in the word after the sequence; if their classes differ
too, they are a maximal pair: equal for exactly ``d`` words and neither way longer. Its distance
``q`` makes a stretch of ``q + d`` words with period ``q`` that nothing extends, so a pair whose
distance meets the constraints is a run as it stands. Only neighbours in the merged order are
paired: a place between the two would give the stretch a smaller period. That also is why the
places are one list with a class each, and not a list per class: a neighbour is found by one
search, whatever its class. Intervals whose places all have one class have no pair, and are not
searched.

A run has at least ``d >= max(least_words - q, (least_repeats - 1) * q)`` equal words, so no
interval that is shallower than any run's is built, and a text without a sequence of that many
words that occurs twice is done after one look. Smaller intervals are merged into larger ones.
Words are numbered per text by equality of their bytes; nothing is compared by hash.

Defined results: a null or empty text, or one of separators only, has no words, no runs and an
empty collapsed text. Repeated rows give repeated rows, a null id stays null. Other columns are
not read. An empty table gives no rows. A long text takes some 60 bytes of memory a word in the
one task that holds its row.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.arrow import annotate
from tallyhouse.llm.columns import id_and_text

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Run = tuple[int, int, int]

#: About a megabyte of a text, up to the end of a word.
_BLOCK = re.compile(rb"(?s).{1,1000000}[^\x20\x09-\x0D]*")
_MIXED = -2


def numbered_words(text: bytes) -> tuple[array, list[bytes]]:
    """The words of a text as numbers, and the word of each number."""
    numbers: dict[bytes, int] = {}
    words = array("i")
    for block in _BLOCK.finditer(text):
        words.extend([numbers.setdefault(w, len(numbers)) for w in block[0].split()])
    return words, list(numbers)


def repeated_places(words: array, size: int) -> np.ndarray:
    """The places where a sequence of ``size`` words begins that occurs at least twice."""
    if len(words) <= size or len(set(zip(*(words[k:] for k in range(size))))) == len(words) - size + 1:
        return np.empty(0, np.int64)
    values = np.frombuffer(words, np.int32).astype(np.int64)
    names = values[: len(values) - size + 1]
    for k in range(1, size):
        key = names * (len(values) + 1) + values[k : k + len(names)]
        names = np.unique(key, return_inverse=True)[1]
    return np.flatnonzero(np.bincount(names)[names] > 1)


def suffix_order(words: array) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the place of each suffix in that order."""
    rank = np.frombuffer(words, np.int32).astype(np.int64)
    n, size = len(rank), 1
    while True:
        key = rank * (n + 1)
        key[: n - size] += rank[size:] + 1
        order = np.argsort(key, kind="stable")
        changes = np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(changes)))
        size *= 2
        if changes.all() or size >= n:
            return order, rank


def common_prefixes(words: array, places: np.ndarray, order: np.ndarray, rank: np.ndarray) -> array:
    """For the suffixes at ``places``: words in common with the suffix before in order."""
    n, shared, last = len(words), 0, -2
    before = array("i", np.concatenate(([-1], order[:-1])).astype(np.int32).tobytes())
    ranks = array("i", rank.astype(np.int32).tobytes())
    found = array("i", bytes(4 * n))
    for i in places.tolist():
        shared = shared - 1 if shared and last == i - 1 else 0
        last, j = i, before[ranks[i]]
        if j < 0:
            shared = 0
            continue
        most = n - max(i, j)
        while shared < most and words[i + shared] == words[j + shared]:
            shared += 1
        found[ranks[i]] = shared
    return found


class _Interval:
    """Places where one sequence of words begins, in order, and their class if all share one."""

    __slots__ = ("places", "left")

    def __init__(self, places: list[int], left: int):
        self.places, self.left = places, left


def _merged(children: list[_Interval], left_of: array) -> tuple[_Interval, Iterator[tuple[int, int]]]:
    """The parent of ``children``, and the neighbours in it that come from two children."""
    children.sort(key=lambda child: len(child.places))
    largest = children.pop()
    added = sorted((place, k) for k, child in enumerate(children) for place in child.places)
    classes = {child.left for child in children} | {largest.left}
    pairs: list[tuple[int, int]] = []
    places = largest.places
    if len(classes) > 1 or _MIXED in classes:
        for k, (place, child) in enumerate(added):
            at = bisect_left(places, place)
            below = places[at - 1] if at else -1
            above = places[at] if at < len(places) else -1
            if k and added[k - 1][0] > below:
                below = added[k - 1][0] if added[k - 1][1] != child else -1
            if k + 1 < len(added) and added[k + 1][0] < above:
                above = -1
            if below >= 0 and left_of[below] != left_of[place]:
                pairs.append((below, place))
            if above >= 0 and left_of[above] != left_of[place]:
                pairs.append((place, above))
    if len(added) * 1000 < len(places):
        for place, _ in added:
            insort(places, place)
    else:
        places.extend(place for place, _ in added)
        places.sort()
    return _Interval(places, classes.pop() if len(classes) == 1 else _MIXED), pairs


def runs_of(words: array, least_words: int = 6, least_repeats: int = 4) -> list[Run]:
    """``(start, length, period)`` of every run, by start and period."""
    if least_repeats < 2:
        raise ValueError("a period must occur twice to be one")
    # The least d over all periods; runs of larger periods lie deeper.
    shallow = min(max(least_words - q, (least_repeats - 1) * q) for q in range(1, max(2, least_words)))
    places = repeated_places(words, shallow)
    if not len(places):
        return []
    order, rank = suffix_order(words)
    shared = common_prefixes(words, places, order, rank)
    left_of = array("i", [-1])
    left_of.extend(words[:-1])
    runs: set[Run] = set()
    stack: list[tuple[int, list[_Interval]]] = []

    def close(depth: int, children: list[_Interval]) -> _Interval:
        interval, pairs = _merged(children, left_of)
        for i, j in pairs:
            if j - i + depth >= max(least_words, least_repeats * (j - i)):
                runs.add((i, j - i + depth, j - i))
        return interval

    ranks = np.sort(rank[places])
    for r, follows in zip(ranks.tolist(), np.append(np.diff(ranks) == 1, False).tolist()):
        child = _Interval([int(order[r])], left_of[order[r]])
        depth = shared[r + 1] if follows else 0
        while stack and stack[-1][0] > depth:
            below, children = stack.pop()
            children.append(child)
            child = close(below, children)
        if depth < shallow:
            continue
        if stack and stack[-1][0] == depth:
            stack[-1][1].append(child)
        else:
            stack.append((depth, [child]))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapsed(words: array, names: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that a run repeats after its first period."""
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(inside)[:-1] == 0)
    return b" ".join([names[words[k]] for k in kept.tolist()])


def find_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_words: int = 6,
    least_repeats: int = 4,
) -> DataFrame:
    """``doc_id, runs, collapsed`` per row of ``docs``: all runs by start and period (in words
    from 0), and the text with each run reduced to its first period."""

    def search(texts: pa.Array) -> list:
        found, short = [], []
        for text in texts.cast(pa.binary()).to_pylist():
            words, names = numbered_words(text or b"")
            runs = runs_of(words, least_words, least_repeats) if words else []
            found.append([dict(zip(("start", "length", "period"), run)) for run in runs])
            short.append(collapsed(words, names, runs).decode())
        return [found, short]

    rows = id_and_text(docs, id_column, text_column)
    return annotate(rows, "text", {"runs": RUNS, "collapsed": "string"}, search, ["doc_id"])
