"""Byte-level BPE: ids of texts, and texts of ids.

A text is split by the tokenizer's pattern, and each match is encoded apart: its bytes
are pieces, and the adjacent pair whose joined bytes have the lowest rank is merged, the
leftmost first, until no pair has a rank. The merges are a fold by Spark's higher-order
functions over arrays of pieces, with the ranks as a literal: a fixed hash table of small
maps, as looking up a key in one literal map would search all of it.

A fold's state remembers where its next merge is, so that a word that is done costs no more look-ups.

Words are folded once, not once per use. The words of all texts are counted; the most
frequent (at most ``DICTIONARY_WORDS``, counted more than once, of at most
``DICTIONARY_BYTES`` each) are folded as a table and shipped to the tasks. A task replaces
them by their ids and hands the words that are left, distinct per text, to the same
fold, which runs between two Arrow steps of one stage. No text is shuffled. The Arrow steps
split, count, look up, put together and decode the words of many texts at once as arrays; the
pattern itself runs only on parts that are not plainly letters and marks.

A match longer than ``LONG_BYTES`` is folded by steps that merge all pairs of the lowest
rank at once, so that its work grows with the number of different merges. That gives
the same ids where every token of the vocabulary encodes to itself.

Decoding concatenates the bytes of the ids.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated rows get
equal results. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.arrow import map_batches
from tallyhouse.llm.columns import id_and_text
from tallyhouse.llm.frequent import most_frequent
from tallyhouse.llm.words import Texts, hashes_of, prefix_hashes, slices
from tallyhouse.operators.scratch import stage

DICTIONARY_WORDS, DICTIONARY_BYTES = 800_000, 32
LONG_BYTES = 64
_TABLE = 1 << 15
_COUNTED_WORDS = 400_000
_IDS_AT_ONCE, _HASHED_AT_ONCE = 1 << 20, 50_000


def read_ranks(path: str | Path) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)}


class RankTable:
    """The ranks as a literal column: maps of tokens to ranks by hash of the token. Bytes are
    written as two hexadecimal digits, which maps in JSON can have as keys."""

    def __init__(self, ranks: dict[bytes, int]):
        table: list[dict[str, int]] = [{} for _ in range(_TABLE)]
        for token, rank in ranks.items():
            key = token.hex().upper()
            table[xxhash.xxh64_intdigest(key, 42) % _TABLE][key] = rank  # as Spark's xxhash64
        self.maps = F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), "array<map<string,int>>")

    def bound(self, use) -> Column:
        """``use`` of a function from bytes to their rank, or null. The literal stands in the
        plan once, however often the function is used."""

        def with_maps(maps: Column) -> Column:
            def rank(piece: Column) -> Column:
                entry = F.xxhash64(piece).bitwiseAND(F.lit(_TABLE - 1)).cast("int")
                return F.try_element_at(F.get(maps, entry), piece)

            return use(rank)

        return _bind(self.maps, with_maps)


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pair_ranks(rank, pieces: Column) -> Column:
    """Rank of each piece joined with the next; null for none, and for the last."""
    joined = F.transform(pieces, lambda piece, i: F.concat(piece, F.get(pieces, i + 1)))
    return F.transform(joined, rank)


def _state(rank, pieces: Column) -> Column:
    """Pieces, and where the leftmost pair of the lowest rank is: null for none."""

    def with_place(pieces: Column) -> Column:
        place = _bind(
            _pair_ranks(rank, pieces), lambda r: F.array_position(r, F.array_min(r)).cast("int")
        )
        return F.struct(pieces.alias("pieces"), place.alias("place"))

    return _bind(pieces, with_place)


def _merge_first(rank, state: Column) -> Column:
    """Merge the leftmost pair of the lowest rank."""
    pieces, right = state.getField("pieces"), state.getField("place")  # from 0
    joined = F.transform(
        pieces, lambda piece, i: F.when(i == right - 1, F.concat(piece, F.get(pieces, right))).otherwise(piece)
    )
    merged = F.filter(joined, lambda _, i: i != right)
    return F.when(right.isNull(), state).otherwise(_state(rank, merged))


def _merge_all(rank, pieces: Column) -> Column:
    """Merge all pairs of the lowest rank, of overlapping ones every other from the left."""

    def merged(ranks: Column) -> Column:
        marks = F.array_join(
            F.transform(ranks, lambda r: F.when(r == F.array_min(ranks), "1").otherwise("0")), ""
        )
        chosen = F.split(F.regexp_replace(marks, "11", "10"), "")

        def rebuilt(chosen: Column) -> Column:
            taken = lambda i: F.coalesce(F.get(chosen, i) == "1", F.lit(False))
            joined = F.transform(
                pieces,
                lambda piece, i: F.when(taken(i), F.concat(piece, F.get(pieces, i + 1))).when(
                    ~taken(i - 1), piece
                ),
            )
            return F.array_compact(joined)

        return F.when(F.array_min(ranks).isNull(), pieces).otherwise(_bind(chosen, rebuilt))

    return _bind(_pair_ranks(rank, pieces), merged)


def _encoded(rank, word: Column) -> Column:
    def fold(data: Column) -> Column:
        n = F.length(data) / 2
        places = F.sequence(F.lit(1), n.cast("int"))
        pieces = F.transform(places, lambda i: F.substring(data, 2 * i - 1, F.lit(2)))
        steps = F.slice(places, F.lit(2), F.length(data))
        short = F.aggregate(steps, _state(rank, pieces), lambda state, _: _merge_first(rank, state))
        long = F.aggregate(steps, pieces, lambda state, _: _merge_all(rank, state))
        return _bind(
            rank(data),
            lambda whole: F.when(whole.isNotNull(), F.array(whole))
            .when(n == 0, F.array().cast("array<int>"))
            .when(n <= LONG_BYTES, F.transform(short.getField("pieces"), rank))
            .otherwise(F.transform(long, rank)),
        )

    return _bind(F.hex(word.cast("binary")), fold)


def encode_word(table: RankTable, word: Column) -> Column:
    """Ids of one match of the pattern, as an array."""
    return table.bound(lambda rank: _encoded(rank, word))


def encode_words(table: RankTable, words: Column) -> Column:
    """Ids of each of an array of matches."""
    return table.bound(lambda rank: F.transform(words, lambda word: _encoded(rank, word)))


_MAYBE_WHITE = np.zeros(256, bool)
_MAYBE_WHITE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: Bytes that begin a white space character outside ASCII (and other characters).
_MAYBE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


_MARKS = b".,!?;:#$%&*|"
_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Classes of bytes: letters, marks, and the rest.
_LETTER, _MARK = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_LETTERS)], _CLASS[list(_MARKS)] = _LETTER, _MARK


class Splitter:
    """Matches of the pattern, as bytes. A text can be split before each space that no white
    space is next to, as the space begins a match."""

    def __init__(self, pattern: str):
        import regex

        compiled = regex.compile(pattern)
        self._find, self._iterate = compiled.findall, compiled.finditer
        # Whether the pattern treats letters and marks after a space as one match each.
        self._plain = self._find("\ns\n") == ["\n", "s", "\n"] and all(
            self._find(f"{space}{letter}s{marks}\ns") == [f"{space}{letter}s", marks, "\n", "s"]
            for space in ("", " ")
            for letter in _LETTERS.decode()
            for marks in (*_MARKS.decode(), _MARKS.decode())
        )
        # Characters of two bytes that the pattern treats as letters.
        self._letters = np.zeros(1 << 16, bool)
        for c in map(chr, range(0x80, 0x800)):
            word = f"s{c}s{c}{c}"
            if self._find(f"{c}{word}.") == [c + word, "."] and self._find(f" {c}{word}") == [f" {c}{word}"]:
                self._letters[int.from_bytes(c.encode())] = True

    def matches(self, data: bytes) -> list[bytes]:
        return [found.encode() for found in self._find(data.decode())]

    def unit_matches(self, unit: bytes) -> list[bytes]:
        """Of a unit and the space before it. Units that begin with another letter are one match,
        if they have ASCII letters alone, and two with ASCII marks at the end; the pattern
        need not run on them."""
        if self._plain:
            if unit.isalpha():
                return [b" " + unit]
            stem = unit.rstrip(_MARKS)
            if stem.isalpha():
                return [b" " + stem, unit[len(stem) :]]
        return self.matches(b" " + unit)

    def texts(self, column: pa.Array) -> Iterator[tuple[bytes, list[bytes] | None]]:
        """Each text and what is between its spaces, or None if it has to be matched whole."""
        for part in slices(column):
            _, whole = self._spaces(part)
            for i in range(part.last - part.first):
                text = part.data[part.offsets[i] : part.offsets[i + 1]].tobytes()
                yield text, None if whole[i] else text.split(b" ")

    @staticmethod
    def _spaces(part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Which bytes are spaces, and which texts have white space beside a space."""
        data = np.append(part.data, np.zeros(4, np.uint8))
        white, space = _MAYBE_WHITE[data], data == 0x20
        beside = np.zeros(len(part.data) + 1, np.int64)
        both = (space[:-1] & white[1:]) | (white[:-1] & space[1:])
        # A character outside ASCII may be white up to its last byte, which is before a space.
        both[:-1] |= white[:-2] & (data[:-2] >= 0x80) & space[2:]
        both[:-2] |= white[:-3] & (data[:-3] >= 0x80) & space[3:]
        np.cumsum(both[: len(part.data)], out=beside[1:])
        return space[: len(part.data)], np.diff(beside[part.offsets]) > 0

    def _classes(self, data: np.ndarray) -> np.ndarray:
        classes = _CLASS[data]
        first = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] < 0xE0))
        first = first[self._letters[data[first].astype(np.int64) << 8 | data[first + 1]]]
        classes[first] = classes[first + 1] = _LETTER
        return classes

    @staticmethod
    def _breaks(data: np.ndarray) -> np.ndarray:
        """Where line ends are that no white space is next to."""
        at = np.flatnonzero(data == 0x0A)
        padded = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)])
        near, white = padded[at + 2], _MAYBE_WHITE[padded]
        beside = white[at + 2] | white[at + 4] | (near >= 0x80) & (white[at] | white[at + 1])
        return at[~beside]

    def _match(self, data: np.ndarray, starts: np.ndarray, parts: np.ndarray, begins: np.ndarray) -> list[int]:
        """Mark in ``begins`` where the matches of some parts of the data begin. Returns where what is
        between matches begins, which a pattern may leave out."""
        gaps: list[int] = []
        for start, end in zip(starts[parts].tolist(), starts[parts + 1].tolist()):
            begins[start + 1 : end] = False
            text, at, done = data[start:end].tobytes().decode(), start, 0
            for found in self._iterate(text):
                if found.start() > done:
                    begins[at] = True
                    gaps.append(at)
                    at += len(text[done : found.start()].encode())
                if found.end() > found.start():
                    begins[at] = True
                    at += len(found.group().encode())
                done = found.end()
            if at < end:
                begins[at] = True
                gaps.append(at)
        return gaps

    def words(self, part: Texts) -> tuple[pa.Array, np.ndarray]:
        """The matches of some texts one after the other, and where those of each end.

        Texts are cut at spaces, and at single line ends. Of the parts, those of letters and then
        marks (if any) are cut between both; the pattern runs on the others, and on texts
        that have white space beside a space."""
        data, offsets = part.data, part.offsets
        sizes = np.diff(offsets)
        begins, whole = self._spaces(part)
        starts_of_texts = offsets[:-1][sizes > 0]
        if not self._plain:
            whole = np.ones(len(sizes), bool)
        else:
            breaks = self._breaks(data)
            begins[breaks] = True
            begins[breaks[breaks + 1 < len(data)] + 1] = True
        begins[starts_of_texts] = True
        of_text = np.repeat(whole, sizes)
        begins[of_text] = False
        begins[starts_of_texts] = True
        starts = np.append(np.flatnonzero(begins), len(data))
        if len(starts) > 1:
            classes = self._classes(data)
            inner = np.flatnonzero(data == 0x20)
            classes[inner[begins[inner]]] = _LETTER  # the space before a word belongs to it
            marks = classes == _MARK
            odd = classes == 0
            if self._plain:
                odd[breaks] = False
            follows = ~begins
            follows[1:] &= (classes[1:] == _LETTER) & marks[:-1]  # a letter after a mark
            follows[0] = False
            odd |= follows
            # A part must begin with a letter; after a space too.
            first = starts[:-1]
            second = np.where(data[first] == 0x20, np.minimum(first + 1, starts[1:] - 1), first)
            lone = marks[second] | (data[second] == 0x20)
            wrong = (np.add.reduceat(odd, first, dtype=np.int64) > 0) | lone | of_text[first]
            begins[1:] |= marks[1:] & (classes[:-1] == _LETTER)
            gaps = self._match(data, starts, np.flatnonzero(wrong), begins)
            starts = np.append(np.flatnonzero(begins), len(data))
        else:
            gaps = []
        ends = np.searchsorted(starts[:-1], offsets)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]
        )
        if gaps:
            kept = ~np.isin(starts[:-1], gaps)
            return words.filter(pa.array(kept)), _ends(kept)[ends]
        return words, ends


def count_words(docs: DataFrame, pattern: str) -> DataFrame:
    """``word, n`` of all matches in ``docs`` short enough for the dictionary, added up in a part of a
    task before they are shuffled."""

    def merged(counts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
        words = pa.concat_arrays([w for w, _ in counts]).dictionary_encode()
        n = np.bincount(words.indices, np.concatenate([n for _, n in counts]), len(words.dictionary))
        return words.dictionary, n.astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts, rows = Splitter(pattern), [], 0
        for batch in batches:
            for part in slices(batch.column(1)):
                words = splitter.words(part)[0]
                words = words.filter(pc.less_equal(pc.binary_length(words), DICTIONARY_BYTES))
                words = words.dictionary_encode()
                counts.append((words.dictionary, np.bincount(words.indices, None, len(words.dictionary))))
                rows += len(words.dictionary)
                if rows > 2 * _COUNTED_WORDS:
                    counts = [merged(counts)]
                    rows = len(counts[0][0])
                    if rows > _COUNTED_WORDS:
                        yield out(*counts[0])
                        counts, rows = [], 0
        if counts:
            yield out(*merged(counts))

    def out(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([words.cast(pa.binary()), pa.array(n, pa.int64())], ["word", "n"])

    return map_batches(docs, count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _ends(sizes) -> np.ndarray:
    """Where parts of these sizes begin and end."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return ends


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words, and where each begins and ends."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hashes(words: pa.Array) -> np.ndarray:
    data, ends = _bytes(words)
    return hashes_of(prefix_hashes(data), ends[:-1], ends[1:])


class Dictionary:
    """Words and their ids, as a few flat buffers: a worker holds some 40 bytes per word. Found
    by 64-bit hash and compared in full."""

    def __init__(self, words: pa.Table):
        table = words.combine_chunks()
        if not table.num_rows:
            table = pa.table([pa.array([], pa.large_binary()), pa.array([], pa.list_(pa.int32()))], table.column_names)
        values, ids = (table.column(k).combine_chunks() for k in ("word", "ids"))
        values = values.cast(pa.large_binary())
        # In parts, as the tables of powers are as long as what is hashed at once.
        parts = (values.slice(at, _HASHED_AT_ONCE) for at in range(0, max(len(values), 1), _HASHED_AT_ONCE))
        hashes = np.concatenate([_hashes(part) for part in parts])
        order = np.argsort(hashes)
        self.hashes, (self.data, self.ends) = hashes[order], _bytes(values.take(pa.array(order)))
        ids = ids.take(pa.array(order))
        self.ids = np.asarray(ids.flatten(), np.int32)
        self.id_ends = _ends(np.asarray(ids.value_lengths(), np.int64))

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which of some words are in the dictionary, and their places there."""
        (data, ends), hashes = _bytes(words), _hashes(words)
        places = np.searchsorted(self.hashes, hashes)
        found = np.zeros(len(words), bool)
        inside = places < len(self.hashes)
        at = places[inside]
        found[inside] = (self.hashes[at] == hashes[inside]) & (np.diff(self.ends)[at] == np.diff(ends)[inside])
        at = np.flatnonzero(found)
        theirs, parts = _gathered(self.data, self.ends, places[at])
        differ = np.flatnonzero(theirs != _gathered(data, ends, at)[0])
        found[at[np.searchsorted(parts, differ, "right") - 1]] = False
        return found, places


class _Coder:
    """Ids of the words in the dictionary; a negative number for each other word."""

    def __init__(self, pattern: str, dictionary: Dictionary):
        self.splitter, self.dictionary = Splitter(pattern), dictionary

    def code(self, part: Texts) -> tuple[pa.Array, pa.Array]:
        """Ids of each text, as bytes of 32-bit numbers, and its other words: -1 stands for the
        first of them, -2 for the second."""
        words, ends = self.splitter.words(part)
        words = words.dictionary_encode()
        found, places = self.dictionary.find(words.dictionary)
        others = words.dictionary.filter(pa.array(~found))
        ids, bounds = _gathered(self.dictionary.ids, self.dictionary.id_ends, places[found])
        ids = np.concatenate([ids, -1 - np.arange(len(others), dtype=np.int32)])
        bounds = np.concatenate([bounds, bounds[-1] + 1 + np.arange(len(others))])
        place = np.empty(len(found), np.int64)
        place[found] = np.arange(np.count_nonzero(found))
        place[~found] = len(bounds) - 1 - len(others) + np.arange(len(others))
        ids, id_ends = _gathered(ids, bounds, place[np.asarray(words.indices)])
        return _numbered(ids, id_ends[ends], others)


def _numbered(ids: np.ndarray, ends: np.ndarray, others: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Ids of texts, with the numbers of other words made those of their text, and these words."""
    at = np.flatnonzero(ids < 0)
    text = np.searchsorted(ends, at, "right") - 1
    pairs, place = np.unique(text << 32 | (-1 - ids[at].astype(np.int64)), return_inverse=True)
    starts = np.searchsorted(pairs >> 32, np.arange(len(ends)))
    ids[at] = starts[text] - place - 1
    words = others.take(pa.array(pairs & 0xFFFFFFFF)).cast(pa.binary())
    return _binary(ids, ends), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words)


def _gathered(values: np.ndarray, bounds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of ``values`` at ``places`` one after the other, and where they end."""
    sizes = np.diff(bounds)[places]
    ends = _ends(sizes)
    shift = np.repeat(bounds[:-1][places] - ends[:-1], sizes)
    return values[shift + np.arange(len(shift))], ends


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids of each text as bytes."""
    if 4 * ends[-1] >= 1 << 31:
        raise ValueError("the ids of one text are more than a row can hold")
    offsets = pa.py_buffer((4 * ends).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(ids)])


def _filled(coded: Texts, rest: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some texts one after the other, and where those of each end: ``rest`` has the ids of
    the words that the negative numbers stand for."""
    ids, ends = coded.data.view(np.int32), coded.offsets // 4
    at = np.flatnonzero(ids < 0)
    if not len(at):
        return ids, ends
    text = np.searchsorted(ends, at, "right") - 1
    words = rest.flatten()
    word = _ends(np.asarray(rest.value_lengths(), np.int64))[text] - ids[at] - 1
    bounds = len(ids) + _ends(np.asarray(words.value_lengths(), np.int64))
    values = np.concatenate([ids, np.asarray(words.flatten(), np.int32)])
    places = np.arange(len(ids))
    places[at] = len(ids) + word
    values, all_ends = _gathered(values, np.concatenate([np.arange(len(ids)), bounds]), places)
    return values, all_ends[ends]


Finish = Callable[[np.ndarray, np.ndarray], list[pa.Array]]


@cache
def _texts_of_ids(most: int) -> pa.Array:
    """Each number up to ``most`` after a space."""
    return pa.array([b" %d" % i for i in range(most + 1)], pa.large_binary())


def _joined(pieces: pa.Array, ids: np.ndarray, ends: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The pieces of ids one after the other, and where those of each text end."""
    taken = pieces.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :]
    return memoryview(taken.buffers()[2] or b""), offsets[ends]


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    finish: Finish | None = None,
    fields: str = "ids binary",
) -> DataFrame:
    """``doc_id, ids`` per row of ``docs``; ``ids`` are decimal, joined by one space. Or, in
    place of the ids, ``fields`` that ``finish`` makes in the same step of the ids of some texts, one
    after the other, and where those of each begin and end."""
    docs, table = id_and_text(docs, id_column, text_column), RankTable(ranks)
    most, complete = max(ranks.values(), default=0), all(bytes([b]) in ranks for b in range(256))

    def known_ids(ids: Column) -> Column:
        return ids if complete else F.array_compact(ids)  # a byte that is no token has no id

    counts = stage(count_words(docs, pattern))
    frequent = most_frequent(counts, DICTIONARY_WORDS).filter("n > 1").select("word")
    dictionary = Dictionary(
        frequent.select("word", known_ids(encode_word(table, F.col("word"))).alias("ids")).toArrow()
    )

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(pattern, dictionary)
        for batch in batches:
            for part in slices(batch.column(1)):
                ids = batch.column(0).slice(part.first, part.last - part.first)
                yield pa.record_batch([ids, *coder.code(part)], ["doc_id", "coded", "rest"])

    schema = "doc_id bigint, coded binary, rest array<binary>"
    folded = encode_words(table, F.col("rest"))
    rest = folded if complete else F.transform(folded, F.array_compact)

    def as_text(ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        text, ends = _joined(_texts_of_ids(most), ids, ends)
        return [pa.array([text[a + 1 : b].tobytes() for a, b in pairwise(ends)], pa.binary())]

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1), 4 * _IDS_AT_ONCE):
                doc_ids, rest = (batch.column(k).slice(part.first, part.last - part.first) for k in (0, 2))
                yield pa.record_batch([doc_ids, *(finish or as_text)(*_filled(part, rest))], names)

    names = ["doc_id", *(field.split()[0] for field in fields.split(", "))]
    coded = map_batches(docs, known, schema).select("doc_id", "coded", rest.alias("rest"))
    return map_batches(coded, filled, f"doc_id bigint, {fields}")


@cache
def _decoder(ranks: tuple[tuple[bytes, int], ...]):
    """Bytes of decimal ids joined by one space."""
    pieces = {b"%d" % rank: token for token, rank in ranks}

    def decode(ids: bytes) -> bytes:
        return b"".join(map(pieces.__getitem__, ids.split(b" "))) if ids else b""

    return decode


@cache
def _tokens(ranks: tuple[tuple[bytes, int], ...]) -> pa.Array:
    """The bytes of each id, by id."""
    tokens = {rank: token for token, rank in ranks}
    return pa.array([tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)], pa.large_binary())


def decode(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, data`` of ``doc_id, ids``: the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _decoder(tuple(ranks.items()))
        for batch in batches:
            data = [bytes_of(ids.as_py()) for ids in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return map_batches(rows.select("doc_id", "ids"), run, "doc_id bigint, data binary")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row of ``docs``: the ids of its
    text, and the bytes that they decode to."""
    most = max(ranks.values(), default=0)

    def finish(ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        text, text_ends = _joined(_texts_of_ids(most), ids, ends)
        data, data_ends = _joined(_tokens(tuple(ranks.items())), ids, ends)
        return [
            pa.array(np.diff(ends), pa.int64()),
            pa.array([hashlib.sha256(text[a + 1 : b]).hexdigest() for a, b in pairwise(text_ends)], pa.string()),
            pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in pairwise(data_ends)], pa.string()),
        ]

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return encode(docs, ranks, pattern, finish=finish, fields=fields)
