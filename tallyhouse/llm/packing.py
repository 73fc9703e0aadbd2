"""Packing of texts into training sequences by lexical retrieval.

Each task reads its rows in shards of bounded size. A shard has an inverted index of its
tokens with BM25 weights. A seed text fills its window; what room is left goes to
unused texts that the index ranks highest for the seed, whole ones first, and the
last is cut where the window ends; its rest is the next seed. A seed whose window
is still open at the end of a shard is finished with texts of the next. No row is shuffled
and no group of rows decides how much a task holds.

Sequences have ``WINDOW`` tokens. The rest of a task is cut into sequences whose lengths are
powers of two, so nothing is padded.

Defined results: a null or empty text has the end token alone. A null id and repeated rows
are packed like any other row. Other columns are not read. An empty table gives no
sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from struct import pack as pack_ids
from threading import Timer
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyhouse.llm.arrow import map_batches
from tallyhouse.llm.columns import id_and_text

WINDOW = 2048
END = 1
SHARD_TOKENS = 1 << 20
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
K1, B = 1.2, 0.75
#: Of so many best neighbours the first that fits whole is preferred to a cut.
_LOOKED_AT = 8
#: Words encoded once and remembered by a worker: at most twice as many, of so many bytes.
REMEMBERED, REMEMBERED_BYTES = 200_000, 40
#: A worker that is idle for so many seconds forgets them, as it may serve other stages next.
IDLE_SECONDS = 2.0
_MARKS = b".,!?;:#$%&*|()"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
#: Latin letters end here; all that are lower-case and composed are one unit of the tokenizer.
_AFTER_LATIN = "\u0250"


def _byte_characters() -> list[str]:
    """The characters that stand for bytes in byte-level vocabularies: visible ones for
    themselves, the others for the characters from 256 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0x100)} - {0xAD}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(0x100)]


_BYTE_CHARACTERS = _byte_characters()


class Encoder(dict):
    """Bytes of the little-endian 32-bit ids of words between ASCII white space, as bytes
    with A-Z lower-cased. The tokenizer lower-cases, too, and treats such words apart, and
    likewise marks that follow an ASCII letter at the end of a word. Two generations of
    remembered words bound the memory."""

    def __init__(self, tokenizer: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        super().__init__()
        self.remembered = remembered
        self.old: dict[bytes, bytes] = {}
        self.timer: Timer | None = None
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            stem = word.rstrip(_MARKS)
            if stem and stem != word and stem[-1] in _LETTERS:
                ids = self[stem] + self[word[len(stem) :]]
            else:
                found = self.word_ids(word)
                ids = pack_ids(f"<{len(found)}I", *found)
        if len(word) <= REMEMBERED_BYTES:
            if len(self) >= self.remembered:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def word_ids(self, word: bytes) -> list[int]:
        """Lower-case Latin letters alone go to the merges as they are, as no rule of the
        tokenizer changes or divides them; everything else takes the whole way."""
        text = word.decode()
        if text.isalpha() and max(text) < _AFTER_LATIN and text == text.lower() and is_normalized("NFC", text):
            units = text if text.isascii() else "".join(map(_BYTE_CHARACTERS.__getitem__, word))
            return [token.id for token in self.model.tokenize(units)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.lower().split()))

    @contextmanager
    def in_use(self) -> Iterator[None]:
        if self.timer:
            self.timer.cancel()
        try:
            yield
        finally:
            self.timer = Timer(IDLE_SECONDS, self.forget)
            self.timer.daemon = True
            self.timer.start()

    def forget(self) -> None:
        self.clear()
        self.old = {}


@cache
def _encoder(tokenizer: str, remembered: int) -> Encoder:
    return Encoder(tokenizer, remembered)


class Index:
    """BM25 over the texts of one shard."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), lengths)
        keys, times = np.unique(owner << 32 | np.concatenate(texts).astype(np.int64), return_counts=True)
        self.owner, terms = keys >> 32, keys & 0xFFFFFFFF
        known, self.term = np.unique(terms, return_inverse=True)
        found_in = np.bincount(self.term)
        # Terms in half of the texts or more tell nothing: their weight is not above 0.
        idf = np.log((len(texts) - found_in + 0.5) / (found_in + 0.5))
        size = K1 * (1 - B + B * lengths / lengths.mean())
        weight = idf[self.term] * times * (K1 + 1) / (times + size[self.owner])
        self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        telling = np.flatnonzero(idf[self.term] > 0)
        order = telling[np.argsort(self.term[telling], kind="stable")]
        self.texts, self.weights = self.owner[order], weight[order]
        self.bounds = np.searchsorted(self.term[order], np.arange(len(known) + 1))

    def scores(self, text: int) -> np.ndarray:
        """Of all texts of the shard, for the distinct tokens of one of them."""
        terms = self.term[self.first[text] : self.first[text + 1]]
        starts, ends = self.bounds[terms], self.bounds[terms + 1]
        sizes = ends - starts
        places = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        return np.bincount(self.texts[places], self.weights[places], len(self.first) - 1)


class Packer:
    """The windows of one task, one after another."""

    def __init__(self, window: int, task: int):
        self.window = window
        self.next_id = task << 32
        self.rows: list[tuple] = []
        self.open: list[tuple] = []  # pieces of the open window: id, start, ids, tokens
        self.room = window

    def place(self, doc_id, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.room]
            self.open.append((doc_id, start, part, len(ids)))
            start += len(part)
            self.room -= len(part)
            if not self.room:
                self.write(self.open)
                self.open, self.room = [], self.window

    def write(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            self.rows.append(
                (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.next_id, offset)
            )
            offset += len(ids)
        self.next_id += 1

    def pack(self, shard: list[tuple]) -> None:
        """All texts of the shard; the window may stay open."""
        ids = [i for _, i in shard]
        lengths = np.array([len(i) for i in ids])
        index = Index(ids)
        unused = np.ones(len(shard), bool)
        for first in range(len(shard)):
            if not unused[first]:
                continue
            seed: int | None = first
            while seed is not None:
                unused[seed] = False
                self.place(*shard[seed])
                seed = self.fill(seed, shard, index, unused, lengths)

    def fill(self, seed: int, shard, index: Index, unused: np.ndarray, lengths: np.ndarray) -> int | None:
        """Neighbours of the seed that fit whole; then the best, to be cut, or None."""
        if self.room == self.window:
            return None
        scores = np.where(unused, index.scores(seed), -1.0)
        while self.room < self.window:
            if len(scores) > _LOOKED_AT:
                best = np.argpartition(-scores, _LOOKED_AT)[:_LOOKED_AT]
                best = best[np.argsort(-scores[best], kind="stable")]
            else:
                best = np.argsort(-scores, kind="stable")
            best = best[scores[best] > 0]
            if not len(best):
                return None
            whole = best[lengths[best] <= self.room]
            if not len(whole):
                return int(best[0])
            taken = int(whole[0])
            unused[taken] = False
            scores[taken] = -1.0
            self.place(*shard[taken])
        return None

    def finish(self) -> None:
        """Cut the open window into sequences whose lengths are powers of two."""
        left = self.window - self.room
        while left:
            size = 1 << (left.bit_length() - 1)
            taken, rest, room = [], [], size
            for doc_id, start, ids, tokens in self.open:
                here = min(room, len(ids))
                if here:
                    taken.append((doc_id, start, ids[:here], tokens))
                if here < len(ids):
                    rest.append((doc_id, start + here, ids[here:], tokens))
                room -= here
            self.write(taken)
            self.open, left = rest, left - size
        self.open, self.room = [], self.window

    def take_rows(self) -> pa.RecordBatch:
        names = [field.split()[0] for field in PIECES.split(", ")]
        columns = list(zip(*self.rows)) or [()] * len(names)
        self.rows = []
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece of a text, as ``PIECES``. ``tokenizer`` is the content of a
    tokenizer's JSON file; each text is closed by the id ``end``. A worker remembers up to twice
    ``remembered`` words, of some 250 bytes each; with fewer it encodes more of them again."""
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, remembered)
        with encoder.in_use():
            yield from packed(batches, encoder)

    def packed(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId())
        shard, tokens = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                ids = np.frombuffer(encoder.ids(data) + closing, "<u4")
                shard.append((doc_id, ids))
                tokens += len(ids)
                if tokens >= shard_tokens:
                    packer.pack(shard)
                    yield packer.take_rows()
                    shard, tokens = [], 0
        if shard:
            packer.pack(shard)
        packer.finish()
        yield packer.take_rows()

    return map_batches(id_and_text(docs, id_column, text_column), run, PIECES)
