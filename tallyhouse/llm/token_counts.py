"""Token counts of a unigram tokenizer, by counting along the best path only.

A text is split before each run of spaces, which no piece of the vocabulary crosses. In
each unit an Aho-Corasick automaton lists the pieces that end at a character, and
dynamic programming carries the best score and its number of pieces; the pieces
themselves are never built. Ties and unknown characters follow the unigram model of the
``tokenizers`` library, whose counts these equal: among equal scores the path whose last
piece begins first wins; a character without a piece of its own may be unknown at the lowest
score less ten, and counts one token per byte where the vocabulary has byte pieces, else one
per run of unknown characters.

The vocabulary is a SentencePiece model file. Its scores are taken as they are; for a
file that was trained as BPE (scores are merge ranks) the counts are those of the
unigram tokenizer with the same pieces and scores, not of its BPE.

Defined results: a null or empty text has 0 tokens. Repeated rows get equal counts.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.arrow import annotate
from tallyhouse.llm.columns import id_and_text

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Units counted once and remembered by a worker: at most so many, of so many characters.
REMEMBERED, REMEMBERED_CHARS = 300_000, 40
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, float], ...]
    bytes_known: bool
    prefix: bool

    @staticmethod
    def from_file(path: str | Path) -> Vocabulary:
        """Of a SentencePiece model without text normalization."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(Path(path).read_bytes())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("models that normalize texts are not supported")
        normal = tuple((p.piece, p.score) for p in model.pieces if p.type == p.NORMAL)
        for piece, _ in normal:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"the piece {piece!r} crosses a space")
        return Vocabulary(normal, model.trainer_spec.byte_fallback, rules.add_dummy_prefix)


class Counter(dict):
    """Tokens of a unit; two generations of remembered units bound the memory."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__()
        self.old: dict[str, int] = {}
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, unit: str) -> int:
        n = self.old.get(unit)
        if n is None:
            n = self.best_path(unit)
        if len(unit) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[unit] = n
        return n

    def best_path(self, unit: str) -> int:
        size, bytes_known, unknown = len(unit), self.vocabulary.bytes_known, self.unknown
        scores, counts, last_unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        done = 0  # characters whose best path is known

        def settle(end: int, best: float | None, start: int, single: bool) -> None:
            """Allow the character before ``end`` to be unknown, then store its best path."""
            other = scores[end - 1] + unknown
            if not single and (best is None or other > best):
                scores[end], last_unknown[end] = other, True
                more = len(unit[end - 1].encode()) if bytes_known else not last_unknown[end - 1]
                counts[end] = counts[end - 1] + more
            else:
                scores[end], counts[end] = best, counts[start] + 1

        best, start, single = None, 0, False
        for at, (length, score) in self.automaton.iter(unit):
            while done < at:
                settle(done + 1, best, start, single)
                done, best, single = done + 1, None, False
            found = scores[at + 1 - length] + score
            if best is None or found > best:  # pieces come longest first
                best, start = found, at + 1 - length
            single |= length == 1
        while done < size:
            settle(done + 1, best, start, single)
            done, best, single = done + 1, None, False
        return counts[size]

    def units(self, text: str) -> Iterator[str]:
        escaped = text.replace(" ", SPACE)
        return _UNIT.findall(SPACE + escaped if self.vocabulary.prefix else escaped)

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.units(text))) if text else 0


@cache
def _counter(vocabulary: Vocabulary) -> Counter:
    return Counter(vocabulary)


def token_counts(
    docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens`` per row of ``docs``."""

    def count(texts: pa.Array) -> list:
        counter = _counter(vocabulary)
        return [[counter.count(t.as_py()) for t in texts]]

    rows = id_and_text(docs, id_column, text_column)
    return annotate(rows, "text", {"n_tokens": "bigint"}, count, ["doc_id"])
