"""Toxic texts and their toxic sentences, learnt from labels of whole texts.

Multiple-instance learning: a text is a bag of sentences, a sentence with log odds ``z``
(bias plus the weights of its words) is toxic with probability ``sigmoid(z)``, and a text
is toxic if any sentence is: ``1 - prod(1 - sigmoid(z))``, the noisy-or. The weights are
fitted to labelled texts by proximal gradient steps (Adam, L1), so that few features keep
a weight. A sentence ends after ``. ! ?`` or a line feed. Its features are its distinct words
(runs of letters and digits, A-Z lower-cased, compared by 64-bit hash) and their first
``PREFIXES`` bytes, which stand for inflected forms.

Defined results: a null or empty text has no sentence and scores 0. Without a labelled text
of each class every text scores 0. Repeated rows get equal scores. Other columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm import labels as labelled
from tallyhouse.llm.arrow import annotate
from tallyhouse.llm.columns import id_and_text
from tallyhouse.llm.words import (
    NOT_ALNUM, Texts, Words, find_words, hashes_of, prefix_hashes, slices,
)

THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
SENTENCES = "array<struct<first_byte:bigint,last_byte:bigint,score:double,text:string>>"
_SIEVE_BITS = 20
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


@dataclass(frozen=True)
class Training:
    steps: int = 300
    rate: float = 0.1
    l1: float = 4e-4
    least_texts: int = 4


@dataclass(frozen=True)
class Model:
    """Feature hashes in order, their weights, and the bias of a sentence."""

    known: np.ndarray
    weights: np.ndarray
    bias: float | None

    def log_odds(self, features: list, sentences: int, sieve: np.ndarray) -> np.ndarray:
        """Of each sentence; ``features`` has pairs of sentences and hashes."""
        found = []
        for sentence, hashes in features:
            places = np.flatnonzero(sieve[_sieve_entry(hashes)])
            at = np.minimum(np.searchsorted(self.known, hashes[places]), len(self.known) - 1)
            same = self.known[at] == hashes[places]
            found.append(sentence[places[same]] * len(self.known) + at[same])
        distinct = np.unique(np.concatenate(found))
        weights = self.weights[distinct % len(self.known)]
        sums = np.bincount(distinct // len(self.known), weights, sentences)
        return np.clip(self.bias + sums, -30, 30)

    def sieve(self) -> np.ndarray:
        """Which hashes may be known: most words are settled by one look."""
        sieve = np.zeros(1 << _SIEVE_BITS, bool)
        sieve[_sieve_entry(self.known)] = True
        return sieve


def _sieve_entry(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)


@dataclass
class _Sentences:
    """Of some texts: their words, the sentence of each word, the text of each sentence, and
    the features as pairs of sentences and hashes. Only sentences with a word count."""

    words: Words
    sentence: np.ndarray
    owner: np.ndarray
    features: list[tuple[np.ndarray, np.ndarray]]


def _sentences(texts: Texts) -> _Sentences:
    data = texts.lowered()
    words = find_words(data, texts.offsets, NOT_ALNUM)
    ended = np.cumsum(_ENDS[texts.data])[words.starts] if len(words.starts) else np.empty(0, np.int64)
    new = np.ones(len(ended), bool)
    new[1:] = (ended[1:] != ended[:-1]) | (words.text[1:] != words.text[:-1])
    sentence = np.cumsum(new) - 1
    features, sums = [(sentence, words.hashes)], prefix_hashes(data)
    for n in PREFIXES:
        longer = np.flatnonzero(words.ends - words.starts > n)
        starts = words.starts[longer]
        features.append((sentence[longer], hashes_of(sums, starts, starts + n) ^ np.uint64(n)))
    return _Sentences(words, sentence, words.text[new], features)


def _bags(texts: pa.Array) -> list:
    hashes, sentences = [], []
    for text in texts.to_pylist():
        data = np.frombuffer((text or "").encode(), np.uint8)
        features = _sentences(Texts(0, 1, data, np.array([0, len(data)]))).features
        hashes.append(np.concatenate([h for _, h in features]).view(np.int64))
        sentences.append(np.concatenate([s for s, _ in features]))
    return [pa.array(hashes, pa.list_(pa.int64())), pa.array(sentences, pa.list_(pa.int32()))]


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn,
    label: str = "toxic",
    texts_per_class: int = labelled.TEXTS_PER_CLASS,
    training: Training = Training(),
) -> Model:
    """Fit on at most ``texts_per_class`` texts of each class whose labels row satisfies
    ``learn``; the driver gets their features as hashes."""
    rows, share = labelled.sample(docs, labels, label, learn, texts_per_class)
    fields = {"hashes": "array<bigint>", "sentences": "array<int>"}
    bags = annotate(rows, "text", fields, _bags, ["doc_id", "label"]).orderBy("doc_id").toArrow()
    hashes, sentences = (bags[c].combine_chunks() for c in ("hashes", "sentences"))
    bounds = np.asarray(hashes.offsets) - hashes.offsets[0].as_py()
    y = bags["label"].to_numpy()
    del bags
    flat = np.asarray(hashes.flatten()).view(np.uint64)
    return fit(flat, np.asarray(sentences.flatten()), bounds, y, share, training)


def fit(
    hashes: np.ndarray, sentence: np.ndarray, bounds: np.ndarray, y: np.ndarray, share_of_1: float, t: Training
) -> Model:
    """``hashes`` and ``sentence`` (counted per text) have an entry per feature, ``bounds`` says
    where those of each text begin. The classes weigh as much as they do among all labels."""
    if len(set(y.tolist())) < 2 or not len(hashes):
        return Model(np.zeros(1, np.uint64), np.zeros(1), None)
    texts = list(zip(bounds[:-1], bounds[1:]))
    found, times = np.unique(np.concatenate([np.unique(hashes[a:b]) for a, b in texts]), return_counts=True)
    known = found[times >= t.least_texts]
    last = max(1, len(known))
    # One text at a time, so that only the features that are kept take memory.
    pairs, owner = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    first = 0
    for text, (a, b) in enumerate(texts):
        if a == b:
            continue
        place = np.searchsorted(known, hashes[a:b])
        same = np.flatnonzero(known[np.minimum(place, last - 1)] == hashes[a:b]) if len(known) else []
        pairs.append(np.unique((sentence[a:b][same].astype(np.int64) + first) * last + place[same]))
        sentences = int(sentence[a:b].max()) + 1
        owner.append(np.full(sentences, text))
        first += sentences
    at, word = np.divmod(np.concatenate(pairs), last)
    owner = np.concatenate(owner)

    weights, bias = np.zeros(len(known)), -4.0
    cost = np.array([1 - share_of_1, share_of_1])[y] / np.bincount(y)[y]
    moments = [np.zeros(len(known) + 1), np.zeros(len(known) + 1)]
    for step in range(1, t.steps + 1):
        z = np.clip(bias + np.bincount(at, weights[word], len(owner)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(owner, np.logaddexp(0, z), len(y)))
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * cost
        slope = pull[owner] * p
        gradient = np.append(np.bincount(word, slope[at], len(known)), slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        size = t.rate / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-4)
        move = size * moments[0] / (1 - 0.9**step)
        weights -= move[:-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - size[:-1] * t.l1, 0)
        bias -= move[-1]
    strong = np.abs(weights) > 0.05
    if not strong.any():
        return Model(np.zeros(1, np.uint64), np.zeros(1), float(bias))
    return Model(known[strong], weights[strong], float(bias))


def _scorer(model: Model, locate: bool):
    sieve = model.sieve()

    def score(texts: pa.Array) -> list:
        scores, found = np.zeros(len(texts)), [[] for _ in range(len(texts) if locate else 0)]
        for part in slices(texts) if model.bias is not None else ():
            found_here = _sentences(part)
            words, sentence, owner = found_here.words, found_here.sentence, found_here.owner
            z = model.log_odds(found_here.features, len(owner), sieve)
            clean = np.bincount(owner, np.logaddexp(0, z), part.last - part.first)
            scores[part.first : part.last] = -np.expm1(-clean)
            if locate:
                firsts = np.flatnonzero(np.diff(sentence, prepend=-1))
                for s in np.flatnonzero(z > 0):
                    end = firsts[s + 1] if s + 1 < len(firsts) else len(sentence)
                    first, last = words.starts[firsts[s]], words.ends[end - 1]
                    base = part.offsets[owner[s]]
                    found[part.first + owner[s]].append({
                        "first_byte": int(first - base),
                        "last_byte": int(last - base),
                        "score": float(1 / (1 + np.exp(-z[s]))),
                        "text": part.data[first:last].tobytes().decode(),
                    })
        return [scores, found] if locate else [scores]

    return score


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", locate: bool = True
) -> DataFrame:
    """``doc_id, score`` per row of ``docs`` and, if wanted, ``sentences``: those more
    likely toxic than not, as byte range from the first word to the last, score and text."""
    fields = {"score": "double"} | ({"sentences": SENTENCES} if locate else {})
    rows = id_and_text(docs, id_column, text_column)
    return annotate(rows, "text", fields, _scorer(model, locate), ["doc_id"])
