"""Quality of a text by supervised subword embeddings.

A text is the mean of learned vectors of its words and of its three- and four-byte runs
within words (their ends included), hashed into fixed tables, and of one vector for each
word that repeats the word before it; a softmax over that mean gives the class. The mean
counts ``PRIOR`` features of zero, so that very short texts stay near the share of the
classes. The tables are trained by plain stochastic gradient descent in numpy, on a
bounded sample of labelled texts (``labels``), and the bias is then moved from the
sample's share of label 1 to that of all labels. Scoring needs the table only times the
softmax weights, one number per feature, so a text of any length is scored in one pass over
its bytes.

Defined results: a null or empty text has no features and scores sigmoid(bias). Without a labelled text of each class every score is
0.5. Repeated rows get equal scores. Other columns are kept by ``keep`` and not read. An
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm import labels as labelled
from tallyhouse.llm.arrow import annotate
from tallyhouse.llm.columns import column, fresh, id_and_text
from tallyhouse.llm.words import WHITE, Texts, find_words, slices

TABLE_BITS = 16
THRESHOLD = 0.7
PRIOR = 20
_RUNS = (3, 4)
_REPEAT = (1 + len(_RUNS)) << TABLE_BITS
_MIXER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Training:
    dimensions: int = 8
    epochs: int = 12
    least_steps: int = 600
    batch: int = 32
    rate: float = 4.0
    seed: int = 1


@dataclass(frozen=True)
class Model:
    """Log odds of label 1: ``bias`` plus the mean of ``weights`` over a text's features."""

    weights: np.ndarray
    bias: float
    fitted: bool = True


def _features(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words and for each run length: place of the feature in the data, table entry."""
    size = np.uint64(1 << TABLE_BITS)
    words = find_words(texts.data, texts.offsets)
    same = np.zeros(len(words.starts), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])
    found = [
        (words.starts, (words.hashes % size).astype(np.int64)),
        (words.starts[same], np.full(same.sum(), _REPEAT)),
    ]
    white = WHITE[texts.data]
    plain = np.where(white, np.uint8(0x20), texts.data).astype(np.uint64)
    ends = np.zeros(len(plain) + 1, bool)
    ends[texts.offsets] = True
    for table, n in enumerate(_RUNS, 1):
        m = len(plain) - n + 1
        if m <= 0:
            continue
        packed = np.full(m, n, np.uint64)
        usable = np.ones(m, bool)
        for k in range(n):
            packed = (packed << np.uint64(8)) | plain[k : k + m]
            if k:
                usable &= ~ends[k : k + m]
            if 0 < k < n - 1:
                usable &= ~white[k : k + m]
        places = np.flatnonzero(usable)
        entry = (packed[places] * _MIXER) >> np.uint64(64 - TABLE_BITS)
        found.append((places, entry.astype(np.int64) + table * int(size)))
    return found


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table entries of one text and their shares."""
    data = np.frombuffer(text.encode(), np.uint8)
    found = _features(Texts(0, 1, data, np.array([0, len(data)])))
    entries, counts = np.unique(np.concatenate([e for _, e in found]), return_counts=True)
    return entries.astype(np.int32), (counts / (PRIOR + counts.sum())).astype(np.float32)


def _bags(column_: pa.Array) -> list:
    bags = [_bag(t or "") for t in column_.to_pylist()]
    return [pa.array([b[0] for b in bags], pa.list_(pa.int32())), pa.array([b[1] for b in bags], pa.list_(pa.float32()))]


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn,
    label: str = "quality",
    texts_per_class: int = labelled.TEXTS_PER_CLASS,
    training: Training = Training(),
) -> Model:
    """Fit on at most ``texts_per_class`` texts of each class whose labels row satisfies
    ``learn``. Features are taken in the tasks; the driver gets at most
    ``3 * 2 ** TABLE_BITS + 1`` distinct entries per text."""
    rows, share = labelled.sample(docs, labels, label, learn, texts_per_class)
    fields = {"entries": "array<int>", "shares": "array<float>"}
    bags = annotate(rows, "text", fields, _bags, ["doc_id", "label"]).orderBy("doc_id").toArrow()
    return fit(
        bags["entries"].combine_chunks(),
        bags["shares"].combine_chunks(),
        bags["label"].to_numpy(),
        share,
        training,
    )


def fit(
    entries: pa.ListArray, shares: pa.ListArray, y: np.ndarray, share_of_1: float, t: Training
) -> Model:
    """Softmax over the mean vector, gradient steps on shuffled small batches."""
    table = _REPEAT + 1
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(table, np.float32), 0.0, fitted=False)
    bounds = np.asarray(entries.offsets)
    bounds, first = bounds - bounds[0], bounds[0]
    flat = np.asarray(entries.values)[first:].astype(np.int64)
    share = np.asarray(shares.values)[first:]
    rng = np.random.default_rng(t.seed)
    vectors = rng.uniform(-1 / t.dimensions, 1 / t.dimensions, (table, t.dimensions)).astype(np.float32)
    out = np.zeros((t.dimensions, 2), np.float32)
    bias = np.zeros(2, np.float32)
    per_epoch = -(-len(y) // t.batch)
    epochs = max(t.epochs, -(-t.least_steps // per_epoch))
    steps, step = epochs * per_epoch, 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), t.batch):
            rate = t.rate * (1 - step / steps)
            step += 1
            hidden, rows = [], order[at : at + t.batch]
            for r in rows:
                s = slice(bounds[r], bounds[r + 1])
                hidden.append(share[s] @ vectors[flat[s]])
            hidden = np.array(hidden, np.float32)
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = p @ out.T
            out -= rate * hidden.T @ p
            bias -= rate * p.sum(0)
            for r, g in zip(rows, back):
                s = slice(bounds[r], bounds[r + 1])
                vectors[flat[s]] -= rate * len(rows) * share[s, None] * g
    weights = vectors @ (out[:, 1] - out[:, 0])
    log_odds = lambda share: np.log(share / (1 - share))
    moved = log_odds(share_of_1) - log_odds(y.mean())
    return Model(weights.astype(np.float32), float(bias[1] - bias[0] + moved))


def _scorer(model: Model):
    weights = model.weights.astype(np.float64)

    def score(texts: pa.Array) -> list[np.ndarray]:
        scores = np.empty(len(texts))
        for part in slices(texts):
            sums, counts = np.zeros(part.last - part.first), np.zeros(part.last - part.first)
            for places, entries in _features(part):
                running = np.concatenate([[0.0], np.cumsum(weights[entries])])
                bounds = np.searchsorted(places, part.offsets)
                sums += np.diff(running[bounds])
                counts += np.diff(bounds)
            odds = model.bias + sums / (PRIOR + counts)
            scores[part.first : part.last] = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        return [scores]

    return score


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` per row of ``docs``."""
    rows = id_and_text(docs, id_column, text_column)
    return annotate(rows, "text", {"score": "double"}, _scorer(model), ["doc_id"])


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more, with their columns; all rows if the
    model had nothing to learn from."""
    if not model.fitted:
        return docs
    name = fresh(docs, "quality_score")
    rows = docs.withColumn(text_column, column(text_column).cast("string"))
    scored = annotate(rows, text_column, {name: "double"}, _scorer(model))
    return scored.filter(F.col(name) >= threshold).select(*[column(c) for c in docs.columns])
