"""Log probabilities of texts by a hashed maximum-entropy language model.

Tokens are the words between white space, A-Z lower-cased, then one end per text. Words
are compared by 64-bit hashes. The model is factored by classes: the class of a word is its
ending (last two bytes; the most frequent endings have classes of their own, the others
share classes), so every word has one, known or not.

* ``P(class | history)`` is a softmax over features of the history: the word before, the
  words two and three before (skips), and the pair of words before, each hashed into a table
  of rows of one weight per class, and a bias. The table grows with the square root of
  the training tokens (``table_rows``), so that it can still be handed to the tasks. It is trained
  by distributed gradient updates: in each round every task takes small gradient steps
  (AdaGrad) through its part of the training texts, and the changes of a row are averaged by
  how often the tasks used it, so that a row that few tasks met keeps what they learnt. Each
  training text takes part in exactly one round.
* ``P(word | class)`` has only biases, whose maximum-entropy values are the relative
  counts; the counts of a class are discounted by its share of words seen once, and the
  discount is the probability of its unknown words together.

The probabilities of all known words and of one unknown word per class add up to one.

Counts are exact and cover all training texts: words are counted per task, then by a shuffle.
The ``HOT_WORDS`` most frequent words are shipped to the tasks (16 bytes each); all other
words of a text get their counts by a join, added up per text before.

Defined results: a null or empty text is the end alone. Repeated rows are counted and scored
like any others; a null id counts as the empty text for the choice of training texts.
Without a training text both scores are 0 (one outcome). Other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.arrow import map_batches
from tallyhouse.llm.columns import id_and_text
from tallyhouse.llm.frequent import most_frequent
from tallyhouse.llm.words import Texts, find_words, mix, slices
from tallyhouse.operators.scratch import stage

HOT_WORDS = 1 << 18
CLASSES = 48
LEAST_ROWS, ROWS_PER_ROOT = 1 << 13, 6
ROUNDS = 2
_BATCH = 4096
_RATE = np.float32(0.5)
_ONES = np.ones(CLASSES, np.float32)
_FAN_IN, _LEVELS = 32, 3
_PART_ROWS = 1 << 11
_SHORT_RUN = 8
_END_ENDING = 1 << 16
_END_HASH = np.uint64(0x5851F42D4C957F2D)
_START_HASH = np.uint64(0x14057B7EF767814F)
_KEPT_WORDS = 1 << 20


@dataclass
class Tokens:
    """Tokens of some texts in order: hash, ending, text."""

    hashes: np.ndarray
    endings: np.ndarray
    text: np.ndarray


def tokens(texts: Texts) -> Tokens:
    n = len(texts.offsets) - 1
    data = texts.lowered()
    words = find_words(data, texts.offsets)
    size = len(words.starts) + n
    hashes, endings = np.full(size, _END_HASH), np.full(size, _END_ENDING, np.int64)
    owner = np.empty(size, np.int64)
    at = np.arange(len(words.starts)) + words.text  # each earlier text has an end
    hashes[at] = words.hashes
    last = data[words.ends - 1].astype(np.int64)
    long = words.ends - words.starts > 1
    endings[at] = last | np.where(long, data[words.ends - 2].astype(np.int64) << 8, 0)
    owner[at] = words.text
    owner[words.bounds(n)[1:] + np.arange(n)] = np.arange(n)
    return Tokens(hashes, endings, owner)


class Counts:
    """Counts by hash with one or few looks each: a table with open addresses."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.bits = max(10, int(4 * len(hashes)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.counts = np.zeros(1 << self.bits, np.int64)
        slot, left = self._slot(hashes), np.arange(len(hashes))
        while len(left):
            free = self.counts[slot[left]] == 0
            chosen, first = np.unique(slot[left[free]], return_index=True)
            placed = left[free][first]
            self.keys[chosen], self.counts[chosen] = hashes[placed], counts[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Count of each hash, 0 where it is not in the table."""
        slot = self._slot(hashes)
        found = np.where(self.keys[slot] == hashes, self.counts[slot], 0)
        left = np.flatnonzero((found == 0) & (self.counts[slot] != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            same = self.keys[slot] == hashes[left]
            found[left[same]] = self.counts[slot[same]]
            going = ~same & (self.counts[slot] != 0)
            left, slot = left[going], slot[going]
        return found


@dataclass(frozen=True)
class Model:
    """``train_tokens`` and ``types`` of the training texts; the most frequent words; the class
    of each ending; per class its tokens, types and discount; the weights."""

    train_tokens: int
    types: int
    hot_hashes: np.ndarray
    hot_counts: np.ndarray
    class_of: np.ndarray
    class_tokens: np.ndarray
    class_types: np.ndarray
    discounts: np.ndarray
    bias: np.ndarray
    weights: np.ndarray

    def within_class(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of P(word | class) for words that occur ``counts`` times."""
        seen = np.where(counts > 0, counts - self.discounts[classes], self.unseen()[classes])
        return np.log10(seen / self.class_tokens[classes])

    def unseen(self) -> np.ndarray:
        """Counts taken off the known words of each class, for its unknown words."""
        return self.discounts * self.class_types


def table_rows(train_tokens: int) -> int:
    """Rows of weights for so many training tokens: a power of two."""
    return max(LEAST_ROWS, 1 << (ROWS_PER_ROOT * isqrt(train_tokens)).bit_length())


def _history(t: Tokens, size: int) -> list[np.ndarray]:
    """Of ``size`` rows of weights those for each feature of each token's history."""
    before = []
    for back in (1, 2, 3):
        word = np.full(len(t.hashes), _START_HASH)
        same = t.text[back:] == t.text[:-back]
        word[back:][same] = t.hashes[:-back][same]
        before.append(word)
    pair = mix(before[0] + before[1] * np.uint64(0xA24BAED4963EE407))
    keys = [mix(word + np.uint64(k)) for k, word in enumerate([*before, pair], 1)]
    kind = np.uint16 if size <= 1 << 16 else np.uint32
    return [(key & np.uint64(size - 1)).astype(kind) for key in keys]


def _logits(rows: list[np.ndarray], bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Up to a number per token: the largest is 0."""
    z = weights.take(rows[0], 0)
    for more in rows[1:]:
        z += weights.take(more, 0)
    z += bias
    z -= z.max(1, keepdims=True)
    return z


def _class_scores(t: Tokens, model: Model) -> np.ndarray:
    """log10 of P(class | history) of each token."""
    classes, rows = model.class_of[t.endings], _history(t, len(model.weights))
    scores = np.empty(len(classes))
    for at in range(0, len(classes), _BATCH):
        part = slice(at, at + _BATCH)
        z = _logits([r[part] for r in rows], model.bias, model.weights)
        truth = z[np.arange(len(z)), classes[part]]
        scores[part] = truth - np.log(np.exp(z, out=z) @ _ONES)
    return scores / np.log(10)


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows that begin at ``first``. Most runs are short; they are added up by
    place in the run, as a call of ``reduceat`` costs much per run."""
    sizes = np.diff(first, append=len(rows))
    total = rows[first]
    for place in range(1, _SHORT_RUN):
        runs = np.flatnonzero((sizes > place) & (sizes <= _SHORT_RUN))
        total[runs] += rows[first[runs] + place]
    long = np.flatnonzero(sizes > _SHORT_RUN)
    if len(long):
        own = np.repeat(sizes > _SHORT_RUN, sizes)
        starts = np.cumsum(sizes[long]) - sizes[long]
        total[long] = np.add.reduceat(rows[own], starts)
    return total


class _Learner:
    """Gradient steps of one task from the shared weights."""

    def __init__(self, model: Model):
        self.model = model
        self.bias, self.weights = model.bias.copy(), model.weights.copy()
        self.squares = np.full(len(self.weights), 1e-3, np.float32)
        self.uses = np.zeros(len(self.weights), np.float32)
        self.tokens = 0

    def learn(self, t: Tokens) -> None:
        classes, rows = self.model.class_of[t.endings], _history(t, len(self.weights))
        for at in range(0, len(classes), _BATCH):
            part = [r[at : at + _BATCH] for r in rows]
            truth = classes[at : at + _BATCH]
            slope = np.exp(_logits(part, self.bias, self.weights))
            slope *= (-1 / (slope @ _ONES))[:, None]
            slope[np.arange(len(truth)), truth] += 1
            self.bias += np.float32(0.1) * slope.mean(0)
            row = np.concatenate(part)
            order = np.argsort(row, kind="stable")  # of 16-bit values a radix sort
            ordered = row[order]
            first = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)
            touched = ordered[first]
            self.uses[touched] += np.diff(first, append=len(row))
            total = _sums(slope.take(order % len(truth), 0), first)
            self.squares[touched] += np.einsum("ij,ij->i", total, total) / CLASSES
            self.weights[touched] += total * (_RATE / np.sqrt(self.squares[touched]))[:, None]
        self.tokens += len(classes)

    def changes(self) -> Iterator[bytes]:
        """Of the bias and of each row its change times how often it was used, and how often;
        ``_PART_ROWS`` rows at a time, the bias first."""
        bias = (self.bias - self.model.bias) * np.float32(self.tokens)
        yield np.append(bias, np.float32(self.tokens)).tobytes()
        for at in range(0, len(self.weights), _PART_ROWS):
            part = slice(at, at + _PART_ROWS)
            uses = self.uses[part, None]
            moved = (self.weights[part] - self.model.weights[part]) * uses
            yield np.hstack([moved, uses]).tobytes()


def _trained(docs: DataFrame, model: Model) -> Model:
    """The model after one round over ``docs``. Each task hands on the changes of the weights in
    parts of a fixed size; each part is added up in a tree, ``_FAN_IN`` at a time, for the
    driver, so that no task holds more than a few parts of others."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = _Learner(model)
        for batch in batches:
            for part in slices(batch.column(1)):
                learner.learn(tokens(part))
        for number, moved in enumerate(learner.changes() if learner.tokens else ()):
            yield row(TaskContext.get().partitionId(), number, moved)

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, group, number = np.float32(0), 0, 0
        for batch in rows:
            for g, n, moved in zip(*(batch.column(k) for k in range(3))):
                group, number = g.as_py() // _FAN_IN, n.as_py()
                total = total + np.frombuffer(moved.as_buffer(), np.float32)
        yield row(group, number, total.tobytes())

    def row(group: int, number: int, change: bytes) -> pa.RecordBatch:
        columns = [pa.array([group], pa.int32()), pa.array([number], pa.int32()), pa.array([change], pa.binary())]
        return pa.record_batch(columns, ["group", "part", "change"])

    schema = "group int, part int, change binary"
    summed = map_batches(docs, learn, schema)
    for _ in range(_LEVELS):
        by = (F.col("group") / _FAN_IN).cast("int"), F.col("part")
        summed = summed.groupBy(*by).applyInArrow(add, schema)
    parts: dict[int, np.ndarray] = {}
    for found in summed.collect():
        change = np.frombuffer(found["change"], np.float32).reshape(-1, CLASSES + 1)
        parts[found["part"]] = parts.get(found["part"], 0) + change
    if not parts:
        return model
    change = np.concatenate([parts[number] for number in sorted(parts)])
    change = change[:, :CLASSES] / np.maximum(change[:, CLASSES:], 1)
    return replace(model, bias=model.bias + change[0], weights=model.weights + change[1:])


def count_words(docs: DataFrame) -> DataFrame:
    """``hash, ending, n`` of every distinct token of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def merged() -> np.ndarray:
            rows = np.concatenate(held)
            rows = rows[np.argsort(rows["hash"])]
            first = np.flatnonzero(np.diff(rows["hash"], prepend=~rows["hash"][:1]) != 0)
            out = rows[first]
            out["n"] = np.add.reduceat(rows["n"], first)
            return out

        def out(rows: np.ndarray) -> pa.RecordBatch:
            columns = [rows["hash"].view(np.int64), rows["ending"], rows["n"]]
            return pa.record_batch([pa.array(c) for c in columns], ["hash", "ending", "n"])

        for batch in batches:
            for part in slices(batch.column(1)):
                t = tokens(part)
                hashes, first, n = np.unique(t.hashes, return_index=True, return_counts=True)
                rows = np.empty(len(hashes), [("hash", "u8"), ("ending", "i4"), ("n", "i8")])
                rows["hash"], rows["ending"], rows["n"] = hashes, t.endings[first], n
                held.append(rows)
                size += len(rows)
                if size > _KEPT_WORDS:
                    held = [merged()]
                    size = len(held[0])
                    if size > _KEPT_WORDS // 2:
                        yield out(held.pop())
                        size = 0
        if held:
            yield out(merged())

    counted = map_batches(docs, count, "hash bigint, ending int, n bigint")
    return counted.groupBy("hash", "ending").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Column, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of the rows of ``docs`` (``doc_id, text``) where ``learn`` holds, and their
    word counts as a written table."""
    rows = docs.filter(learn).select("doc_id", "text")
    counts = stage(count_words(rows))
    by_ending = (
        counts.groupBy("ending")
        .agg(F.sum("n").alias("n"), F.count("*").alias("types"), F.sum((F.col("n") == 1).cast("int")).alias("once"))
        .orderBy(F.desc("n"), "ending")
        .collect()  # two bytes: 65,537 endings at most
    )
    hot = most_frequent(counts, HOT_WORDS).filter("n > 1").select("hash", "n").toArrow()
    # The end has a class; frequent endings have one each, the others share the rest.
    class_of = np.arange(_END_ENDING + 1) % (CLASSES // 6) + CLASSES - CLASSES // 6
    class_of[_END_ENDING] = 0
    endings = [row["ending"] for row in by_ending if row["ending"] != _END_ENDING]
    own = endings[: CLASSES - CLASSES // 6 - 1]
    class_of[own] = np.arange(1, len(own) + 1)
    sums = np.zeros((3, CLASSES))
    for row in by_ending:
        sums[:, class_of[row["ending"]]] += row["n"], row["types"], row["once"]
    # A class without a word holds one unknown word that was never met.
    per_class, types = np.maximum(sums[0], 1), np.maximum(sums[1], 1)
    discounts = np.where(sums[0] > 0, np.maximum(sums[2], 0.5) / (sums[1] + 1), 1.0)
    train_tokens = int(sums[0].sum())
    model = Model(
        train_tokens,
        int(sums[1].sum()),
        hot["hash"].to_numpy().view(np.uint64),
        hot["n"].to_numpy(),
        class_of,
        per_class,
        types,
        discounts,
        np.log((sums[0] + 1) / (sums[0] + 1).sum()).astype(np.float32),
        np.zeros((table_rows(train_tokens), CLASSES), np.float32),
    )
    for turn in range(rounds if model.train_tokens else 0):
        model = _trained(rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == turn), model)
    return model, counts


_PART = (
    "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, "
    "hashes array<bigint>, classes array<int>, times array<int>"
)


def _hot_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per text what the tasks know: all of P(class | history), the rest for hot words; and
    the other words with their class and number."""
    unit = model.train_tokens + model.types + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Counts(model.hot_hashes, model.hot_counts)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch.column(1)):
                n = part.last - part.first
                t = tokens(part)
                counts, classes = table.of(t.hashes), model.class_of[t.endings]
                known = counts > 0
                score = _class_scores(t, model)
                score[known] += model.within_class(counts[known], classes[known])
                base = np.where(known, np.log10((counts + 1) / unit), 0.0)
                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((t.hashes[rare], t.text[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (t.hashes[order][1:] != t.hashes[order][:-1]) | (t.text[order][1:] != t.text[order][:-1])
                first = np.flatnonzero(new)
                owner = t.text[order[first]]
                bounds = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                times = np.diff(np.append(first, len(order)))
                lists = [
                    pa.ListArray.from_arrays(bounds, pa.array(values, kind))
                    for values, kind in (
                        (t.hashes[order[first]].view(np.int64), pa.int64()),
                        (classes[order[first]], pa.int32()),
                        (times, pa.int32()),
                    )
                ]
                sums = [np.bincount(t.text, w, n) for w in (known, base, score)]
                columns = [
                    pa.array(row + np.arange(n)),
                    batch.column(0).slice(part.first, n),
                    pa.array(np.bincount(t.text, minlength=n)),
                    pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1]),
                    pa.array(sums[2]),
                    *lists,
                ]
                yield pa.record_batch(columns, [field.split()[0] for field in _PART.split(", ")])
                row += n

    return map_batches(docs, run, _PART)


def _pick(values: np.ndarray, index: str) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col(index))


def score(docs: DataFrame, model: Model, counts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``;
    ``base_score`` is that of single words with one added to each count."""
    unit = model.train_tokens + model.types + 1
    parts = stage(_hot_scores(id_and_text(docs, id_column, text_column), model))
    rare = parts.filter(F.size("hashes") > 0).select(
        "row", F.inline(F.arrays_zip("hashes", "classes", "times"))
    ).toDF("row", "hash", "class", "times")
    found = rare.join(counts.select("hash", "n"), "hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    seen = F.when(
        F.col("n") > 0, F.col("n") - _pick(model.discounts, "class")
    ).otherwise(_pick(model.unseen(), "class"))
    within = F.log10(seen / _pick(model.class_tokens, "class"))
    rest = found.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.lit(float(unit)))).alias("rare_base"),
        F.sum(F.col("times") * within).alias("rare_score"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    learnt = F.lit(float(model.train_tokens > 0))
    return parts.drop("hashes", "classes", "times").join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + zero("rare_known")).cast("bigint").alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + zero("rare_base")).alias("base_score"),
        (learnt * (F.col("score") + zero("rare_score"))).alias("score"),
    )
