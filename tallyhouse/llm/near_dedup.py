"""Near-duplicates by MinHash over an LSH forest, confirmed on whole shingle sets.

1. Each text becomes the set of its word shingles (64-bit hashes). Equal sets form a class,
   known by a 128-bit digest; one member per class goes on, so that copies of any number cost
   nothing more.
2. The forest: each of ``TREES`` trees has its own sequence of ``DEPTH`` MinHash values per
   class. The classes are sorted by tree and sequence, with a range partitioning that splits
   runs of equal sequences too. Candidates are neighbours, up to ``REACH`` places apart, with
   a common prefix of ``LEAST_PREFIX`` values. Where few classes share a prefix all of
   them are within reach; in a dense region the neighbours are those with the longest common
   prefix, so the depth follows the density. Partitions hand on their ends, so that no
   neighbours are parted.
3. A pair stays if the sizes of its sets allow the similarity, and its signatures do not
   rule it out (more than five standard deviations below).
4. Sets are compared in full: first each class with its most similar candidate either way;
   then the pairs that still lie in different components.
5. Classes that had a neighbour are sorted once more, and each looks ``FAR_REACH`` places
   either way for the ``FOREIGN`` nearest of other components: what a dense region's own
   neighbours have hidden. Pairs that are new go through 3 and 4, too.
6. What is left is settled exactly. Where more classes share a prefix than are within reach,
   and not all are of one component, a join by prefix filter finds every pair of different
   components that can be similar enough: the shingles of each class are ranked, the rarest
   first, and two similar sets share one among their first. All these pairs are compared in
   full, without 3. Frequent shingles are salted.
7. Components of confirmed links, and for each its smallest id.

Two texts at the least similarity share a prefix in a tree with probability
``0.8 ** 5 = 0.33``, in none of 32 trees with ``3e-6``; that and 3 are all that can part them.
Before 6 the number of pairs is in proportion to the classes, whatever the size of a group;
in 6 it is that of the pairs of unlinked classes with a common shingle among their rarest.

Defined results: a null or empty text has an empty set, is linked with nothing and
stays. A text with fewer words than a shingle has its whole sequence as one shingle. Repeated
rows are one class. A null id is no candidate for ``component_id``, which is null if all ids
of a component are; rows with a null id stay only then. Other columns are not
read by ``near_groups`` and kept by ``drop_near_copies``. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm import sieve
from tallyhouse.llm.arrow import annotate, map_batches, small_batches
from tallyhouse.llm.columns import column, id_and_text
from tallyhouse.llm.components import components
from tallyhouse.llm.shingles import common, shingle_sets, signatures
from tallyhouse.llm.words import slices
from tallyhouse.operators.scratch import stage

TREES, DEPTH = 32, 8
LEAST_PREFIX = 5
REACH = 3
FAR_REACH, FOREIGN = 48, 2
#: Classes per salt of a shingle, and shingles that leave Python at once.
_SALTED, _ROWS = 4096, 1 << 18
SHINGLE_WORDS, SIMILARITY = 5, 80
_SIGNATURE = TREES * DEPTH


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sketches(shingle_words: int):
    def compute(texts: pa.Array) -> list:
        sizes, digests, signs = [], [], []
        for part in slices(texts):
            sets = shingle_sets(part, shingle_words)
            sizes.append(np.diff(sets.bounds))
            digests += [_digest(sets.of(i)) for i in range(part.last - part.first)]
            signs += [row.tobytes() for row in signatures(sets, _SIGNATURE)]
        return [np.concatenate(sizes) if sizes else [], digests, signs]

    return compute


_RUN = "a bigint, b bigint, tree int, label binary, part bigint"


def _pairs(run: pa.Table, reach: int, nearest: int, new: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of different parts with a long enough common prefix, for each row the
    ``nearest`` before and after; the later one of a pair at ``new`` or after."""
    tree, keys, part = (run[c].to_numpy() for c in ("tree", "key", "part"))
    labels = np.frombuffer(b"".join(run["label"].to_pylist()), np.uint16).reshape(-1, DEPTH)
    labels = np.column_stack([tree, labels[:, :LEAST_PREFIX]])
    met_after, met_before = np.zeros((2, len(keys)), np.int64)
    smaller, larger = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for apart in range(1, min(reach, len(keys) - 1) + 1):
        alike = (labels[apart:] == labels[:-apart]).all(1) & (part[apart:] != part[:-apart])
        at = np.flatnonzero(alike & ((met_after[:-apart] < nearest) | (met_before[apart:] < nearest)))
        met_after[at] += 1
        met_before[at + apart] += 1
        at = at[at + apart >= new]
        smaller.append(np.minimum(keys[at], keys[at + apart]))
        larger.append(np.maximum(keys[at], keys[at + apart]))
    return np.concatenate(smaller), np.concatenate(larger)


def _neighbours(reach: int, nearest: int):
    """Pairs ``a < b`` of a sorted run of ``tree, label, key, part``, and its ends: rows with
    all but ``b``."""

    def ends(rows: pa.Table) -> pa.RecordBatch:
        none = pa.nulls(rows.num_rows, pa.int64())
        columns = [rows["key"], none, rows["tree"], rows["label"], rows["part"]]
        return pa.table(columns, names).combine_chunks().to_batches()[0]

    def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), kind) for kind in (pa.int32(), pa.binary(), pa.int64())]
        return pa.record_batch([pa.array(a), pa.array(b), *none], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if seen < reach:
                yield ends(pa.Table.from_batches([batch.slice(0, reach - seen)]))
            rows = pa.Table.from_batches([batch] if tail is None else [*tail.to_batches(), batch])
            found = _pairs(rows, reach, nearest, rows.num_rows - batch.num_rows)
            if len(found[0]):
                yield pairs(*found)
            seen += batch.num_rows
            tail = rows.slice(max(0, rows.num_rows - reach))
        if tail is not None and seen > reach:
            yield ends(tail)

    names = [field.split()[0] for field in _RUN.split(", ")]
    return run


def _candidates(classes: DataFrame, reach: int, nearest: int) -> DataFrame:
    """``a, b``: neighbours in some tree that are of different parts. ``classes`` has ``key``,
    ``signature`` and ``part``."""
    labels = [F.substring("signature", 1 + 2 * DEPTH * t, 2 * DEPTH) for t in range(TREES)]
    entries = classes.select(F.posexplode(F.array(*labels)).alias("tree", "label"), "key", "part")
    order, find = ["tree", "label", "key"], _neighbours(reach, nearest)
    ordered = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = stage(map_batches(ordered, find, _RUN))
    # The ends of all runs, a bounded number per partition, hold the neighbours across them.
    met = runs.filter("b IS NULL").selectExpr("tree", "label", "a AS key", "part").distinct()
    across = map_batches(met.repartition("tree").sortWithinPartitions(*order), find, _RUN)
    pairs = runs.filter("b IS NOT NULL").unionByName(across.filter("b IS NOT NULL"))
    return stage(pairs.select("a", "b").distinct())


def _alike(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose sizes and signatures allow the similarity, with the share of equal
    signature values."""
    sketch = classes.select("key", "n_shingles", "signature")
    joined = pairs.join(sketch.toDF("a", "size_a", "sign_a"), "a").join(
        sketch.toDF("b", "size_b", "sign_b"), "b"
    )
    fits = 100 * F.least("size_a", "size_b") >= similarity * F.greatest("size_a", "size_b")
    share = similarity / 100
    least = share - 5 * (share * (1 - share) / _SIGNATURE) ** 0.5

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, _SIGNATURE)
                for c in ("sign_a", "sign_b")
            ]
            equal = (signs[0] == signs[1]).mean(1)
            found = equal >= least
            rows = [batch["a"].filter(pa.array(found)), batch["b"].filter(pa.array(found))]
            yield pa.record_batch([*rows, pa.array(equal[found])], ["a", "b", "equal"])

    chosen = joined.filter(fits).select("a", "b", "sign_a", "sign_b")
    return map_batches(chosen, compare, "a bigint, b bigint, equal double")


def _whole_sets(docs: DataFrame, classes: DataFrame, shingle_words: int) -> DataFrame:
    """``key, hashes`` of ``classes``. The texts are read again, and only those whose id may
    be one of a class's sought member are made into sets."""
    sought = stage(classes.select("key", "digest", "doc_id"))
    ids = sought.filter("doc_id IS NOT NULL").select("doc_id")
    maybe, others = sieve.split(docs, "doc_id", ids)
    texts = maybe.unionByName(others.filter("doc_id IS NULL"))

    def sets(column_: pa.Array) -> list:
        digests, hashes = [], []
        for part in slices(column_):
            found = shingle_sets(part, shingle_words)
            for i in range(part.last - part.first):
                digests.append(_digest(found.of(i)))
                hashes.append(found.of(i).tobytes())
        return [digests, hashes]

    fields = {"digest": "binary", "hashes": "binary"}
    found = annotate(texts, "text", fields, sets, ["doc_id"])
    kept = found.join(sought.withColumnRenamed("doc_id", "member"), "digest")
    members = kept.filter(F.col("doc_id").eqNullSafe(F.col("member")))
    return members.groupBy("key").agg(F.first("hashes").alias("hashes"))


def _links(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch["set_a"], batch["set_b"]):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = common(x, y)
                found.append(100 * both >= similarity * (len(x) + len(y) - both))
            mask = pa.array(found, pa.bool_())
            yield pa.record_batch([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    ends = pairs.select(F.col("a").alias("one"), F.col("b").alias("other"))
    joined = ends.join(sets.toDF("one", "set_a"), "one").join(sets.toDF("other", "set_b"), "other")
    both = joined.select(F.col("one").alias("a"), F.col("other").alias("b"), "set_a", "set_b")
    return map_batches(both, compare, "a bigint, b bigint")


def _best(pairs: DataFrame) -> DataFrame:
    """For each class its most similar candidate with a larger key and with a smaller one."""
    rank = F.struct(F.col("equal"), F.col("a"), F.col("b"))
    tops = [pairs.groupBy(end).agg(F.max(rank).alias("top")).select("top.a", "top.b") for end in ("a", "b")]
    return tops[0].unionByName(tops[1]).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose classes are not equally labelled."""
    ends = pairs.join(labels.toDF("a", "x"), "a", "left").join(labels.toDF("b", "y"), "b", "left")
    return ends.filter("x IS NULL OR y IS NULL OR x <> y").select("a", "b")


def _parts(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``classes`` with their component as ``part``, a class without links being its own."""
    labelled = classes.join(labels.toDF("key", "part"), "key", "left")
    return labelled.withColumn("part", F.coalesce("part", "key"))


def _contested(parts: DataFrame) -> DataFrame:
    """``key, part`` of the classes in a run of a common prefix, in some tree, that is longer
    than the reach and has more than one component."""
    prefixes = [
        F.xxhash64(F.lit(t), F.substring("signature", 1 + 2 * DEPTH * t, 2 * LEAST_PREFIX))
        for t in range(TREES)
    ]
    entries = parts.select(F.explode(F.array(*prefixes)).alias("run"), "key", "part")
    runs = entries.groupBy("run").agg(
        F.count("*").alias("n"), F.min("part").alias("least"), F.max("part").alias("most")
    )
    mixed = runs.filter((F.col("n") > REACH + 1) & (F.col("least") < F.col("most"))).select("run")
    return stage(entries.join(mixed, "run", "left_semi").select("key", "part").distinct())


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, key, part, size`` for each shingle of ``key, part, hashes``."""
    names = ["hash", "key", "part", "size"]
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch["hashes"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        keys, parts = batch["key"].to_numpy(), batch["part"].to_numpy()
        done = (np.cumsum(sizes) - sizes) // _ROWS
        for rows in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(done)) + 1):
            some = sizes[rows]
            columns = [np.concatenate([sets[i] for i in rows])] if len(rows) else [np.empty(0, np.int64)]
            columns += [np.repeat(column_[rows], some) for column_ in (keys, parts, sizes)]
            yield pa.record_batch([pa.array(c) for c in columns], names)


def _prefix_pairs(contested: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """``a, b``: all pairs of different parts that can be similar enough.

    Sets of sizes ``x <= y`` are so if at least ``s (x + y) / (100 + s)`` shingles are common.
    Ranked alike, the first common one then has as many after it in both: in the smaller set
    it is among the first ``x - 2 s x / (100 + s)``, in the larger among ``y - s y / 100``.
    """
    rows = map_batches(
        sets.join(contested, "key").select("key", "part", "hashes"),
        _shingle_rows,
        "hash bigint, key bigint, part bigint, size bigint",
    )
    # Rare is what few of these classes have. A shingle of one class meets nothing but has a rank.
    counts = (
        rows.groupBy("hash", "part")
        .agg(F.count("*").alias("n"))
        .groupBy("hash")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "part"))["part"].alias("main"), F.count("*").alias("parts"))
        .filter("n > 1")
    )
    ranked = (
        rows.join(counts, "hash")
        .groupBy("key", "part", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "hash", "main", "parts"))).alias("shingles"))
    )
    entry = F.posexplode("shingles").alias("place", "shingle")
    entries = ranked.select("key", "part", "size", F.size("shingles").alias("shared"), entry)
    entries = entries.selectExpr(
        "shingle.hash", "key", "part", "size", "size - shared + place AS place",
        "part <> shingle.main AS outside", "shingle.parts", "1 + shingle.n DIV {n} AS salts".format(n=_SALTED),
    )
    probes = entries.filter(f"parts > 1 AND 100 * (size - place) >= {similarity} * size").drop("parts")
    probes = stage(probes)
    # Pairs within the main part of a shingle are never made: one of the two is outside.
    smaller = probes.filter(f"{100 + similarity} * (size - place) >= {2 * similarity} * size")
    smaller = smaller.withColumn("salt", F.expr("pmod(xxhash64(key), salts)")).drop("salts")
    larger = probes.withColumn("salt", F.explode(F.expr("sequence(0L, salts - 1)"))).drop("salts")
    left = smaller.toDF("hash", "a", "part_a", "size_a", "place_a", "outside_a", "salt")
    right = larger.toDF("hash", "b", "part_b", "size_b", "place_b", "outside_b", "salt")
    least = f"{similarity} * (size_a + size_b)"
    fits = (
        "part_a <> part_b AND size_a <= size_b "
        f"AND {100 + similarity} * (size_a - place_a) >= {least} "
        f"AND {100 + similarity} * (size_b - place_b) >= {least}"
    )
    met = [
        left.filter(one).join(right.filter(other), ["hash", "salt"]).filter(fits)
        for one, other in (("outside_a", "true"), ("NOT outside_a", "outside_b"))
    ]
    pairs = met[0].unionByName(met[1])
    return stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _grouped(docs: DataFrame, shingle_words: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n_shingles, digest`` of each row, and ``digest, component_id`` of each class."""
    fields = {"n_shingles": "bigint", "digest": "binary", "signature": "binary"}
    rows = stage(annotate(docs, "text", fields, _sketches(shingle_words), ["doc_id"]))
    classes = stage(
        rows.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .withColumn("key", F.monotonically_increasing_id())
    )
    met = _candidates(classes.withColumn("part", F.col("key")), REACH, REACH)
    pairs = stage(_alike(met, classes, similarity))
    keys = met.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    near = stage(classes.join(keys, "key", "left_semi"))
    sets = stage(_whole_sets(docs, near, shingle_words))
    labels = components(_links(_best(pairs), sets, similarity))
    labels = components(_links(_apart(pairs, labels), sets, similarity), labels)
    new = _candidates(_parts(near, labels), FAR_REACH, FOREIGN).join(met, ["a", "b"], "left_anti")
    foreign = _alike(new, classes, similarity)
    labels = components(_links(foreign, sets, similarity), labels)
    contested = _contested(_parts(near, labels))
    if not contested.isEmpty():
        missed = _prefix_pairs(contested, sets, similarity)
        labels = components(_links(missed, sets, similarity), labels)

    member = classes.select("key", "digest", "doc_id").join(
        labels.withColumnRenamed("node", "key"), "key", "left"
    )
    member = member.withColumn("label", F.coalesce("label", "key"))
    # Written, so that both sides of the join are shuffled for it and a hot label can be split.
    smallest = stage(member.groupBy("label").agg(F.min("doc_id").alias("component_id")))
    return rows, stage(member.join(smallest, "label").select("digest", "component_id"))


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``, where texts with
    ``100 * intersection >= similarity * union`` are linked."""
    with small_batches(docs.sparkSession):
        rows, of_class = _grouped(id_and_text(docs, id_column, text_column), shingle_words, similarity)
    linked = rows.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: one id of each component."""
    groups = near_groups(docs, id_column, text_column, shingle_words, similarity)
    dropped = stage(groups.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct())
    rows = docs.withColumn(id_column, column(id_column).cast("bigint"))
    kept = sieve.without(rows, id_column, dropped)
    return kept.select(*[column(c).cast(kind).alias(c) for c, kind in docs.dtypes])
