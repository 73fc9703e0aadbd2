import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import near_dedup, sieve
from tallyhouse.llm.components import components
from tallyhouse.operators.scratch import stage

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, n):
    words = tuple(WORD.findall((text or "").encode().lower().decode()))
    found = {words[i : i + n] for i in range(len(words) - n + 1)}
    return found or ({words} if words else set())


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[max(self.find(a), self.find(b))] = min(self.find(a), self.find(b))


def brute(rows, n, similarity=80):
    sets, groups = [shingles(t, n) for _, t in rows], Groups()
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= similarity * (len(a) + len(sets[j]) - both):
                groups.join(i, j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[groups.find(i)].append(doc_id)
    smallest = {g: min((x for x in ids if x is not None), default=None) for g, ids in members.items()}
    return [(doc_id, len(sets[i]), smallest[groups.find(i)]) for i, (doc_id, _) in enumerate(rows)]


def corpus(seed):
    """Unrelated texts, chains of edits, and a group around one text."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 3000)}"
    texts = [" ".join(word() for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    for size, edits in ((40, 1), (100, 4)):
        text = [word() for _ in range(size)]
        for _ in range(25):
            texts.append(" ".join(text))
            for _ in range(edits):
                text[rnd.randrange(size)] = word()
    centre = [word() for _ in range(80)]
    for _ in range(60):
        copy = list(centre)
        for _ in range(rnd.randint(0, 6)):
            copy[rnd.randrange(80)] = word()
        texts.append(" ".join(copy))
    texts += ["a b c d e f", "A  b C d e f", None, "", "one", "ONE", "two words", "x " * 3000]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return [*rows, (None, "no id at all here"), (7000, "no id at all here"), (None, "another one alone"), (3, texts[3])]


@pytest.mark.parametrize("shingle_words", [2, 5])
def test_groups_match_brute_force(clashing, shingle_words):
    rows = corpus(shingle_words)
    found = near_dedup.near_groups(clashing(*rows), shingle_words=shingle_words).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted([tuple(r)[:3] for r in found], key=key) == sorted(brute(rows, shingle_words), key=key)
    for row in found:
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_dense_region_below_the_similarity_hides_no_link(documents):
    """Many texts that share a passage, at 0.78 to each other, and pairs at 0.81 among them."""
    rnd = random.Random(6)
    passage, rows, partners = [f"p{i}" for i in range(193)], [], {}
    own = lambda n: [f"o{rnd.getrandbits(40)}" for _ in range(n)]
    for i in range(2000):
        tail = own(27)
        rows.append((i, " ".join(passage + tail)))
        if i % 50 == 0:
            partner = 10_000 + i
            partners[partner] = i
            rows.append((partner, " ".join(passage + tail[:4] + own(23))))
    sets = [shingles(t, 5) for _, t in rows[:3]]  # 0, its partner, 1
    alike = [len(x & y) / len(x | y) for x, y in (sets[:2], sets[::2])]
    assert alike[0] >= 0.8 and 0.75 < alike[1] < 0.8
    found = near_dedup.near_groups(documents(*rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: partners.get(i, i) for i, _ in rows}


def test_dropping_keeps_one_of_each_group_and_all_columns(clashing):
    rows = [(i, t) for i, t in corpus(9) if i is not None][:-1]
    docs = clashing(*rows)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows, 5)})


def test_neighbours_do_not_depend_on_partitions(documents, spark):
    rows = corpus(4)
    classes = near_dedup.annotate(
        near_dedup.id_and_text(documents(*rows), "doc_id", "text"), "text",
        {"n": "bigint", "digest": "binary", "signature": "binary"}, near_dedup._sketches(2), ["doc_id"],
    ).filter("doc_id IS NOT NULL AND n > 0").selectExpr("doc_id AS key", "signature", "doc_id AS part")
    classes = stage(classes.dropDuplicates(["key"]))
    found, name = [], "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    for n in ("1", "5", "60"):
        spark.conf.set(name, n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found.append({tuple(r) for r in near_dedup._candidates(classes, 4, 4).collect()})
    spark.conf.set(name, before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] and found[0] == found[1] == found[2]


def test_empty(documents):
    docs = documents((1, "a")).limit(0)
    assert near_dedup.near_groups(docs).isEmpty() and near_dedup.drop_near_copies(docs).isEmpty()
    assert [r["kept"] for r in near_dedup.near_groups(documents((1, None), (2, ""))).collect()] == [True, True]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rnd = np.random.default_rng(seed)
    edges = {tuple(sorted(rnd.integers(0, 120, 2).tolist())) for _ in range(90)}
    edges |= {(i, i + 1) for i in range(200, 330)} | {(400, i) for i in range(401, 460)} | {(5, 5)}
    first, more = list(edges)[::2], list(edges)
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    frame = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    labels = components(frame(more), components(frame(first)))
    found = {r["node"]: r["label"] for r in labels.collect()}
    assert found.keys() == {x for e in edges for x in e}
    pairs = {(found[x], groups.find(x)) for x in found}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_sieve(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 10 != 3, F.col("id")).alias("k"), F.lit("b").alias("bucket"))
    keys = stage(spark.range(0, 2000, 7))
    left = [r["k"] for r in sieve.without(rows, "k", keys).collect()]
    assert sorted(k for k in left if k is not None) == [k for k in range(1000) if k % 10 != 3 and k % 7]
    assert left.count(None) == 100
