import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import labels as labelled, quality_classifier, toxicity

WORDS = "the of and house river walking quietly morning window garden letter paper under".split()


@pytest.fixture(scope="module")
def corpus():
    """``(id, text, quality, toxic)``: bad texts shout and repeat, toxic ones have a slur in
    one sentence, with changing endings."""
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        sentences = [" ".join(rnd.choices(WORDS, k=rnd.randint(3, 12))) + "." for _ in range(rnd.randint(2, 9))]
        quality, toxic = int(i % 5 != 0), int(i % 4 == 1)
        if toxic:
            slur = rnd.choice(["scumbag", "vermin", "filthhead", "filthface", f"filth{rnd.randint(0, 999)}"])
            at = rnd.randrange(len(sentences))
            sentences[at] = f"You {slur} of {sentences[at]}"
        text = " ".join(sentences)
        if not quality:
            text = text.upper().replace(" ", "!! ") if i % 2 else f"{rnd.choice(WORDS)} " * 80
        rows.append((i, text, quality, toxic))
    return rows


@pytest.fixture
def tables(spark, documents, corpus):
    docs = documents(*[(i, t) for i, t, _, _ in corpus])
    return docs, spark.createDataFrame([(i, q, x) for i, _, q, x in corpus], "doc_id bigint, quality int, toxic int")


LEARN = "doc_id % 3 != 1"


def accuracy(scored, corpus, column, of):
    found = {r["doc_id"]: r["score"] for r in scored.collect()}
    held_out = [r for r in corpus if r[0] % 3 == 1 and of(r)]
    return sum((found[r[0]] >= 0.7) == bool(r[column]) for r in held_out) / len(held_out)


def test_quality_of_held_out_texts(tables, corpus):
    docs, marks = tables
    model = quality_classifier.train(docs, marks, F.expr(LEARN))
    scored = quality_classifier.score(docs, model)
    assert accuracy(scored, corpus, 2, lambda r: True) > 0.97
    kept = {r["doc_id"] for r in quality_classifier.keep(docs, model).collect()}
    assert kept == {r["doc_id"] for r in scored.collect() if r["score"] >= quality_classifier.THRESHOLD}


def test_toxicity_of_held_out_texts_and_sentences(tables, corpus):
    docs, marks = tables
    scored = toxicity.score(docs, toxicity.train(docs, marks, F.expr(LEARN)))
    assert accuracy(scored, corpus, 3, lambda r: r[2]) > 0.95
    texts = {r[0]: r[1] for r in corpus}
    located = [(r["doc_id"], s) for r in scored.collect() for s in r["sentences"] if texts[r["doc_id"]][0].islower() or True]
    right = 0
    for doc_id, s in located:
        assert texts[doc_id].encode()[s["first_byte"] : s["last_byte"]].decode() == s["text"]
        right += any(w in s["text"].lower() for w in ("scumbag", "vermin", "filth"))
    assert right > 0.95 * len(located) > 50


def test_scores_do_not_depend_on_ids_or_neighbours(tables, documents):
    docs, marks = tables
    for module in (quality_classifier, toxicity):
        model = module.train(docs, marks, F.expr(LEARN))
        text = docs.filter("doc_id = 7").first()["text"]
        alone = module.score(documents((None, text), (1, None), (2, ""), (3, "long " * 100_000), (4, "é日")), model)
        found = {r["doc_id"]: r["score"] for r in alone.collect()}
        among = module.score(docs, model).filter("doc_id = 7").first()["score"]
        assert found[None] == pytest.approx(among, abs=1e-9) and found[1] == found[2]
        assert all(0 <= s <= 1 for s in found.values()) and len(found) == 5


def test_the_sample_is_bounded_and_leaves_out_what_contradicts(spark, documents):
    docs = documents(*[(i, f"text {i}") for i in range(100)], (100, "x" * 1000))
    marks = [(i, i % 2, 0) for i in range(101)] + [(0, 1, 0), (2, None, 0), (3, 1, 0), (None, 1, 0), (4, 7, 0)]
    table = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    rows, share = labelled.sample(docs, table, "quality", F.lit(True), texts_per_class=1000, text_bytes=500)
    found = {r["doc_id"]: r["label"] for r in rows.collect()}
    assert found == {i: i % 2 for i in range(1, 100)} and share == pytest.approx(50 / 100)
    rows, _ = labelled.sample(docs, table, "quality", F.lit(True), texts_per_class=7)
    assert rows.groupBy("label").count().orderBy("label").collect() == [(0, 7), (1, 7)]


def test_nothing_to_learn_from(spark, documents):
    docs = documents((1, "a b"), (2, None))
    marks = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    for table in (marks, marks.limit(0)):
        model = quality_classifier.train(docs, table, F.lit(True))
        assert {r["score"] for r in quality_classifier.score(docs, model).collect()} == {0.5}
        assert quality_classifier.keep(docs, model).count() == 2
        assert {r["score"] for r in toxicity.score(docs, toxicity.train(docs, table, F.lit(True))).collect()} == {0.0}
    assert quality_classifier.score(docs.limit(0), model).isEmpty()
    assert toxicity.score(docs.limit(0), toxicity.train(docs, marks, F.lit(True))).isEmpty()


def test_kept_rows_have_their_columns(clashing, tables):
    docs, marks = tables
    model = quality_classifier.train(docs, marks, F.expr(LEARN))
    some = clashing((1, "the of and house river"), (2, "SHOUT!! " * 50))
    assert quality_classifier.keep(some, model).schema == some.schema
