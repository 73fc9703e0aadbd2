import builtins
import importlib
import sys

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import compare, oracle
from tallyhouse.llm import quality_classifier, queries
from tests.llm.test_near_dedup import brute as brute_near
from tests.llm.test_packing import check
from tests.llm.test_quality_rules import failed, measures


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_its_twin(spark, sf_folder, name):
    con = oracle(sf_folder)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_folder}/documents.parquet')")
    assert compare(spark, con, name, sf_folder) is None


@pytest.mark.parametrize("name", queries.QUERIES)
def test_every_query_runs_over_the_whole_table(spark, sf_folder, name):
    table, key = "documents", "doc_id"
    if name == "op12_conversation_repair":
        table, key = "conversations", "conv_id"
    rows = queries.QUERIES[name](spark, sf_folder)
    ids = [r[key] for r in rows.select(key).collect()]
    if name != "op7_license_scan":
        every = spark.read.parquet(f"{sf_folder}/{table}.parquet").select(key).collect()
        assert set(ids) == {r[key] for r in every}
    if name not in ("op6_packing", "op7_license_scan"):
        assert len(ids) == len(set(ids))


def test_stages_match_plain_python(spark, sf_folder):
    """Each stage on what the one before it kept."""
    docs = queries.documents(spark, sf_folder)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    columns, kept, stages = docs.columns, docs, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "quality_classifier", "exact_dedup", "near_dedup", "packing"]

    def step(name):
        found = corpus_pipeline.stage(stages[name](spark, kept, sf_folder))
        assert name == "packing" or found.columns == columns
        return found

    kept = step("quality_rules")
    rows = [(i, t) for i, t in rows if not failed(measures(t))]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows)

    learn = queries.remainder(queries.F.col("doc_id"), 4) != 2
    model = quality_classifier.train(docs, queries.labels(spark, sf_folder), learn)
    scored = quality_classifier.score(kept, model).collect()
    good = {r["doc_id"] for r in scored if r["score"] >= 0.7}
    kept = step("quality_classifier")
    rows = [(i, t) for i, t in rows if i in good]
    assert {r["doc_id"] for r in kept.collect()} == good

    kept = step("exact_dedup")
    last = {t.encode().lower(): i for i, t in sorted(rows)}
    rows = [(i, t) for i, t in rows if last[t.encode().lower()] == i]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows)

    kept = step("near_dedup")
    first = {component for _, _, component in brute_near(rows, 5)}
    rows = [(i, t) for i, t in rows if i in first]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check(rows, step("packing").collect(), lambda t: tokenizer.encode(t, add_special_tokens=False).ids, 2048)
    assert corpus_pipeline.run(spark, sf_folder).count() == step("packing").count()


def test_an_empty_table_passes_every_stage(spark, sf_folder):
    rows = queries.documents(spark, sf_folder).limit(0)
    for _, function in corpus_pipeline.STAGES:
        rows = corpus_pipeline.stage(function(spark, rows, sf_folder))
        assert rows.isEmpty()


def test_a_missing_module_of_another_kind_is_an_error(monkeypatch):
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == "numpy":
            raise ModuleNotFoundError("No module named 'numpy'", name="numpy")
        return real(name, *args, **kwargs)

    for name in [n for n in sys.modules if n.startswith(("tallyhouse.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    with monkeypatch.context() as patched:
        patched.setattr(builtins, "__import__", without)
        with pytest.raises(ModuleNotFoundError, match="numpy"):
            importlib.reload(entry)
    importlib.reload(entry)
