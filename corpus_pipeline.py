"""Documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``docs``; the last returns one row per piece of a document in a sequence. Rows with null
or empty texts fail the rules. An empty table passes every stage as an empty table. The
classifier learns from the labels of all documents, as few bad ones are left to learn
from after the rules; without a label of each class it rejects nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import exact_dedup, near_dedup, packing, quality_classifier, quality_rules
from tallyhouse.llm.arrow import set_batch_rows
from tallyhouse.llm.labels import remainder
from tallyhouse.operators.scratch import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pass_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def pass_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    texts = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(texts, _table(spark, sf_dir, "labels"), learn=~held_out)
    return quality_classifier.keep(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


#: Words that a worker of the last stage remembers: it shares its executor with what the stages
#: before have left.
_REMEMBERED = 80_000


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    return packing.pack(docs, tokenizer, remembered=_REMEMBERED)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Bytes of rows that go to Python at once; a longer row goes alone.
_BATCH_BYTES = 4 << 20


def _with_settings(step: Stage) -> Stage:
    """The stages' rows are whole texts and sets: few of them go to Python at once, by number and
    by size."""

    def stage_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        set_batch_rows(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
        return step(spark, docs, sf_dir)

    return stage_


STAGES = [
    ("quality_rules", _with_settings(pass_rules)),
    ("quality_classifier", _with_settings(pass_classifier)),
    ("exact_dedup", _with_settings(drop_exact_copies)),
    ("near_dedup", _with_settings(drop_near_copies)),
    ("packing", _with_settings(pack_sequences)),
]

#: The classifier is trained and the near-duplicates are hashed: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        rows = stage(step(spark, rows, sf_dir))
    return STAGES[-1][1](spark, rows, sf_dir)
