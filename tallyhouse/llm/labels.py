"""Labelled texts to learn from: a bounded, reproducible sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bounds of what a classifier is fitted on: texts per class, and bytes of one text.
TEXTS_PER_CLASS = 2_000
TEXT_BYTES = 64_000


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    texts_per_class: int = TEXTS_PER_CLASS,
    text_bytes: int = TEXT_BYTES,
) -> tuple[DataFrame, float]:
    """``doc_id, text, label`` of at most ``texts_per_class`` rows with label 0 and as many with 1,
    chosen by a hash of their id among the rows where ``learn`` holds.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id`` and the label column. Ids
    with null or contradicting labels, and other labels than 0 and 1, teach nothing.
    Texts of more than ``text_bytes`` are not learnt from (all are scored). Second, the share
    of label 1 among all rows that may be learnt from, for scores that keep to it.
    """
    agreed = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(learn & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .drop("most")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [
        row
        for value in (0, 1)
        for row in agreed.filter(F.col("label") == value).orderBy(*order).limit(texts_per_class).collect()
    ]
    counts = dict(agreed.groupBy("label").count().collect())
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    few = F.broadcast(labels.sparkSession.createDataFrame(chosen, "doc_id bigint, label int"))
    rows = (
        docs.filter(F.octet_length("text") <= text_bytes)
        .join(few, "doc_id")
        .dropDuplicates(["doc_id"])
        .select("doc_id", "text", "label")
    )
    return rows, share
