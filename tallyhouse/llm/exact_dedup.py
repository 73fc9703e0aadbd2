"""Exact deduplication with a heavy-hitter split.

1. Every text is reduced to the SHA-256 of its bytes with A-Z lower-cased; only these
   digests, ids and row numbers go on. They are written once.
2. Misra-Gries: each partition keeps a summary of at most ``counters`` digests, the
   summaries are added up and cut down again to ``counters``. Every digest with more
   than ``1 / (counters + 1)`` of all rows is among them.
3. The candidates are counted exactly. Those found at least twice are verified heavy
   hitters; their winners (at most ``counters`` rows of 56 bytes) are broadcast, and rows
   of these groups are settled where they stand.
4. All other digests are shuffled. A group there has at most ``1 / (counters + 1)`` of all
   rows.

Defined results: a null text equals an empty one. Of equal texts the row with the largest
id stays; of several such rows (repeated ids) one stays. A null id is smaller than
every id; if all ids of a group are null, ``keep_id`` is null. An empty table gives no
rows. Other columns of the input, whatever their names, are not read by
``exact_groups`` and are all kept by ``drop_copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.arrow import map_batches, small_batches
from tallyhouse.llm.columns import column, fresh, id_and_text
from tallyhouse.operators.scratch import stage

COUNTERS = 512
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()  # bytes.lower() changes A-Z only


def digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, digest`` for every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = (digest(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts)
            yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

    return map_batches(id_and_text(docs, id_column, text_column), hashed, "doc_id bigint, digest binary")


def frequent_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each that more than ``1 / (counters + 1)``
    of the rows share."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for key in batch.column(0).to_pylist():
                if key in counts:
                    counts[key] += 1
                elif len(counts) < counters:
                    counts[key] = 1
                else:
                    for other in list(counts):
                        counts[other] -= 1
                        if not counts[other]:
                            del counts[other]
        yield pa.record_batch(
            [pa.array(counts, pa.binary()), pa.array(counts.values(), pa.int64())],
            ["digest", "n"],
        )

    summed = (
        map_batches(rows.select("digest"), summary, "digest binary, n bigint")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
    )
    # Adding summaries up and taking off the next largest counter keeps the guarantee.
    top = summed.orderBy(F.desc("n"), "digest").limit(counters + 1).collect()
    cut = top[counters]["n"] if len(top) > counters else 0
    kept = [(bytes(row["digest"]),) for row in top if row["n"] > cut]
    return rows.sparkSession.createDataFrame(kept, "digest binary")


def heavy_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Per verified heavy hitter its exact size and the row that stays. ``rows`` has
    ``digest`` and ``row``, whose largest value stays."""
    candidates = F.broadcast(frequent_digests(rows, counters))
    exact = (
        rows.join(candidates, "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.max("row").alias("winner"))
        .filter("group_size > 1")
    )
    # At most ``counters`` rows, so they may pass through the driver.
    return rows.sparkSession.createDataFrame(exact.collect(), exact.schema)


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    numbered = digests(docs, id_column, text_column).withColumn(
        "row", F.struct("doc_id", F.monotonically_increasing_id().alias("number"))
    )
    with small_batches(docs.sparkSession):
        rows = stage(numbered.select("digest", "row"))
    winners = F.broadcast(heavy_winners(rows, counters))
    heavy = rows.join(winners, "digest")
    group = Window.partitionBy("digest")
    rest = rows.join(winners, "digest", "left_anti").select(
        "digest",
        "row",
        F.count("*").over(group).alias("group_size"),
        F.max("row").over(group).alias("winner"),
    )
    return heavy.unionByName(rest).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("winner.doc_id").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("row") == F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Copies in heavy groups go before the shuffle; the other rows are shuffled once, whole.
    """
    with small_batches(docs.sparkSession):
        rows = stage(digests(docs, id_column, text_column).withColumnRenamed("doc_id", "row"))
    digest_name, winner_name = fresh(docs, "text_digest"), fresh(docs, "winner_id")
    place, known = fresh(docs, "place"), fresh(docs, "known")
    winners = heavy_winners(rows, counters).select(
        F.col("digest").alias(digest_name), F.col("winner").alias(winner_name), F.lit(True).alias(known)
    )
    ids = column(id_column).cast("bigint")
    # The same digests by built-in functions: the whole rows need not pass through Python.
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    hashed = docs.withColumn(digest_name, F.unhex(F.sha2(F.translate(text, UPPER, UPPER.lower()), 256)))
    left = hashed.join(F.broadcast(winners), digest_name, "left").filter(
        F.col(known).isNull() | ids.eqNullSafe(F.col(winner_name))
    )
    others = [column(c) for c, kind in docs.dtypes if "map<" not in kind]
    order = Window.partitionBy(digest_name).orderBy(ids.desc_nulls_last(), F.xxhash64(*others))
    first = left.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1)
    return first.select(*[column(c) for c in docs.columns])
