"""Faults put into the given tables on purpose, for the queries that mend them.

Which rows are changed follows from checksums of their keys, so every run damages the same rows
in the same way. Built-in expressions only. Fixed values: the moduli and what each remainder does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_WORD_GAP = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _WORD_GAP), lambda word: word != "")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the texts repeat a passage up to their end: from word
    ``a`` on, word ``i`` becomes word ``a + (i - a) % p``. Their words are joined by one space.
    A null id or a text without words is left as it is."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(
        "doc_id", "text",
        F.when(checksum % 10 == 0, _words(F.col("text"))).alias("_words"),
        F.floor(checksum / 10).alias("_g"),
    ).withColumn("_n", F.size("_words"))
    placed = chosen.withColumn("_a", F.expr("IF(_n > 0, _g % _n, 0)")).withColumn(
        "_p", F.expr("1 + (_n - _a) div (3 + _g % 8)")
    )
    repeated = F.expr(
        "concat_ws(' ', slice(_words, 1, CAST(_a AS INT)), slice(flatten(array_repeat("
        "slice(_words, CAST(_a + 1 AS INT), CAST(_p AS INT)), CAST((_n - _a) div _p + 1 AS INT)"
        ")), 1, CAST(_n - _a AS INT)))"
    )
    return placed.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def damage_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` where one row in five has a fault, by the checksum of id and
    turn: dropped, emptied, without the ends of its sentences, repeated, or said to be the user's.
    A null role or text is one space, and a null id or turn is one in the checksum."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat_ws(":", shown("conv_id"), shown("turn"))
    rows = conversations.select(
        "conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_kind"),
    ).filter("_kind != 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "")
        .when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.expr("sequence(1, IF(_kind = 3, 2, 1))")).alias("_copy"),
    ).drop("_copy")
