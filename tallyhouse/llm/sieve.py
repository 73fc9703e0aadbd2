"""Leaving most rows where they are when a few are looked up by key.

The keys are reduced to at most ``BUCKETS`` hash buckets, a bound that holds for any number
of keys. Rows in other buckets are settled at once; the rest, with every sought row and some
others, goes through an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.columns import column, fresh

BUCKETS = 1 << 20


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def split(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of the keys, and rows that have none. ``keys`` is a written
    table with one column; rows with a null key have none."""
    name = fresh(rows, "bucket")
    buckets = F.broadcast(keys.select(_bucket(F.col(keys.columns[0])).alias(name)).distinct())
    placed = rows.withColumn(name, F.when(column(key).isNotNull(), _bucket(column(key))))
    return (
        placed.join(buckets, name, "left_semi").select(*[column(c) for c in rows.columns]),
        placed.join(buckets, name, "left_anti").select(*[column(c) for c in rows.columns]),
    )


def without(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose key is not among ``keys``."""
    maybe, others = split(rows, key, keys)
    named = keys.select(F.col(keys.columns[0]).alias(key))
    return others.unionByName(maybe.join(named, key, "left_anti").select(*[column(c) for c in rows.columns]))
