"""Row counts, lost sales and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions import exact_sum
from tallyhouse.schema import TEXT_LIMITS

KEYS = ("customer_key", "seller_key", "product_key", "store_key", "supplier_key", "date_key")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def lost_sales(fact: DataFrame) -> DataFrame:
    """Sales and revenue without a key, per key: what the mart of that key leaves out.
    One pass over the fact."""
    lines = [F.count_if(F.col(key).isNull()) for key in KEYS]
    money = [
        F.coalesce(exact_sum(F.when(F.col(key).isNull(), F.col("sale_total_price"))), F.lit(0.0))
        for key in KEYS
    ]
    per_key = [
        F.struct(F.lit(key).alias("key_column"), n.alias("lost_lines"), m.alias("lost_revenue"))
        for key, n, m in zip(KEYS, lines, money)
    ]
    return fact.agg(F.array(*per_key).alias("per_key")).select(F.inline("per_key"))


def orphan_keys(fact: DataFrame, dimension: DataFrame, fact_key: str, surrogate: str) -> DataFrame:
    """Keys of the fact that the dimension does not hold; none in a sound star."""
    used = fact.select(F.col(fact_key).alias(surrogate)).filter(f"{surrogate} IS NOT NULL")
    return used.distinct().join(dimension.select(surrogate), surrogate, "left_anti")


def repeated_keys(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys held by several rows; joining on them would multiply sales."""
    return dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def text_lengths(staging: DataFrame) -> DataFrame:
    """Per text column with a limit: the longest value, and how many pass the limit.
    Spark's strings have no length, so a database's limits are checked here. One pass."""
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(limit).alias("allowed"),
            F.max(F.length(name)).alias("longest"),
            F.count_if(F.length(name) > limit).alias("too_long"),
        )
        for name, limit in TEXT_LIMITS.items()
        if name in staging.columns
    ]
    return staging.agg(F.array(*per_column).alias("per_column")).select(F.inline("per_column"))
