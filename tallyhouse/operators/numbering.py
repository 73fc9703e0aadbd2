"""Row numbers and ranks over a whole table, without one task that holds it.

The rows are dealt into ranges of the order, as many as the session's shuffles have
partitions, and written with the number of their range. The ranges are counted; a row's
number is the number of rows in the ranges before its own plus its number within the range.

Ranks of several measures are found in one pass: every row gives one narrow row per measure, and
these are dealt into ranges by measure and value, with the key last, so that many rows with one
value fill several ranges. A value that begins in an earlier range has the rank that it has
there. The ranks of a row are put together by its key and joined to it once.

Both functions read their input several times; hand them a written table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.operators.scratch import stage


def number_rows(rows: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Add 1..n in ascending order of ``by``, nulls first. ``by`` must be unique."""
    order = [F.col(c).asc_nulls_first() for c in by]
    placed = _in_ranges(rows, order, F.lit(1))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.select(*rows.columns, (F.col("_before") + within).alias(name))


def rank_rows(rows: DataFrame, ranks: Mapping[str, str], key: Sequence[str]) -> DataFrame:
    """Add one rank per entry ``{rank column: measure}``: largest first, nulls last, ties
    share a rank and leave a gap after it. ``key`` must be unique; it may be null."""
    placed = stage(_ranked_in_ranges(_measures(rows, list(ranks.values()), key), key))
    ranges = _ranges_of_ranks(placed)
    begun_before = F.col("_carried") & (_value() == F.col("_first"))
    rank = F.when(begun_before, F.col("_carried_rank")).otherwise(F.col("_before") + F.col("_within"))
    # Structs are equal where their fields are both null, and rows grouped by one are already where
    # the join wants them.
    found = (
        placed.join(F.broadcast(ranges), ["_measure", "_range"])
        .groupBy(F.struct(*key).alias("_key"))
        .agg(*[F.max(F.when(F.col("_measure") == i, rank)).alias(name) for i, name in enumerate(ranks)])
    )
    return rows.join(found, F.struct(*[rows[c] for c in key]) == found["_key"]).drop("_key")


def _measures(rows: DataFrame, measures: Sequence[str], key: Sequence[str]) -> DataFrame:
    """One row per row and measure. A measure is whole or broken; the other number is zero, and
    both are where it is null."""
    kinds = dict(rows.dtypes)
    whole = {m: kinds[m] in ("tinyint", "smallint", "int", "bigint") for m in measures}
    values = [
        F.struct(
            F.lit(i).alias("_measure"),
            F.col(m).isNotNull().alias("_known"),
            F.coalesce(F.col(m) if whole[m] else F.lit(None), F.lit(0)).cast("bigint").alias("_whole"),
            F.coalesce(F.lit(None) if whole[m] else F.col(m), F.lit(0)).cast("double").alias("_broken"),
        )
        for i, m in enumerate(measures)
    ]
    return rows.select(*key, F.inline(F.array(*values)))


def _value() -> Column:
    """A measure as it is ordered, largest first."""
    return F.struct("_known", "_whole", "_broken")


def _ranked_in_ranges(measures: DataFrame, key: Sequence[str]) -> DataFrame:
    """``measures`` with ``_range``, in the order of the ranges, and ``_within``, the rank among the
    rows of the measure in the range."""
    order = [F.col(c).desc() for c in ("_known", "_whole", "_broken")]
    ranged = measures.repartitionByRange("_measure", *order, *key).withColumn("_range", F.spark_partition_id())
    within = Window.partitionBy("_range", "_measure").orderBy(*order)
    return ranged.withColumn("_within", F.rank().over(within).cast("bigint"))


def _ranges_of_ranks(placed: DataFrame) -> DataFrame:
    """Per measure and range: the rows before, the first value, and where the ranges before end
    with that value (``_carried``), its rank. At most one row per measure and range."""
    ranges = placed.groupBy("_measure", "_range").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(_value()).alias("_first"),
        F.min(_value()).alias("_last"), F.max("_within").alias("_last_within"),
    )
    in_order = Window.partitionBy("_measure").orderBy("_range")
    above = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    begins = ~(F.col("_carried") & (F.col("_first") == F.col("_last")))
    last_rank = F.last(F.when(begins, F.col("_before") + F.col("_last_within")), ignorenulls=True)
    return (
        ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(above), F.lit(0)))
        .withColumn("_carried", F.coalesce(F.lag("_last").over(in_order) == F.col("_first"), F.lit(False)))
        .withColumn("_last_rank", last_rank.over(so_far))
        .withColumn("_carried_rank", F.lag("_last_rank").over(in_order))
        .select("_measure", "_range", "_before", "_first", "_carried", "_carried_rank")
    )
def _in_ranges(rows: DataFrame, order: Sequence[Column], weight: Column) -> DataFrame:
    """``rows`` with ``_range``, in the order of the ranges, and ``_before``, the weight of all
    ranges before. The driver gets one number per range."""
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    placed = stage(ranged)
    weights = placed.groupBy("_range").agg(F.sum(weight).alias("n")).orderBy("_range").collect()
    before = accumulate((row["n"] for row in weights), initial=0)
    offsets = rows.sparkSession.createDataFrame(
        [(row["_range"], n) for row, n in zip(weights, before)], "_range int, _before bigint"
    )
    return placed.join(F.broadcast(offsets), "_range")
