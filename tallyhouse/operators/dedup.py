"""One row per key, the same row whatever the partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def variants(rows: DataFrame) -> DataFrame:
    """The distinct rows, with the number of ``copies`` of each.

    Equal rows collapse by hash before the shuffle: a key that holds a third of the
    input leaves each task as one row per variant, and its variants are spread over
    the tasks by all columns.
    """
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def one_row_per_key(
    rows: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]
) -> DataFrame:
    """``columns`` computed from ``rows``, one row per key: the one whose other columns
    sort first, nulls before values.

    The columns are computed per variant, not per row. ``copies`` keeps the optimizer
    from folding both steps into one, which would have to sort every input row: a
    minimum of a struct is aggregated by sorting, and here it only meets variants.
    """
    others = [name for name in columns if name not in keys]
    found = variants(rows).select(*[c.alias(name) for name, c in columns.items()], "copies")
    kept = found.groupBy(*keys).agg(
        F.min(F.struct(*others)).alias("kept"), F.sum("copies").alias("copies")
    )
    return kept.filter("copies > 0").select(*keys, "kept.*")
