"""The most frequent keys of a table of counts, without sorting it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F


def most_frequent(counts: DataFrame, most: int, n: str = "n") -> DataFrame:
    """Rows of ``counts`` whose ``n`` is at least a threshold, the lowest that leaves no more
    than ``most`` rows. ``counts`` is a written table with a row per key. The driver gets a row
    per different count, of which a corpus of N tokens has less than sqrt(2 N)."""
    histogram = counts.groupBy(n).count().orderBy(F.desc(n)).collect()
    upto = accumulate(row["count"] for row in histogram)
    fitting = [row[n] for row, total in zip(histogram, upto) if total <= most]
    least = min(fitting, default=None)
    return counts.filter(F.lit(False) if least is None else F.col(n) >= least)
