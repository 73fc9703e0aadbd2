"""Writes that count their rows as they go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from tallyhouse.operators.scratch import shuffles_removed


def write_counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    counted = Observation()
    with shuffles_removed(rows.sparkSession):
        write(rows.observe(counted, F.count(F.lit(1)).alias("rows")))
    return counted.get["rows"]
