"""Names and typed reading of staging text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DateType

from tallyhouse.functions.dates import parse_date


def convert(column: Column, wanted: DataType) -> Column:
    """A staging value in the wanted type; null where it does not fit."""
    if isinstance(wanted, DateType):
        return parse_date(column)
    return column.try_cast(wanted)


def full_name(*parts: str) -> Column:
    """The parts joined by a space; nulls are skipped, so no part gives ``''``."""
    return F.concat_ws(" ", *parts)
