"""Tables read from a database, by several connections at once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """An integer column cut into ranges, one per part; every part but the first begins at a cut.
    Every row meets exactly one of the conditions, those below all cuts and nulls the first."""

    column: str
    cuts: tuple[int, ...]

    @property
    def parts(self) -> int:
        return len(self.cuts) + 1

    @property
    def predicates(self) -> list[str]:
        if not self.cuts:
            return ["1 = 1"]
        first, last = self.cuts[0], self.cuts[-1]
        return [
            f"({self.column} < {first} OR {self.column} IS NULL)",
            *(f"({self.column} >= {a} AND {self.column} < {b})" for a, b in zip(self.cuts, self.cuts[1:])),
            f"{self.column} >= {last}",
        ]


def key_split(
    spark: SparkSession, url: str, table: str, column: str, parts: int,
    properties: Mapping[str, str], sample: str | None = None,
) -> Split:
    """A split into ranges of equally many rows, whatever gaps the values have.

    The database is asked for the least value of each of ``parts`` equal tiles, which an index on
    the column serves; ``sample`` names a smaller table, or a subquery with an alias, to take
    them from. Rows with one value cannot be told apart by it: a value that fills tiles of its own
    makes fewer and larger parts, and ``hash_predicates`` on another column deals those out.
    """
    tiles = (
        f"(SELECT MIN({column}) AS cut FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS tile "
        f"FROM {sample or table} WHERE {column} IS NOT NULL) tiles GROUP BY tile) cuts"
    )
    found = spark.read.jdbc(url, tiles, properties=dict(properties)).collect()
    least = sorted({int(row[0]) for row in found})
    return Split(column, tuple(least[1:]))


def hash_predicates(column: str, parts: int) -> list[str]:
    """Conditions that deal rows out by remainder: even also where values lie unevenly.
    Every row meets exactly one of them."""
    remainders = [f"ABS(MOD(({column}), {parts})) = {i}" for i in range(parts)]
    return [f"({remainders[0]} OR ({column}) IS NULL)", *remainders[1:]]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split: Split | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """A table over one connection, or over one per part of ``split`` or per predicate.

    ``properties`` holds driver, user, password, timeouts and the like, and comes from
    the caller's configuration.
    """
    if split and predicates:
        raise ValueError("give a split or predicates, not both")
    conditions = split.predicates if split else predicates
    if conditions:
        return spark.read.jdbc(url, table, predicates=conditions, properties=dict(properties))
    return spark.read.jdbc(url, table, properties=dict(properties))
