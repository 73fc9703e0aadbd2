"""Names and columns that do not clash with those of the caller's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fresh(taken: DataFrame | list[str], name: str) -> str:
    """``name``, with underscores appended until no column is called so."""
    names = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    while name.lower() in names:
        name += "_"
    return name


def column(name: str) -> Column:
    """The column of exactly that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, text`` and nothing else; a null text stays null."""
    return docs.select(
        column(id_column).cast("bigint").alias("doc_id"),
        column(text_column).cast("string").alias("text"),
    )
