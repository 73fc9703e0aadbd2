"""Writing tables. Every function returns the number of rows, counted by the write.

``overwrite_*`` replaces a table with its definition; ``reload_*`` replaces the rows
and keeps the definition. Both can be repeated: the result is the last write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.schema import MARTS
from tallyhouse.sinks.counted import write_counted


def sorted_by(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in ranges of ``columns``, each sorted, so that the statistics of a file
    let readers skip it. Adaptive execution sets the number of files by size."""
    if not columns:
        return rows
    return rows.repartitionByRange(*columns).sortWithinPartitions(*columns)


def overwrite_parquet(rows: DataFrame, path: str, sort_by: Sequence[str] = ()) -> int:
    return write_counted(
        sorted_by(rows, sort_by), lambda r: r.write.mode("overwrite").parquet(path)
    )


def overwrite_catalog_table(rows: DataFrame, table: str, sort_by: Sequence[str] = ()) -> int:
    return write_counted(
        sorted_by(rows, sort_by), lambda r: r.write.mode("overwrite").saveAsTable(table)
    )


def create_mart_tables(spark: SparkSession, database: str) -> None:
    """The six empty mart tables, where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for mart in MARTS.values():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()} NOT NULL" for f in mart.columns)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{mart.name} ({columns}) USING parquet "
            f"TBLPROPERTIES ('sort_key' = '{', '.join(mart.sort_by)}')"
        )


def reload_catalog_table(rows: DataFrame, table: str, sort_by: Sequence[str] = ()) -> int:
    columns = rows.sparkSession.table(table).columns
    return write_counted(
        sorted_by(rows.select(*columns), sort_by),
        lambda r: r.write.insertInto(table, overwrite=True),
    )
