"""The two jobs: staging rows to star tables, star tables to marts.

Every table is written before the next step reads it. That hands the planner real
table sizes, keeps lineages short and lets a lost executor cost one task; nothing is
cached, because Parquet reads just the columns a step needs.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.connections import Connections
from tallyhouse.operators import released, stage, together
from tallyhouse.plans import audit, dimensions, marts
from tallyhouse.plans.fact import fact_sales
from tallyhouse.schema import MARTS, STAGING, STAR, shaped
from tallyhouse.sinks import (
    create_mart_tables, overwrite_jdbc, overwrite_parquet, reload_catalog_table, reload_jdbc,
)
from tallyhouse.sources import key_split, read_jdbc, read_layout, read_table
from tallyhouse.versions import new_version

log = logging.getLogger(__name__)


def _write_all(writers: Mapping[str, Callable[[], int]]) -> dict[str, int]:
    """Independent writes, submitted together."""

    def logged(name: str) -> int:
        rows = writers[name]()
        log.info("%s: %d rows written", name, rows)
        return rows

    return together({name: lambda name=name: logged(name) for name in writers})


def land_staging(staging: DataFrame, root: str) -> int:
    """Store staging rows (from CSV or a database) as a table. Every column of every
    row is read here, so a malformed value fails here."""
    return overwrite_parquet(shaped(staging, STAGING), f"{root}/staging")


def build_star(
    spark: SparkSession,
    root: str,
    null_safe: bool = False,
    staging: DataFrame | None = None,
) -> dict[str, int]:
    """Job 1: staging rows to six dimensions and the fact, written under ``root``, where they
    replace the star in use together, once all are written and checked.

    Reads the staging table under ``root``, or ``staging``: a stored table with the
    staging columns that need not be copied first. It is scanned once per dimension,
    each time for that dimension's columns only, and once for the fact.
    """
    if staging is None:
        staging = read_table(spark, root, "staging")
    with released(spark), new_version(spark, root, "star") as folder:

        def write_dimension(dimension):
            rows = dimensions.build(staging, dimension)
            return overwrite_parquet(rows, f"{folder}/{dimension.table}")

        counts = _write_all({
            "dim_date": lambda: overwrite_parquet(
                dimensions.dim_date(staging), f"{folder}/dim_date", ("full_date",)
            ),
            **{
                name: lambda d=dimension: write_dimension(d)
                for name, dimension in dimensions.DIMENSIONS.items()
            },
        })
        keys = {name: read_layout(spark, f"{folder}/{name}", name) for name in dimensions.DIMENSIONS}
        fact = fact_sales(staging, keys, null_safe)
        counts |= _write_all({"fact_sales": lambda: overwrite_parquet(fact, f"{folder}/fact_sales")})
        _check_star(keys, counts, staging.count())
    return counts


def _check_star(keys: Mapping[str, DataFrame], counts: Mapping[str, int], staged: int) -> None:
    """What must hold before a star is put to use. With unique keys in the dimensions and one
    fact row per staging row, every key of the fact is one of its dimension's."""
    if counts["fact_sales"] != staged:
        raise RuntimeError(f"{staged} staging rows gave {counts['fact_sales']} sales")
    for name, dimension in dimensions.DIMENSIONS.items():
        if not audit.repeated_keys(keys[name], [dimension.surrogate]).isEmpty():
            raise RuntimeError(f"{name} has a repeated {dimension.surrogate}")


def star_from_jdbc(
    spark: SparkSession, url: str, properties: Mapping[str, str], parts: int = 16, connections: int = 32
) -> dict[str, DataFrame]:
    """The star tables of a database, each read once and staged for the marts.

    Each table is read in up to ``parts`` ranges, of equally many rows, of a key an index can
    serve: the fact and the dates by date, the other dimensions by their dense surrogate
    key. All tables together open at most ``connections`` connections.
    """
    keys = {name: d.surrogate for name, d in dimensions.DIMENSIONS.items()}
    limit = Connections(connections)

    def fetch(name: str) -> DataFrame:
        key = keys.get(name, "date_key")
        with limit.take(parts) as granted:
            split = key_split(spark, url, name, key, granted, properties)
            return stage(shaped(read_jdbc(spark, url, name, properties, split=split), STAR[name]))

    return together({name: lambda name=name: fetch(name) for name in STAR})


def build_marts(
    spark: SparkSession,
    root: str,
    star: Mapping[str, DataFrame] | None = None,
    nulls: str = "fill",
) -> dict[str, int]:
    """Job 2: star tables to the six marts, written under ``root``, where they replace the
    marts in use together. ``nulls="reject"`` fails where a mart's column would be null, in
    place of putting in a default.

    Reads the star under ``root``, or ``star``: the seven tables from elsewhere. The
    fact is scanned once per mart, for one key and its measures.
    """
    if star is None:
        star = {name: read_table(spark, root, name) for name in STAR}
    with released(spark), new_version(spark, root, "marts") as folder:
        fact = star["fact_sales"]
        products = stage(marts.product_totals(fact, star["dim_product"]))
        builders = {
            "mart_product_sales": lambda: marts.ranked_product_sales(products, nulls),
            "mart_product_quality": lambda: marts.ranked_product_quality(products, nulls),
            "mart_customer_sales": lambda: marts.mart_customer_sales(fact, star["dim_customer"], nulls),
            "mart_time_sales": lambda: marts.mart_time_sales(fact, star["dim_date"], nulls),
            "mart_store_sales": lambda: marts.mart_store_sales(fact, star["dim_store"], nulls),
            "mart_supplier_sales": lambda: marts.mart_supplier_sales(fact, star["dim_supplier"], nulls),
        }
        return _write_all({
            name: lambda name=name, build=build: overwrite_parquet(
                build(), f"{folder}/{name}", MARTS[name].sort_by
            )
            for name, build in builders.items()
        })


def run(
    staging: DataFrame, root: str, null_safe: bool = False
) -> dict[str, int]:
    """Land the staging rows, build the star, build the marts. Rerunning replaces all
    tables. Returns the rows written per table."""
    spark = staging.sparkSession
    counts = {"staging": land_staging(staging, root)}
    counts |= build_star(spark, root, null_safe)
    counts |= build_marts(spark, root)
    return counts


def open_views(spark: SparkSession, root: str) -> None:
    """Make the star and mart tables known to ``spark.sql`` under their names."""
    for name in (*STAR, *MARTS):
        read_table(spark, root, name).createOrReplaceTempView(name)


def publish_catalog(spark: SparkSession, root: str, database: str) -> dict[str, int]:
    """Copy the marts into tables of the session's catalog, which are made by their contracts where
    they do not exist: columns that must not be null, rows in the order of the sort key."""
    create_mart_tables(spark, database)
    return _write_all({
        name: lambda name=name: reload_catalog_table(
            read_table(spark, root, name), f"{database}.{name}", MARTS[name].sort_by
        )
        for name in MARTS
    })


def publish_star(
    spark: SparkSession, root: str, url: str, properties: Mapping[str, str], connections: int = 8
) -> dict[str, int]:
    """Copy the star tables into a database, replacing the tables there, over at most
    ``connections`` connections in all."""
    return _publish(spark, root, url, properties, connections, STAR, overwrite_jdbc)


def publish_marts(
    spark: SparkSession, root: str, url: str, properties: Mapping[str, str], connections: int = 8
) -> dict[str, int]:
    """Copy the marts into a database whose mart tables exist: their rows are replaced,
    their definitions kept. At most ``connections`` connections are open in all."""
    return _publish(spark, root, url, properties, connections, MARTS, reload_jdbc)


def _publish(spark, root, url, properties, connections, tables, write) -> dict[str, int]:
    limit = Connections(connections)

    def copy(name: str) -> int:
        with limit.take(connections) as granted:
            rows = read_table(spark, root, name)
            return write(rows, url, name, properties, connections=granted, stored=True)

    return _write_all({name: lambda name=name: copy(name) for name in tables})
