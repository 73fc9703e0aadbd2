"""The jobs for ``spark-submit``.

    spark-submit jobs.py land  --root R --csv FILE [FILE ...]
    spark-submit jobs.py land  --root R --jdbc URL --table T --properties FILE
                               [--split-column id --parts 64]
    spark-submit jobs.py star  --root R [--staging PATH] [--jdbc URL --properties FILE]
    spark-submit jobs.py marts --root R [--star-jdbc URL --star-properties FILE]
                               [--jdbc URL --properties FILE] [--catalog DATABASE]
                               [--reject-nulls]

``land`` stores the staging rows, ``star`` builds dimensions and fact, ``marts`` the
report marts. ``--staging`` names a Parquet table to use as it is, without landing, ``--star-jdbc`` a database that holds the star tables. With
``--jdbc``, ``star`` and ``marts`` also copy their tables into that database. The
properties file is JSON: driver, user, password, timeouts.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import SparkSession

from tallyhouse import warehouse
from tallyhouse.operators import released
from tallyhouse.schema import STAGING
from tallyhouse.sources import key_split, read_csv_staging, read_jdbc


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["land", "star", "marts"])
    parser.add_argument("--root", required=True, help="folder of the warehouse tables")
    parser.add_argument("--csv", nargs="+", help="staging files with a header line")
    parser.add_argument("--multi-line", action="store_true",
                        help="texts may hold quoted line breaks: quotes are counted first")
    parser.add_argument("--staging", help="Parquet table with the staging columns")
    parser.add_argument("--jdbc", help="database URL")
    parser.add_argument("--table", help="staging table in the database")
    parser.add_argument("--properties", type=Path, help="JSON file of connection properties")
    parser.add_argument("--star-jdbc", help="URL of a database to read the star tables from")
    parser.add_argument("--star-properties", type=Path, help="JSON file for --star-jdbc")
    parser.add_argument("--split-column", help="integer column to read by in parts")
    parser.add_argument("--parts", type=int, default=16)
    parser.add_argument("--connections", type=int, default=8,
                        help="connections to a database that are open at once while tables are copied")
    parser.add_argument("--unsplit", action="store_true", help="read over one connection")
    parser.add_argument("--catalog", help="database of the catalog to copy the marts into")
    parser.add_argument("--reject-nulls", action="store_true",
                        help="fail where a mart's column would be null, in place of a default")
    parser.add_argument("--null-safe", action="store_true", help="let null business keys match")
    args = parser.parse_args()
    if args.job == "land" and not (args.csv or args.jdbc):
        parser.error("land needs --csv or --jdbc")
    if args.job == "land" and args.jdbc and not (args.split_column or args.unsplit):
        parser.error("land --jdbc needs --split-column, or --unsplit for a small table")
    return args


def connection(path: Path | None) -> dict:
    return json.loads(path.read_text()) if path else {}


def staging(spark: SparkSession, args: argparse.Namespace, properties: dict):
    if args.csv:
        return read_csv_staging(spark, args.csv, multi_line=args.multi_line)
    split = args.split_column and key_split(
        spark, args.jdbc, args.table, args.split_column, args.parts, properties
    )
    return read_jdbc(spark, args.jdbc, args.table, properties, split=split or None)


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    args = arguments()
    properties = connection(args.properties)
    spark = SparkSession.builder.appName(f"tallyhouse {args.job}").getOrCreate()
    with released(spark):
        run(spark, args, properties)
    spark.stop()


def run(spark: SparkSession, args: argparse.Namespace, properties: dict) -> None:
    if args.job == "land":
        rows = warehouse.land_staging(staging(spark, args, properties), args.root)
        logging.info("staging: %d rows written", rows)
    elif args.job == "star":
        stored = spark.read.schema(STAGING).parquet(args.staging) if args.staging else None
        warehouse.build_star(spark, args.root, args.null_safe, staging=stored)
        if args.jdbc:
            warehouse.publish_star(spark, args.root, args.jdbc, properties, args.connections)
    else:
        star = args.star_jdbc and warehouse.star_from_jdbc(
            spark, args.star_jdbc, connection(args.star_properties), args.parts
        )
        nulls = "reject" if args.reject_nulls else "fill"
        warehouse.build_marts(spark, args.root, star=star or None, nulls=nulls)
        if args.catalog:
            warehouse.publish_catalog(spark, args.root, args.catalog)
        if args.jdbc:
            warehouse.publish_marts(spark, args.root, args.jdbc, properties, args.connections)


if __name__ == "__main__":
    main()
