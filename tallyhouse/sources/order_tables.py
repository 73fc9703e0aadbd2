"""Staging rows derived from normalised order tables (region, nation, customer,
supplier, part, orders, lineitem): one row per order line.

The expressions read the same in Spark SQL and in other SQL dialects.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.schema import STAGING

# alias -> (table, alias it hangs on, join condition). A child row is kept without a parent row, so a
# parent whose columns nobody reads can be left out.
PARENTS = {
    "o": ("orders", "l", "l_orderkey = o_orderkey"),
    "c": ("customer", "o", "o_custkey = c_custkey"),
    "cn": ("nation", "c", "c_nationkey = cn.n_nationkey"),
    "cr": ("region", "cn", "cn.n_regionkey = cr.r_regionkey"),
    "s": ("supplier", "l", "l_suppkey = s_suppkey"),
    "sn": ("nation", "s", "s_nationkey = sn.n_nationkey"),
    "sr": ("region", "sn", "sn.n_regionkey = sr.r_regionkey"),
    "p": ("part", "l", "l_partkey = p_partkey"),
}


def _slashed(day: str) -> str:
    return (
        f"concat(CAST(month({day}) AS STRING), '/', CAST(day({day}) AS STRING), '/', "
        f"CAST(year({day}) AS STRING))"
    )


def _part_date(first_year: int, years: int) -> str:
    return _slashed(
        f"make_date(CAST({first_year} + p_partkey % {years} AS INT), "
        "CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))"
    )


# Staging column -> (aliases it reads besides l, expression).
COLUMNS = {
    "id": ("", "l_orderkey * 10 + l_linenumber"),
    "customer_first_name": ("", "'Customer'"),
    "customer_last_name": ("c", "substr(c_name, 10)"),
    "customer_age": ("c", "CAST(18 + c_custkey % 60 AS INT)"),
    "customer_email": ("c", "concat('c', CAST(c_custkey AS STRING), '@example.com')"),
    "customer_country": ("cn", "CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE cn.n_name END"),
    "customer_postal_code": ("c", "lpad(CAST(c_custkey AS STRING), 6, '0')"),
    "customer_pet_type": ("c", "c_mktsegment"),
    "customer_pet_name": ("c", "concat('Pet', CAST(c_custkey % 97 AS STRING))"),
    "customer_pet_breed": ("c", "concat('Breed', CAST(c_custkey % 13 AS STRING))"),
    "seller_first_name": ("", "'Seller'"),
    "seller_last_name": ("o", "CAST(o_custkey % 50 AS STRING)"),
    "seller_email": ("o", "concat('s', CAST(o_custkey % 50 AS STRING), '@example.com')"),
    "seller_country": ("o", "concat('NATION_', CAST(o_custkey % 25 AS STRING))"),
    "seller_postal_code": ("o", "lpad(CAST(o_custkey % 50 AS STRING), 5, '0')"),
    "product_name": ("p", "p_name"),
    "product_category": ("p", "p_type"),
    "product_price": ("p", "CAST(p_retailprice AS DECIMAL(10,2))"),
    "product_quantity": ("p", "p_size"),
    "sale_date": (
        "o", f"CASE WHEN l_orderkey % 500 = 0 THEN 'n/a' ELSE {_slashed('o_orderdate')} END"
    ),
    "sale_customer_id": ("o", "o_custkey"),
    "sale_seller_id": ("o", "o_custkey % 50"),
    "sale_product_id": ("", "l_partkey"),
    "sale_quantity": ("", "CAST(l_quantity AS INT)"),
    "sale_total_price": ("", "CAST(l_extendedprice AS DECIMAL(10,2))"),
    "store_name": ("o", "concat('Store ', o_orderpriority)"),
    "store_location": ("o", "concat('Block ', substr(o_orderpriority, 1, 1))"),
    "store_city": ("cn", "cn.n_name"),
    "store_state": ("", "CAST(NULL AS STRING)"),
    "store_country": ("cr", "cr.r_name"),
    "store_phone": (
        "o cn", "concat('555-', CAST(cn.n_nationkey AS STRING), substr(o_orderpriority, 1, 1))"
    ),
    "store_email": (
        "o cn",
        "concat('store', CAST(cn.n_nationkey AS STRING), substr(o_orderpriority, 1, 1), "
        "'@example.com')",
    ),
    "pet_category": ("p", "p_type"),
    "product_weight": ("p", "CAST(p_size / 10.0 AS DECIMAL(10,2))"),
    "product_color": ("p", "split_part(p_name, ' ', 1)"),
    "product_size": ("p", "CASE WHEN p_size < 17 THEN 'S' WHEN p_size < 34 THEN 'M' ELSE 'L' END"),
    "product_brand": ("p", "p_brand"),
    "product_material": ("p", "split_part(p_name, ' ', 2)"),
    "product_description": ("p", "concat(p_name, ', ', p_type, ' ', p_brand)"),
    "product_rating": (
        "p",
        "CASE WHEN p_partkey % 50 = 0 THEN NULL "
        "ELSE CAST((10 + p_size % 41) / 10.0 AS DECIMAL(3,1)) END",
    ),
    "product_reviews": (
        "p",
        "CASE WHEN p_partkey % 70 = 0 THEN NULL ELSE CAST(p_partkey * 37 % 1000 AS INT) END",
    ),
    "product_release_date": ("p", _part_date(2010, 10)),
    "product_expiry_date": ("p", _part_date(2022, 8)),
    "supplier_name": ("s", "s_name"),
    "supplier_contact": ("s", "concat('Contact ', CAST(s_suppkey AS STRING))"),
    "supplier_email": ("s", "concat('sup', CAST(s_suppkey AS STRING), '@example.com')"),
    "supplier_phone": ("s", "concat('777-', CAST(s_suppkey AS STRING))"),
    "supplier_address": ("s", "concat(CAST(s_suppkey AS STRING), ' Main St')"),
    "supplier_city": ("sn", "sn.n_name"),
    "supplier_country": ("sr", "sr.r_name"),
}


# What the expressions above read of the order lines and their orders.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "o_custkey", "o_orderdate", "o_orderpriority",
)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with what staging rows need of their orders: the one join of two large tables.
    Written once, it feeds ``staging_from_orders`` for any number of tables."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return _join(lines, _parent(spark, folder, "o"), "o").select(*LINE_COLUMNS)


def _parent(spark: SparkSession, folder: str, alias: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{PARENTS[alias][0]}.parquet").alias(alias)


def _join(rows: DataFrame, parent: DataFrame, alias: str) -> DataFrame:
    return rows.join(parent, F.expr(PARENTS[alias][2]), "left")


def staging_from_orders(
    spark: SparkSession,
    folder: str,
    columns: Iterable[str] | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """All staging columns, or the given ones, with just the joins these need. There is a row
    for each order line; what comes from a missing parent is null. ``lines`` are order lines
    that are joined with their orders already.

    The lines are the largest table, so they pass as few shuffles as can be, and narrow. Orders
    meet their customers first, as there are fewer orders than lines. Lines meet the parts
    before the orders, and what is computed from parts is computed after, so that plain columns of
    parts go through one shuffle. Where orders are not joined, parts are the last large
    table, and their columns are computed once per part. Suppliers, nations and regions are
    small: their texts are looked up when the large tables are joined.
    """
    wanted = [name for name in COLUMNS if columns is None or name in set(columns)]
    joined: set[str] = set()

    def need(alias: str) -> None:
        if alias in PARENTS and alias not in joined:
            need(PARENTS[alias][1])
            joined.add(alias)

    for name in wanted:
        for alias in COLUMNS[name][0].split():
            need(alias)

    computed = {
        name: F.expr(COLUMNS[name][1]).cast(STAGING[name].dataType).alias(name) for name in wanted
    }
    of_part = [name for name in wanted if COLUMNS[name][0] == "p"]
    if lines is None:
        rows = spark.read.parquet(f"{folder}/lineitem.parquet").alias("l")
    else:
        rows = lines.alias("l")
        joined.discard("o")
    parents = {alias: _parent(spark, folder, alias) for alias in joined}
    if "o" in joined:
        # A part without a row has no values, also none of expressions that give one for nulls.
        known = F.col("p_partkey").isNotNull()
        computed |= {name: F.when(known, computed[name]).alias(name) for name in of_part}
        order = ("p", "o", "s")
        if "c" in joined:
            parents["o"] = _join(parents["o"], parents["c"], "c")
    else:
        order = ("s", "c", "p")
        if "p" in joined:
            parents["p"] = parents["p"].select("p_partkey", *[computed[name] for name in of_part])
        computed |= {name: F.col(name) for name in of_part}
    for alias in (*order, "cn", "cr", "sn", "sr"):
        if alias in joined:
            rows = _join(rows, parents[alias], alias)
    return rows.select(*[computed[name] for name in wanted])
