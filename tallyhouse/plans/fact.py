"""The sales fact: one row per staging row, with dimension keys and measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions import convert, date_key, parse_date
from tallyhouse.plans.dimensions import CUSTOMER, PRODUCT, SELLER, STORE, SUPPLIER, Dimension
from tallyhouse.schema import STAR

# Store and supplier are found by three texts each. They are looked up first, so
# that only their 8-byte keys travel through the shuffles of the large dimensions.
LOOKUPS = (STORE, SUPPLIER, SELLER, PRODUCT, CUSTOMER)

MEASURES = {
    "sale_quantity": "sale_quantity",
    "sale_total_price": "sale_total_price",
    "unit_price": "product_price",
}


def fact_sales(
    staging: DataFrame, dimensions: Mapping[str, DataFrame], null_safe: bool = False
) -> DataFrame:
    """Sales with the keys of the given dimensions (all six tables of the star: the
    full fact; fewer: a fact with fewer key columns).

    Every dimension is joined on its full business key, which is unique there, so no
    sale is multiplied; a left join keeps sales without a member. A null business key
    matches nothing unless ``null_safe`` is set. The date key follows from the date
    itself and needs no join.

    No broadcast is forced: Spark broadcasts a key table whose measured size is under
    its threshold and otherwise shuffles both sides, where adaptive execution splits
    the partition of a key that holds much of the sales.
    """
    sales = staging
    for dimension in LOOKUPS:
        if dimension.table in dimensions:
            sales = _look_up(sales, dimension, dimensions[dimension.table], null_safe)
    available = set(sales.columns)
    measures = {name: source for name, source in MEASURES.items() if source in available}
    types = {f.name: f.dataType for f in STAR["fact_sales"]}
    sales = sales.select(
        *[F.col(d.fact_key) for d in LOOKUPS if d.table in dimensions],
        *([date_key(parse_date("sale_date")).alias("date_key")] if "sale_date" in available else []),
        *[convert(F.col(source), types[name]).alias(name) for name, source in measures.items()],
    )
    return sales.select(*[c for c in STAR["fact_sales"].names if c in sales.columns])


def _look_up(
    sales: DataFrame, dimension: Dimension, table: DataFrame, null_safe: bool
) -> DataFrame:
    prefix = f"{dimension.table}_"
    keys = table.select(
        F.col(dimension.surrogate).alias(dimension.fact_key),
        *[F.col(key).alias(prefix + key) for key in dimension.keys],
    )
    matched = F.lit(True)
    for key in dimension.keys:
        ours, theirs = F.col(dimension.sources[key]), F.col(prefix + key)
        matched &= ours.eqNullSafe(theirs) if null_safe else ours == theirs
    return sales.join(keys, matched, "left").drop(*[prefix + key for key in dimension.keys])
