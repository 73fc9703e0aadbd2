"""Table layouts: the flat staging rows, the star tables and the mart contracts.

Identifiers and surrogate keys are ``bigint``: a 32-bit key ends at 2.1 billion
members, which a large customer or product table can pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "date": DateType(),
    "decimal(10,2)": DecimalType(10, 2),
    "decimal(3,1)": DecimalType(3, 1),
}


def _layout(columns: str) -> StructType:
    """``name type`` pairs as a schema; needs no running session."""
    words = columns.split()
    return StructType([
        StructField(name, _TYPES[kind.rstrip(",")]) for name, kind in zip(words[::2], words[1::2])
    ])


# The 50 staging columns in file order.
STAGING = _layout("""
    id bigint,
    customer_first_name string, customer_last_name string, customer_age int,
    customer_email string, customer_country string, customer_postal_code string,
    customer_pet_type string, customer_pet_name string, customer_pet_breed string,
    seller_first_name string, seller_last_name string, seller_email string,
    seller_country string, seller_postal_code string,
    product_name string, product_category string, product_price decimal(10,2),
    product_quantity int,
    sale_date string, sale_customer_id bigint, sale_seller_id bigint,
    sale_product_id bigint, sale_quantity int, sale_total_price decimal(10,2),
    store_name string, store_location string, store_city string, store_state string,
    store_country string, store_phone string, store_email string,
    pet_category string, product_weight decimal(10,2), product_color string,
    product_size string, product_brand string, product_material string,
    product_description string, product_rating decimal(3,1), product_reviews int,
    product_release_date string, product_expiry_date string,
    supplier_name string, supplier_contact string, supplier_email string,
    supplier_phone string, supplier_address string, supplier_city string,
    supplier_country string
""")

# Longest allowed text per staging column (product_description has none).
TEXT_LIMITS = {
    "customer_first_name": 100,
    "customer_last_name": 100,
    "customer_email": 200,
    "customer_country": 100,
    "customer_postal_code": 20,
    "customer_pet_type": 50,
    "customer_pet_name": 100,
    "customer_pet_breed": 100,
    "seller_first_name": 100,
    "seller_last_name": 100,
    "seller_email": 200,
    "seller_country": 100,
    "seller_postal_code": 20,
    "product_name": 200,
    "product_category": 100,
    "sale_date": 20,
    "store_name": 200,
    "store_location": 200,
    "store_city": 100,
    "store_state": 100,
    "store_country": 100,
    "store_phone": 50,
    "store_email": 200,
    "pet_category": 50,
    "product_color": 50,
    "product_size": 50,
    "product_brand": 100,
    "product_material": 100,
    "product_release_date": 20,
    "product_expiry_date": 20,
    "supplier_name": 200,
    "supplier_contact": 200,
    "supplier_email": 200,
    "supplier_phone": 50,
    "supplier_address": 200,
    "supplier_city": 100,
    "supplier_country": 100,
}

# The star tables.
STAR = {
    "dim_date": _layout("""
        full_date date, date_key int, year int, quarter int, month int, day int,
        day_of_week int, month_name string, day_name string
    """),
    "dim_customer": _layout("""
        customer_id bigint, first_name string, last_name string, age int, email string,
        country string, postal_code string, pet_type string, pet_name string,
        pet_breed string, customer_key bigint
    """),
    "dim_seller": _layout("""
        seller_id bigint, first_name string, last_name string, email string,
        country string, postal_code string, seller_key bigint
    """),
    "dim_product": _layout("""
        product_id bigint, name string, category string, price double, weight double,
        color string, size string, brand string, material string, description string,
        rating double, reviews int, release_date date, expiry_date date,
        pet_category string, product_key bigint
    """),
    "dim_store": _layout("""
        store_name string, location string, city string, state string, country string,
        phone string, email string, store_id bigint
    """),
    "dim_supplier": _layout("""
        supplier_name string, contact string, email string, phone string,
        address string, city string, country string, supplier_id bigint
    """),
    "fact_sales": _layout("""
        customer_key bigint, seller_key bigint, product_key bigint, store_key bigint,
        supplier_key bigint, date_key int, sale_quantity int, sale_total_price double,
        unit_price double
    """),
}


@dataclass(frozen=True)
class Contract:
    """A mart table: columns in order, none of them nullable, and its sort key."""

    name: str
    columns: StructType
    sort_by: tuple[str, ...]


def _mart(name: str, ddl: str, *sort_by: str) -> Contract:
    return Contract(name, _layout(ddl), sort_by)


# The mart tables.
MARTS = {
    mart.name: mart
    for mart in (
        _mart("mart_product_sales", """
            product_id bigint, product_name string, category string,
            total_quantity bigint, total_revenue double, avg_rating double,
            review_count bigint, quantity_rank bigint, revenue_rank bigint
        """, "product_id"),
        _mart("mart_customer_sales", """
            customer_id bigint, customer_name string, country string,
            total_purchases double, order_count bigint, avg_check double,
            purchase_rank bigint
        """, "customer_id"),
        _mart("mart_time_sales", """
            year int, month int, month_name string, total_revenue double,
            order_count bigint, avg_order_size double
        """, "year", "month"),
        _mart("mart_store_sales", """
            store_id bigint, store_name string, city string, country string,
            total_revenue double, order_count bigint, avg_check double,
            revenue_rank bigint
        """, "store_id"),
        _mart("mart_supplier_sales", """
            supplier_id bigint, supplier_name string, country string,
            total_revenue double, avg_product_price double, order_count bigint,
            revenue_rank bigint
        """, "supplier_id"),
        _mart("mart_product_quality", """
            product_id bigint, product_name string, category string,
            avg_rating double, total_reviews bigint, total_sales_quantity bigint,
            total_revenue double, rating_rank bigint, review_rank bigint, sales_rank bigint
        """, "product_id"),
    )
}

# What a missing value becomes in a column that must not be null.
FILL = {StringType(): "Unknown", DoubleType(): 0.0, LongType(): 0, IntegerType(): 0}


def shaped(rows: DataFrame, layout: StructType) -> DataFrame:
    """The columns of ``layout``, in its order and types."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])


def filled(rows: DataFrame) -> DataFrame:
    """Nulls (and NaN) replaced by the default of the column's type."""
    return rows.fillna(
        {f.name: FILL[f.dataType] for f in rows.schema if f.dataType in FILL}
    )


def conform(rows: DataFrame, contract: Contract, nulls: str = "fill") -> DataFrame:
    """``rows`` as the contract wants them.

    ``nulls="fill"`` puts in defaults. ``nulls="reject"`` fails the job that meets
    a null; the check is part of that job, not a scan of its own.
    """
    rows = shaped(rows, contract.columns)
    if nulls == "fill":
        return filled(rows)
    if nulls != "reject":
        raise ValueError(f"nulls must be 'fill' or 'reject', not {nulls!r}")
    return rows.select(*[
        F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"{contract.name}.{f.name} is null")))
        .otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in contract.columns
    ])
