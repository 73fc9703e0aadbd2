"""The six dimensions, each built from the flat staging rows.

A dimension names its business key and where its columns come from; the layout in
``schema.STAR`` gives the types. Members are kept by ``one_row_per_key`` and numbered
1..n in the order of the full business key, so the same rows always give the same
keys. A null key is a member too, though no sale joins to it by default.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions import convert, date_parts, parse_date
from tallyhouse.operators import number_rows, one_row_per_key, stage, together, variants
from tallyhouse.schema import STAR, shaped


@dataclass(frozen=True)
class Dimension:
    table: str
    surrogate: str
    fact_key: str
    keys: tuple[str, ...]
    sources: dict[str, str]  # column of the dimension -> column of the staging rows

    @property
    def staging_columns(self) -> list[str]:
        return list(self.sources.values())

    @property
    def staging_keys(self) -> list[str]:
        return [self.sources[key] for key in self.keys]


CUSTOMER = Dimension(
    "dim_customer", "customer_key", "customer_key", ("customer_id",),
    {
        "customer_id": "sale_customer_id",
        "first_name": "customer_first_name",
        "last_name": "customer_last_name",
        "age": "customer_age",
        "email": "customer_email",
        "country": "customer_country",
        "postal_code": "customer_postal_code",
        "pet_type": "customer_pet_type",
        "pet_name": "customer_pet_name",
        "pet_breed": "customer_pet_breed",
    },
)
SELLER = Dimension(
    "dim_seller", "seller_key", "seller_key", ("seller_id",),
    {
        "seller_id": "sale_seller_id",
        "first_name": "seller_first_name",
        "last_name": "seller_last_name",
        "email": "seller_email",
        "country": "seller_country",
        "postal_code": "seller_postal_code",
    },
)
PRODUCT = Dimension(
    "dim_product", "product_key", "product_key", ("product_id",),
    {
        "product_id": "sale_product_id",
        "name": "product_name",
        "category": "product_category",
        "price": "product_price",
        "weight": "product_weight",
        "color": "product_color",
        "size": "product_size",
        "brand": "product_brand",
        "material": "product_material",
        "description": "product_description",
        "rating": "product_rating",
        "reviews": "product_reviews",
        "release_date": "product_release_date",
        "expiry_date": "product_expiry_date",
        "pet_category": "pet_category",
    },
)
STORE = Dimension(
    "dim_store", "store_id", "store_key", ("store_name", "city", "country"),
    {
        "store_name": "store_name",
        "location": "store_location",
        "city": "store_city",
        "state": "store_state",
        "country": "store_country",
        "phone": "store_phone",
        "email": "store_email",
    },
)
SUPPLIER = Dimension(
    "dim_supplier", "supplier_id", "supplier_key", ("supplier_name", "city", "country"),
    {
        "supplier_name": "supplier_name",
        "contact": "supplier_contact",
        "email": "supplier_email",
        "phone": "supplier_phone",
        "address": "supplier_address",
        "city": "supplier_city",
        "country": "supplier_country",
    },
)
DIMENSIONS = {d.table: d for d in (CUSTOMER, SELLER, PRODUCT, STORE, SUPPLIER)}


def members(staging: DataFrame, dimension: Dimension) -> DataFrame:
    """The members of a dimension, one row per business key, not yet numbered."""
    types = {f.name: f.dataType for f in STAR[dimension.table]}
    columns = {
        name: convert(F.col(source), types[name]) for name, source in dimension.sources.items()
    }
    return one_row_per_key(
        staging.select(*dimension.staging_columns), dimension.keys, columns
    )


def build(staging: DataFrame, dimension: Dimension) -> DataFrame:
    """A dimension with its surrogate key.

    The members are staged: dealing them into ranges then samples and reads them, not
    the sales again.
    """
    rows = stage(members(staging, dimension))
    numbered = number_rows(rows, dimension.keys, dimension.surrogate)
    return shaped(numbered, STAR[dimension.table])


def build_all(
    staging: DataFrame | Callable[[Dimension], DataFrame],
    dimensions: Iterable[Dimension] = tuple(DIMENSIONS.values()),
) -> dict[str, DataFrame]:
    """Several numbered dimensions, from one staging table or from what ``staging``
    gives for each."""
    rows_for = staging if callable(staging) else lambda _: staging
    return together({d.table: lambda d=d: build(rows_for(d), d) for d in dimensions})


def dim_date(staging: DataFrame) -> DataFrame:
    """The dates that occur, with their calendar columns. Unreadable dates are left out.

    Texts are collapsed first and parsed once each; the condition on ``copies`` keeps
    the parsing from being pushed below that, to every row.
    """
    texts = variants(staging.select("sale_date"))
    day = F.when(F.col("copies") > 0, parse_date("sale_date"))
    days = texts.select(day.alias("full_date")).distinct().filter("full_date IS NOT NULL")
    return shaped(days.withColumns(date_parts(F.col("full_date"))), STAR["dim_date"])

