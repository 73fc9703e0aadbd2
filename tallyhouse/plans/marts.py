"""The six report marts, built from the sales fact and one dimension each.

Sales are added up per surrogate key before the dimension is joined: the key
identifies the member, so the groups are the same, the partial aggregation leaves
one row per key and task (a key with a third of all sales included), and the join
sees totals, not sales. The inner join drops sales without a member.

``*_totals`` are the marts without ranks and with nulls kept; ``mart_*`` add the
ranks, then fill nulls as the contract wants (ranking first: a missing rating ranks
last and only then shows as 0.0), or fail on them with ``nulls="reject"``. Totals are staged before they are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import average, cents, from_cents, full_name, total_cents
from tallyhouse.operators import rank_rows, stage
from tallyhouse.schema import MARTS, conform


def _sales_per(fact: DataFrame, key: str) -> DataFrame:
    """Measures per key; columns nobody reads are pruned, from the scan up."""
    wanted = [
        ("order_count", key, F.count(F.lit(1))),
        ("quantity", "sale_quantity", F.sum("sale_quantity")),
        ("revenue", "sale_total_price", cents("sale_total_price")),
        ("priced_lines", "sale_total_price", F.count("sale_total_price")),
        ("unit_prices", "unit_price", cents("unit_price")),
        ("unit_priced_lines", "unit_price", F.count("unit_price")),
    ]
    present = set(fact.columns)
    return fact.groupBy(key).agg(
        *[total.alias(name) for name, measure, total in wanted if measure in present]
    )


def _mean_sale() -> Column:
    return average(from_cents("revenue"), F.col("priced_lines"))


def product_totals(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Quantity and revenue per product, with its rating and reviews."""
    return _sales_per(fact, "product_key").join(dim_product, "product_key").select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        F.col("quantity").alias("total_quantity"),
        from_cents("revenue").alias("total_revenue"),
        F.col("rating").cast("double").alias("avg_rating"),
        F.col("reviews").cast("bigint").alias("review_count"),
    )


def customer_totals(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Purchases per customer."""
    return _sales_per(fact, "customer_key").join(dim_customer, "customer_key").select(
        "customer_id",
        full_name("first_name", "last_name").alias("customer_name"),
        "country",
        from_cents("revenue").alias("total_purchases"),
        "order_count",
        _mean_sale().alias("avg_check"),
    )


def store_totals(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Revenue per store."""
    per_store = _sales_per(fact, "store_key").withColumnRenamed("store_key", "store_id")
    return per_store.join(dim_store, "store_id").select(
        "store_id",
        "store_name",
        "city",
        "country",
        from_cents("revenue").alias("total_revenue"),
        "order_count",
        _mean_sale().alias("avg_check"),
    )


def supplier_totals(fact: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    """Revenue per supplier and the mean unit price over its sale lines."""
    per_supplier = _sales_per(fact, "supplier_key").withColumnRenamed(
        "supplier_key", "supplier_id"
    )
    return per_supplier.join(dim_supplier, "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "country",
        from_cents("revenue").alias("total_revenue"),
        average(from_cents("unit_prices"), F.col("unit_priced_lines")).alias("avg_product_price"),
        "order_count",
    )


def quality_totals(totals: DataFrame) -> DataFrame:
    """Product totals under the column names of the quality mart, ratings unfilled."""
    return totals.withColumnsRenamed({
        "review_count": "total_reviews",
        "total_quantity": "total_sales_quantity",
    })


PRODUCT_RANKS = {"quantity_rank": "total_quantity", "revenue_rank": "total_revenue"}
QUALITY_RANKS = {
    "rating_rank": "avg_rating",
    "review_rank": "total_reviews",
    "sales_rank": "total_sales_quantity",
}
CUSTOMER_RANKS = {"purchase_rank": "total_purchases"}
REVENUE_RANKS = {"revenue_rank": "total_revenue"}


def _ranked(mart: str, totals: DataFrame, ranks: dict[str, str], nulls: str) -> DataFrame:
    contract = MARTS[mart]
    return conform(rank_rows(totals, ranks, contract.sort_by), contract, nulls)


def ranked_product_sales(totals: DataFrame, nulls: str = "fill") -> DataFrame:
    """The product sales mart from staged product totals."""
    return _ranked("mart_product_sales", totals, PRODUCT_RANKS, nulls)


def ranked_product_quality(totals: DataFrame, nulls: str = "fill") -> DataFrame:
    """The product quality mart from staged product totals."""
    return _ranked("mart_product_quality", quality_totals(totals), QUALITY_RANKS, nulls)


def mart_product_sales(
    fact: DataFrame, dim_product: DataFrame, nulls: str = "fill"
) -> DataFrame:
    return ranked_product_sales(stage(product_totals(fact, dim_product)), nulls)


def mart_product_quality(
    fact: DataFrame, dim_product: DataFrame, nulls: str = "fill"
) -> DataFrame:
    return ranked_product_quality(stage(product_totals(fact, dim_product)), nulls)


def mart_customer_sales(
    fact: DataFrame, dim_customer: DataFrame, nulls: str = "fill"
) -> DataFrame:
    totals = stage(customer_totals(fact, dim_customer))
    return _ranked("mart_customer_sales", totals, CUSTOMER_RANKS, nulls)


def mart_store_sales(
    fact: DataFrame, dim_store: DataFrame, nulls: str = "fill"
) -> DataFrame:
    totals = stage(store_totals(fact, dim_store))
    return _ranked("mart_store_sales", totals, REVENUE_RANKS, nulls)


def mart_supplier_sales(
    fact: DataFrame, dim_supplier: DataFrame, nulls: str = "fill"
) -> DataFrame:
    totals = stage(supplier_totals(fact, dim_supplier))
    return _ranked("mart_supplier_sales", totals, REVENUE_RANKS, nulls)


def time_totals(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per month. Sales are added per day first, so the join with the dates
    and the second aggregation see one row per day."""
    per_day = _sales_per(fact, "date_key").join(dim_date, "date_key")
    per_month = per_day.groupBy("year", "month", "month_name").agg(
        total_cents("revenue").alias("revenue"),
        F.sum("priced_lines").alias("priced_lines"),
        F.sum("order_count").alias("order_count"),
    )
    return per_month.select(
        "year",
        "month",
        "month_name",
        from_cents("revenue").alias("total_revenue"),
        "order_count",
        "priced_lines",
        _mean_sale().alias("avg_order_size"),
    )


def mart_time_sales(fact: DataFrame, dim_date: DataFrame, nulls: str = "fill") -> DataFrame:
    totals = time_totals(fact, dim_date).drop("priced_lines")
    return conform(totals, MARTS["mart_time_sales"], nulls)
