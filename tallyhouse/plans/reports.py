"""Reports over the marts.

Each takes a mart, freshly built or read back, or its ``*_totals`` where no rank is
needed. Top lists order by rank and id, so ties are cut the same way every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions import average, exact_difference, exact_sum


def _top(rows: DataFrame, rank: str, measure: str, tie_break: str, n: int) -> DataFrame:
    """The ``n`` highest rows with their rank.

    Without a rank column only the ``n`` rows are ranked: every row above one of them
    is among them too, so the rank is that of the whole table. Each task passes on
    ``n`` rows at most.
    """
    if rank in rows.columns:
        return rows.orderBy(rank, tie_break).limit(n)
    order = F.col(measure).desc_nulls_last()
    first = rows.orderBy(order, tie_break).limit(n)
    return first.withColumn(rank, F.rank().over(Window.orderBy(order)).cast("bigint"))


def top_products(product_sales: DataFrame, n: int = 10) -> DataFrame:
    """The products sold most."""
    return _top(product_sales, "quantity_rank", "total_quantity", "product_id", n).select(
        "product_id", "product_name", "total_quantity", "quantity_rank"
    )


def top_customers(customer_sales: DataFrame, n: int = 10) -> DataFrame:
    """The customers who spent most."""
    return _top(customer_sales, "purchase_rank", "total_purchases", "customer_id", n).select(
        "customer_id", "customer_name", "country", "total_purchases", "purchase_rank"
    )


def top_stores(store_sales: DataFrame, n: int = 5) -> DataFrame:
    """The stores with the highest revenue."""
    return _top(store_sales, "revenue_rank", "total_revenue", "store_id", n).select(
        "store_id", "store_name", "city", "country", "total_revenue", "revenue_rank"
    )


def top_suppliers(supplier_sales: DataFrame, n: int = 5) -> DataFrame:
    """The suppliers with the highest revenue."""
    return _top(supplier_sales, "revenue_rank", "total_revenue", "supplier_id", n).select(
        "supplier_id", "supplier_name", "country", "total_revenue", "revenue_rank"
    )


def best_rated(quality: DataFrame, n: int = 10) -> DataFrame:
    """The products with the highest rating."""
    return _top(quality, "rating_rank", "avg_rating", "product_id", n).select(
        "product_id", "product_name", "avg_rating", "total_reviews",
        "total_sales_quantity", "rating_rank",
    )


def worst_rated(quality_totals: DataFrame, n: int = 10) -> DataFrame:
    """The products with the lowest rating. Takes the totals, where a missing rating
    is still null and not 0.0."""
    return (
        quality_totals.orderBy(F.col("avg_rating").asc_nulls_last(), "product_id")
        .limit(n)
        .select("product_id", "product_name", "avg_rating", "total_reviews",
                "total_sales_quantity")
    )


def most_reviewed(quality: DataFrame, n: int = 10) -> DataFrame:
    """The products with the most reviews."""
    return _top(quality, "review_rank", "total_reviews", "product_id", n).select(
        "product_id", "product_name", "avg_rating", "total_reviews", "review_rank"
    )


def category_revenue(product_sales: DataFrame) -> DataFrame:
    """Revenue and quantity per product category."""
    return product_sales.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("total_quantity").alias("total_quantity"),
        exact_sum("total_revenue").alias("total_revenue"),
    )


def product_ratings(product_sales: DataFrame) -> DataFrame:
    """Rating and number of reviews per product."""
    return product_sales.select(
        "product_id", "product_name", "category", "avg_rating", "review_count"
    )


def _share(part: str) -> Column:
    # Over rows already grouped by country, of which there are few.
    return F.try_divide(F.col(part), F.sum(part).over(Window.partitionBy()))


def _percent(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part) * 100, F.col(whole))


def country_customers(customer_sales: DataFrame) -> DataFrame:
    """Customers per country, with their purchases and share of all customers."""
    return (
        customer_sales.groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("order_count").alias("order_count"),
            exact_sum("total_purchases").alias("total_purchases"),
        )
        .withColumn("customer_share", _share("customers"))
    )


def customer_avg_check(customer_sales: DataFrame) -> DataFrame:
    """Mean value of a purchase per customer."""
    return customer_sales.select("customer_id", "customer_name", "order_count", "avg_check")


def monthly_trend(time_sales: DataFrame) -> DataFrame:
    """Revenue month by month."""
    return time_sales.select(
        "year", "month", "month_name", "total_revenue", "order_count"
    ).orderBy("year", "month")


def yearly_trend(time_totals: DataFrame) -> DataFrame:
    """Revenue year by year. The mean is over lines with a price, like that of a month;
    it comes from the totals, which still have the number of those lines."""
    per_year = time_totals.groupBy("year").agg(
        exact_sum("total_revenue").alias("total_revenue"),
        F.sum("order_count").alias("order_count"),
        F.sum("priced_lines").alias("priced_lines"),
    )
    mean = average(F.col("total_revenue"), F.col("priced_lines"))
    return per_year.select(
        "year", "total_revenue", "order_count", mean.alias("avg_order_size")
    ).orderBy("year")


def period_comparison(time_sales: DataFrame) -> DataFrame:
    """Each month against the month before and against the same month of the year before,
    where the table has them. The window holds one row per month."""
    in_time = Window.orderBy("year", "month")
    months = F.col("year") * 12 + F.col("month")
    month_before = F.when(
        F.lag(months).over(in_time) == months - 1, F.lag("total_revenue").over(in_time)
    )
    same_month = Window.partitionBy("month").orderBy("year")
    year_before = F.when(
        F.lag("year").over(same_month) == F.col("year") - 1,
        F.lag("total_revenue").over(same_month),
    )
    return (
        time_sales.select("year", "month", "total_revenue")
        .withColumn("previous_revenue", month_before)
        .withColumn("year_before_revenue", year_before)
        .withColumn("change", exact_difference("total_revenue", "previous_revenue"))
        .withColumn("change_pct", _percent("change", "previous_revenue"))
        .withColumn("year_change", exact_difference("total_revenue", "year_before_revenue"))
        .withColumn("year_change_pct", _percent("year_change", "year_before_revenue"))
        .orderBy("year", "month")
    )


def avg_order_size(time_sales: DataFrame) -> DataFrame:
    """Mean value of a sale by month."""
    return time_sales.select(
        "year", "month", "month_name", "order_count", "avg_order_size"
    ).orderBy("year", "month")


def store_distribution(store_sales: DataFrame) -> DataFrame:
    """Stores and revenue per city, per country and in total. ``level`` is 0 for a
    city, 1 for a country and 3 for the total."""
    return store_sales.rollup("country", "city").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("stores"),
        F.sum("order_count").alias("order_count"),
        exact_sum("total_revenue").alias("total_revenue"),
    )


def store_avg_check(store_sales: DataFrame) -> DataFrame:
    """Mean value of a sale per store."""
    return store_sales.select(
        "store_id", "store_name", "city", "country", "order_count", "avg_check"
    )


def supplier_avg_price(supplier_sales: DataFrame) -> DataFrame:
    """Mean unit price per supplier, over its sale lines."""
    return supplier_sales.select(
        "supplier_id", "supplier_name", "country", "avg_product_price"
    )


def supplier_countries(supplier_sales: DataFrame) -> DataFrame:
    """Suppliers and revenue per country."""
    return supplier_sales.groupBy("country").agg(
        F.count(F.lit(1)).alias("suppliers"),
        F.sum("order_count").alias("order_count"),
        exact_sum("total_revenue").alias("total_revenue"),
    )


def _correlation(x: str, y: str) -> Column:
    """Null where one side does not vary; the built-in fails there under ANSI mode."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def rating_sales_corr(quality_totals: DataFrame) -> DataFrame:
    """Correlation of rating with quantity and revenue, over rated products only.
    Takes the totals, where a missing rating is still null and not 0.0."""
    return quality_totals.filter(F.col("avg_rating").isNotNull()).agg(
        F.count(F.lit(1)).alias("rated_products"),
        _correlation("avg_rating", "total_sales_quantity").alias("rating_quantity_corr"),
        _correlation("avg_rating", "total_revenue").alias("rating_revenue_corr"),
    )
