import datetime
import itertools

import pytest

from conftest import rows_of
from tallyhouse.plans import audit, dimensions as dims
from tallyhouse.schema import STAR


def test_dates_are_parsed_and_bad_ones_left_out(sales):
    staging = sales(*[
        {"sale_date": d} for d in ("5/4/2021", "05/04/2021", "13/40/2021", "n/a", None, "12/31/2020")
    ])
    table = dims.dim_date(staging)
    assert rows_of(table) == [
        (datetime.date(2020, 12, 31), 20201231, 2020, 4, 12, 31, 5, "December", "Thursday"),
        (datetime.date(2021, 5, 4), 20210504, 2021, 2, 5, 4, 3, "May", "Tuesday"),
    ]
    assert table.schema == STAR["dim_date"]


def test_sunday_is_day_one(sales):
    assert rows_of(dims.dim_date(sales({"sale_date": "1/3/2021"})), "day_of_week") == [(1,)]


def test_dates_are_parsed_once_per_text(sales):
    plan = dims.dim_date(sales({"sale_date": "1/3/2021"}))._jdf.queryExecution().optimizedPlan().toString()
    below_the_grouping = plan.split("Aggregate [sale_date")[1]
    assert "gettimestamp" not in below_the_grouping


@pytest.mark.parametrize("partitions", [1, 8, 37])
def test_survivor_and_keys_do_not_depend_on_partitioning(spark, sales, partitions):
    rows = [
        {"sale_product_id": i % 40, "product_name": n, "product_price": p, "product_reviews": r}
        for i, (n, p, r) in enumerate(itertools.islice(
            itertools.cycle(itertools.product(["b", "a", None], [2.5, 10.25], [None, 9, 10])), 700))
    ]
    expected = rows_of(dims.build(sales(*rows), dims.PRODUCT))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = sales(*reversed(rows)).repartition(partitions)
        assert rows_of(dims.build(shuffled, dims.PRODUCT)) == expected
        assert rows_of(dims.build(shuffled, dims.PRODUCT)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_first_variant_survives(sales):
    staging = sales(
        {"sale_product_id": 1, "product_name": "b", "product_price": 1},
        {"sale_product_id": 1, "product_name": "a", "product_price": 3},
        {"sale_product_id": 1, "product_name": "a", "product_price": 20},
    )
    assert rows_of(dims.build(staging, dims.PRODUCT), "product_id", "name", "price") == [(1, "a", 3.0)]


def test_texts_of_one_date_are_one_variant(sales):
    staging = sales(
        {"sale_product_id": 1, "product_release_date": "05/04/2021"},
        {"sale_product_id": 1, "product_release_date": "5/4/2021"},
        {"sale_product_id": 2, "product_release_date": "4th of May"},
    )
    assert rows_of(dims.build(staging, dims.PRODUCT), "product_key", "release_date") == [
        (1, datetime.date(2021, 5, 4)), (2, None),
    ]


def test_store_keys_follow_the_full_business_key(sales):
    staging = sales(*[
        {"store_name": n, "store_city": c, "store_country": l}
        for n, c, l in [("S", "Rome", "US"), ("S", "Rome", "IT"), ("R", "Rome", "US"), ("S", None, "IT")]
    ])
    table = dims.build(staging, dims.STORE)
    assert rows_of(table, "store_id", "store_name", "city", "country") == [
        (1, "R", "Rome", "US"), (2, "S", None, "IT"), (3, "S", "Rome", "IT"), (4, "S", "Rome", "US"),
    ]


def test_same_supplier_name_in_two_countries_is_two_members(sales):
    staging = sales(*[
        {"supplier_name": "Acme", "supplier_city": "Springfield", "supplier_country": c}
        for c in ("US", "CA", "US")
    ])
    table = dims.build(staging, dims.SUPPLIER)
    assert rows_of(table, "supplier_id", "country") == [(1, "CA"), (2, "US")]
    assert audit.repeated_keys(table, dims.SUPPLIER.keys).isEmpty()


def test_a_null_key_is_one_member(sales):
    table = dims.build(sales({"sale_customer_id": 4}, {}, {}), dims.CUSTOMER)
    assert rows_of(table, "customer_key", "customer_id") == [(1, None), (2, 4)]


@pytest.mark.parametrize("name", list(dims.DIMENSIONS))
def test_layout(sales, name):
    table = dims.build(sales({"sale_customer_id": 1}), dims.DIMENSIONS[name])
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in STAR[name]
    ]


def test_bad_numbers_become_null(spark):
    staging = spark.createDataFrame(
        [("7", "old"), ("8", "30")], "sale_customer_id string, customer_age string"
    )
    for column in dims.CUSTOMER.staging_columns:
        if column not in staging.columns:
            staging = staging.selectExpr("*", f"CAST(NULL AS STRING) AS {column}")
    assert rows_of(dims.build(staging, dims.CUSTOMER), "customer_id", "age") == [(7, None), (8, 30)]
