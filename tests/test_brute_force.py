"""Both jobs over untidy rows against plain Python."""

import random

import pytest

import brute_force
from conftest import rows_of
from tallyhouse import warehouse
from tallyhouse.plans.dimensions import DIMENSIONS
from tallyhouse.schema import MARTS
from tallyhouse.sources import read_table


def untidy(n, seed):
    """Repeated keys with differing attributes, null keys and key parts, ties, missing
    prices, bad dates, and a third of the sales on one customer and product."""
    rnd = random.Random(seed)
    maybe = lambda *values: rnd.choice([None, *values])
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append({
            "id": i,
            "sale_customer_id": 7 if hot else maybe(*range(40)),
            "customer_first_name": maybe("Ann", "Bo"), "customer_last_name": maybe("Li"),
            "customer_age": maybe(30, 31), "customer_country": maybe("PE", "IT"),
            "sale_seller_id": maybe(1, 2, 3), "seller_email": maybe("a@x", "b@x"),
            "sale_product_id": 5 if hot else maybe(*range(60)),
            "product_name": maybe("ball", "bone"), "product_category": maybe("Toy", "Food"),
            "product_price": maybe(0.1, 0.2, 19.99, 5.0), "product_rating": maybe(1.5, 4.0, 4.5),
            "product_reviews": maybe(0, 10, 500), "product_release_date": maybe("1/2/2020", "x"),
            "store_name": rnd.choice(["S", "R"]), "store_city": maybe("Rome", "Bari"),
            "store_country": maybe("IT", "US"), "store_phone": maybe("1", "2"),
            "supplier_name": maybe("Acme", "Zoo"), "supplier_city": rnd.choice(["Bern", "Oslo"]),
            "supplier_country": rnd.choice(["CH", "NO"]), "supplier_email": maybe("s@x"),
            "sale_date": rnd.choice(["1/5/2020", "01/05/2020", "2/29/2020", "2/30/2020", "n/a",
                                     None, "12/31/2021", "13/1/2021"]),
            "sale_quantity": maybe(1, 2, 9), "sale_total_price": maybe(0.1, 0.7, 12.34, 100.0),
        })
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 37])
def test_warehouse(spark, sales, tmp_path, partitions):
    rows = untidy(400, seed=11)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        staging = sales(*rows).repartition(partitions)
        warehouse.run(staging, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    dims, fact = brute_force.star(rows)
    by_text = lambda rows: sorted(rows, key=str)
    for name, spec in DIMENSIONS.items():
        found = read_table(spark, str(tmp_path), name).drop("price", "weight").collect()
        assert len(found) == len(dims[name])
        for row in found:
            number, attributes = dims[name][tuple(row[k] for k in spec.keys)]
            assert row[spec.surrogate] == number
            for column in row.asDict():
                if column in attributes:
                    assert row[column] == attributes[column], (name, column)
    assert by_text(rows_of(read_table(spark, str(tmp_path), "fact_sales"))) == by_text(fact)
    for name, expected in brute_force.marts(dims, fact).items():
        found = rows_of(read_table(spark, str(tmp_path), name))
        assert len(found) == len(expected), name
        for a, b in zip(by_text(found), by_text(expected)):
            assert a == b, (name, MARTS[name].columns.names)


def test_null_safe_keys(spark, sales, tmp_path):
    warehouse.run(sales(*untidy(100, seed=2)), str(tmp_path), null_safe=True)
    fact = read_table(spark, str(tmp_path), "fact_sales")
    assert fact.count() == 100
    keys = [spec.fact_key for spec in DIMENSIONS.values()]
    assert fact.filter(" OR ".join(f"{key} IS NULL" for key in keys)).isEmpty()
