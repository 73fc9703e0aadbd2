import pytest

from conftest import rows_of
from tallyhouse.plans import audit, dimensions as dims
from tallyhouse.plans.fact import fact_sales
from tallyhouse.schema import STAR

FULL = {
    "sale_customer_id": 5, "sale_seller_id": 6, "sale_product_id": 7, "store_name": "S",
    "store_city": "Rome", "store_country": "IT", "supplier_name": "Acme",
    "supplier_city": "Bern", "supplier_country": "CH", "sale_date": "5/4/2021",
    "sale_quantity": 2, "sale_total_price": 10.5, "product_price": 5.25,
}


def star(staging, **options):
    tables = dims.build_all(staging)
    return fact_sales(staging, tables, **options), tables


def test_one_row_per_staging_row(sales):
    fact, _ = star(sales(FULL, FULL, {**FULL, "sale_customer_id": 9}))
    assert rows_of(fact) == [
        (1, 1, 1, 1, 1, 20210504, 2, 10.5, 5.25),
        (1, 1, 1, 1, 1, 20210504, 2, 10.5, 5.25),
        (2, 1, 1, 1, 1, 20210504, 2, 10.5, 5.25),
    ]
    assert [(f.name, f.dataType) for f in fact.schema] == [
        (f.name, f.dataType) for f in STAR["fact_sales"]
    ]


def test_suppliers_in_two_countries_do_not_multiply_sales(sales):
    fact, _ = star(sales(*[{**FULL, "supplier_country": c} for c in ("US", "CA")]))
    assert rows_of(fact, "supplier_key") == [(1,), (2,)]


@pytest.mark.parametrize(
    "column, key",
    [("sale_customer_id", "customer_key"), ("store_city", "store_key"),
     ("supplier_country", "supplier_key"), ("sale_date", "date_key")],
)
def test_a_null_key_part_keeps_the_sale_without_a_key(sales, column, key):
    staging = sales(FULL, {**FULL, column: None})
    fact, tables = star(staging)
    assert sorted(rows_of(fact, key), key=str)[-1] == (None,) and fact.count() == 2
    lost = dict(rows_of(audit.lost_sales(fact), "key_column", "lost_lines"))
    assert lost.pop(key) == 1 and set(lost.values()) == {0}
    if key != "date_key":
        safe = fact_sales(staging, tables, null_safe=True)
        assert safe.count() == 2 and safe.filter(f"{key} IS NULL").isEmpty()


def test_lost_revenue(sales):
    fact, _ = star(sales(FULL, {**FULL, "sale_date": "n/a", "sale_total_price": 0.1},
                         {**FULL, "sale_date": None, "sale_total_price": 0.2}))
    lost = audit.lost_sales(fact).filter("key_column = 'date_key'").first()
    assert (lost["lost_lines"], lost["lost_revenue"]) == (2, 0.3)


def test_every_key_is_found_in_its_dimension(sales):
    fact, tables = star(sales(*[{**FULL, "sale_product_id": i % 7} for i in range(30)], {}))
    for dimension in dims.DIMENSIONS.values():
        assert audit.orphan_keys(
            fact, tables[dimension.table], dimension.fact_key, dimension.surrogate
        ).isEmpty()


def test_bad_date_has_no_date_key(sales):
    fact, _ = star(sales({**FULL, "sale_date": "13/40/2021"}, {**FULL, "sale_date": "05/04/2021"}))
    assert rows_of(fact, "date_key") == [(None,), (20210504,)]


@pytest.fixture
def no_broadcast(spark):
    """Shuffle joins only, with sizes at which small test data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("hot", ["17", "NULL"])
def test_hot_keys_are_split_in_every_shuffle_join(spark, no_broadcast, hot):
    """A third of the sales share one customer, one product and one store, or have
    none: no join may leave them to one task."""
    columns = {
        "sale_customer_id": f"CASE WHEN id % 3 = 0 THEN {hot} ELSE id % 2000 END",
        "sale_product_id": f"CASE WHEN id % 3 = 1 THEN {hot} ELSE id % 1999 END",
        "store_name": f"CASE WHEN id % 3 = 2 THEN CAST({hot} AS STRING) ELSE concat('S', id % 1000) END",
        "store_city": "'Rome'",
        "store_country": "'IT'",
        "sale_quantity": "CAST(id % 5 AS INT)",
    }
    chosen = [dims.CUSTOMER, dims.PRODUCT, dims.STORE]
    for name in [c for d in chosen for c in d.staging_columns]:
        columns.setdefault(name, "CAST(NULL AS STRING)")
    staging = spark.range(0, 60_000, 1, 8).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])

    tables = dims.build_all(staging, chosen)
    fact = fact_sales(staging, tables)
    rows = fact.collect()
    plan = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("SortMergeJoin(skew=true)") == 3

    assert len(rows) == 60_000
    if hot == "NULL":
        for key in ("customer_key", "product_key", "store_key"):
            assert sum(r[key] is None for r in rows) == 20_000
        return
    customer = tables["dim_customer"].filter("customer_id = 17").first()["customer_key"]
    product = tables["dim_product"].filter("product_id = 17").first()["product_key"]
    store = tables["dim_store"].filter("store_name = '17'").first()["store_id"]
    ids = range(60_000)
    assert [
        sum(r["customer_key"] == customer for r in rows),
        sum(r["product_key"] == product for r in rows),
        sum(r["store_key"] == store for r in rows),
    ] == [
        sum(i % 3 == 0 or i % 2000 == 17 for i in ids),
        sum(i % 3 == 1 or i % 1999 == 17 for i in ids),
        20_000,
    ]
