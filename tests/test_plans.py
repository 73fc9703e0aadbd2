"""Physical plans: what is read, and that nothing large meets in one task."""

import pytest

from tallyhouse.plans import dimensions as dims, marts
from tallyhouse.plans.fact import fact_sales
from tallyhouse.sources import read_table
from tallyhouse import warehouse
from tallyhouse.sources.order_tables import staging_from_orders


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    warehouse.run(staging_from_orders(spark, sf_folder), root)
    return lambda name: read_table(spark, root, name)


@pytest.mark.parametrize("name", dims.DIMENSIONS)
def test_a_dimension_reads_its_own_columns(stored, name):
    spec = dims.DIMENSIONS[name]
    plan = plan_of(dims.members(stored("staging"), spec))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    read = {field.split(":")[0] for field in schema.replace("...", "").split(",") if ":" in field}
    assert read <= set(spec.staging_columns)
    # Equal rows collapse before the first shuffle, without a sort of the input.
    assert plan.rindex("HashAggregate") > plan.rindex("Exchange") > plan.rindex("SortAggregate")


@pytest.mark.parametrize("name", dims.DIMENSIONS)
def test_dimensions_are_numbered_in_ranges(stored, name):
    spec = dims.DIMENSIONS[name]
    assert "SinglePartition" not in plan_of(dims.build(stored("staging"), spec))


def test_marts_are_ranked_in_ranges(stored):
    fact = stored("fact_sales")
    for mart, dimension in (
        (marts.mart_product_sales, "dim_product"),
        (marts.mart_product_quality, "dim_product"),
        (marts.mart_customer_sales, "dim_customer"),
        (marts.mart_store_sales, "dim_store"),
        (marts.mart_supplier_sales, "dim_supplier"),
    ):
        assert "SinglePartition" not in plan_of(mart(fact, stored(dimension)))


def test_a_mart_reads_one_key_and_its_measures(stored):
    plan = plan_of(marts.customer_totals(stored("fact_sales"), stored("dim_customer")))
    assert "ReadSchema: struct<customer_key:bigint,sale_total_price:double>" in plan
    assert "IsNotNull(customer_key)" in plan


def test_the_fact_forces_no_broadcast(stored, spark):
    tables = {name: stored(name) for name in dims.DIMENSIONS}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(fact_sales(stored("staging"), tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_texts_leave_before_the_large_lookups(stored, spark):
    """Store and supplier texts are gone from the rows that meet the customers."""
    tables = {name: stored(name) for name in dims.DIMENSIONS}
    tree = fact_sales(stored("staging"), tables)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in tree.splitlines() if "Join LeftOuter" in line]
    assert ["customer_id" in joins[0], "product_id" in joins[1], "seller_id" in joins[2]] == [True] * 3
    after_texts = tree.split(joins[2])[0]
    assert "store_name" not in after_texts and "supplier_name" not in after_texts


@pytest.mark.parametrize("name", ["fact_sales", "table_counts", "lost_sales"])
def test_the_order_lines_are_scanned_and_joined_once(spark, sf_folder, monkeypatch, name):
    """Every other table is computed from what that join has written."""
    import __spark_entry__ as entry
    from pyspark.sql import DataFrameReader

    read, plain = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **k: (read.extend(paths), plain(self, *paths, **k))[1])
    plan = plan_of(entry.queries()[name](spark, sf_folder))
    for table in ("lineitem", "orders"):
        assert read.count(f"{sf_folder}/{table}.parquet") == 1 and f"/{table}.parquet" not in plan


def test_lines_meet_parts_first_and_orders_with_their_customers(spark, sf_folder):
    """The lines go through two joins of large tables; only plain columns of parts through one."""
    tree = staging_from_orders(spark, sf_folder)._jdf.queryExecution().optimizedPlan().toString()
    joins = {}
    for line in tree.splitlines():
        for key in ("l_partkey#", "o_orderkey#", "c_custkey#"):
            if "Join LeftOuter" in line and key in line:
                joins[key] = len(line) - len(line.lstrip(" :+-"))
    assert joins["o_orderkey#"] < min(joins["l_partkey#"], joins["c_custkey#"])


def test_the_fact_broadcasts_written_dimensions(spark, sf_folder):
    """What is small is known before the sales are shuffled."""
    import __spark_entry__ as entry

    fact = entry.queries()["fact_sales"](spark, sf_folder)
    assert "SortMergeJoin" not in plan_of(fact)
