from pyspark.sql.types import StringType

from conftest import rows_of
from tallyhouse.plans import audit
from tallyhouse.schema import STAGING, TEXT_LIMITS, filled


def test_fifty_staging_columns():
    assert len(STAGING) == 50 == len(set(STAGING.names))
    texts = {f.name for f in STAGING if f.dataType == StringType()}
    assert texts - set(TEXT_LIMITS) == {"product_description"} and not set(TEXT_LIMITS) - texts


def test_fill_replaces_nulls_and_nan(spark):
    rows = spark.createDataFrame(
        [(None, None, None, None), ("a", float("nan"), 5, 6)], "s string, d double, n bigint, i int"
    )
    assert rows_of(filled(rows)) == [("Unknown", 0.0, 0, 0), ("a", 0.0, 5, 6)]


def test_text_lengths(sales):
    found = audit.text_lengths(sales({"sale_date": "x" * 21, "product_name": "é" * 200}, {}))
    by_name = {r["column_name"]: tuple(r)[1:] for r in found.collect()}
    assert by_name["sale_date"] == (20, 21, 1)
    assert by_name["product_name"] == (200, 200, 0)
    assert by_name["store_state"] == (100, None, 0)
