import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tallyhouse-tests")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tallyhouse-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sales(spark):
    """Staging rows from dicts; columns not given are null, decimals may be floats."""
    from decimal import Decimal

    from pyspark.sql.types import DecimalType

    from tallyhouse.schema import STAGING

    def build(*rows):
        def value(row, field):
            found = row.get(field.name)
            if found is not None and isinstance(field.dataType, DecimalType):
                return Decimal(str(found))
            return found

        return spark.createDataFrame(
            [tuple(value(row, f) for f in STAGING) for row in rows], STAGING
        )

    return build


def rows_of(table, *columns):
    """The rows as a sorted list of tuples."""
    chosen = table.select(*columns) if columns else table
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, v) for v in r])
