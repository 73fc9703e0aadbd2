import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import cents, exact_difference, exact_sum, from_cents, total_cents


@pytest.fixture(params=["true", "false"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def amounts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a double")


def test_large_sums_do_not_wrap(spark, ansi):
    for values in ([4e16] * 3, [9e16] * 50, [-4e16] * 9, [4e16, 0.01, -4e16], [1e18, 1e18, 0.25]):
        exact = sum(Decimal(repr(v)) for v in values)
        assert amounts(spark, *values).agg(exact_sum("a")).first()[0] == float(exact), values


def test_sums_are_exact_in_any_order(spark, ansi):
    rnd = random.Random(1)
    values = [rnd.randint(-10**12, 10**12) / 100 for _ in range(4000)] + [0.1, 0.2, -0.0, 1e-9]
    exact = float(sum(Decimal(repr(round(v, 2))) for v in values))
    table = amounts(spark, *values)
    for parts in (1, 3, 16):
        assert table.repartition(parts).agg(exact_sum("a")).first()[0] == exact
    per_group = table.withColumn("g", F.rint("a") % 7).groupBy("g").agg(cents("a").alias("s"))
    assert per_group.agg(from_cents(total_cents("s"))).first()[0] == exact


def test_no_amounts(spark, ansi):
    assert amounts(spark, None, float("nan")).agg(exact_sum("a")).first()[0] is None
    assert amounts(spark).agg(exact_sum("a")).first()[0] is None
    assert amounts(spark, None, float("nan"), 2.5).agg(exact_sum("a")).first()[0] == 2.5


def test_differences(spark, ansi):
    pairs = spark.createDataFrame([(0.3, 0.1), (5e16, 4e16), (None, 1.0), (1.0, None), (1.1, 1.1)], "a double, b double")
    found = [r[0] for r in pairs.select(exact_difference("a", "b")).collect()]
    assert found == [0.2, 1e16, None, None, 0.0]


def test_sums_stay_in_generated_code(spark):
    plan = spark.range(10).select((F.col("id") / 4).alias("a"), "id").groupBy("id").agg(exact_sum("a"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
