import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import number_rows, numbering, rank_rows, stage


def brute_ranks(values):
    """1 + how many are larger; a null is smaller than any value."""
    low = float("-inf")
    known = [low if v is None else v for v in values]
    return [1 + sum(other > v for other in known) for v in known]


@pytest.fixture(params=["merged", "split"])
def ranges(request, spark):
    """Ranges as adaptive execution merges them, and as many as shuffles have partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(request.param == "merged").lower())
    yield request.param
    spark.conf.set(name, before)


def test_ranks_match_brute_force(spark, ranges):
    rnd = random.Random(3)
    rows = [
        (
            i,
            rnd.choice([None, 1.5, 2.5, 3.5]) if i % 3 else 4.5,
            rnd.randint(0, 400),
            round(rnd.uniform(-50, 50), 2),
        )
        for i in range(900)
    ]
    table = stage(spark.createDataFrame(rows, "id int, rating double, n int, money double"))
    ranked = rank_rows(table, {"rating_rank": "rating", "n_rank": "n", "money_rank": "money"}, ["id"])
    found = {r["id"]: (r["rating_rank"], r["n_rank"], r["money_rank"]) for r in ranked.collect()}
    expected = zip(*[brute_ranks([r[i] for r in rows]) for i in (1, 2, 3)])
    assert found == {row[0]: ranks for row, ranks in zip(rows, expected)}


@pytest.mark.parametrize("by", [["id"], ["name", "city"], ["city", "name"]])
def test_row_numbers_match_the_plain_order(spark, ranges, by):
    rnd = random.Random(5)
    pairs = {(rnd.choice(["é", "Z", "a", "", None]), rnd.choice([None, *map(str, range(200))]))
             for _ in range(3000)}
    rows = [(i, *pair) for i, pair in enumerate(sorted(pairs, key=str))]
    rows.append((None, "no id", "x"))
    table = stage(spark.createDataFrame(rows, "id int, name string, city string"))
    numbered = number_rows(table, by, "key")
    found = numbered.collect()

    def place(row):
        # Null first, then the order of the text's bytes.
        return [(row[c] is not None, row[c].encode() if isinstance(row[c], str) else row[c])
                for c in by]

    in_order = sorted(found, key=lambda r: r["key"])
    assert [r["key"] for r in in_order] == list(range(1, len(rows) + 1))
    assert [place(r) for r in in_order] == sorted(place(r) for r in in_order)
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()


def test_a_shared_value_is_one_value_of_the_order(spark, ranges):
    """A third of the rows tie."""
    table = stage(
        spark.range(30_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") * 1.0).alias("v")
        )
    )
    ranked = rank_rows(table, {"r": "v"}, ["id"])
    assert "SinglePartition" not in ranked._jdf.queryExecution().executedPlan().toString()
    found = ranked.groupBy("v").agg(F.min("r").alias("a"), F.max("r").alias("b"), F.count("*").alias("n"))
    above = 0
    for row in found.orderBy(F.desc("v")).collect():
        assert row["a"] == row["b"] == above + 1
        above += row["n"]
    assert above == 30_000


def test_values_that_fill_several_ranges(spark, ranges):
    """Runs of one value, over none, one and many ranges, next to each other; 64-bit numbers that a
    double cannot tell apart; NaN and both zeros; a null key."""
    rnd = random.Random(9)
    big = 2**60
    rows = []
    for value, times in ((9.0, 700), (8.0, 1), (7.5, 900), (float("nan"), 30), (0.0, 200), (-0.0, 200), (None, 400), (-3.0, 5)):
        rows += [(value, rnd.choice([big, big + 1, big + 2, None, -5]), rnd.randint(0, 9)) for _ in range(times)]
    rnd.shuffle(rows)
    rows = [(i or None, *row) for i, row in enumerate(rows)]
    table = stage(spark.createDataFrame(rows, "id int, a double, b bigint, c int"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found = rank_rows(table, {"a_rank": "a", "b_rank": "b", "c_rank": "c"}, ["id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda v: float("inf") if v != v else v
    expected = zip(*[brute_ranks([v if v is None else key(v) for v in column]) for column in list(zip(*rows))[1:]])
    assert {r["id"]: (r["a_rank"], r["b_rank"], r["c_rank"]) for r in found} == {
        row[0]: ranks for row, ranks in zip(rows, expected)
    }


def test_several_ranks_take_one_pass(spark):
    table = stage(spark.range(2000).selectExpr("id", "id % 7 AS a", "id * 1.5D AS b", "'x' AS wide"))
    measures = numbering._measures(table, ["a", "b"], ["id"])
    plan = numbering._ranked_in_ranges(measures, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and plan.count("FileScan") == 1 and "wide" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = rank_rows(table, {"a_rank": "a", "b_rank": "b"}, ["id"])
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_all_rows_equal(spark):
    table = stage(spark.range(1000).select("id", F.lit(None).cast("double").alias("v")))
    ranks = rank_rows(table, {"r": "v"}, ["id"]).select("r").distinct().collect()
    assert [r["r"] for r in ranks] == [1]


def test_empty_table(spark):
    table = stage(spark.range(0).withColumn("v", F.col("id") * 1.0))
    assert number_rows(table, ["id"], "key").isEmpty()
    assert rank_rows(table, {"r": "v"}, ["id"]).isEmpty()
