import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallyhouse import sinks
from tallyhouse.operators import scratch_folder
from tallyhouse.schema import MARTS, STAGING
from tallyhouse.sources import hash_predicates, read_csv_staging
from tallyhouse.sources.csv_files import _FORMAT
from tallyhouse.sources.quoted_records import UnclosedQuote
from tallyhouse.sources.order_tables import staging_from_orders

HEADER = ",".join(STAGING.names)


def csv_line(**values):
    return ",".join(values.get(name, "") for name in STAGING.names)


def csv_file(folder, *lines, name="a.csv"):
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_csv_quoting_and_empty_fields(spark, tmp_path):
    path = csv_file(
        tmp_path,
        csv_line(id="1", product_description='"two\nlines, one ""field"""', product_price="2.50"),
        csv_line(id="2", product_name='""', sale_date="5/4/2021"),
    )
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_staging(spark, path).collect()
    rows = read_csv_staging(spark, path, multi_line=True).orderBy("id").collect()
    assert len(rows) == 2
    assert rows[0]["product_description"] == 'two\nlines, one "field"'
    assert str(rows[0]["product_price"]) == "2.50"
    assert rows[0]["sale_quantity"] is None and rows[0]["store_name"] is None
    assert rows[1]["product_name"] == "" and rows[1]["sale_date"] == "5/4/2021"


@pytest.fixture
def tiny_splits(spark):
    """Files are cut every few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def wild_field(rnd, longest):
    parts = ["a", "b,", "\n", '""', "é", "\r\n", " ", "x" * 30]
    text = "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 2, 5, 40, longest])))
    return f'"{text}"' if any(c in text for c in ',\n"\r') or rnd.random() < 0.5 else text


def test_records_over_many_splits_equal_those_of_one_task(spark, tmp_path, tiny_splits):
    """Fields with breaks, of up to several splits, against Spark's reader with a task a file."""
    rnd = random.Random(1)
    for k in range(4):
        lines = []
        for i in range(60):
            lines.append(csv_line(id=str(100 * k + i), product_description=wild_field(rnd, 60 if k else 500),
                                  store_name=wild_field(rnd, 3)))
            if rnd.random() < 0.1:
                lines.append("")
        csv_file(tmp_path, *lines, name=f"{k}.csv")
    (tmp_path / "no rows.csv").write_text(HEADER)
    (tmp_path / "empty.csv").write_text("")
    found = read_csv_staging(spark, str(tmp_path), multi_line=True)
    plain = spark.read.schema(STAGING).csv(str(tmp_path), header=True, multiLine=True, **_FORMAT)
    assert found.schema == STAGING and found.count() == 240
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 200
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    # The lines are shuffled once for records of one line and of several.
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan text") == 1


def test_lines_are_not_shuffled(spark, tmp_path, tiny_splits):
    """Those of records that run on over the end of a split alone are, and they are few."""
    rnd = random.Random(2)
    lines = [csv_line(id=str(i), product_description=f'"{"x" * rnd.randrange(90)}\n""b{i}\n"') for i in range(300)]
    csv_file(tmp_path, *lines)
    found = read_csv_staging(spark, str(tmp_path), multi_line=True)
    ids = [row["id"] for row in found.select("id", "product_description").collect()]
    assert sorted(ids) == list(range(300))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above_text = [line for line in plan.splitlines() if "Relation" in line and "value#" in line]
    assert len(above_text) == 1  # what is shuffled comes from a written table
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    before_scan = final.split("FileScan text")[0].rsplit("MapInArrow", 1)[1]
    assert "hashpartitioning" not in before_scan and "Sort" not in before_scan


def test_carriage_returns_end_records_and_stay_in_fields(spark, tmp_path, tiny_splits):
    path = tmp_path / "a.csv"
    lines = [HEADER] + [csv_line(id=str(i), store_name=f'"a\r\nb{i}"') for i in range(40)]
    path.write_bytes("\r\n".join(lines).encode())
    found = read_csv_staging(spark, str(path), multi_line=True)
    assert rows_of(found, "id", "store_name") == [(i, f"a\r\nb{i}") for i in range(40)]


def test_a_header_with_a_break_is_one_record(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER.replace("store_name", '"store\nname"') + "\n" + csv_line(id="1") + "\n")
    assert rows_of(read_csv_staging(spark, str(path), multi_line=True), "id") == [(1,)]


@pytest.mark.parametrize("line", [csv_line(id="x"), csv_line(sale_quantity="1.5"), "1,2,3", csv_line(id="1") + ",4"])
def test_malformed_records_fail(spark, tmp_path, line):
    path = csv_file(tmp_path, csv_line(id="1", store_name='"a\nb"'), line)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv_staging(spark, path, multi_line=True).collect()


def test_a_quote_that_is_never_closed_fails(spark, tmp_path, tiny_splits):
    good = csv_file(tmp_path, csv_line(id="1"))
    bad = csv_file(tmp_path, *[csv_line(id=str(i)) for i in range(9)], csv_line(store_name='"a'), name="b.csv")
    with pytest.raises(UnclosedQuote, match="b.csv"):
        read_csv_staging(spark, [good, bad], multi_line=True)


def test_several_csv_files_are_one_table(spark, tmp_path):
    paths = [csv_file(tmp_path, csv_line(id=str(i)), name=f"f {i}.csv") for i in range(10)]
    for multi_line in (True, False):
        staging = read_csv_staging(spark, paths, multi_line)
        assert staging.schema == STAGING
        assert rows_of(staging, "id") == [(i,) for i in range(10)]


@pytest.mark.parametrize("line", [csv_line(id="x"), csv_line(sale_quantity="1.5"), "1,2,3"])
def test_malformed_csv_fails(spark, tmp_path, line):
    path = csv_file(tmp_path, csv_line(id="1"), line)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv_staging(spark, path).collect()


def test_hash_predicates_deal_each_row_to_one_part(spark):
    ids = spark.createDataFrame([(i,) for i in [None, 0, -7, 3, 2**40, *range(50)]], "k bigint")
    parts = hash_predicates("k", 4)
    hits = sum(F.expr(p).cast("int") if i == 0 else F.coalesce(F.expr(p), F.lit(False)).cast("int")
               for i, p in enumerate(parts))
    assert rows_of(ids.select(hits.alias("n")).distinct()) == [(1,)]


def test_overwrite_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.overwrite_parquet(spark.range(100), path) == 100
    assert sinks.overwrite_parquet(spark.range(30), path, ("id",)) == 30
    assert spark.read.parquet(path).count() == 30


def test_sorted_layout_separates_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shuffled = spark.range(10_000).orderBy(F.xxhash64("id"))
        sinks.overwrite_parquet(shuffled, path, ("id",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spans = rows_of(
        spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi")), "lo", "hi",
    )
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_catalog_tables(spark):
    sinks.create_mart_tables(spark, "marts_test")
    sinks.create_mart_tables(spark, "marts_test")
    mart = MARTS["mart_time_sales"]
    rows = spark.createDataFrame(
        [(2020, 2, "February", 1.0, 2, 0.5), (2020, 1, "January", 3.0, 1, 3.0)], mart.columns
    )
    table = "marts_test.mart_time_sales"
    columns = spark.table(table).dtypes
    assert sinks.reload_catalog_table(rows.select(*reversed(rows.columns)), table, mart.sort_by) == 2
    assert sinks.reload_catalog_table(rows.limit(1), table) == 1
    assert spark.table(table).dtypes == columns and spark.table(table).count() == 1
    assert sinks.overwrite_catalog_table(rows.select("year"), table) == 2
    assert spark.table(table).columns == ["year"]


def test_leaving_out_joins_changes_nothing(spark, sf_folder):
    whole = staging_from_orders(spark, sf_folder)
    assert [(f.name, f.dataType) for f in whole.schema] == [(f.name, f.dataType) for f in STAGING]
    for columns in (["sale_product_id", "product_name"], ["store_name", "store_city"],
                    ["supplier_country", "sale_total_price"], ["customer_country", "sale_date"]):
        few = staging_from_orders(spark, sf_folder, columns)
        assert few.exceptAll(whole.select(*few.columns)).isEmpty()
        assert few.count() == whole.count()


def test_the_csv_table_of_the_query_is_compressed(spark, sf_folder):
    import __spark_entry__ as entry

    files = entry.queries()["csv_staging"](spark, sf_folder).inputFiles()
    assert files and all(name.endswith(".csv.gz") for name in files)


def test_the_csv_files_with_breaks_never_lie_on_disk_together(spark, sf_folder, monkeypatch):
    """They are written, read and removed in parts, and the result is that of all rows."""
    import __spark_entry__ as entry

    def sizes():
        folders = Path(urlparse(scratch_folder(spark)).path).glob("csv-*")
        return {folder: sum(file.stat().st_size for file in folder.iterdir()) for folder in folders}

    def read(spark, path, **options):
        on_disk.append(sum(size for folder, size in sizes().items() if folder not in before))
        return read_csv_staging(spark, path, **options)

    on_disk, before = [], sizes()
    rows = staging_from_orders(spark, sf_folder)
    monkeypatch.setattr(entry, "staging_from_orders", lambda *args: rows.repartition(16))
    monkeypatch.setattr(entry, "read_csv_staging", read)
    found = entry.queries()["csv_quoted_breaks"](spark, sf_folder)
    assert len(on_disk) == entry.CSV_PARTS and 0 < max(on_disk) < sum(on_disk) / 4
    assert set(sizes()) == set(before)
    broken = F.replace("product_description", F.lit(", "), F.lit(',\n"'))
    wanted = rows.withColumn("product_description", broken)
    assert found.schema == STAGING and found.count() == rows.count()
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
