import os
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier, Event

import pytest

from tallyhouse import versions, warehouse
from tallyhouse.sources import read_table
from tallyhouse.sources.order_tables import staging_from_orders
from tallyhouse.versions import VersionConflict, folders, new_version


def write(spark, folder, n):
    spark.range(n).write.parquet(f"{folder}/t")


def in_use(spark, root):
    return spark.read.parquet(f"{root}/{folders(spark, root, 'star')[0]}/t").count()


def entries(root):
    return sorted(n for n in os.listdir(root) if not n.startswith("."))


def test_versions_replace_each_other(spark, tmp_path):
    root = str(tmp_path / "w")
    assert folders(spark, root, "star") == []
    for n in range(1, 5):
        with new_version(spark, root, "star") as folder:
            write(spark, folder, n)
        assert in_use(spark, root) == n
    # The last two versions, each a folder and the file that names it.
    assert len(entries(root)) == 4 and len(folders(spark, root, "star")) == 2


def test_of_two_jobs_at_once_the_first_to_end_wins(spark, tmp_path):
    root, slow_began, fast_done = str(tmp_path), Event(), Event()

    def slow():
        with new_version(spark, root, "star") as folder:
            slow_began.set()
            assert fast_done.wait(60)
            write(spark, folder, 5)

    with ThreadPoolExecutor(1) as pool:
        running = pool.submit(slow)
        assert slow_began.wait(60)
        with new_version(spark, root, "star") as folder:
            write(spark, folder, 7)
        fast_done.set()
        with pytest.raises(VersionConflict):
            running.result(60)
    assert in_use(spark, root) == 7 and len(entries(root)) == 2
    with new_version(spark, root, "star") as folder:
        write(spark, folder, 9)
    assert in_use(spark, root) == 9


def test_many_jobs_that_end_at_the_same_time_have_one_winner(spark, tmp_path):
    root, together = str(tmp_path), Barrier(6)

    def job(n):
        try:
            with new_version(spark, root, "star") as folder:
                write(spark, folder, n)
                together.wait(120)
        except VersionConflict:
            return None
        return n

    with ThreadPoolExecutor(6) as pool:
        won = [n for n in pool.map(job, range(1, 7)) if n]
    assert len(won) == 1 and in_use(spark, root) == won[0]
    assert len(entries(root)) == 2


def test_a_job_passed_by_many_versions_fails(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(VersionConflict):
        with new_version(spark, root, "star") as late:
            write(spark, late, 1)
            for n in (2, 3, 4, 5):
                with new_version(spark, root, "star") as folder:
                    write(spark, folder, n)
    assert in_use(spark, root) == 5 and len(entries(root)) == 4


def test_what_crashed_jobs_left_is_swept_by_later_ones(spark, tmp_path):
    root = str(tmp_path)
    write(spark, f"{root}/star-0000000001-{'a' * 32}", 3)
    for n in (1, 2, 3):
        with new_version(spark, root, "star") as folder:
            write(spark, folder, n)
    assert not any(name.endswith("a" * 32) for name in entries(root))


def test_a_failed_job_leaves_no_trace(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ZeroDivisionError):
        with new_version(spark, root, "star") as folder:
            write(spark, folder, 1)
            raise ZeroDivisionError
    assert entries(root) == [] and folders(spark, root, "star") == []


def test_a_file_that_is_there_stays(spark, tmp_path):
    path = str(tmp_path / "a.version")
    assert versions._create_if_absent(spark, path, "first")
    assert not versions._create_if_absent(spark, path, "second")
    # A job whose answer was lost finds its own text.
    assert versions._create_if_absent(spark, path, "first")
    assert entries(tmp_path) == ["a.version"]


def test_conditional_writes_keep_what_is_there(spark, tmp_path):
    """The way of object stores, through the same interface."""
    path = str(tmp_path / "b.version")
    versions._write(spark, path, "first", conditional=True)
    with pytest.raises(Exception, match="exist"):
        versions._write(spark, path, "second", conditional=True)
    assert versions._read(spark, path) == "first"


def test_two_star_jobs_at_once(spark, sf_folder, tmp_path):
    root = str(tmp_path)
    warehouse.land_staging(staging_from_orders(spark, sf_folder).limit(200), root)
    together = Barrier(2)

    def job(_):
        together.wait(60)
        try:
            return warehouse.build_star(spark, root)
        except VersionConflict as lost:
            return lost

    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(job, range(2)))
    assert sum(isinstance(r, VersionConflict) for r in results) <= 1
    won = next(r for r in results if not isinstance(r, VersionConflict))
    assert read_table(spark, root, "fact_sales").count() == won["fact_sales"] == 200
    winners = sum(not isinstance(r, VersionConflict) for r in results)
    assert len([n for n in os.listdir(root) if n.startswith("star-")]) == winners
