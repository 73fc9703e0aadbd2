"""Intermediate tables, written once and read as often as needed.

A written table cuts the lineage, survives the loss of executors, and has a size
the planner can read when it chooses between a broadcast and a shuffle join. Tables lie in
the run folder of the session; those written inside a ``released`` block in a folder of that
job, which goes when the block ends.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock
from typing import TypeVar
from urllib.parse import unquote, urlparse
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_released_at_exit: set[str] = set()

_SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes: dict[SparkSession, tuple[int, str | None]] = {}
_writes_lock = Lock()

T = TypeVar("T")


class _Job:
    """A folder of intermediate tables, kept while anyone holds a lease on it."""

    def __init__(self, spark: SparkSession):
        self.path = f"{_run_folder(spark)}/job-{uuid4().hex}"
        self._leases, self._lock = 0, Lock()

    def take(self) -> None:
        with self._lock:
            self._leases += 1

    def give_back(self) -> bool:
        """Whether this was the last lease."""
        with self._lock:
            self._leases -= 1
            return not self._leases


_job: ContextVar[_Job | None] = ContextVar("job", default=None)


def _run_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(base).scheme == "file" and not _is_local(spark):
            raise RuntimeError(
                f"the executors of {spark.sparkContext.master} do not share {base}; "
                "set spark.checkpoint.dir to a folder that they share"
            )
    folder = f"{base.rstrip('/')}/tallyhouse-{spark.sparkContext.applicationId}"
    if folder not in _released_at_exit:
        _released_at_exit.add(folder)
        atexit.register(_release_at_exit, spark, folder)
    return folder


def _is_local(spark: SparkSession) -> bool:
    """Whether the executors are threads of the driver, so that its disk is theirs."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_folder(spark: SparkSession) -> str:
    """The folder of the job that the calling context is in, else the run folder of the session:
    in the folder ``spark.checkpoint.dir`` names, which all executors share, else in the warehouse
    folder. On a cluster a warehouse folder on a machine's own disk is refused. The run
    folder is removed at the latest when the driver exits."""
    job = _job.get()
    return job.path if job else _run_folder(spark)


def scratch_path(spark: SparkSession, label: str = "stage") -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are removed when it is written; no other plan can
    use them. Else executors keep them until the driver's garbage collection finds that nothing
    refers to them, which is seldom on a driver with much memory, and those of all steps add up.
    The session's setting is the caller's again after the last write at work in it."""
    with _writes_lock:
        at_work, before = _writes.get(spark) or (0, spark.conf.get(_SHUFFLES_REMOVED, None))
        _writes[spark] = at_work + 1, before
        spark.conf.set(_SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        with _writes_lock:
            at_work, before = _writes.pop(spark)
            if at_work > 1:
                _writes[spark] = at_work - 1, before
            elif before is None:
                spark.conf.unset(_SHUFFLES_REMOVED)
            else:
                spark.conf.set(_SHUFFLES_REMOVED, before)


def stage(rows: DataFrame) -> DataFrame:
    """``rows`` written to the run folder and read back."""
    spark = rows.sparkSession
    path = scratch_path(spark)
    with shuffles_removed(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def in_parts(rows: DataFrame, parts: int) -> Iterator[DataFrame]:
    """``rows`` written to the run folder and read back in up to ``parts`` parts, of about equally many
    whole files each, for steps that would take too much disk for all rows at once. A part is
    removed when the next one is asked for."""
    spark = rows.sparkSession
    files = sorted(unquote(file) for file in stage(rows).inputFiles())
    for some in [files[i::parts] for i in range(min(parts, len(files)))]:
        yield spark.read.schema(rows.schema).parquet(*some)
        for file in some:
            release(spark, file)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed at the end, also after a failure.

    The block belongs to the calling context: blocks of other threads have folders of their own,
    and threads started by ``together`` write into the caller's. Of nested blocks the outermost
    counts; its folder stays as long as a nested block is open in any thread.
    """
    job = _job.get() or _Job(spark)
    job.take()
    token = _job.set(job)
    try:
        yield
    finally:
        _job.reset(token)
        if job.give_back():
            release(spark, job.path)


def together(calls: Mapping[str, Callable[[], T]], at_once: int | None = None) -> dict[str, T]:
    """Results by name of calls that do not depend on each other: their Spark jobs are submitted
    together, and one fills the cluster while another tails off. Each runs in a copy of the
    caller's context."""
    if not calls:
        return {}
    with ThreadPoolExecutor(at_once or len(calls)) as pool:
        started = {name: pool.submit(copy_context().run, call) for name, call in calls.items()}
        return {name: future.result() for name, future in started.items()}


def release(spark: SparkSession, path: str | None = None) -> None:
    """Remove one intermediate table, or the whole run folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path or scratch_folder(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _release_at_exit(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:
        release(spark, folder)
