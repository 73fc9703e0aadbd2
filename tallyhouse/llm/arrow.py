"""Columns computed from texts in Arrow batches, inside the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType, _parse_datatype_string

_ROOT = str(Path(__file__).resolve().parents[2])


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def set_batch_rows(spark: SparkSession, rows: int = 500) -> None:
    """Hand at most ``rows`` rows at once to Python, as rows of whole texts or sets are wide.
    A session's setting, for applications; operators leave it as it is."""
    spark.conf.set(_BATCH_ROWS, rows)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The same for jobs that end inside; the session's setting is put back."""
    before = spark.conf.get(_BATCH_ROWS)
    set_batch_rows(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def map_batches(rows: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``rows.mapInArrow``. Python workers that share the driver's folders, as in a local
    session, find this package where the driver found it; to others it is shipped with
    ``--py-files``."""
    rows.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return rows.mapInArrow(run, schema)


def annotate(
    rows: DataFrame,
    text_column: str,
    fields: Mapping[str, str | DataType],
    compute: Callable[[pa.Array], Sequence],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``rows``, or their columns ``keep``, with ``fields`` computed from the text column.

    ``compute`` takes a batch's texts and returns the values of each field in turn. Rows
    keep their order and partitions; nothing is shuffled.
    """
    kept = list(rows.columns if keep is None else keep)
    places = [rows.columns.index(name) for name in kept]
    text = rows.columns.index(text_column)
    added = [
        StructField(n, _parse_datatype_string(t) if isinstance(t, str) else t) for n, t in fields.items()
    ]
    kinds = [to_arrow_type(f.dataType) for f in added]
    names = [*kept, *fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = compute(batch.column(text))
            arrays = [
                v if isinstance(v, pa.Array) and v.type == kind else pa.array(v, kind)
                for v, kind in zip(values, kinds, strict=True)
            ]
            yield pa.record_batch([*(batch.column(p) for p in places), *arrays], names)

    schema = StructType([*(rows.schema[p] for p in places), *added])
    return map_batches(rows, run, schema)
