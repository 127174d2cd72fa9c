"""Small helpers for functions that map Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from meterline.session import ship_package

#: Rows per Arrow batch: long texts must not fill a worker's memory.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and send the package to the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.cast(column, pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def portions(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes; a longer row stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def arrow_schema(schema: T.StructType) -> pa.Schema:
    """Plain Arrow types; dates and times without a zone are not needed by the callers."""
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])


def keep_rows(df: DataFrame, text: str, verdict) -> DataFrame:
    """Rows whose text passes `verdict` (string column to a boolean array); columns stay as they are."""
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdict(batch.column(at))))

    return df.mapInArrow(run, df.schema)
