"""One row per key, distinct rows and unions of frames that differ."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(
    df: DataFrame, keys: list[str], by: str, first: Column, ties: list[str] | None
) -> DataFrame:
    """Row number 1 of each key.

    Written as a filter directly on the row number so that Spark limits each group ahead of the
    shuffle: a key with very many copies reaches the reducer as one row per input task.
    """
    rest = ties if ties is not None else [c for c in df.columns if c not in (*keys, by)]
    window = Window.partitionBy(*keys).orderBy(first, *[F.col(c).asc_nulls_last() for c in rest])
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], by: str, ties: list[str] | None = None):
    """The row with the largest `by`; nulls come last, equal rows are settled by `ties`."""
    return _one_per_key(df, keys, by, F.col(by).desc_nulls_last(), ties)


def first_per_key(df: DataFrame, keys: list[str], by: str, ties: list[str] | None = None):
    """The row with the smallest `by`; nulls come last, equal rows are settled by `ties`."""
    return _one_per_key(df, keys, by, F.col(by).asc_nulls_last(), ties)


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union all by name. Types must agree: a silent widening would hide a bad cast."""
    for field in a.schema.fields:
        other = b.schema[field.name]
        if other.dataType != field.dataType:
            raise TypeError(
                f"{field.name}: {field.dataType.simpleString()} against "
                f"{other.dataType.simpleString()}"
            )
    return a.unionByName(b)


def union_many(frames: Iterable[DataFrame]) -> DataFrame:
    """Union all of frames with differing columns, missing ones filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
