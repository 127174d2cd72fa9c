"""Grouped measures, extreme rows and high-water marks."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_sum(value: Column, scale: int = 6) -> Column:
    """Sum as a double that keeps every digit of every value.

    The part of each value up to `scale` decimals is added up as a whole number, in a plain long inside generated
    code; what a value has beyond that, or beyond 1e9, is added up as a double. So sums of money do not depend on the
    order of the rows, and nothing is rounded away. NaN and infinity behave as in Spark's own sum. A sum of
    whole numbers over 9.2e18 raises an error.
    """
    unit = float(10**scale)
    number = value.cast("double")
    fits = F.abs(number) < F.lit(1e9)
    whole = F.when(fits, F.rint(number * F.lit(unit)).cast("bigint"))
    rest = number - F.coalesce(whole / F.lit(unit), F.lit(0.0))
    total = F.coalesce(F.sum(whole), F.lit(0)).cast("decimal(20,0)")
    exact = (total * F.lit(Decimal(1).scaleb(-scale))).cast("double")
    return F.when(F.count(number) > 0, exact + F.sum(rest))


def exact_avg(value: Column, scale: int = 6) -> Column:
    """Average over the values that are there, from an exact sum, as a double."""
    return exact_sum(value, scale) / F.count(value.cast("double"))


def rollout(
    df: DataFrame,
    keys: Mapping[str, Column],
    sums: Mapping[str, str] = {},
    averages: Mapping[str, str] = {},
    counts: Mapping[str, str] = {},
    scale: int = 6,
) -> DataFrame:
    """Many measures per group in one aggregate: new name -> column.

    Keys are given as expressions under their output name, so a key can never be mistaken for an
    input column of the same name.
    """
    staged = df.select(
        *[expr.alias(f"_key_{name}") for name, expr in keys.items()],
        *sorted({*sums.values(), *averages.values(), *counts.values()}),
    )
    measures = [
        *[exact_sum(F.col(c), scale).alias(n) for n, c in sums.items()],
        *[F.count(F.col(c)).alias(n) for n, c in counts.items()],
        *[exact_avg(F.col(c), scale).alias(n) for n, c in averages.items()],
    ]
    grouped = staged.groupBy(*[f"_key_{name}" for name in keys]).agg(*measures)
    return grouped.withColumnsRenamed({f"_key_{name}": name for name in keys})


def extreme_rows(
    df: DataFrame, by: str, k: int, *, descending: bool = True, ties: list[str]
) -> DataFrame:
    """The first k rows by one column; `ties` settles equal values."""
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(order, *[F.col(t).asc_nulls_last() for t in ties]).limit(k)


def high_water_mark(df: DataFrame, column: str):
    """The largest value of a column, or None."""
    return df.agg(F.max(column)).first()[0]
