"""Checks on columns and tables.

All checks of a suite share one pass over the table and one shuffle. A row gives an entry (check, key) for each key and parent check, and one
without a key for each row check that it fails. Keys of parents join the same stream, marked as such. Entries are counted by check and key ahead of
the shuffle, so a hot key, or a check that every row fails, is one row a task.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RowCheck:
    """A condition that marks a failing row."""

    name: str
    failing: Column


@dataclass(frozen=True)
class KeyCheck:
    """Columns that together identify a row."""

    name: str
    columns: tuple[str, ...]
    skip_nulls: bool


@dataclass(frozen=True)
class ParentCheck:
    """Every non-null value of a column occurs in a parent table."""

    name: str
    column: str
    parent: DataFrame
    parent_key: str


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null({column})", F.col(column).isNull())


def accepted_values(column: str, values: Iterable) -> RowCheck:
    return RowCheck(f"accepted_values({column})", ~F.col(column).isin(list(values)))


def non_negative(column: str) -> RowCheck:
    return RowCheck(f"non_negative({column})", F.col(column) < 0)


def positive(column: str) -> RowCheck:
    return RowCheck(f"positive({column})", F.col(column) <= 0)


def unique(*columns: str) -> KeyCheck:
    """Failures are keys that occur more than once; keys with a null are left aside."""
    return KeyCheck(f"unique({','.join(columns)})", columns, True)


def unique_combination(*columns: str) -> KeyCheck:
    """As `unique`, but a null counts as a value of its own."""
    return KeyCheck(f"unique_combination({','.join(columns)})", columns, False)


def relationship(column: str, parent: DataFrame, parent_key: str) -> ParentCheck:
    return ParentCheck(f"relationship({column})", column, parent, parent_key)


def run_checks(df: DataFrame, checks: Iterable) -> DataFrame:
    """One row per check: its name and the number of failures.

    A row check counts rows, `unique` and `unique_combination` keys that repeat, a parent check rows without a parent. Row checks
    stand first in the report.
    """
    checks = sorted(checks, key=lambda c: not isinstance(c, RowCheck))
    entries, parents = [], []
    for i, c in enumerate(checks):
        if isinstance(c, RowCheck):
            entries.append(_entry(i, F.lit(None), F.coalesce(c.failing, F.lit(False))))
        elif isinstance(c, KeyCheck):
            complete = F.lit(True)
            for name in c.columns if c.skip_nulls else ():
                complete = complete & F.col(name).isNotNull()
            entries.append(_entry(i, _key_text([(F.col(n), df.schema[n].dataType) for n in c.columns]), complete))
        else:
            child, parent = df.schema[c.column].dataType, c.parent.schema[c.parent_key].dataType
            # Both ends take the type that Spark compares the two in.
            ends = F.coalesce(F.col(c.column), F.lit(None).cast(parent)), F.coalesce(F.lit(None).cast(child), F.col(c.parent_key))
            kind = df.select(ends[0].alias("key")).schema["key"].dataType
            entries.append(_entry(i, _key_text([(ends[0], kind)]), F.col(c.column).isNotNull()))
            key = _key_text([(ends[1], kind)])
            parents.append(c.parent.where(F.col(c.parent_key).isNotNull()).select(F.lit(i).alias("check"), key.alias("key")))
    if not entries:
        return df.sparkSession.createDataFrame([], "check string, failures long")
    stream = df.select(F.inline(F.array(*entries))).where("check is not null").withColumn("held", F.lit(0))
    for known in parents:
        stream = stream.unionByName(known.withColumn("held", F.lit(1)))
    counted = stream.groupBy("check", "key").agg(F.sum(1 - F.col("held")).alias("rows"), F.max("held").alias("held"))
    failures = []
    for i, c in enumerate(checks):
        value = F.col("rows")
        if isinstance(c, KeyCheck):
            value = F.when(F.col("rows") > 1, 1).otherwise(0)
        elif isinstance(c, ParentCheck):
            value = F.when(F.col("held") == 0, F.col("rows")).otherwise(0)
        failures.append(F.coalesce(F.sum(F.when(F.col("check") == i, value)), F.lit(0)).cast("bigint").alias(f"c{i}"))
    lines = [
        F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)
    ]
    return counted.agg(*failures).select(F.inline(F.array(*lines)))


def _entry(number: int, key: Column, given: Column) -> Column:
    return F.when(given, F.struct(F.lit(number).alias("check"), key.cast("string").alias("key")))


def _key_text(parts: list[tuple[Column, T.DataType]]) -> Column:
    """Text that is equal for two keys if and only if Spark groups them together; null is a value of its own."""
    texts = []
    for value, kind in parts:
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)  # the two zeros are one value
        elif isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.BinaryType):
            value = F.hex(value)
        elif isinstance(kind, (T.ArrayType, T.StructType)):
            value = F.to_json(F.struct(value))
        text = value.cast("string")
        texts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*texts)


def require(df: DataFrame, checks: Iterable) -> None:
    """Raise if any check fails."""
    passed(run_checks(df, checks))


def passed(report: DataFrame) -> None:
    """Raise an error that names the failed checks of a report, if there are any."""
    failed = report.where("failures > 0").collect()
    if failed:
        raise ValueError("; ".join(f"{r['check']}: {r['failures']}" for r in failed))


def query_returns(name: str, result: DataFrame, expected) -> DataFrame:
    """A custom check: a one-value query must give the expected value; numbers are compared as numbers."""
    value = F.col(result.columns[0])
    if isinstance(expected, (int, float, Decimal)) and not isinstance(expected, bool):
        agrees = value.try_cast("double") == F.lit(float(expected))
    else:
        agrees = value.cast("string") == F.lit(expected).cast("string")
    passed = F.coalesce(agrees, F.lit(False))
    return result.select(
        F.lit(name).alias("check"), F.when(passed, 0).otherwise(1).cast("bigint").alias("failures")
    )


def freshness(
    df: DataFrame,
    column: str,
    now: datetime,
    warn_hours: int = 24,
    error_hours: int = 48,
) -> DataFrame:
    """How far the newest row lies behind `now`, and what that means.

    Exactly at a limit still passes it. A table without rows is an error.
    """
    newest = df.agg(F.max(column).cast("timestamp").alias("newest"))
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    behind = (F.unix_micros(at) - F.unix_micros("newest")) / F.lit(3.6e9)
    status = (
        F.when(F.col("newest").isNull() | (F.col("hours_behind") > error_hours), "error")
        .when(F.col("hours_behind") > warn_hours, "warn")
        .otherwise("pass")
    )
    return (
        newest.withColumn("hours_behind", behind)
        .withColumn("status", status)
        .withColumn("newest", F.col("newest").cast("timestamp_ntz"))
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, non-null values. One pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)],
    )
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("n").alias("rows"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*lines)))
