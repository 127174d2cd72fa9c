"""Joins between a fact and its lookups, and anti joins between two large sides.

No lookup is broadcast by hint. Spark broadcasts a side only while its size, known from the files
or measured at run time, is below `spark.sql.autoBroadcastJoinThreshold`; a larger lookup turns
into a sort-merge join in which adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: Column | str,
    dim_key: str,
    attributes: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add attributes of a lookup: new name -> lookup column. The lookup key is unique."""
    key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    side = dim.select(
        F.col(dim_key).alias("_key"), *[F.col(src).alias(new) for new, src in attributes.items()]
    )
    return fact.join(side, key == F.col("_key"), how).drop("_key")


def two_roles(
    fact: DataFrame,
    dim: DataFrame,
    dim_key: str,
    roles: Mapping[str, str],
    attributes: list[str],
    how: str = "left",
) -> DataFrame:
    """Join one lookup once per role: role prefix -> fact key column."""
    out = fact
    for role, key in roles.items():
        out = lookup(out, dim, key, dim_key, {f"{role}_{a}": a for a in attributes}, how)
    return out


def lookup_or_default(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    new: str,
    source: str,
    default_key,
    default_label,
) -> DataFrame:
    """Left lookup on a key that falls back to a default; a missing label does as well."""
    key = F.coalesce(F.col(fact_key), F.lit(default_key))
    named = lookup(fact, dim, key, dim_key, {new: source})
    return named.withColumns({fact_key: key, new: F.coalesce(F.col(new), F.lit(default_label))})


def anti_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `left` without a partner in `right`; null keys have no partner and stay.

    The right side is reduced to its distinct keys ahead of the shuffle. Spark broadcasts them where their measured size
    allows; else both sides are shuffled, and adaptive execution splits a key that makes up much of the left.
    """
    return left.join(right.select(*on).distinct(), on, "left_anti").select(*left.columns)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; null child keys are not orphans.

    Counting before the join leaves one row per key, so a hot key costs nothing.
    """
    counted = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = parent.select(F.col(parent_key).alias("key")).distinct()
    return counted.join(parents, "key", "left_anti")
