"""A side table that tells in which partitions of a table a key is held.

It has a row (hash of the key, partition) for each key, in folders by a prefix of the hash. An upsert asks it for the partitions to
rewrite and reads nothing else of the table. Rows are added ahead of the change that needs them, never taken out:
a row too many makes a load rewrite a partition for nothing, it loses no key. Building the index anew drops such rows. Loads that do not
keep the index are refused on a table that has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.layout import set_properties, table_properties

INDEXED, PREFIXES = "meterline.key_index", "meterline.key_prefixes"


def build_key_index(spark: SparkSession, table: str, key: list[str], part: str, prefixes: int = 16) -> None:
    """Build or rebuild the index of a table on the columns of its key; more prefixes suit larger tables."""
    rows = _entries(spark.table(table), table, key, part, prefixes).distinct()
    rows.hint("rebalance", "prefix").write.mode("overwrite").partitionBy("prefix").saveAsTable(index_table(table))
    set_properties(spark, table, {INDEXED: ",".join(key), PREFIXES: str(prefixes)})


def index_table(table: str) -> str:
    return f"{table}__keys"


def keys_of(spark: SparkSession, table: str) -> list[str] | None:
    """The columns of the table's key index, if it has one."""
    names = table_properties(spark, table).get(INDEXED)
    return names.split(",") if names else None


def refuse_indexed(spark: SparkSession, table: str) -> None:
    if names := keys_of(spark, table):
        raise ValueError(f"{table} has a key index on {names}: only an upsert on these columns keeps it")


def partitions_of(source: DataFrame, table: str, key: list[str], part: str) -> DataFrame:
    """Partitions of the table that may hold a key of the source, as a column named like the partition."""
    asked, held = _asked(source, table, key, part)
    return held.join(asked.select("key_hash").distinct(), "key_hash", "left_semi").select("part").distinct().toDF(part)


def note_keys(source: DataFrame, table: str, key: list[str], part: str) -> None:
    """Add the source's keys where they are new, or new in their partition."""
    asked, held = _asked(source, table, key, part)
    same = (F.col("a.key_hash") == F.col("h.key_hash")) & F.col("a.part").eqNullSafe(F.col("h.part"))
    new = asked.alias("a").join(held.alias("h"), same, "left_anti")
    new.hint("rebalance", "prefix").write.insertInto(index_table(table))


def _asked(source: DataFrame, table: str, key: list[str], part: str) -> tuple[DataFrame, DataFrame]:
    """The source's entries, and the index's in the folders that these can be in."""
    spark = source.sparkSession
    prefixes = int(table_properties(spark, table)[PREFIXES])
    asked = _entries(source, table, key, part, prefixes).distinct()
    folders = [r[0] for r in asked.select("prefix").distinct().collect()]
    return asked, spark.table(index_table(table)).where(F.col("prefix").isin(folders))


def _entries(rows: DataFrame, table: str, key: list[str], part: str, prefixes: int) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.sparkSession.table(table).schema.fields}
    key_hash: Column = F.xxhash64(*[F.col(k).cast(kinds[k]) for k in key])
    return rows.select(key_hash.alias("key_hash"), F.col(part).cast(kinds[part]).alias("part")).withColumn(
        "prefix", F.pmod("key_hash", F.lit(prefixes)).cast("int")
    )
