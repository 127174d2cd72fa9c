"""Connected components of a graph of links, by alternating stars, and joins that deal hot keys over several tasks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import scratch_path


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Deal:
    """A join of many rows a key with one row a key, in which the rows of a hot key go to several tasks.

    `hot` has the hot keys and their `slots`; other keys have one slot. Rows are dealt by a hash of the column `spread`.
    """

    hot: DataFrame
    key: str
    spread: str

    def join(self, rows: DataFrame, facts: DataFrame) -> DataFrame:
        """Inner join on the key: each of the rows has one slot of its key, each of the facts is there once a slot."""
        hot = F.broadcast(self.hot)
        slot = F.pmod(F.xxhash64(self.spread), F.coalesce("slots", F.lit(1)))
        dealt = rows.join(hot, self.key, "left").withColumn("slot", slot).drop("slots")
        copies = facts.join(hot, self.key, "left")
        copies = copies.withColumn("slot", F.explode(F.expr("sequence(0L, coalesce(slots, 1L) - 1)"))).drop("slots")
        return dealt.join(copies.hint("merge"), [self.key, "slot"]).drop("slot")


def deal_of(counts: DataFrame, total: int, key: str, spread: str) -> Deal:
    """Deal keys, given with their rows `n`, so that a slot holds about a tenth of an average task's rows of `total`.

    Fewer than total / most keys have more than `most` rows: at most ten a task, or `total` if that is less. So the list of
    hot keys does not grow with the rows and can be broadcast.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, total // (10 * tasks))
    hot = counts.filter(F.col("n") > most)
    return Deal(hot.select(key, F.ceil(F.col("n") / most).cast("long").alias("slots")), key, spread)


def components(spark: SparkSession, links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component) for every id with a link to a smaller id in its component.

    The component is the smallest id that can be reached; an id that is missing in the result is the
    smallest of its own. Links may be in either direction and may repeat; null ends and loops are left
    out. Each round replaces a link by one to the smallest neighbour, so the rounds grow with the logarithm
    of the longest path, and end once the links are stars around smallest ids. Rounds are joins on the id, in which the links of an id that has very many are dealt over
    several tasks; smallest neighbours are aggregated ahead of the shuffle. Each round is written to the shared
    folder, so a lost executor costs one round at most.
    """
    pair = links.select(
        F.greatest(left, right).cast("long").alias("u"), F.least(left, right).cast("long").alias("v")
    )
    pair = pair.filter(F.col("u") != F.col("v")).distinct()
    pair = write_scratch(pair, "links")
    while (crossed := _crossed(pair))[0]:
        both = pair.unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        # An id has no more links after the first half of a round than before, so both halves deal the same ids.
        deal = deal_of(least, 2 * crossed[1], "u", "v")
        least = least.select("u", F.least("u", "m").alias("m"))
        large = deal.join(both.filter("v > u"), least)
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        lower = deal.join(large, smallest).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = lower.unionByName(smallest.withColumnRenamed("m", "v")).distinct()
        pair = write_scratch(small, "links")
    return pair.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _crossed(pair: DataFrame) -> tuple[int, int]:
    """Ids with links to two smaller ids, or to smaller and larger ones, and the number of links.

    Without such ids the links are stars, each around the smallest id of its component: nothing is left to do.
    """
    ends = pair.select(F.inline(F.expr("array(struct(u AS id, 1L AS up, 0 AS down), struct(v AS id, 0L AS up, 1 AS down))")))
    ids = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = ids.agg(F.count(F.when((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)), 1)), F.sum("up")).first()
    return row[0], row[1] or 0
