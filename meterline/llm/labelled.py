"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows with crc32(doc_id as text) mod FOLDS = 0 are held out: no model sees their labels.
FOLDS = 5


def fold(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


def training_rows(
    docs: DataFrame, labels: DataFrame, rows: int, key: str = "doc_id", target: str = "quality"
) -> DataFrame:
    """At most `rows` labelled documents outside of the held-out fold, with a column `target` of 0 and 1.

    The ids are those with the smallest hashes, so the same labels give the same sample. A doc_id whose labels differ, or
    that has none, is left out. Rows that repeat are taken once; of an id with several texts all are taken as far as
    `rows` allows, after one of each other id. The bounded lists of ids and of rows' hashes are sent to the documents.
    """
    single = labels.filter(F.col(key).isNotNull() & F.col(target).isin(0, 1)).groupBy(key)
    single = single.agg(F.min(target).alias("lo"), F.max(target).alias("hi")).filter("lo = hi")
    single = single.filter(fold(key) != 0)
    picked = single.orderBy(F.xxhash64(key), key).limit(rows)
    picked = picked.select(F.col(key).alias("labelled_id"), F.col("lo").cast("int").alias("labelled_as"))
    others = [c for c in docs.columns if c not in (key, target)]
    kept = docs.join(F.broadcast(picked), F.col(key) == F.col("labelled_id"))
    kept = kept.select("labelled_id", "labelled_as", *others, F.xxhash64(*others).alias("labelled_row"))
    # Rows are chosen by their hashes alone, an id's first row ahead of any second.
    each = Window.partitionBy("labelled_id").orderBy("labelled_row")
    chosen = kept.select("labelled_id", "labelled_row").distinct()
    chosen = chosen.withColumn("nth", F.row_number().over(each)).filter(F.col("nth") <= rows)
    chosen = chosen.orderBy("nth", F.xxhash64("labelled_id"), "labelled_id").limit(rows).drop("nth")
    kept = kept.join(F.broadcast(chosen), ["labelled_id", "labelled_row"], "left_semi")
    kept = kept.dropDuplicates(["labelled_id", "labelled_row"])
    return kept.select(F.col("labelled_id").alias(key), *others, F.col("labelled_as").alias(target))
