"""A corpus from raw documents to packed sequences: five stages, each written and read again.

Every stage works on all rows the one before has kept. All but the last return the columns of documents, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm import byte_cnn, minmax, packing, pfair, tree_rules
from meterline.llm.arrow import keep_rows, prepare
from meterline.llm.queries import packing_of_documents
from meterline.session import scratch_path

#: SQL cannot express the fitted models and the packing.
ORACLE_SQL = None


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Models are fitted on these, so they do not change with what earlier stages keep."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees. Null and empty texts go; rows that repeat are judged each."""
    prepare(spark)
    forest = tree_rules.fit(_raw(spark, sf_dir, "documents"), _raw(spark, sf_dir, "labels"))
    return keep_rows(docs, "text", tree_rules.verdict(forest))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network gives at least the threshold. Null texts are scored as empty ones."""
    prepare(spark)
    net = byte_cnn.fit(_raw(spark, sf_dir, "documents"), _raw(spark, sf_dir, "labels"))
    return keep_rows(docs, "text", byte_cnn.verdict(net))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the smallest id.

    Texts that share a doc_id are judged each; of rows that repeat a doc_id and its text, one stays, picked by a hash of the
    row. Rows without a doc_id all stay: they are in no group. Columns may have any names: they travel in one structure.
    """
    prepare(spark)
    found = minmax.near_duplicates(docs, minmax.MinMax(width=5), ids_link=False)
    kept = found.filter("kept_text AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("hash"),
    )
    out = rows.join(kept, ["id", "hash"], "left_semi")
    repeated = rows.groupBy("id", "hash").count().filter("count > 1 AND id IS NOT NULL").select("id", "hash")
    if not repeated.isEmpty():
        single = out.join(repeated, ["id", "hash"], "left_anti")
        several = out.join(repeated, ["id", "hash"], "left_semi")
        order = F.xxhash64(*[F.col(f"row.`{c}`") for c in docs.columns if not pfair.is_map(docs, c)])
        first = Window.partitionBy("id", "hash").orderBy(order)
        out = single.unionByName(several.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth"))
    return out.select("row.*").unionByName(docs.filter("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; those of sources that weigh more than they hold come again.

    A row of the result is a place in the mix: files and rows stand in its order.
    """
    prepare(spark)
    names = ("of_mix_position", "of_mix_slot", "of_mix_round")
    return pfair.mix_sources(docs, columns=names).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, in the order of the mix within each part of the input."""
    prepare(spark)
    return packing.pack(docs, packing_of_documents())


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read by the next."""
    docs = _raw(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
