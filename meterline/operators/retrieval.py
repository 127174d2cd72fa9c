"""Nearest vectors by cosine similarity, by full comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    StructField,
    StructType,
)

from meterline.session import ship_package

BLOCK = 256
CHUNK = 1024


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a row that is zero or holds anything but numbers becomes zero."""
    rows = np.where(np.isfinite(rows).all(axis=1, keepdims=True), rows, 0.0)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1.0, length)


def _packed(df: DataFrame, key: str, vector: str, size: int, prefix: str) -> DataFrame:
    """Vectors of up to `size` rows in one row each: keys, dimension, unit vectors as bytes."""
    shape = StructType(
        [
            StructField(f"{prefix}_ids", ArrayType(df.schema[key].dataType)),
            StructField(f"{prefix}_dim", IntegerType()),
            StructField(f"{prefix}_vectors", BinaryType()),
        ]
    )
    arrow_shape = to_arrow_schema(shape)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                batch = whole.slice(start, size)
                lengths = pc.unique(pc.list_value_length(batch.column(1))).to_pylist()
                if len(lengths) > 1:
                    raise ValueError(f"vectors of length {sorted(lengths)} in one column")
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                rows = _unit(flat.reshape(batch.num_rows, lengths[0]).astype("float64"))
                columns = [[batch.column(0).to_pylist()], [lengths[0]], [rows.tobytes()]]
                yield pa.RecordBatch.from_pydict(dict(zip(shape.names, columns)), schema=arrow_shape)

    given = df.select(key, vector).where(F.col(vector).isNotNull())
    return given.mapInArrow(pack, shape)


def top_k_cosine(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    query_id: str,
    corpus_id: str,
    query_vector: str = "embedding",
    corpus_vector: str = "embedding",
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """The k most similar corpus rows of each query: query id, corpus id, similarity, rank.

    Both sides are packed, queries into blocks and the corpus, scanned once, into chunks. A chunk has one slot, drawn from its
    ids; a block, the smaller side, is repeated once a slot; an equi-join on the slot so lets every block meet every
    chunk once. No vector passes through the driver. A pair is one matrix product and hands on only the best k
    of the chunk per query, so the number of shuffled rows depends on chunks, not on corpus rows. Equal
    similarities are ordered by corpus id. Null vectors are left out; a vector that is zero or holds nulls or
    infinities is similar to nothing (0). Vectors whose length is not that of the queries are an error, found
    when the result is computed. Without queries the result is empty.
    """
    ship_package(corpus.sparkSession)
    blocks = _packed(queries, query_id, query_vector, block, "query")
    chunks = _packed(corpus, corpus_id, corpus_vector, chunk, "corpus")
    result = StructType(
        [
            StructField("query", queries.schema[query_id].dataType),
            StructField("match", corpus.schema[corpus_id].dataType),
            StructField("similarity", DoubleType()),
        ]
    )
    arrow_result = to_arrow_schema(result)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names, dim, vectors, asked, asked_dim, wanted = (column[i] for column in batch.columns)
                if dim.as_py() != asked_dim.as_py():
                    raise ValueError(f"vectors of length {dim}, queries of length {asked_dim}")
                left = np.frombuffer(vectors.as_buffer()).reshape(len(names), -1)
                right = np.frombuffer(wanted.as_buffer()).reshape(len(asked), -1)
                by_name = np.array(pc.sort_indices(names.values))
                scores = np.round(left[by_name] @ right.T, 12)
                rows = np.argsort(-scores, axis=0, kind="stable")[:k]
                columns = np.broadcast_to(np.arange(len(asked)), rows.shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        asked.values.take(pa.array(columns.ravel())),
                        names.values.take(pa.array(by_name[rows.ravel()])),
                        pa.array(scores[rows.ravel(), columns.ravel()]),
                    ],
                    schema=arrow_result,
                )

    slots = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.withColumn("slot", F.pmod(F.xxhash64("corpus_ids"), F.lit(slots)))
    copies = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint"))))
    met = dealt.join(copies, "slot").select(*chunks.columns, *blocks.columns)
    found = met.mapInArrow(best, result)
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), F.asc("match"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
