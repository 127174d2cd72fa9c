"""k-means in whole numbers with heap-ordered bounds: only vectors whose bound expires are looked at again.

A vector's gap is the distance to its second nearest centroid less that to its own one. When centroids move, the gap of a
vector of cluster c shrinks by no more than the way of c plus the longest way of any other. Each cluster adds these up, its drift, and keeps its
vectors in a binary heap by gap plus the drift at the time of the gap. What lies in the heap above the drift of now is surely nearest to
its own centroid. The rest is a connected top of the heap: it is popped, compared with all centroids in exact arithmetic, and pushed.

Vectors are packed into blocks, written once to a table bucketed by block. A block's heaps are one row of a second table with the same
buckets, which a round reads and writes anew, so a round joins the two without a shuffle, and the vectors themselves never move again. Sums and counts
follow the vectors that change their cluster. Only k centroids and their sums pass through the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.arrow import arrow_schema
from meterline.session import scratch_database, scratch_path

#: A gap's rounding errors stay far below this.
MARGIN = 1e-5


@dataclass(frozen=True)
class HeapKMeans:
    """`clusters` centroids over vectors of `width` components in steps of 1 / `scale`, moved `rounds` times; `block` vectors a row."""

    clusters: int = 8
    width: int = 64
    scale: int = 1024
    rounds: int = 10
    seed: int = 3
    block: int = 4096

    def largest(self) -> int:
        """Up to this size of the whole components, squared distances fit a long."""
        return int(((2**63 - 1) / self.width) ** 0.5 / 2) - 1


def squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column a centroid: by a matrix product where doubles hold all terms, else in longs."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centers).max(initial=0)))
    if 4 * most * most * x.shape[1] < 2**53:
        a, c = x.astype(np.float64), centers.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    wide = x.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(1) for c in centers], 1)


def expired(keys: np.ndarray, limit: float) -> np.ndarray:
    """Places of a heap whose key is not above the limit; a place is looked at only if the one above it is among them."""
    found, front = [], np.arange(min(1, len(keys)))
    while len(front):
        hit = front[keys[front] <= limit]
        found.append(hit)
        front = np.concatenate([2 * hit + 1, 2 * hit + 2])
        front = front[front < len(keys)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def exchange(
    keys: np.ndarray, rows: np.ndarray, gone: np.ndarray, new_keys: np.ndarray, new_rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The heap without the places `gone`, which `expired` gave, and with the new entries."""
    gone, n, m = np.sort(gone), len(keys), len(new_keys)
    size = n - len(gone) + m
    k, r = np.empty(max(n, size), np.float64), np.empty(max(n, size), np.int32)
    k[:n], r[:n] = keys, rows
    filled = min(m, len(gone))
    k[gone[:filled]], r[gone[:filled]] = new_keys[:filled], new_rows[:filled]
    touched = gone[gone < size]
    if m > filled:
        k[n:size], r[n:size] = new_keys[filled:], new_rows[filled:]
        above = np.arange(n, size)
        while len(above):
            above = np.unique((above[above > 0] - 1) // 2)
            touched = np.union1d(touched, above)
    else:
        holes = gone[filled:]
        tail = np.setdiff1d(np.arange(size, n), holes, assume_unique=True)
        low = holes[holes < size]
        k[low], r[low] = k[tail], r[tail]
    k, r = k[:size], r[:size]
    # From the deepest level up: whatever stands below a place of a level is in order already.
    level = np.frexp(touched + 1)[1]
    for depth in range(int(level.max(initial=0)), 0, -1):
        _sink(k, r, touched[level == depth])
    return k, r


def _sink(keys: np.ndarray, rows: np.ndarray, at: np.ndarray) -> None:
    """Let entries of one level sink, all at once, as far as an entry below is smaller."""
    n = len(keys)
    while len(at):
        at = at[2 * at + 1 < n]
        left = 2 * at + 1
        right = np.minimum(left + 1, n - 1)
        child = np.where(keys[right] < keys[left], right, left)
        lower = keys[child] < keys[at]
        at, child = at[lower], child[lower]
        keys[at], keys[child] = keys[child], keys[at]
        rows[at], rows[child] = rows[child], rows[at]
        at = child


@dataclass
class Heaps:
    """A block's heaps, one a cluster."""

    keys: list
    rows: list

    @classmethod
    def empty(cls, k: int) -> Heaps:
        return cls([np.zeros(0)] * k, [np.zeros(0, np.int32)] * k)

    def pack(self) -> tuple[bytes, bytes, bytes]:
        ends = np.cumsum([len(x) for x in self.keys]).astype(np.int64)
        return ends.tobytes(), np.concatenate(self.keys).tobytes(), np.concatenate(self.rows).astype(np.int32).tobytes()

    @classmethod
    def unpack(cls, ends: bytes, keys: bytes, rows: bytes) -> Heaps:
        cut = np.frombuffer(ends, np.int64)[:-1]
        return cls(np.split(np.frombuffer(keys), cut), np.split(np.frombuffer(rows, np.int32), cut))

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int32)
        for c, rows in enumerate(self.rows):
            out[rows] = c
        return out


def advance(x: np.ndarray, heaps: Heaps | None, centers: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray]:
    """The heaps after the centroids have moved, and by how much that changes each cluster's sums and count."""
    k = len(centers)
    if heaps is None:
        heaps, gone = Heaps.empty(k), [np.zeros(0, np.int64)] * k
        popped, came = np.arange(len(x)), np.full(len(x), -1)
    else:
        gone = [expired(keys, d + MARGIN) for keys, d in zip(heaps.keys, drift)]
        popped = np.concatenate([rows[g] for rows, g in zip(heaps.rows, gone)]).astype(np.int64)
        came = np.repeat(np.arange(k), [len(g) for g in gone])
    far = squared(x[popped], centers)
    near = far.argmin(1) if len(popped) else np.zeros(0, np.int64)
    own = np.take_along_axis(far, near[:, None], 1)[:, 0] if len(popped) else np.zeros(0, np.int64)
    if k > 1:
        second = np.where(np.arange(k) == near[:, None], np.iinfo(np.int64).max, far).min(1) if len(popped) else own
        key = np.sqrt(second.astype(np.float64)) - np.sqrt(own.astype(np.float64)) + drift[near]
    else:
        key = np.full(len(popped), np.inf)
    out, moved = Heaps.empty(k), np.zeros((k, x.shape[1] + 1), np.int64)
    for c in range(k):
        to = near == c
        out.keys[c], out.rows[c] = exchange(heaps.keys[c], heaps.rows[c], gone[c], key[to], popped[to])
        for sign, which in ((1, to & (came != c)), (-1, (came == c) & ~to)):
            moved[c, :-1] += sign * x[popped[which]].sum(0, dtype=np.int64)
            moved[c, -1] += sign * int(which.sum())
    return out, moved


VECTORS = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("vectors", T.BinaryType()),
    ]
)
STATE = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("ends", T.BinaryType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("rows", T.BinaryType()),
        T.StructField("moved", T.ArrayType(T.LongType())),
    ]
)
PLACED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()),
    ]
)


def _kept(vectors: DataFrame, how: HeapKMeans) -> DataFrame:
    limit = how.largest() / how.scale
    fine = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < limit, F.lit(False)))
    sound = (F.size("embedding") == how.width) & fine
    return vectors.select("vec_id", "embedding").filter(F.coalesce(sound, F.lit(False)))


def _whole(rows: np.ndarray, how: HeapKMeans) -> np.ndarray:
    return np.floor(how.scale * np.asarray(rows, np.float64)).astype(np.int32)


def _packed(kept: DataFrame, how: HeapKMeans) -> DataFrame:
    schema = arrow_schema(VECTORS)

    def pack(batches):
        from pyspark import TaskContext

        block, ids, parts = TaskContext.get().partitionId() << 32, [], []

        def row():
            values = _whole(np.concatenate(parts), how)
            columns = [[block], pa.array([pa.concat_arrays(ids).to_pylist()], schema.field(1).type), [values.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), columns[1], pa.array(columns[2], pa.binary())], schema=schema)

        held = 0
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                piece = batch.slice(low, how.block - held)
                low += piece.num_rows
                held += piece.num_rows
                ids.append(piece.column(0).cast(pa.int64()))
                flat = piece.column(1).flatten().to_numpy(zero_copy_only=False)
                parts.append(flat.reshape(-1, how.width).astype(np.float64))
                if held == how.block:
                    yield row()
                    block, ids, parts, held = block + 1, [], [], 0
        if held:
            yield row()

    return kept.mapInArrow(pack, VECTORS)


def _matrix(cell: pa.Scalar, how: HeapKMeans) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.int32).reshape(-1, how.width)


def _round(blocks: DataFrame, centers: np.ndarray, drift: np.ndarray, how: HeapKMeans) -> DataFrame:
    """One round's state from the blocks: with the state of the round before beside the vectors, or without for the first."""
    schema = arrow_schema(STATE)
    later = "keys" in blocks.columns

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cells = [column[i] for column in batch.columns]
                heaps = Heaps.unpack(*[c.as_py() for c in cells[2:]]) if later else None
                heaps, moved = advance(_matrix(cells[1], how), heaps, centers, drift)
                columns = [[cells[0].as_py()], *[[x] for x in heaps.pack()], [moved.ravel().tolist()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema
                )

    return blocks.select("block", "vectors", *(["ends", "keys", "rows"] if later else [])).mapInArrow(run, STATE)


def _place(blocks: DataFrame, centers: np.ndarray, how: HeapKMeans) -> DataFrame:
    """A row a vector: its cluster as the heaps hold it, and its exact squared distance."""
    schema = arrow_schema(PLACED)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, cell, ends, keys, rows = (column[i] for column in batch.columns)
                x = _matrix(cell, how)
                near = Heaps.unpack(ends.as_py(), keys.as_py(), rows.as_py()).clusters(len(x))
                apart = x.astype(np.int64) - centers[near]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(near), pa.array((apart * apart).sum(1))], schema=schema
                )

    return blocks.select("ids", "vectors", "ends", "keys", "rows").mapInArrow(run, PLACED)


def _starts(kept: DataFrame, how: HeapKMeans) -> np.ndarray:
    ranked = kept.filter(F.col("vec_id").isNotNull())
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = ranked.orderBy(digest, "embedding").limit(how.clusters).collect()
    return _whole([r["embedding"] for r in first], how).reshape(len(first), how.width).astype(np.int64)


def cluster(vectors: DataFrame, how: HeapKMeans = HeapKMeans()) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each kept row of (vec_id, embedding).

    Kept are embeddings with exactly `width` components, none null or non-finite, and none so large that a squared distance
    leaves the long (with 64 components about 185,000). Components become floor(scale * x). The first centroids are the kept vectors with the
    smallest sha256 of `seed:vec_id`, of rows with one id the smaller embedding first; with fewer vectors there are fewer centroids. Distances tie for the
    smaller number; a centroid without vectors stays. Rows that repeat each count; a row without an id is clustered but
    starts no centroid, and if no row has one the result is empty, as for an empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, how)
    centers = _starts(kept, how)
    if not len(centers):
        return _empty(spark)
    base = scratch_database(spark, "heaps")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.bucketBy(buckets, "block").saveAsTable(f"{base}.{name}")
        return spark.table(f"{base}.{name}")

    blocks = store(_packed(kept, how).repartition(buckets, "block"), "vectors")
    k, beside = len(centers), blocks
    drift, totals = np.zeros(k), np.zeros((k, how.width + 1), object)
    for turn in range(how.rounds + 1):
        state = store(_round(beside, centers, drift, how), f"state{turn}")
        beside = blocks.join(state.drop("moved").hint("merge"), "block")
        if turn:
            spark.sql(f"DROP TABLE {base}.state{turn - 1}")
        if turn == how.rounds:
            break
        totals = totals + _moved(state, k, how)
        new = np.array([[s // t[-1] for s in t[:-1]] if t[-1] else c for t, c in zip(totals.tolist(), centers.tolist())], np.int64)
        way = np.sqrt(((new - centers).astype(np.float64) ** 2).sum(1))
        if not way.any():
            break
        others = [max([0.0, *np.delete(way, c)]) for c in range(k)]
        centers, drift = new, drift + way + np.array(others)
    path = scratch_path(spark, "placed")
    _place(beside, centers, how).write.parquet(path)
    spark.sql(f"DROP DATABASE {base} CASCADE")
    placed = spark.read.schema(PLACED).parquet(path)
    sums = {r[0]: r[1] for r in placed.groupBy("cluster").agg(F.sum("distance")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    facts = [(c, sums.get(c, 0), sum(sums.values()), digests[c]) for c in range(k)]
    shape = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    out = placed.join(F.broadcast(spark.createDataFrame(facts, shape)), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(state: DataFrame, k: int, how: HeapKMeans) -> np.ndarray:
    """The changes of all blocks added up; a longer sum than a long is an error, not a wrong number."""
    rows = state.select(F.posexplode("moved")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    out = np.zeros(k * (how.width + 1), object)
    for r in rows:
        out[r["pos"]] = r["total"]
    return out.reshape(k, how.width + 1)


def _empty(spark: SparkSession) -> DataFrame:
    shape = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    return spark.createDataFrame([], shape)
