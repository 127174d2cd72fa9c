"""Near-duplicate embeddings with an inverted multi-index.

Vectors are scaled to length one and cut in halves. Each half has its own codebook, learned by k-means on a
bounded sample; a pair of codewords is a cell of the product grid, and every vector is indexed in the cell of its
nearest codewords. As a query, a vector visits the cells in the order of how far it would have to move to get there: by at
least `m1` in the first half and `m2` in the second, the distances to the planes between its own codeword and the
other, so cells come in ascending m1² + m2² (the multi-sequence order). It stops where the wanted recall is
reached. That point is calibrated on the sample: vectors exactly at the threshold are put around sampled ones in
random directions, and the walk goes as far as the stated share of them needs. Visited cells are verified in double
precision, so no pair below the threshold is linked.

How hot groups are kept small: equal vectors are one node with a count; the vectors of a cell and its visitors are dealt
into tiles of a bounded size, each pair of tiles is one task's matrix product, and a tile gives out one row a vector:
its number of links and a link to the smallest vector of its component within the tile.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.components import components, write_scratch


@dataclass(frozen=True)
class MultiIndex:
    """`sample` bounds the vectors that codebooks and walk are fitted on (not what is indexed).

    `per_cell` is the mean number of vectors wanted in a cell; `codewords` bounds each codebook, and with it what
    is sent to every task. `tile` bounds members and visitors of one task's matrix.
    """

    threshold: float = 0.98
    recall: float = 0.9999
    sample: int = 16_384
    per_cell: int = 512
    codewords: int = 256
    tile: int = 512
    seed: int = 11


def unit(rows: list) -> np.ndarray:
    """Rows of equal length scaled to length one, in double precision."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def codebook(x: np.ndarray, k: int, random, rounds: int = 10) -> np.ndarray:
    """k-means; a codeword without vectors stays where it is."""
    x = np.unique(x, axis=0)
    centers = x[random.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        near = squared(x, centers).argmin(1)
        n = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


@dataclass
class Grid:
    """Two codebooks and how far a query walks, as the square of m1² + m2²'s root."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    def cut(self) -> int:
        return self.first.shape[1]

    def homes(self, x: np.ndarray) -> np.ndarray:
        a = squared(x[:, : self.cut()], self.first).argmin(1)
        b = squared(x[:, self.cut() :], self.second).argmin(1)
        return a * len(self.second) + b

    def margins(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each half, the distance to the plane that parts the own codeword from each other one."""
        out = []
        for half, book in ((x[:, : self.cut()], self.first), (x[:, self.cut() :], self.second)):
            d = squared(half, book)
            own = d.argmin(1)
            apart = np.sqrt(squared(book, book))[own]
            m = (d - d.min(1, keepdims=True)) / np.maximum(2 * apart, 1e-12)
            m[np.arange(len(m)), own] = 0
            out.append(m)
        return out[0], out[1]

    def walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that a query visits, nearest first within a row."""
        a, b = self.margins(x)
        limit = self.reach + 1e-12
        rows, cells = [], []
        for i in range(len(x)):
            ia, ib = np.argsort(a[i], kind="stable"), np.argsort(b[i], kind="stable")
            sa, sb = a[i][ia] ** 2, b[i][ib] ** 2
            ends = np.searchsorted(sb, limit - sa, side="right")  # cells of each row of the grid
            used = int((ends > 0).sum())
            at = np.concatenate([ia[k] * len(self.second) + ib[: ends[k]] for k in range(used)])
            far = np.concatenate([sa[k] + sb[: ends[k]] for k in range(used)])
            cells.append(at[np.argsort(far, kind="stable")])
            rows.append(np.full(len(at), i))
        return np.concatenate(rows), np.concatenate(cells)


def calibrate(grid: Grid, x: np.ndarray, how: MultiIndex, random) -> float:
    """How far to walk so that the stated share of vectors exactly at the threshold is met.

    Each sampled vector gets as many neighbours as it takes to judge that share.
    """
    enough = min(int(20 / max(1 - how.recall, 1e-6)), 200_000)
    return float(
        np.quantile(
            np.concatenate([_walks(grid, x, how, random) for _ in range(max(1, -(-enough // len(x))))]),
            how.recall,
            method="higher",
        )
    )


def _walks(grid: Grid, x: np.ndarray, how: MultiIndex, random) -> np.ndarray:
    """Square of the distance to walk from each vector to one at the threshold, in a random direction."""
    noise = random.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.sqrt((noise * noise).sum(1, keepdims=True))
    c = min(how.threshold, 1.0)
    near = c * x + np.sqrt(1 - c * c) * noise
    a, b = grid.margins(x)
    home = grid.homes(near)
    return (
        a[np.arange(len(x)), home // len(grid.second)] ** 2
        + b[np.arange(len(x)), home % len(grid.second)] ** 2
    )


def fit(x: np.ndarray, n: int, how: MultiIndex) -> Grid:
    """Codebooks for n vectors in all from a sample x of unit vectors."""
    random = np.random.default_rng(how.seed)
    k = int(np.clip(np.ceil(np.sqrt(n / how.per_cell)), 1, how.codewords))
    cut = max(x.shape[1] // 2, 1)
    grid = Grid(codebook(x[:, :cut], k, random), codebook(x[:, cut:], k, random), 0.0)
    grid.reach = calibrate(grid, x, how, random)
    return grid


def compare(members: np.ndarray, visitors: np.ndarray, member_n, visitor_ids, member_ids, threshold):
    """Number of rows that each visitor links with, and links to the smallest id of its component here."""
    linked = visitors @ members.T >= threshold
    same = visitor_ids[:, None] == member_ids[None, :]
    linked &= ~same
    counts = linked @ member_n
    v, m = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    if not len(v):
        return counts, np.zeros(0, np.int64), np.zeros(0, np.int64)
    sub = linked[np.ix_(v, m)]
    left, right = visitor_ids[v].copy(), member_ids[m].copy()
    big = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(sub, right[None, :], big).min(1))
        new_right = np.minimum(right, np.where(sub, new_left[:, None], big).min(0))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    ids = np.concatenate((visitor_ids[v], member_ids[m]))
    low = np.concatenate((left, right))
    return counts, ids[low < ids], low[low < ids]


def near_duplicates(
    vectors: DataFrame,
    how: MultiIndex = MultiIndex(),
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | None = "label",
) -> DataFrame:
    """One row for each row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors are compared within their label (all with each other if `label` is None) and within their number of
    dimensions. A null label, a null vector, one of zeros or without components, and one with a null or non-finite component
    link with nothing. Rows with equal vectors link with each other without a comparison, also when their ids are
    equal. n_links counts the other rows at or over the threshold that the walk found; component_id is the smallest
    id that links reach; kept is id = component_id. A row with a null id gets a null component, is kept and counts for no
    one. Other columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    group = F.lit(0) if label is None else F.col(label)
    rows = vectors.select(
        F.col(key).cast("long").alias("id"),
        group.alias("label"),
        F.col(vector).alias("vec"),
        F.expr(
            f"size(`{vector}`) > 0 AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < "
            f"double('Infinity')) AND exists(`{vector}`, x -> x != 0)"
        ).alias("sound"),
    )
    usable = rows.filter("id IS NOT NULL AND label IS NOT NULL AND sound")
    nodes = usable.groupBy("label", "vec").agg(F.min("id").alias("node"), F.count("*").alias("n"))
    nodes = write_scratch(nodes.withColumn("dims", F.size("vec")), "index-nodes")
    own = rows.join(nodes.select("label", "vec", "node", "n"), ["label", "vec"], "left")
    own = own.select("id", "node", "n")

    found = []
    for dims, n in sorted(tuple(r) for r in nodes.groupBy("dims").count().collect()):
        found.append(_linked(nodes.filter(F.col("dims") == dims), int(n), how))
    if not found:
        out = own.withColumn("links", F.lit(None).cast("long")).withColumn("component", F.col("node"))
    else:
        facts = found[0]
        for more in found[1:]:
            facts = facts.unionByName(more)
        facts = write_scratch(facts, "index-links")
        counts = facts.filter("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
        # Rows that repeat an id with another vector are one node: link the vectors' smallest ids.
        same = usable.groupBy("id").agg(F.count("*").alias("c")).filter("c > 1").select("id")
        same = usable.join(same, "id").join(nodes.select("label", "vec", "node"), ["label", "vec"])
        links = facts.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
        links = links.unionByName(same.filter("id != node").select(F.col("id").alias("a"), F.col("node").alias("b")))
        reach = components(spark, links).withColumnRenamed("id", "node")
        out = own.join(counts, "node", "left").join(reach, "node", "left")
    smallest = F.coalesce("component", "node", "id")
    out = out.withColumn("component_id", F.when(F.col("id").isNotNull(), smallest))
    return out.select(
        F.col("id").alias("vec_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _linked(nodes: DataFrame, n: int, how: MultiIndex) -> DataFrame:
    """(node, links, null) with the number of rows linked, and (node, null, other) for links between nodes."""
    spark = nodes.sparkSession
    picked = nodes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(how.sample).toArrow()
    grid = fit(unit(picked.column(0).to_pylist()), n, how)
    sent = spark.sparkContext.broadcast(grid)
    label_kind = nodes.schema["label"].dataType.simpleString()

    def visits(batches):
        for batch in batches:
            x = unit(batch.column(0).to_pylist())
            for low in range(0, len(x), 256):
                part = x[low : low + 256]
                home = sent.value.homes(part)
                rows, cells = sent.value.walk(part)
                taken = pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(pa.array(rows + low)),
                        pa.array(cells),
                        batch.column(2).take(pa.array(rows + low)),
                        pa.array(home[rows] == cells),
                    ],
                    names=["label", "cell", "node", "home"],
                )
                yield taken

    seen = nodes.select("vec", "label", "node").mapInArrow(
        visits, f"label {label_kind}, cell long, node long, home boolean"
    )
    seen = write_scratch(seen, "index-cells")
    sizes = seen.groupBy("label", "cell").agg(
        F.count("*").alias("visitors"), F.count(F.when(F.col("home"), 1)).alias("members")
    )
    sizes = sizes.filter("members > 0").select(
        "label",
        "cell",
        F.ceil(F.col("members") / how.tile).cast("int").alias("mt"),
        F.ceil(F.col("visitors") / how.tile).cast("int").alias("vt"),
    )
    dealt = seen.join(sizes, ["label", "cell"])
    slot = F.pmod(F.xxhash64("node"), F.col("mt")).cast("int")
    members = dealt.filter("home").withColumn("m", slot).withColumn("v", F.explode(F.expr("sequence(0, vt - 1)")))
    slot = F.pmod(F.xxhash64("node"), F.col("vt")).cast("int")
    visitors = dealt.withColumn("v", slot).withColumn("m", F.explode(F.expr("sequence(0, mt - 1)")))
    columns = ["label", "cell", "m", "v", "node"]
    both = members.select(*columns, F.lit(True).alias("member")).unionByName(
        visitors.select(*columns, F.lit(False).alias("member"))
    )
    both = both.join(nodes.select("node", "label", "vec", "n"), ["node", "label"])

    def verify(tile: pa.Table) -> pa.Table:
        member = tile.column("member").to_numpy(zero_copy_only=False)
        x = unit(tile.column("vec").to_pylist())
        ids = tile.column("node").to_numpy()
        n = tile.column("n").to_numpy()
        if member.all() or not member.any():
            counts, a, b = np.zeros(0, np.int64), ids[:0], ids[:0]
            asked = ids[:0]
        else:
            asked = ids[~member]
            counts, a, b = compare(x[member], x[~member], n[member], asked, ids[member], how.threshold)
        some = counts > 0
        k = int(some.sum())
        return pa.table(
            {
                "node": pa.array(np.concatenate((asked[some], a)), pa.int64()),
                "links": pa.array([*counts[some].tolist(), *[None] * len(a)], pa.int64()),
                "other": pa.array([*[None] * k, *b.tolist()], pa.int64()),
            }
        )

    return both.groupBy("label", "cell", "m", "v").applyInArrow(
        verify, "node long, links long, other long"
    )
