"""Mix sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of equal size. Block j of a source with weight w may take a slot from
floor(j / w) on and has to have one before ceil((j + 1) / w). Giving each slot to the released block with the earliest deadline
meets all deadlines, as the weights add up to one; so after any number of slots t a source has had more than w·t - 1
and less than w·t + 1 blocks.

Weights are whole numbers, exactly as they are written, so nothing is rounded and nothing drifts. Deadlines decide one slot after
the other: one task makes the schedule, with a block of each source in memory, and passes it on as rows of a table.
A document's places follow from its rank in its source, by a join of the ranks with the slots of their blocks.

The schedule runs until every source has given each document at least once. A source that has given all of its documents
goes round again. So no document is dropped, and the weights hold at the end as in every prefix.

Texts are shuffled twice, to be ranked and, as often as the mix repeats them, to be put in order. They travel
compressed one by one, which for prose takes a third less than what the shuffle's own compression does.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from meterline.llm.components import write_scratch


@dataclass(frozen=True)
class Mix:
    """Documents in a block, slots that are passed on at a time, and the power of a source's size that is its default weight.

    `rank_rows` is the mean number of rows that are ranked together within a source. More than `most_sources`
    sources raise an error: their weights would no longer be data to send to every task.
    """

    block: int = 16
    period: int = 1000
    power: float = 0.7
    rank_rows: int = 1000
    most_sources: int = 100_000


def whole(weights: dict) -> dict:
    """The weights as whole numbers in the same proportions: a float is the decimal number it is written as."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    scale = math.lcm(*[w.denominator for w in exact.values()])
    out = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*out.values())
    return {s: n // common for s, n in out.items()}


def shares(weights: dict, period: int) -> dict:
    """Weights as whole numbers of slots that add up to the period, each at least one (largest remainders).

    The period grows to a slot for each source where there are more sources. The mix itself does not round its weights.
    """
    period = max(period, len(weights))
    parts = whole(weights)
    total = sum(parts.values())
    order = sorted(weights, key=lambda s: (s is None, "" if s is None else str(s)))
    out = {s: max(parts[s] * period // total, 1) for s in order}
    over = {s: parts[s] * period - out[s] * total for s in order}
    while (left := period - sum(out.values())) != 0:
        step = 1 if left > 0 else -1
        s = max((s for s in order if step > 0 or out[s] > 1), key=lambda s: step * over[s])
        out[s] += step
        over[s] -= step * total
    return out


def slots_of(parts: list[int]) -> Iterator[tuple[int, int]]:
    """Source and block of each slot, without end: earliest deadline first among released blocks.

    Source i has the weight parts[i] / sum(parts). A block of each source is held, whatever the number of slots.
    """
    total = sum(parts)
    waiting = [(0, i, 0) for i in range(len(parts))]  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // parts[i]), i, j))
        deadline, i, j = heapq.heappop(ready)
        assert deadline > t, "a block missed its deadline"
        yield i, j
        heapq.heappush(waiting, ((j + 1) * total // parts[i], i, j + 1))
        t += 1


def schedule(slots: dict) -> list:
    """Which source has each slot of one period of whole weights."""
    names = list(slots)
    return [names[i] for i, _ in islice(slots_of(list(slots.values())), sum(slots.values()))]


def scheduled(spark, parts: list[int], blocks: list[int], batch: int) -> DataFrame:
    """(of_index, of_block, of_slot) up to the slot at which each source has had its number of blocks."""

    def run(batches):
        for _ in batches:
            pass
        open_, rows = sum(n > 0 for n in blocks), []
        for t, (i, j) in enumerate(slots_of(parts)):
            rows.append((i, j, t))
            open_ -= j + 1 == blocks[i]
            if not open_ or len(rows) == batch:
                columns = zip(*rows, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["of_index", "of_block", "of_slot"])
                rows = []
            if not open_:
                return

    return spark.range(0, 1, 1, 1).mapInArrow(run, "of_index int, of_block long, of_slot long")


def _squeeze(texts: pa.Array) -> pa.Array:
    """Each text compressed; null stays null."""
    coder = zstandard.ZstdCompressor(level=1)
    raw = texts.cast(pa.large_binary())
    return pa.array([None if t is None else coder.compress(t) for t in raw.to_pylist()], pa.binary())


def _restore(packed: pa.Array) -> pa.Array:
    coder = zstandard.ZstdDecompressor()
    texts = [None if t is None else coder.decompress(t) for t in packed.to_pylist()]
    return pa.array(texts, pa.binary()).cast(pa.string())


def mix_sources(
    docs: DataFrame,
    how: Mix = Mix(),
    weights: dict | None = None,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    columns: tuple[str, str, str] = ("mix_position", "mix_slot", "mix_round"),
) -> DataFrame:
    """All columns of `docs`, in the order of the mix, with its position, its slot and the round of its source.

    Without `weights`, a source weighs its number of documents to the `power`. With them, each source of the table needs
    a weight above zero; weights of other sources are not used. A null source is a source of its own. Documents of a source
    come in an order that only a hash of the row decides; rows that repeat, also with a null key, keep a place each.
    The column `text`, if it is there and of strings, is compressed on the way and comes out as it was. Columns
    of `docs` keep their names: choose others for the three new ones if they clash (a clash raises). An empty table gives no
    rows. Only the number of documents of each source comes to the driver.
    """
    spark = docs.sparkSession
    if clash := set(columns) & set(docs.columns):
        raise ValueError(f"docs has columns named {sorted(clash)}")
    counted = docs.groupBy(F.col(f"`{source}`").alias("of_own")).agg(F.count("*")).limit(how.most_sources + 1).collect()
    if len(counted) > how.most_sources:
        raise ValueError(f"more than {how.most_sources} sources")
    sizes = {r[0]: r[1] for r in counted}
    position, slot, round_ = columns
    if not sizes:
        empty = docs.limit(0)
        return empty.withColumns({c: F.lit(0).cast("long") for c in columns})
    if weights is None:
        weights = {s: n**how.power for s, n in sizes.items()}
    missing = [s for s in sizes if not weights.get(s, 0) > 0]
    if missing:
        raise ValueError(f"no weight for sources {missing[:5]}")
    parts = whole({s: weights[s] for s in sizes})
    names = list(parts)
    blocks = [-(-sizes[s] // how.block) for s in names]
    slots = write_scratch(scheduled(spark, [parts[s] for s in names], blocks, how.period), "mix-slots")
    rows = [(i, s, sizes[s], -(-sizes[s] // how.rank_rows)) for i, s in enumerate(names)]
    plan = _plan(spark, rows, docs.schema[source].dataType)

    # The caller's row travels in one structure, whatever its names; a text stands beside it, to be compressed.
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if not is_map(docs, c)])
    long = text in docs.columns and text not in (key, source) and isinstance(docs.schema[text].dataType, T.StringType)
    rest = [c for c in docs.columns if not (long and c == text)]
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("of_row"),
        (F.col(f"`{text}`") if long else F.lit(None).cast("string")).alias("of_text"),
        F.col(f"`{key}`").alias("of_key"),
        F.col(f"`{source}`").alias("of_own"),
        hashed.alias("of_hash"),
    )
    # One row for each source: bounded by a parameter.
    marked = marked.join(F.broadcast(plan), marked.of_own.eqNullSafe(plan.of_source))
    # Rank within the source: by buckets of a hash, so that no source is sorted in one task.
    marked = marked.withColumn("of_bucket", F.pmod("of_hash", "of_buckets"))
    counted = marked.groupBy("of_index", "of_bucket").count()
    if long:
        marked = marked.withColumn("of_text", F.arrow_udf(_squeeze, "binary")("of_text"))
    counts = write_scratch(counted, "mix-buckets")
    before = Window.partitionBy("of_index").orderBy("of_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "of_index", "of_bucket", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("of_before")
    )
    own = Window.partitionBy("of_index", "of_bucket").orderBy("of_hash", "of_key")
    ranked = marked.select("of_index", "of_bucket", "of_row", "of_text", F.row_number().over(own).alias("of_rank"))
    ranked = ranked.join(_rounds(offsets, slots, plan, how.block), ["of_index", "of_bucket"])
    placed = ranked.withColumn("of_place", F.col("of_begin") + F.col("of_rank") - 1)
    placed = placed.filter("of_place < of_length")
    at = F.expr(f"of_slots[cast(of_place div {how.block} - of_first as int)]")
    placed = placed.withColumn("of_slot", at)
    place = F.col("of_slot") * how.block + F.col("of_place") % how.block
    out = placed.select("of_row", "of_text", place.alias("of_place"), "of_slot", "of_round")
    out = out.repartitionByRange("of_place").sortWithinPartitions("of_place")
    if long:
        out = out.withColumn("of_text", F.arrow_udf(_restore, "string")("of_text"))
    return out.select(
        *[(F.col("of_text") if long and c == text else F.col(f"of_row.`{c}`")).alias(c) for c in docs.columns],
        F.col("of_place").alias(position),
        F.col("of_slot").alias(slot),
        F.col("of_round").alias(round_),
    )


def _plan(spark, rows: list[tuple], kind: T.DataType) -> DataFrame:
    """(of_index, of_source, of_rows, of_buckets) as literal rows.

    Arrow passes them on by the driver alone. A list of rows goes through a Python job, for which every executor starts a
    second set of Python workers; so only sources of nested types or points in time are sent like that.
    """
    fields = {"of_index": T.IntegerType(), "of_source": kind, "of_rows": T.LongType(), "of_buckets": T.LongType()}
    schema = T.StructType([T.StructField(name, t) for name, t in fields.items()])
    if not isinstance(kind, (T.StringType, T.NumericType, T.BooleanType, T.DateType)):
        return spark.createDataFrame(rows, schema)
    columns = zip(zip(*rows, strict=True), fields.values(), strict=True)
    arrays = [pa.array(values, to_arrow_type(t)) for values, t in columns]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(fields)), schema)


def _rounds(offsets: DataFrame, slots: DataFrame, plan: DataFrame, block: int) -> DataFrame:
    """For each bucket and round of its source: the place of its first row, its first block, and the slots of its blocks."""
    lengths = slots.groupBy("of_index").agg((F.count("*") * block).alias("of_length"))
    lengths = lengths.join(plan.select("of_index", "of_rows"), "of_index")
    rounds = offsets.join(lengths, "of_index")
    rounds = rounds.withColumn("of_round", F.explode(F.expr("sequence(0L, (of_length - 1 - of_before) div of_rows)")))
    rounds = rounds.withColumn("of_begin", F.expr("of_round * of_rows + of_before"))
    last = F.expr(f"(least(of_begin + count, of_length) - 1) div {block}")
    rounds = rounds.withColumns({"of_first": F.expr(f"of_begin div {block}"), "of_last": last})
    each = rounds.withColumn("of_block", F.explode(F.expr("sequence(of_first, of_last)")))
    found = each.join(slots, ["of_index", "of_block"])
    found = found.groupBy("of_index", "of_bucket", "of_round", "of_begin", "of_first", "of_length")
    found = found.agg(F.sort_array(F.collect_list(F.struct("of_block", "of_slot"))).alias("of_found"))
    return found.withColumn("of_slots", F.col("of_found.of_slot")).drop("of_found")


def is_map(docs: DataFrame, column: str) -> bool:
    return docs.schema[column].dataType.simpleString().find("map<") >= 0
