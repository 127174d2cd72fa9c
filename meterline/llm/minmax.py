"""Near-duplicate documents by min-max hashing.

A document's set is its distinct shingles of `width` words. Each of `permutations` random permutations of the shingles
gives two values, the set's smallest and its largest element, so one evaluation of a hash yields two
signature values that agree with a probability equal to the sets' similarity (Jaccard). The values are cut into
bands; documents that agree on a whole band are candidates, and a candidate pair becomes a link
only if the full sets say so.

With 126 permutations, 36 bands of 7 values miss a pair of similarity 0.8 with a probability of 2e-4, and one
of 0.9 with 5e-11; unrelated documents hardly ever share a band, so the entries of shared buckets grow with the copies and
not with the square of the corpus.

How hot groups are kept small:

* Documents with equal sets are one node from the start, found by aggregation.
* In a bucket (documents that agree on a band) one document is the head and the others are compared with it only.
  Those that link are in one component and need no further comparison. Buckets that still hold more than one component
  go into the next round with another head. The pairs between components that are left are compared one by one, if
  there are few; else, after `stars` rounds, those that share one of their rarest shingles, which every pair over the
  threshold does. So no link between candidates is lost, and copies are never expanded into pairs.
* Four bits of each of 128 signature values make a sketch of 64 bytes. Its differing bits estimate the similarity with a
  standard deviation of 0.04; candidates are left out inside the join if the estimate is `slack` under the
  threshold, which a pair at the threshold is with a probability of 1e-5.
* The texts to be compared with a head are dealt over several tasks when there are many.
* A bucket with more than a tenth of the rows of an average task is dealt over several tasks in every join on buckets (`Deal`).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.arrow import portions, utf8
from meterline.llm.components import Deal, components, deal_of, write_scratch
from meterline.llm.words import GOLDEN, mix, shingle_sets

_PORTION = 1 << 18
_SHINGLES = 2048
#: Long integers of a sketch.
SKETCH = 8


@dataclass(frozen=True)
class MinMax:
    """`percent` is the least similarity of a link; `members` the texts one task compares with a head at a time."""

    width: int = 2
    percent: int = 80
    slack: float = 0.18
    permutations: int = 126
    band: int = 7
    stars: int = 2
    members: int = 128
    seed: int = 7

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.band

    @property
    def most_bits(self) -> int:
        """Differing bits of two sketches at the least estimate that is still compared."""
        least = self.percent / 100 - self.slack
        return int(4 * min(2 * self.permutations, 16 * SKETCH) * (1 - least) / 2)


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Smallest values under each permutation, then the largest."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for i in range(0, len(shingles), _SHINGLES):
        values = shingles[i : i + _SHINGLES, None] * factors + shifts
        np.minimum(low, values.min(0), out=low)
        np.maximum(high, values.max(0), out=high)
    return np.concatenate((low, high))


def permutations(how: MinMax) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(how.seed)
    n = how.permutations
    return (
        random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
        random.integers(0, 2**63, n, dtype=np.uint64),
    )


def band_keys(signatures: np.ndarray, how: MinMax) -> np.ndarray:
    """One 64-bit key for each row and band.

    A band takes neighbouring permutations' smallest values or largest values, so that a band rarely holds both
    values of one permutation.
    """
    n = how.bands
    values = signatures[:, : n * how.band].reshape(len(signatures), n, how.band)
    keys = np.arange(n, dtype=np.uint64)[None, :] * GOLDEN
    for k in range(how.band):
        keys = mix(keys + values[:, :, k])
    return keys


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each of the first 16 * SKETCH signature values, in SKETCH long integers a row."""
    bits = (mix(signatures[:, : 16 * SKETCH] ^ GOLDEN) & np.uint64(15)).astype(np.uint8)
    wide = np.zeros((len(bits), SKETCH * 16), np.uint8)
    wide[:, : bits.shape[1]] = bits
    return np.ascontiguousarray(wide[:, 0::2] | wide[:, 1::2] << 4).view(np.int64)


def similar_sketches(left: str, right: str, how: MinMax):
    """Join condition: the sketches in two array columns do not rule a link out."""
    bits = " + ".join(f"bit_count({left}[{i}] ^ {right}[{i}])" for i in range(SKETCH))
    return F.expr(f"{bits} <= {how.most_bits}")


def describe(docs: DataFrame, how: MinMax, key: str, text: str) -> DataFrame:
    """doc_id, hash of the text, n_shingles, two sums that stand for the set, band keys and sketch (none for an empty set)."""

    def run(batches):
        factors, shifts = permutations(how)
        for batch in batches:
            ids, (data, offsets) = batch.column(0), utf8(batch.column(1))
            for low, high in portions(offsets, _PORTION):
                part = offsets[low : high + 1]
                sets = shingle_sets(data[part[0] : part[-1]], part - part[0], how.width)
                sizes = np.array([len(s) for s in sets], np.int64)
                first = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                second = np.array([mix(s + GOLDEN).sum(dtype=np.uint64) for s in sets], np.uint64)
                full = np.flatnonzero(sizes)
                signs = np.empty((len(full), 2 * how.permutations), np.uint64)
                for row, i in enumerate(full):
                    signs[row] = signature(sets[i], factors, shifts)
                keys = band_keys(signs, how).view(np.int64)
                bits = sketches(signs)
                ends = np.zeros(len(sets) + 1, np.int32)
                np.cumsum(sizes > 0, out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low).cast(pa.int64()),
                        batch.column(2).slice(low, high - low),
                        pa.array(sizes),
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends * how.bands), pa.array(keys.reshape(-1))),
                        pa.ListArray.from_arrays(pa.array(ends * SKETCH), pa.array(bits.reshape(-1))),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands", "sketch"],
                )

    return docs.select(key, text, F.xxhash64(text)).mapInArrow(
        run,
        "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>",
    )


def confirm(pairs: DataFrame, texts: DataFrame, how: MinMax) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough.

    Each text goes once to the task of the head it is compared with; a head with many partners goes to
    several tasks, each with a bounded number of them.
    """

    def run(batches):
        head, head_set = None, None
        for batch in batches:
            heads, slots, members = (batch.column(i).to_pylist() for i in range(3))
            data, offsets = utf8(batch.column(3))
            out = []
            for low, high in portions(offsets, _PORTION):
                part = offsets[low : high + 1]
                sets = shingle_sets(data[part[0] : part[-1]], part - part[0], how.width)
                for i, own in zip(range(low, high), sets, strict=True):
                    if members[i] is None:
                        head, head_set = (heads[i], slots[i]), own
                    elif head == (heads[i], slots[i]):
                        both = len(own) + len(head_set)
                        shared = both - len(np.union1d(own, head_set))
                        if shared and 100 * shared >= how.percent * (both - shared):
                            out.append((heads[i], members[i]))
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    slots = pairs.groupBy("a").agg(F.ceil(F.count("*") / how.members).cast("int").alias("slots"))
    dealt = pairs.join(slots, "a").withColumn("slot", F.pmod(F.xxhash64("b"), F.col("slots")).cast("int"))
    members = texts.join(dealt.select("a", "b", "slot"), F.col("id") == F.col("b"))
    heads = texts.join(slots, F.col("id") == F.col("a"))
    heads = heads.withColumn("slot", F.explode(F.expr("sequence(0, slots - 1)")))
    both = members.select("a", "slot", "b", "text").unionByName(
        heads.select("a", "slot", F.lit(None).cast("long").alias("b"), "text")
    )
    both = both.repartition("a", "slot").sortWithinPartitions("a", "slot", F.col("b").asc_nulls_first())
    return both.mapInArrow(run, "a long, b long")


def star_pairs(members: DataFrame, deal: Deal, turn: int, how: MinMax) -> DataFrame:
    """Each document of an open bucket with the bucket's head, if they are in different components.

    The head is the smallest id in the first turn, later one that a hash of the turn picks.
    """
    if turn:
        order = F.xxhash64("id", F.lit(turn))
    else:
        order = F.col("id")
    head = F.min(F.struct(order.alias("o"), F.col("id").alias("a"), F.col("component").alias("c"), "sketch"))
    heads = members.groupBy("bucket").agg(head.alias("h"))
    heads = heads.select("bucket", "h.a", "h.c", F.col("h.sketch").alias("other"))
    pairs = deal.join(members, heads).filter("component != c")
    pairs = pairs.filter(similar_sketches("sketch", "other", how))
    return pairs.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()


def rest_pairs(members: DataFrame, deal: Deal, how: MinMax) -> DataFrame:
    """All pairs in open buckets whose documents are in different components.

    Only documents outside of a bucket's largest component start a pair.
    """
    sizes = members.groupBy("bucket", "component").count()
    major = sizes.groupBy("bucket").agg(
        F.max(F.struct("count", "component")).getField("component").alias("major")
    )
    minor = deal.join(members, major).filter("component != major")
    minor = minor.select(
        "bucket", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("sketch").alias("other")
    )
    pairs = deal.join(members, minor).filter("cx != component")
    pairs = pairs.filter(similar_sketches("sketch", "other", how))
    return pairs.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()


def prefix_pairs(members: DataFrame, texts: DataFrame, how: MinMax) -> DataFrame:
    """Pairs of open documents in different components that share one of their rarest shingles.

    For groups that are alike but not enough: all share much, but none of their rare shingles. If the shingles of all sets are
    ordered by how many documents have them, two sets with at least `need` in common share one among the first
    `size - need + 1` of either. Every pair over the threshold passes; shingles are exact here, not hashed values.
    """

    def run(batches):
        for batch in batches:
            ids, (data, offsets) = batch.column(0), utf8(batch.column(1))
            for low, high in portions(offsets, _PORTION):
                part = offsets[low : high + 1]
                sets = shingle_sets(data[part[0] : part[-1]], part - part[0], how.width)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.ListArray.from_arrays(pa.array(ends), flat)],
                    names=["id", "shingles"],
                )

    nodes = members.groupBy("id").agg(F.min("component").alias("component"), F.first("sketch").alias("sketch"))
    sets = texts.select("id", "text").mapInArrow(run, "id long, shingles array<long>")
    rows = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    rows = write_scratch(rows, "minmax-shingles")
    often = rows.groupBy("s").agg(F.count("*").alias("c")).filter("c > 1")
    common = rows.join(often, "s")
    own = Window.partitionBy("id")
    # Shingles of one document only come first; they need no row.
    rank = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("c", "s"))
    common = common.withColumn("r", rank)
    p = how.percent
    common = common.filter(F.expr(f"r <= n - ceil({p} * n / 100) + 1"))
    common = common.join(nodes, "id")
    one = common.select("s", *[F.col(c).alias(f"{c}_1") for c in ("id", "n", "r", "component", "sketch")])
    two = common.select("s", *[F.col(c).alias(f"{c}_2") for c in ("id", "n", "r", "component", "sketch")])
    need = f"ceil({p} * (n_1 + n_2) / {100 + p})"
    pairs = one.join(two, "s").filter(
        f"id_1 < id_2 AND component_1 != component_2 AND r_1 <= n_1 - {need} + 1 AND r_2 <= n_2 - {need} + 1"
    )
    pairs = pairs.filter(similar_sketches("sketch_1", "sketch_2", how))
    return pairs.select(F.col("id_1").alias("a"), F.col("id_2").alias("b")).distinct()


def _rest_size(members: DataFrame) -> tuple[int, int]:
    """Rows in open buckets, and how many pairs `rest_pairs` would make at most.

    Few pairs are compared at once, without further heads; the links found are the same.
    """
    sizes = members.groupBy("bucket", "component").count()
    each = sizes.groupBy("bucket").agg(F.sum("count").alias("n"), F.max("count").alias("major"))
    row = each.agg(F.sum("n"), F.sum(F.expr("(n - major) * cast(n as double)"))).first()
    return int(row[0] or 0), int(row[1] or 0)


def open_buckets(entries: DataFrame, deal: Deal, found: DataFrame) -> DataFrame:
    """(bucket, id, sketch, component) of the buckets that hold more than one component."""
    labelled = entries.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return deal.join(labelled, several.filter("lo != hi").select("bucket"))


def _shared_ids(usable: DataFrame, nodes: DataFrame, same: list[str]) -> DataFrame | None:
    """Links between the nodes of rows that share a doc_id but not a set; None if there are none."""
    sets = F.struct(*same)
    several = usable.groupBy("doc_id").agg(F.min(sets).alias("lo"), F.max(sets).alias("hi"))
    several = several.filter("lo != hi").select("doc_id", F.col("lo").alias("first"))
    rows = usable.select("doc_id", *same).join(several, "doc_id").distinct()
    rows = rows.join(nodes.select(*same, F.col("id").alias("a")), same)
    first = nodes.select(sets.alias("first"), F.col("id").alias("b"))
    links = write_scratch(rows.join(first, "first").filter("a != b").select("a", "b"), "minmax-ids")
    return None if links.isEmpty() else links


def _least_rows(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, least) for all nodes of components of more than one: the smallest (doc_id, hash of the text) in it."""
    rows = nodes.select("id", "own")
    each = found.join(rows, "id").groupBy("component").agg(F.min("own").alias("others"), F.count("*").alias("n"))
    each = each.join(rows.withColumnRenamed("id", "component"), "component")
    each = write_scratch(each.select("component", F.least("own", "others").alias("least"), "n"), "minmax-least")
    deal = deal_of(each, each.agg(F.sum("n")).first()[0] or 0, "component", "id")
    members = deal.join(found, each.select("component", "least")).select("id", "least")
    return members.unionByName(each.select(F.col("component").alias("id"), "least"))


def near_duplicates(
    docs: DataFrame,
    how: MinMax = MinMax(),
    key: str = "doc_id",
    text: str = "text",
    ids_link: bool = True,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, kept, text_hash, kept_text.

    Words are lower-cased (A to Z) and cut at space and the control characters 9 to 13. Documents are linked if
    100 * common shingles >= percent * shingles of both. component_id is the smallest doc_id that links
    reach, kept is doc_id = component_id. text_hash is the text's xxhash64; kept_text tells the rows with the text that stands
    for the component: of its smallest doc_id, the text with the smallest hash.

    A null, empty or blank text has no shingles and no link. Rows with the same doc_id are in one component, whatever their
    texts, each of which links by its own set; without `ids_link`, texts that share a doc_id link by their sets alone. A
    row with a null doc_id gets a null component_id, is kept and links with nothing. Other columns are not read. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    facts = write_scratch(describe(docs, how, key, text), "minmax-facts")
    usable = facts.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "set_a", "set_b"]
    nodes = usable.groupBy(*same).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("own"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    # Numbers hold from here on: they are written once and read again.
    nodes = write_scratch(nodes.withColumn("id", F.monotonically_increasing_id()), "minmax-nodes")
    entries = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")
    )
    shared = write_scratch(shared.filter("lo != hi").select("bucket", "n"), "minmax-shared")
    deal = deal_of(shared, shared.agg(F.sum("n")).first()[0] or 0, "bucket", "id")
    entries = deal.join(entries, shared.select("bucket")).select("bucket", "id")
    entries = write_scratch(entries.join(nodes.select("id", "sketch"), "id"), "minmax-buckets")
    # Only texts that share a bucket are compared; they are picked out once.
    texts = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    wanted = nodes.select("id", "own.doc_id", "own.text_hash").join(entries.select("id"), "id", "left_semi")
    texts = write_scratch(texts.join(wanted, ["doc_id", "text_hash"]).select("id", "text"), "minmax-texts")

    confirmed = _shared_ids(usable, nodes, same) if ids_link else None
    found = None if confirmed is None else write_scratch(components(spark, confirmed), "minmax-components")
    tested = None
    for turn in range(how.stars + 1):
        pairs, last = None, turn == how.stars
        if not turn and found is None:
            members = entries.withColumn("component", F.col("id"))
        else:
            members = open_buckets(entries, deal, found)
        if turn:
            members = write_scratch(members, "minmax-open")
            rows, most = _rest_size(members)
            if not rows:
                break
            if most <= 8 * rows:
                pairs, last = rest_pairs(members, deal, how), True
            elif last:
                still = texts.join(members.select("id").distinct(), "id", "left_semi")
                pairs = prefix_pairs(members, still.dropDuplicates(["id"]), how)
        if pairs is None:
            pairs = star_pairs(members, deal, turn, how)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = write_scratch(pairs, "minmax-pairs")
        new = write_scratch(confirm(pairs, texts, how), "minmax-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        confirmed = new if confirmed is None else confirmed.unionByName(new)
        found = write_scratch(components(spark, confirmed), "minmax-components")
        if last:
            break

    own = facts.select("doc_id", "text_hash", *same).join(nodes.select(*same, "id", "own"), same, "left")
    if found is not None:
        own = own.join(_least_rows(found, nodes), "id", "left")
    else:
        own = own.withColumn("least", F.col("own"))
    least = F.coalesce("least", "own", F.struct("doc_id", "text_hash"))
    out = own.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), least).alias("least"))
    return out.select(
        "doc_id",
        "n_shingles",
        F.col("least.doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("least.doc_id"), F.lit(True)).alias("kept"),
        "text_hash",
        F.coalesce(F.struct("doc_id", "text_hash") == F.col("least"), F.lit(True)).alias("kept_text"),
    )
