"""The highest-scoring documents of each query by the Best Position Algorithm over impact lists.

One pass over the documents keeps the postings of the queries' terms, in shards of a bounded number of documents, and counts what
weights and lengths are computed from. A second pass turns each shard's postings into impact lists, one a term, highest impact first.
A query reads its lists from the top, in rounds. Each document met is looked up directly in all other lists of the query; these direct accesses
mark its places there as seen, too. A list's best position is the end of its unbroken run of seen places; no unseen document of the shard can gain more
from the list than stands at the next place. Once the sum of that over the lists is strictly below the k-th best score, the shard has given all it can,
ties included. The shards' best are ranked by a window, which Spark limits to k rows a query ahead of the shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.arrow import arrow_schema, portions, utf8
from meterline.llm.components import write_scratch
from meterline.llm.words import LOWER, hashes, spans

#: Terms are runs of ASCII digits and letters and of all characters beyond ASCII.
GAPS = np.ones(256, bool)
GAPS[48:58] = GAPS[65:91] = GAPS[97:123] = GAPS[128:] = False


@dataclass(frozen=True)
class Ranking:
    """`k` documents a query. `shard` and `postings` bound a shard, `terms` what is sent to tasks at once: queries with more terms in all
    go in blocks. `reads` places of a list are read in the first round, twice as many in each next one."""

    k: int = 50
    shard: int = 16_384
    postings: int = 2_000_000
    terms: int = 131_072
    reads: int = 16
    portion: int = 1 << 22


def terms_of(column: pa.Array, portion: int):
    """For portions of rows: number of the first row, words' hashes, and the index of each row's first word (one more at the end)."""
    data, offsets = utf8(column)
    for low, high in portions(offsets, portion):
        part = LOWER[data[offsets[low] : offsets[high]]]
        starts, ends, first = spans(part, offsets[low : high + 1] - offsets[low], GAPS)
        yield low, hashes(part, starts, ends), first


QUERIES = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("term", T.LongType())])
SHARDS = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.BinaryType()),
        T.StructField("term", T.BinaryType()),
        T.StructField("doc", T.BinaryType()),
        T.StructField("tf", T.BinaryType()),
        T.StructField("documents", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("held", T.ArrayType(T.IntegerType())),
        T.StructField("held_by", T.ArrayType(T.LongType())),
    ]
)
BEST = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


def _query_terms(items: DataFrame, how: Ranking) -> DataFrame:
    schema = arrow_schema(QUERIES)

    def run(batches):
        for batch in batches:
            for low, words, first in terms_of(batch.column(1), how.portion):
                row = np.repeat(np.arange(len(first) - 1), np.diff(first)) + low
                ids = batch.column(0).cast(pa.int64()).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(words.view(np.int64))], schema=schema)

    return items.select("item_id", "text").mapInArrow(run, QUERIES).distinct()


def _shards(docs: DataFrame, vocabulary: np.ndarray, how: Ranking) -> DataFrame:
    schema = arrow_schema(SHARDS)

    def run(batches):
        ids, lengths, postings, rows, held = [], [], [], 0, 0

        def shard():
            doc, term, tf = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*postings))
            order = np.lexsort((doc, term))
            doc, term, tf = doc[order], term[order], tf[order]
            n = np.concatenate(lengths)
            kinds, by = np.unique(term, return_counts=True)
            columns = [
                [pa.concat_arrays(ids).to_pylist()],
                [n.tobytes()],
                *[[x.astype(np.int32).tobytes()] for x in (term, doc, tf)],
                [int((n > 0).sum())],
                [int(n.sum())],
                [kinds.tolist()],
                [by.tolist()],
            ]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            given = batch.column(0).cast(pa.int64())
            for low, words, first in terms_of(batch.column(1), how.portion):
                n = np.diff(first)
                at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                hit = vocabulary[at] == words
                # The lists' documents are those of the shard, so a portion's rows are numbered on from the last one's.
                doc = np.repeat(np.arange(len(n)), n)[hit] + rows
                pair, tf = np.unique(doc * len(vocabulary) + at[hit], return_counts=True)
                postings.append((pair // len(vocabulary), pair % len(vocabulary), tf))
                ids.append(given.slice(low, len(n)))
                lengths.append(n.astype(np.int64))
                rows, held = rows + len(n), held + len(pair)
                if rows >= how.shard or held >= how.postings:
                    yield shard()
                    ids, lengths, postings, rows, held = [], [], [], 0, 0
        if rows:
            yield shard()

    return docs.select("doc_id", "text").mapInArrow(run, SHARDS)


@dataclass
class Weights:
    """What impacts are computed from: a weight a term, and the corpus' documents and words."""

    term: np.ndarray
    documents: int
    words: int

    def impacts(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        big = 50 * int(length.max(initial=0)) * self.documents >= 2**63
        spread = length.astype(object) if big else length
        m = 50 + (50 * spread * self.documents // max(self.words, 1)).astype(np.int64)
        return self.term[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Lists:
    """A shard's impact lists. Places of all lists stand one after the other; a list is a range of them."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, rows: int):
        gains = impact > 0
        term, doc, impact = term[gains], doc[gains], impact[gains]
        self.rows = rows
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.names, self.begin = np.unique(term, return_index=True)
        self.end = np.append(self.begin[1:], len(term))
        # For direct access: postings by term and document, and where in its list each stands.
        self.key = term * rows + doc
        self.place = np.empty(len(term), np.int64)
        self.place[order] = np.arange(len(term))

    def find(self, lists: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each document in each list, and whether it is there."""
        wanted = self.names[lists][:, None] * self.rows + docs
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return self.place[at], self.key[at] == wanted

    def best(self, terms: np.ndarray, k: int, reads: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them the k best and all that tie with the last of them."""
        at = np.searchsorted(self.names, terms)
        lists = at[(at < len(self.names)) & (self.names[np.minimum(at, len(self.names) - 1)] == terms)] if len(self.names) else at[:0]
        low, high = self.begin[lists], self.end[lists]
        seen = [np.zeros(b - a, bool) for a, b in zip(low, high)]
        met = np.zeros(self.rows, bool)
        best_at = low.copy()  # the first place that is not seen, after the best position
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        depth, found = 0, 0
        while True:
            left = best_at < high
            bound = int(self.impact[best_at[left]].sum())
            if bound == 0:
                break
            if found >= k:
                all_scores = np.concatenate(scores)
                if bound < np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k]:
                    break
            read = [self.doc[a + depth : min(a + depth + reads, b)] for a, b in zip(low, high)]
            new = np.unique(np.concatenate(read))
            new = new[~met[new]]
            depth, reads = depth + reads, 2 * reads
            if not len(new):
                continue
            met[new] = True
            place, there = self.find(lists, new)
            docs.append(new)
            scores.append(np.where(there, self.impact[place], 0).sum(0))
            found += len(new)
            for i, marks in enumerate(seen):
                marks[place[i][there[i]] - low[i]] = True
                rest = marks[best_at[i] - low[i] :]
                best_at[i] += len(rest) if rest.all() else int(rest.argmin())
        return np.concatenate(docs), np.concatenate(scores)


def _search(shards: DataFrame, queries: list, weights: Weights, how: Ranking) -> DataFrame:
    schema = arrow_schema(BEST)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cells = [column[i] for column in batch.columns]
                ids = cells[0].values
                length = np.frombuffer(cells[1].as_buffer(), np.int64)
                term, doc, tf = (np.frombuffer(c.as_buffer(), np.int32).astype(np.int64) for c in cells[2:5])
                lists = Lists(term, doc, weights.impacts(term, tf, length[doc]), len(length))
                by_id = np.empty(len(length), np.int64)  # ids in ascending order, null last
                by_id[np.array(pa.compute.sort_indices(ids))] = np.arange(len(length))
                out = []
                for item, terms in queries:
                    docs, scores = lists.best(terms, how.k, how.reads)
                    first = np.lexsort((by_id[docs], -scores))[: how.k]
                    out.append((item, docs[first], scores[first]))
                sizes = [len(d) for _, d, _ in out]
                items = pa.array([x[0] for x in out], pa.int64()).take(pa.array(np.repeat(np.arange(len(out)), sizes)))
                docs = np.concatenate([x[1] for x in out])
                yield pa.RecordBatch.from_arrays(
                    [items, ids.take(pa.array(docs)), pa.array(np.concatenate([x[2] for x in out]))], schema=schema
                )

    return shards.select("ids", "lengths", "term", "doc", "tf").mapInArrow(run, BEST)


def _block(items: list, docs: DataFrame, how: Ranking) -> DataFrame | None:
    """The shards' best for a bounded block of queries."""
    vocabulary = np.unique(np.array([t for _, terms in items for t in terms], np.int64).view(np.uint64))
    shards = write_scratch(_shards(docs, vocabulary, how), "shards")
    documents, words = shards.agg(F.sum("documents"), F.sum("words")).first()
    if not words:
        return None
    held = shards.select(F.explode(F.arrays_zip("held", "held_by")).alias("h"))
    held = held.groupBy("h.held").agg(F.sum("h.held_by").alias("n")).collect()
    term = np.zeros(len(vocabulary), np.int64)
    for r in held:
        term[r["held"]] = weight(documents, r["n"])
    asked = [(item, np.searchsorted(vocabulary, np.array(sorted(terms), np.int64).view(np.uint64))) for item, terms in items]
    asked = [(item, np.sort(terms)) for item, terms in asked]
    return _search(shards, asked, Weights(term, documents, words), how)


def rank_documents(items: DataFrame, docs: DataFrame, how: Ranking = Ranking()) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its `k` highest-scoring documents with a score above 0.

    Equal scores stand by ascending doc_id, null last. Every document is scored over its whole text, null as empty. Rows that repeat a
    doc_id are documents each; rows that share an item_id are one item with the terms of all, and so are
    those without an id. Items without terms, or without a document that holds one, have no rows; with an empty table the result is empty. A very
    long text is one document of a shard, whose postings are its distinct terms at most. Terms are known by 64-bit hashes. Other columns, whatever their
    names, are not read.
    """
    asked = write_scratch(_query_terms(items, how), "queries")
    blocks = max(1, math.ceil(asked.count() / how.terms))
    asked = asked.groupBy("item_id").agg(F.collect_list("term").alias("terms"))
    found = None
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        part = _block([(r["item_id"], r["terms"]) for r in mine], docs, how) if mine else None
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], BEST)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= how.k)
    return ranked.select("item_id", "rank", "doc_id", "score")
