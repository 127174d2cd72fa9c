"""Pack documents into token sequences of a fixed length, keeping their order.

The tokens of a task's rows form one stream. A dynamic program chooses the cuts: a window (s, e] of at most `length`
tokens costs its padding, `length - (e - s)`, plus a penalty for where it is cut: none at the end of a document,
a little at the end of a sentence, more inside one. As the padding is linear in s and e, the best predecessor of e is the
smallest `cost(s) + s` among the cuts in the window, which a monotone queue gives in constant time. The
stream is solved in blocks; the last window of a block is carried into the next one, so only the end of a task
is short of tokens. That rest is padded, or cut into sequences of a power of two, which need no padding,
whichever costs less.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from meterline.llm.tokens import encoder


@dataclass(frozen=True)
class Packing:
    """How to pack. Penalties and overhead are in tokens of padding.

    `stride` is the distance of the cuts that are allowed inside a sentence. `block` sequences are solved
    at a time, which bounds a task's memory.
    """

    tokenizer: str
    end_id: int
    length: int = 4096
    sentence_penalty: int = 2
    inner_penalty: int = 12
    stride: int = 32
    overhead: int = 64
    block: int = 128


def choose_cuts(at: np.ndarray, penalty: np.ndarray, length: int) -> list[int]:
    """The cheapest chain of cuts from 0 to the last position.

    `at` holds ascending cut positions, none more than `length` after the one before it (the first not more than
    `length` after 0). Returns the chosen positions, the last one included.
    """
    positions = [0, *at.tolist()]
    penalties = [0, *penalty.tolist()]
    best_before = [0] * len(positions)
    slope = [0] * len(positions)  # cost + position
    queue = deque([0])
    for i in range(1, len(positions)):
        p = positions[i]
        while positions[queue[0]] < p - length:
            queue.popleft()
        j = queue[0]
        best_before[i] = j
        s = slope[j] + length + penalties[i]  # cost(i) = slope(j) + length - p + penalty
        slope[i] = s
        while queue and slope[queue[-1]] >= s:
            queue.pop()
        queue.append(i)
    chain, i = [], len(positions) - 1
    while i > 0:
        chain.append(positions[i])
        i = best_before[i]
    return chain[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, sentence: np.ndarray, how: Packing):
    """Cut positions and their penalties: document ends, sentence ends, and every `stride` tokens between."""
    n = len(ids)
    cost = np.full(n + 1, -1, np.int32)
    inside = np.flatnonzero(sentence[ids]) + 1
    cost[inside] = how.sentence_penalty
    cost[ends] = 0
    marks = np.flatnonzero(cost >= 0)
    marks = np.unique(np.concatenate(([0], marks, [n])))
    gaps = np.diff(marks)
    extra = np.maximum((gaps - 1) // how.stride, 0)
    if extra.any():
        base = np.repeat(marks[:-1], extra)
        step = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        cost[base + step * how.stride] = how.inner_penalty
    cost[n] = max(cost[n], 0)
    at = np.flatnonzero(cost >= 0)
    at = at[at > 0]
    return at, cost[at]


def tail_cuts(n: int, how: Packing) -> list[int]:
    """How the last n tokens of a task (at most one sequence) are cut."""
    bits = [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]
    if len(bits) > 1 and (len(bits) - 1) * how.overhead < how.length - n:
        return np.cumsum(bits).tolist()
    return [n]


def sentence_ends(vocabulary: dict[str, int], size: int) -> np.ndarray:
    """Which ids end a sentence: tokens of signs only that hold a full stop, question or exclamation mark."""
    out = np.zeros(max(size, max(vocabulary.values(), default=0) + 1), bool)
    for token, i in vocabulary.items():
        sign = token.removesuffix("</w>")
        if any(c in ".!?。" for c in sign) and not any(c.isalnum() for c in sign):
            out[i] = True
    return out


FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("padded", pa.int64()),
]
SPARK_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"


class _Stream:
    """The tokens that a task has not packed yet."""

    def __init__(self, how: Packing, encode: Callable, end: bytes, sentence: np.ndarray, dtype, task: int):
        self.how, self.encode, self.end, self.sentence, self.dtype = how, encode, end, sentence, dtype
        self.parts: list[bytes] = []
        self.waiting = 0
        self.docs: list[list] = []  # key, tokens in all, tokens packed
        self.sequence = task << 40

    def add(self, key, text: str | None):
        ids = self.encode(text or "") + self.end
        n = len(ids) // self.dtype.itemsize
        self.parts.append(ids)
        self.waiting += n
        self.docs.append([key, n, 0])

    def full(self) -> bool:
        return self.waiting >= self.how.block * self.how.length

    def pack(self, last: bool) -> list[tuple]:
        ids = np.frombuffer(b"".join(self.parts), self.dtype)
        ends = np.cumsum([n - done for _, n, done in self.docs], dtype=np.int64)
        at, penalty = candidates(ids, ends, self.sentence, self.how)
        chain = choose_cuts(at, penalty, self.how.length) if len(at) else []
        begin = chain[-2] if len(chain) > 1 else 0
        if last and chain:
            cuts = chain[:-1] + [begin + c for c in tail_cuts(chain[-1] - begin, self.how)]
        else:
            cuts = chain[:-1]
        rows = self._pieces(ids, cuts)
        packed = cuts[-1] if cuts else 0
        self.docs = [d for d in self.docs if d[2] < d[1]]
        self.parts = [ids[packed:].tobytes()]
        self.waiting = len(ids) - packed
        return rows

    def _pieces(self, ids: np.ndarray, cuts: list[int]) -> list[tuple]:
        rows, at, doc = [], 0, 0
        for cut in cuts:
            size, offset = cut - at, 0
            padded = size if size & (size - 1) == 0 else self.how.length
            while at < cut:
                key, n, done = self.docs[doc]
                take = min(cut - at, n - done)
                crc = zlib.crc32(ids[at : at + take].astype("<u4").tobytes())
                rows.append((key, done, take, crc, n, self.sequence, offset, padded))
                at += take
                offset += take
                self.docs[doc][2] += take
                doc += done + take == n
            self.sequence += 1
        return rows


def pack(docs: DataFrame, how: Packing, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of a document: where it stands in the document and in its sequence.

    Columns: `key`, start (tokens of the document before the piece), length, ids_crc32 (unsigned, of the ids as
    little-endian 32-bit integers), doc_tokens (with the end id), sequence_id, offset (in the sequence, without
    gaps), padded (tokens of the sequence with its padding). Other columns of `docs` are not read, so their names
    cannot clash.

    Rows are packed in the order of their partition; nothing is shuffled. Sequence ids rise with that order
    within a partition and are unique, with gaps between partitions. A null or empty text has the end id only.
    Rows that repeat, also with the same or a null key, are packed each for itself. An empty table gives no rows.
    A document longer than a block is held whole while it is packed.
    """
    kind = docs.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, {SPARK_FIELDS}"

    def run(batches):
        coder = encoder(how.tokenizer)
        sentence = sentence_ends(coder.tokenizer.get_vocab(), 1 << 16)
        end = np.array([how.end_id], coder.dtype).tobytes()
        stream = _Stream(how, coder.encode, end, sentence, coder.dtype, TaskContext.get().partitionId())
        arrow_key = None
        for batch in batches:
            arrow_key = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                stream.add(k, t)
                if stream.full():
                    yield table(arrow_key, stream.pack(last=False))
        if arrow_key is not None and stream.waiting:
            yield table(arrow_key, stream.pack(last=True))

    def table(arrow_key, rows):
        columns = list(zip(*rows, strict=True)) or [()] * (len(FIELDS) + 1)
        types = [(key, arrow_key), *FIELDS]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], names=[n for n, _ in types]
        )

    return docs.select(key, text).mapInArrow(run, schema)
