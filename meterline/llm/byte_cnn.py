"""Quality classifier: a small convolutional network over bytes, in numpy.

A text's bytes are embedded and cut into chunks of 512 bytes that overlap by 64, to the end of the text. Learned filters
eight bytes wide move over a chunk in steps of four; the largest answer of each filter in the chunk is
kept. Largest and mean of these over all chunks give two numbers a filter, which a logistic layer
combines into one probability. The largest answers decide the gradient, so learning touches few positions.

Layout: a row of four bytes is one step. `answers[t] = rows[t] · top + rows[t + 1] · bottom`, one matrix product for
both halves of the filters. Sixteen steps are a block; chunk i of a text holds its blocks 7i to 7i + 7.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.arrow import portions, utf8
from meterline.llm.labelled import training_rows

STEP = 4
BLOCK = 16
STRIDE = 7  # blocks from one chunk to the next; a chunk has one more
BLOCK_BYTES = STEP * BLOCK
STRIDE_BYTES = STRIDE * BLOCK_BYTES


@dataclass(frozen=True)
class ByteCnn:
    """`sample` and `sample_bytes` bound the labelled rows to learn from, whatever their lengths; scoring has no bound.
    `portion` is the number of bytes that are embedded at a time, in learning and in scoring."""

    sample: int = 2000
    sample_bytes: int = 64 << 20
    filters: int = 24
    embedding: int = 8
    epochs: int = 12
    batch: int = 48
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 5
    threshold: float = 0.3
    portion: int = 1 << 19


@dataclass
class Network:
    letters: np.ndarray  # 256 x embedding; byte 0 is padding and stays zero
    top: np.ndarray  # STEP * embedding x filters
    bottom: np.ndarray
    bias: np.ndarray
    weights: np.ndarray  # 2 * filters: of the largest, of the mean
    intercept: np.ndarray  # one number

    def parts(self) -> list[np.ndarray]:
        return [self.letters, self.top, self.bottom, self.bias, self.weights, self.intercept]


def lay_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with byte 0 to whole chunks, as one array, and the number of chunks of each.

    A text has a chunk for each begun stride after the overlap; an empty text has one, of padding.
    """
    sizes = np.diff(offsets)
    chunks = np.maximum(-(-(sizes - BLOCK_BYTES) // STRIDE_BYTES), 1)
    room = chunks * STRIDE_BYTES + BLOCK_BYTES
    ends = np.cumsum(room)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    if len(data):
        shift = (ends - room) - offsets[:-1]
        out[np.arange(len(data)) + np.repeat(shift, sizes)] = data
    return out, chunks


def answers(net: Network, laid: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Answers of the filters at every step, and the rows of embedded bytes."""
    rows = net.letters[laid].reshape(-1, STEP * net.letters.shape[1])
    both = rows @ np.concatenate((net.top, net.bottom), 1)
    n = net.top.shape[1]
    out = both[:, :n].copy()
    out[:-1] += both[1:, n:]
    last = np.cumsum((chunks * STRIDE + 1) * BLOCK) - 1  # the step after it belongs to another text
    out[last] = both[last, :n]
    return out, rows


def chunk_blocks(chunks: np.ndarray) -> np.ndarray:
    """Index of the first block of every chunk of every text."""
    blocks = chunks * STRIDE + 1
    first = np.cumsum(blocks) - blocks
    within = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return np.repeat(first, chunks) + within * STRIDE


def pooled(net: Network, out: np.ndarray, chunks: np.ndarray):
    """Largest answer in each chunk with the filter's bias, not below zero; and the blocks it came from."""
    blocks = out.reshape(-1, BLOCK, out.shape[1]).max(1)
    first = chunk_blocks(chunks)
    best = blocks[first]
    for k in range(1, STRIDE + 1):
        best = np.maximum(best, blocks[first + k])
    return np.maximum(best + net.bias, 0), best, first


def features(chunk_values: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    begins = np.cumsum(chunks) - chunks
    largest = np.maximum.reduceat(chunk_values, begins, axis=0)
    mean = np.add.reduceat(chunk_values, begins, axis=0) / chunks[:, None]
    return np.concatenate((largest, mean), 1)


def score(net: Network, data: np.ndarray, offsets: np.ndarray, portion: int = 1 << 19) -> np.ndarray:
    """Probability of label 1 for texts given as bytes. A text longer than a portion is scored in
    portions of whole chunks, whose largest and sums are put together."""
    out = np.empty(len(offsets) - 1)
    for low, high in portions(offsets, portion):
        part = offsets[low : high + 1]
        if high - low == 1 and part[1] - part[0] > portion:
            z = _long(net, data[part[0] : part[1]], portion)
        else:
            laid, chunks = lay_out(data[part[0] : part[-1]], part - part[0])
            z = features(pooled(net, answers(net, laid, chunks)[0], chunks)[0], chunks)
        out[low:high] = 1 / (1 + np.exp(-(z @ net.weights + net.intercept[0])))
    return out


def _pieces(net: Network, data: np.ndarray, portion: int):
    """(bytes, embedded rows, answers, number of chunks) of one long text, a bounded number of chunks at a time."""
    per = max(portion // STRIDE_BYTES, 1)
    n = max(-(-(len(data) - BLOCK_BYTES) // STRIDE_BYTES), 1)
    for low in range(0, n, per):
        high = min(low + per, n)
        begin, end = low * STRIDE_BYTES, high * STRIDE_BYTES + BLOCK_BYTES
        piece = np.zeros(end - begin + STEP, np.uint8)  # the step that the last answer also sees
        taken = data[begin : end + STEP]
        piece[: len(taken)] = taken
        rows = net.letters[piece].reshape(-1, STEP * net.letters.shape[1])
        both = rows @ np.concatenate((net.top, net.bottom), 1)
        k = net.top.shape[1]
        yield piece, rows, both[:-1, :k] + both[1:, k:], high - low


def _long(net: Network, data: np.ndarray, portion: int) -> np.ndarray:
    """Features of one long text."""
    largest, total, n = None, 0.0, 0
    for _, _, out, chunks in _pieces(net, data, portion):
        values = pooled(net, out, np.array([chunks]))[0]
        best = values.max(0)
        largest = best if largest is None else np.maximum(largest, best)
        total, n = total + values.sum(0), n + chunks
    return np.concatenate((largest, total / n))[None, :]


def start(how: ByteCnn, rate: float) -> Network:
    random = np.random.default_rng(how.seed)
    normal = lambda *s: random.normal(size=s).astype(np.float32)
    letters = normal(256, how.embedding) * np.float32(0.5)
    letters[0] = 0
    width = STEP * how.embedding
    scale = np.float32(1 / np.sqrt(width))
    return Network(
        letters,
        normal(width, how.filters) * scale,
        normal(width, how.filters) * scale,
        np.zeros(how.filters, np.float32),
        normal(2 * how.filters) * np.float32(0.1),
        np.array([np.log(rate / (1 - rate))], np.float32),
    )


def _back(
    net: Network, laid: np.ndarray, rows: np.ndarray, after: np.ndarray, out: np.ndarray, best: np.ndarray,
    first: np.ndarray, d_values: np.ndarray,
) -> list[np.ndarray]:
    """Gradients of letters, filters and bias from those of the chunks' values; `after` is the row behind each step."""
    n = net.top.shape[1]
    # Where in its chunk each filter had its largest answer.
    blocks = out.reshape(-1, BLOCK, n)
    peak = blocks.max(1)
    block = np.zeros(best.shape, np.int64)
    for k in reversed(range(STRIDE + 1)):
        block = np.where(peak[first + k] == best, first[:, None] + k, block)
    step = block * BLOCK + blocks.argmax(1)[block, np.arange(n)[None, :]]
    d_top, d_bottom = np.zeros_like(net.top), np.zeros_like(net.bottom)
    d_letters = np.zeros_like(net.letters)
    padded = np.concatenate((rows, np.zeros((1, rows.shape[1]), rows.dtype)))
    steps = laid.reshape(-1, STEP)
    for f in range(n):
        live = np.flatnonzero(d_values[:, f])
        t, g = step[live, f], d_values[live, f]
        d_top[:, f] = g @ rows[t]
        d_bottom[:, f] = g @ padded[after[t]]
        for side, at in ((net.top, t), (net.bottom, after[t])):
            ok = at < len(steps)
            w = side[:, f].reshape(STEP, -1)
            for k in range(STEP):
                np.add.at(d_letters, steps[at[ok], k], g[ok, None] * w[k])
    d_letters[0] = 0
    return [d_letters, d_top, d_bottom, d_values.sum(0)]


def gradients(net: Network, laid: np.ndarray, chunks: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradient of the mean logistic loss over some texts."""
    out, rows = answers(net, laid, chunks)
    values, best, first = pooled(net, out, chunks)
    z = features(values, chunks)
    p = 1 / (1 + np.exp(-(z @ net.weights + net.intercept[0])))
    dz = ((p - y) / len(y)).astype(np.float32)
    d_weights, d_intercept = z.T @ dz, np.array([dz.sum()], np.float32)
    n = net.top.shape[1]
    text = np.repeat(np.arange(len(chunks)), chunks)
    top_value = z[:, :n][text]
    # The mean hands its share to all chunks, the largest to the first chunk that has it.
    d_values = (dz / chunks)[text][:, None] * net.weights[n:]
    hit = values == top_value
    begins = np.cumsum(chunks) - chunks
    seen = np.cumsum(hit, 0)
    before = np.concatenate((np.zeros((1, n), seen.dtype), seen))[begins][text]
    hit &= seen - before == 1
    d_values = d_values + hit * (dz[text][:, None] * net.weights[:n])
    d_values = np.where(values > 0, d_values, 0).astype(np.float32)
    last = np.cumsum((chunks * STRIDE + 1) * BLOCK) - 1
    after = np.arange(1, len(rows) + 1)
    after[last] = len(rows)  # the last answer of a text sees nothing behind it
    return [*_back(net, laid, rows, after, out, best, first, d_values), d_weights, d_intercept]


def _long_gradients(net: Network, data: np.ndarray, y: float, portion: int) -> list[np.ndarray]:
    """Gradient of the loss over one long text, in two passes over its pieces: its features first, then their shares."""
    z = _long(net, data, portion)
    n = net.top.shape[1]
    p = 1 / (1 + np.exp(-(z @ net.weights + net.intercept[0])))
    dz = np.float32(p[0] - y)
    total = max(-(-(len(data) - BLOCK_BYTES) // STRIDE_BYTES), 1)
    found, open_ = None, np.ones(n, bool)  # filters whose largest answer is still to come
    for piece, rows, out, chunks in _pieces(net, data, portion):
        values, best, first = pooled(net, out, np.array([chunks]))
        hit = (values == z[0, :n]) & open_
        hit &= np.cumsum(hit, 0) == 1
        open_ &= ~hit.any(0)
        d_values = dz / total * net.weights[n:] + hit * (dz * net.weights[:n])
        d_values = np.where(values > 0, d_values, 0).astype(np.float32)
        after = np.arange(1, len(out) + 1)
        part = _back(net, piece, rows, after, out, best, first, d_values)
        found = part if found is None else [a + b for a, b in zip(found, part, strict=True)]
    return [*found, z[0] * dz, np.array([dz], np.float32)]


def batch_gradients(
    net: Network, data: np.ndarray, offsets: np.ndarray, y: np.ndarray, portion: int = 1 << 19
) -> list[np.ndarray]:
    """Gradient of the mean logistic loss over texts given as bytes, a portion of them at a time."""
    found = None
    for low, high in portions(offsets, portion):
        part = offsets[low : high + 1]
        if high - low == 1 and part[1] - part[0] > portion:
            own = _long_gradients(net, data[part[0] : part[1]], float(y[low]), portion)
        else:
            laid, chunks = lay_out(data[part[0] : part[-1]], part - part[0])
            own = gradients(net, laid, chunks, y[low:high])
        own = [g * np.float32((high - low) / len(y)) for g in own]
        found = own if found is None else [a + b for a, b in zip(found, own, strict=True)]
    return found


def train(texts: list[bytes], y: np.ndarray, how: ByteCnn) -> Network:
    """Adam on small batches of texts; deterministic for a seed and the order of the texts."""
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    net = start(how, rate)
    if not len(y) or rate in (0.01, 0.99):
        net.weights[:] = 0
        return net
    random = np.random.default_rng(how.seed + 1)
    parts = net.parts()
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    turn, turns = 0, how.epochs * -(-len(texts) // how.batch)
    for _ in range(how.epochs):
        order = random.permutation(len(texts))
        for low in range(0, len(order), how.batch):
            picked = order[low : low + how.batch]
            own = [texts[i] for i in picked]
            data = np.frombuffer(b"".join(own), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in own])))
            found = batch_gradients(net, data, offsets, y[picked].astype(np.float32), how.portion)
            turn += 1
            rate = how.rate * (1 - 0.9 * turn / turns)
            for i, (p, g) in enumerate(zip(parts, found, strict=True)):
                g = g + how.decay * p
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                unbiased = first[i] / (1 - 0.9**turn)
                p -= (rate * unbiased / (np.sqrt(second[i] / (1 - 0.999**turn)) + 1e-8)).astype(p.dtype)
            net.letters[0] = 0
    return net


def fit(docs: DataFrame, labels: DataFrame, how: ByteCnn = ByteCnn(), text: str = "text") -> Network:
    """A network from a bounded sample of labelled documents outside of the held-out fold.

    Only texts are learned from; labels, ids, languages and sources are no inputs. The rows come in an order of their hashes, until
    `sample` rows or `sample_bytes` bytes of text are reached; the row that passes the bytes is the last one, so no text is
    left out for its length, and a long text is learned from whole, in portions of chunks. Without labels of both kinds
    every document gets the same score, the share of label 1 (0.5 without labels).
    """
    rows = training_rows(docs.select("doc_id", text), labels, how.sample)
    rows = rows.select("doc_id", F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("text"), "quality")
    # At most `sample` rows, so a window without a partition is bounded.
    ahead = Window.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum(F.octet_length("text")).over(ahead), F.lit(0)))
    rows = rows.filter(F.col("ahead") < how.sample_bytes).drop("ahead")
    table = rows.toPandas().sort_values(["doc_id", "text"])
    return train([bytes(t) for t in table["text"]], table["quality"].to_numpy(float), how)


def classify(
    docs: DataFrame, net: Network, how: ByteCnn = ByteCnn(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: key, score (0 to 1) and predicted (1 if the score reaches the threshold).

    A null or empty text is scored as a chunk of padding. A very long text is scored whole, in portions of its chunks.
    Rows that repeat are scored each. Other columns are not read. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            p = score(sent.value, *utf8(batch.column(1)), how.portion)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= how.threshold).astype(np.int32))],
                names=[key, "score", "predicted"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double, predicted int")


def verdict(net: Network, how: ByteCnn = ByteCnn()):
    """Function from a column of texts to the rows that are kept."""
    return lambda column: score(net, *utf8(column), how.portion) >= how.threshold
