"""Quality rules: fixed base rules, then gradient-boosted trees over statistics of a document.

The statistics are counted on whole texts, many texts at once in numpy. The trees are fitted on a bounded sample of
labelled rows with logistic loss; on chosen features the score may only rise or only fall. A fitted forest is five
flat arrays, and a batch of documents walks down all trees level by level in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterline.llm.arrow import portions, utf8
from meterline.llm.labelled import training_rows
from meterline.llm.words import GOLDEN, SECOND, hashes, mix, spans

_PORTION = 1 << 18
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Feature -> the direction in which the score may move: 1 rises, -1 falls, 0 free.
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "sign_share": 0,
    "distinct_share": 0,
    "words_per_line": 0,
    "bare_words_share": -1,
}


@dataclass(frozen=True)
class TreeRules:
    """Base rules, the size of the sample and of the forest, and the least score that is kept."""

    least_words: int = 50
    most_repeat_percent: int = 50
    sample: int = 20_000
    trees: int = 60
    depth: int = 3
    bins: int = 32
    rate: float = 0.15
    ridge: float = 1.0
    least_rows: int = 8
    least_score: float = 0.3


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key, whether another entry is equal."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.empty(len(s), bool)
    out[order] = same[1:] | same[:-1]
    return out


def later(keys: np.ndarray) -> np.ndarray:
    """For each key, whether an earlier entry is equal."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    out = np.zeros(len(s), bool)
    out[order[1:]] = s[1:] == s[:-1]
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (rows x COUNTS) and features (rows x FEATURES) of texts given as bytes."""
    counts, features = [], []
    for low, high in portions(offsets, _PORTION):
        part = offsets[low : high + 1]
        c, f = _statistics(data[part[0] : part[-1]], part - part[0])
        counts.append(c)
        features.append(f)
    if not counts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate(counts), np.concatenate(features)


def _statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = len(offsets) - 1

    def per_row(marked: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, first = spans(data, offsets)
    word = hashes(data, starts, ends)
    n_words = np.diff(first)
    row_of_word = np.repeat(np.arange(rows), n_words)

    space = (data == 32) | ((data >= 9) & (data <= 13))
    points = per_row((data & 0xC0) != 0x80)  # code points: bytes that do not continue one
    word_chars = points - per_row(space)
    n_symbols = per_row(np.isin(data, SYMBOLS))
    upper = per_row((data >= 65) & (data <= 90))
    letters = per_row(((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 0xC0))
    digits = per_row((data >= 48) & (data <= 57))

    # Words inside of three-word windows that occur again in the same text.
    salt = mix(row_of_word.astype(np.uint64) * GOLDEN + np.uint64(1))
    in_window = np.zeros(len(word), bool)
    if len(word) >= 3:
        inside = row_of_word[2:] == row_of_word[:-2]
        keys = mix(mix(word[:-2] * SECOND + word[1:-1]) * SECOND + word[2:]) + salt[:-2]
        at = np.flatnonzero(inside)
        hit = at[repeated(mix(keys[at]))]
        for k in range(3):
            in_window[hit + k] = True
    n_repeat = np.bincount(row_of_word[in_window], minlength=rows)

    # Lines: cut at \n and at the ends of rows; only lines with a word count.
    cuts = np.flatnonzero(data == 10)
    begins = np.concatenate((offsets[:-1], cuts + 1))
    stops = np.concatenate((offsets[1:], cuts))
    begins.sort()
    stops.sort()
    row_of_line = np.searchsorted(offsets, begins, side="right") - 1
    # The line after the last \n of a row begins where the next row does, and empty rows share their place.
    lines = np.bincount(np.searchsorted(offsets[1:], cuts, side="right"), minlength=rows) + 1
    row_of_line = np.repeat(np.arange(rows), lines)
    words_before = np.searchsorted(starts, begins)
    n_line_words = np.searchsorted(starts, stops) - words_before
    full = n_line_words > 0
    line_key = mix(hashes(data, begins[full], stops[full]) + mix(row_of_line[full].astype(np.uint64) * GOLDEN))
    n_dup = np.bincount(row_of_line[full][later(line_key)], minlength=rows) if full.any() else np.zeros(rows, int)
    n_lines = np.bincount(row_of_line[full], minlength=rows)

    distinct = np.bincount(row_of_word[~later(mix(word + salt))], minlength=rows) if len(word) else np.zeros(rows, int)
    # Words without a letter: signs, numbers, bars.
    is_letter = (((data | 32) >= 97) & ((data | 32) <= 122)) | (data >= 0x80)
    total = np.concatenate(([0], np.cumsum(is_letter, dtype=np.int64)))
    bare = np.bincount(row_of_word[total[ends] == total[starts]], minlength=rows)

    counts = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], 1).astype(np.int64)
    w, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / w,
            n_symbols / w,
            n_dup / np.maximum(n_lines, 1),
            n_repeat / w,
            upper / np.maximum(letters, 1),
            digits / chars,
            (word_chars - digits - letters) / chars,
            distinct / w,
            n_words / np.maximum(n_lines, 1),
            bare / w,
        ],
        1,
    )
    return counts, features


@dataclass
class Forest:
    """Nodes of all trees, one tree after the other; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row; all trees of a block of rows go down a level at a time."""
        out = np.full(len(x), self.base)
        for low in range(0, len(x), 4096):
            part = x[low : low + 4096]
            rows = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            for _ in range(self.depth):
                goes_left = part[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            out[low : low + 4096] += self.value[at].sum(1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


@dataclass
class _Growing:
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def leaf(self, value: float) -> int:
        i = len(self.feature)
        self.feature.append(0)
        self.threshold.append(0.0)
        self.left.append(i)
        self.right.append(i)
        self.value.append(value)
        return i


def fit_forest(x: np.ndarray, y: np.ndarray, directions: list[int], how: TreeRules) -> Forest:
    """Trees on binned features. A split that breaks a feature's direction is not taken, and the values below
    it stay on their side of the middle of the two, so the whole forest keeps to the directions."""
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    base = float(np.log(rate / (1 - rate)))
    grown, roots = _Growing(), []
    margin = np.full(len(y), base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, how.bins + 1)[1:-1])) for c in x.T] if len(y) else []
    binned = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)] if len(y) else []

    def grow(rows: np.ndarray, depth: int, low: float, high: float, g: np.ndarray, h: np.ndarray) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        own = float(np.clip(-gs / (hs + how.ridge), low, high))
        best = (1e-6, None)
        if depth < how.depth and len(rows) >= 2 * how.least_rows:
            for f, way in enumerate(directions):
                k = len(edges[f])
                if not k:
                    continue
                b = binned[f][rows]
                gl = np.cumsum(np.bincount(b, g[rows], k + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], k + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=k + 1))[:-1]
                vl = np.clip(-gl / (hl + how.ridge), low, high)
                vr = np.clip(-(gs - gl) / (hs - hl + how.ridge), low, high)
                # Gain of the clipped values: - (g v + (h + ridge) v² / 2), both sides less the parent.
                gain = -(gl * vl + (hl + how.ridge) * vl**2 / 2)
                gain -= (gs - gl) * vr + (hs - hl + how.ridge) * vr**2 / 2
                gain += gs * own + (hs + how.ridge) * own**2 / 2
                gain[(nl < how.least_rows) | (len(rows) - nl < how.least_rows)] = -1
                if way:
                    gain[way * (vr - vl) < 0] = -1
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (float(gain[i]), (f, i, float(vl[i]), float(vr[i])))
        i = grown.leaf(own * how.rate)
        if best[1]:
            f, cut, vl, vr = best[1]
            middle, way = (vl + vr) / 2, directions[f]
            goes_left = binned[f][rows] <= cut
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}
            grown.feature[i], grown.threshold[i] = f, float(edges[f][cut])
            grown.left[i] = grow(rows[goes_left], depth + 1, *bounds[way][0], g, h)
            grown.right[i] = grow(rows[~goes_left], depth + 1, *bounds[way][1], g, h)
        return i

    def forest() -> Forest:
        arrays = [np.array(a) for a in (grown.feature, grown.threshold, grown.left, grown.right, grown.value)]
        return Forest(*arrays, np.array(roots, np.int64), how.depth, base)

    if len(y) and 0 < y.mean() < 1:
        for _ in range(how.trees):
            p = 1 / (1 + np.exp(-margin))
            first = len(grown.feature)
            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf, p - y, p * (1 - p)))
            tree = Forest(
                *(np.array(a) for a in (grown.feature, grown.threshold, grown.left, grown.right, grown.value)),
                np.array([first]), how.depth, 0.0,
            )
            margin += tree.margin(x)
    else:
        roots.append(grown.leaf(0.0))
    return forest()


def fit(docs: DataFrame, labels: DataFrame, how: TreeRules = TreeRules(), text: str = "text") -> Forest:
    """Trees from a bounded sample of labelled documents outside of the held-out fold.

    Only statistics come to the driver, a few numbers for each sampled row. Without labels of both kinds every
    document gets the same score, the share of label 1 (0.5 without labels).
    """
    rows = training_rows(docs.select("doc_id", text), labels, how.sample)
    names = list(FEATURES)

    def run(batches):
        for batch in batches:
            _, x = statistics(*utf8(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in x.T), batch.column(1)], names=[*names, "target"]
            )

    schema = ", ".join(f"{n} double" for n in names) + ", target int"
    table = rows.select(text, "quality").mapInArrow(run, schema).toPandas()
    table = table.sort_values([*names, "target"])
    return fit_forest(table[names].to_numpy(float), table["target"].to_numpy(float), list(FEATURES.values()), how)


def judge(data: np.ndarray, offsets: np.ndarray, forest: Forest, how: TreeRules):
    """Counts, base_failed, score and kept of texts given as bytes."""
    counts, x = statistics(data, offsets)
    n, repeat = counts[:, 0], counts[:, 4]
    failed = (n < how.least_words) | (100 * repeat > how.most_repeat_percent * n)
    score = forest.score(x)
    return counts, failed, score, ~failed & (score >= how.least_score)


def apply_rules(
    docs: DataFrame, forest: Forest, how: TreeRules = TreeRules(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: key, the base counts, base_failed, kept and score.

    A null, empty or blank text has no words and fails the base rules. Rows that repeat are judged each. Other columns
    are not read. An empty table gives no rows. Very long texts are counted whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            counts, failed, score, kept = judge(*utf8(batch.column(1)), sent.value, how)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(kept), pa.array(score)],
                names=[key, *COUNTS, "base_failed", "kept", "score"],
            )

    kind = docs.schema[key].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, {longs}, base_failed boolean, kept boolean, score double"
    )


def verdict(forest: Forest, how: TreeRules = TreeRules()):
    """Function from a column of texts to the rows that are kept."""
    return lambda column: judge(*utf8(column), forest, how)[3]
