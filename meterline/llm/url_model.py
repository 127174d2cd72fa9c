"""URL filter: host and path rules, and character models of accepted and rejected URLs for the rest.

URLs that a rule decides are the examples. For each verdict a Markov model of variable order over the URL's bytes is
counted on all of them: the chance of a byte after the last `order` bytes is smoothed with the chance after one byte
less, down to a uniform one. A byte and the bytes before it are a number, its gram, so counts are exact: a table of Spark with
a row for each gram that occurs in any URL, which grows with the corpus. Chances are joined from order to order, and the steps
of the URLs with what each gram gains. A URL's score is the difference of its log-likelihoods under both models, divided by its
length; the limit between allow and block is calibrated on examples that were not counted.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.arrow import portions, utf8
from meterline.llm.components import write_scratch

ALLOW, BLOCK = "allow", "block"


#: Bits of a byte in a gram (0 stands before the URL), bytes of URLs taken at a time, and a gain of one.
BITS = 9
PORTION = 1 << 20
UNIT = 1 << 30


@dataclass(frozen=True)
class UrlModel:
    """Longest context, weight of the shorter context, and the score's bins."""

    order: int = 5
    weight: float = 2.0
    held_out: int = 5
    bins: int = 4000
    widest: float = 10.0

    def __post_init__(self):
        if not 0 <= self.order <= 5:
            raise ValueError("a gram of more than 6 bytes and its order do not fit into a long")

    @property
    def slots(self) -> int:
        """Grams there can be."""
        return 1 << BITS * (self.order + 1)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A to Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null. A rule `a.b/c` fits hosts a.b and x.a.b and paths that begin with /c."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def _grams(data: np.ndarray, offsets: np.ndarray, how: UrlModel) -> np.ndarray:
    """Every byte with its longest context as one number, the byte itself in the lowest bits."""
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    pad = how.order
    wide = np.zeros(len(data) + rows * pad, np.int64)  # zeros before each URL: contexts stay inside it
    at = np.arange(len(data)) + (np.repeat(np.arange(rows), sizes) + 1) * pad
    byte = data.astype(np.int64)
    byte[(data >= 48) & (data <= 57)] = 48  # all digits are alike
    wide[at] = byte + 1
    gram = np.zeros(len(data), np.int64)
    for k in range(how.order + 1):
        gram |= wide[at - k] << (BITS * k)
    return gram


def _shorter(gram, k: int):
    """The gram of order k at the end of a longer one."""
    mask = (1 << BITS * (k + 1)) - 1
    return gram.bitwiseAND(F.lit(mask)) if isinstance(gram, Column) else gram & mask


def _steps(data: np.ndarray, offsets: np.ndarray, how: UrlModel):
    """For each order, every byte with its context and the context alone."""
    gram = _grams(data, offsets, how)
    for k in range(how.order + 1):
        pair = _shorter(gram, k)
        yield k, pair, pair >> BITS


def _by_portion(batch, how: UrlModel):
    """First row, sizes and grams of portions of a batch whose first column is the URL."""
    data, offsets = utf8(batch.column(0))
    for low, high in portions(offsets, PORTION):
        part = offsets[low : high + 1]
        if part[-1] > part[0]:
            yield low, np.diff(part), _grams(data[part[0] : part[-1]], part - part[0], how)


def count_grams(urls: DataFrame, how: UrlModel) -> DataFrame:
    """(gram, allow, block): all grams of `urls` (url, allow, block), and how often they are in examples of each verdict."""

    def run(batches):
        for batch in batches:
            numbers = [batch.column(i).to_numpy() for i in (1, 2)]
            for low, sizes, gram in _by_portion(batch, how):
                found, at = np.unique(gram, return_inverse=True)
                rows = np.repeat(np.arange(low, low + len(sizes)), sizes)
                sums = [np.bincount(at, n[rows], len(found)).astype(np.int64) for n in numbers]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, *sums)], names=["gram", ALLOW, BLOCK])

    counts = urls.select("url", ALLOW, BLOCK).mapInArrow(run, f"gram long, {ALLOW} long, {BLOCK} long")
    return counts.groupBy("gram").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK))


def gains(counts: DataFrame, how: UrlModel) -> DataFrame:
    """(gram, gain): log of the gram's chance among accepted URLs less that among rejected ones, in whole parts of UNIT."""
    chances = None
    for k in range(how.order + 1):
        level = counts.groupBy(_shorter(F.col("gram"), k).alias("gram"))
        level = level.agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK))
        # A context has at most 256 bytes after it, so no window is larger.
        context = Window.partitionBy(F.shiftright("gram", BITS))
        level = level.withColumns({f"{v}_context": F.sum(v).over(context) for v in (ALLOW, BLOCK)})
        if chances is None:
            level = level.withColumns({f"{v}_before": F.lit(1 / 256) for v in (ALLOW, BLOCK)})
        else:
            before = chances.select(F.col("gram").alias("end"), *[F.col(f"{v}_chance").alias(f"{v}_before") for v in (ALLOW, BLOCK)])
            level = level.withColumn("end", _shorter(F.col("gram"), k - 1)).join(before, "end")
        chances = level.select(
            "gram",
            *[
                ((F.col(v) + how.weight * F.col(f"{v}_before")) / (F.col(f"{v}_context") + how.weight)).alias(f"{v}_chance")
                for v in (ALLOW, BLOCK)
            ],
        )
    gain = F.log(f"{ALLOW}_chance") - F.log(f"{BLOCK}_chance")
    return chances.select("gram", F.round(gain * UNIT).cast("long").alias("gain"))


def _id(url: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(url), F.lit("")).cast("binary")))


def score_urls(urls: DataFrame, gained: DataFrame, how: UrlModel) -> DataFrame:
    """(id, score) of distinct `urls` (url, id): the sum of their grams' gains by their length. Empty URLs have no row.

    Gains are whole numbers, so a sum is the same in any order.
    """

    def run(batches):
        for batch in batches:
            for low, sizes, gram in _by_portion(batch, how):
                rows = np.repeat(np.arange(low, low + len(sizes)), sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(rows)), pa.array(gram)], names=["id", "gram"]
                )

    steps = urls.select("url", "id").mapInArrow(run, "id binary, gram long")
    found = steps.join(gained, "gram").groupBy("id")
    return found.agg((F.sum("gain") / F.lit(UNIT) / F.count("*")).alias("score"))


@dataclass
class Fitted:
    """Exact counts of both models, the scores of the URLs, and the limit; no frames if there were no examples."""

    counts: DataFrame | None
    scores: DataFrame | None
    limit: float
    how: UrlModel

    @cached_property
    def tables(self) -> dict:
        """The counts of both models on the driver, to look into small ones: by (2 * order) * slots + gram and
        (2 * order + 1) * slots + context. What does not occur is 0."""
        if self.counts is None:
            return {}
        out = {ALLOW: Counter(), BLOCK: Counter()}
        for gram, *numbers in self.counts.collect():
            for name, n in zip(out, numbers, strict=True):
                for k in range(self.how.order + 1):
                    pair = _shorter(gram, k)
                    out[name][2 * k * self.how.slots + pair] += n
                    out[name][(2 * k + 1) * self.how.slots + (pair >> BITS)] += n
        return out


def fit(examples: DataFrame, how: UrlModel, url: str = "url", verdict: str = "verdict") -> Fitted:
    """Models, scores and limit: rows with a verdict of allow or block are examples, all rows are scored.

    Counts and scores are tables in the shared folder; only the histogram comes to the driver. Examples whose hash falls in the
    held-out part set the limit, by a histogram of their scores: the middle of the limits with the best mean of
    both verdicts' shares that are right. Without examples of both kinds there is no model and every URL is allowed.
    """
    numbers = [F.sum((F.col(verdict).eqNullSafe(v)).cast("long")).alias(v) for v in (ALLOW, BLOCK)]
    urls = examples.groupBy(F.col(url).alias("url")).agg(*numbers)
    held = F.pmod(F.xxhash64("url"), F.lit(how.held_out)) == 0
    urls = write_scratch(urls.select("url", ALLOW, BLOCK, _id("url").alias("id"), held.alias("held")), "urls")
    counted = urls.withColumns({v: F.when(~F.col("held"), F.col(v)).otherwise(0) for v in (ALLOW, BLOCK)})
    counts = write_scratch(count_grams(counted, how), "url-grams")
    if not all(counts.agg(F.sum(ALLOW), F.sum(BLOCK)).first()):
        return Fitted(None, None, 0.0, how)
    scores = write_scratch(score_urls(urls, gains(counts, how), how), "url-scores")
    fitted = Fitted(counts, scores, 0.0, how)
    known = urls.filter(f"held AND {ALLOW} + {BLOCK} > 0").join(scores, "id", "left")
    at = (F.coalesce("score", F.lit(0.0)) + how.widest) / (2 * how.widest) * how.bins
    bin_ = F.greatest(F.least(F.floor(at), F.lit(how.bins - 1)), F.lit(0)).alias("bin")
    hist = {name: np.zeros(how.bins) for name in (ALLOW, BLOCK)}
    for b, *found in known.groupBy(bin_).agg(F.sum(ALLOW), F.sum(BLOCK)).collect():
        for name, n in zip(hist, found, strict=True):
            hist[name][b] = n
    if hist[ALLOW].any() and hist[BLOCK].any():
        # With the limit at the lower edge of bin b: blocked are the bins below b.
        below = {k: np.concatenate(([0], np.cumsum(h))) / h.sum() for k, h in hist.items()}
        right = below[BLOCK] + 1 - below[ALLOW]
        best = np.flatnonzero(right >= right.max() - 1e-12)
        middle = (best[0] + best[-1]) / 2
        fitted.limit = float(middle / how.bins * 2 * how.widest - how.widest)
    return fitted


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    how: UrlModel = UrlModel(),
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row for each row of `pages`: key, host, path, rule, verdict and score.

    The longest fitting rule decides; without one, the models do. A null URL and one without `://` have an empty host and
    path and no rule; a null one is scored as an empty text. Rows that repeat are judged, and counted, each. Other columns
    are not read. An empty table gives no rows.
    """
    parsed = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    parsed = parsed.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    parsed = parsed.withColumn("verdict", verdict_of(F.col("rule"), rules))
    fitted = fit(parsed, how)
    if fitted.scores is None:
        scored = parsed.withColumn("score", F.lit(0.0))
    else:
        scored = parsed.withColumn("id", _id("url")).join(fitted.scores, "id", "left")
        scored = scored.withColumn("score", F.coalesce("score", F.lit(0.0)))
    own = F.when(F.col("score") >= fitted.limit, ALLOW).otherwise(BLOCK)
    return scored.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score"
    )
