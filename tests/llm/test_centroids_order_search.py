"""Centroid clustering, Order MinHash fingerprints and ranked search against plain versions of each."""

import hashlib
import heapq
import math
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash

from meterline.llm import best_position, heap_kmeans, order_minhash
from meterline.llm.arrow import prepare

VECTORS = "vec_id long, embedding array<float>, label int, cluster string"
DOCS = "doc_id long, text string, rank string, signature int"
ITEMS = "item_id long, text string, score string"


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# k-means


def plain_clusters(vectors, how):
    kept = [
        (i, [math.floor(how.scale * float(x)) for x in v])
        for i, v in vectors
        if v is not None and len(v) == how.width and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"{how.seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centers = [v for _, v in sorted(named)[: how.clusters]]
    if not centers:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(how.rounds):
        groups = [[] for _ in centers]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(g) for x in zip(*g)] if g else c for c, g in zip(centers, groups)]
    found = [(i, *nearest(v)) for i, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    inertia = Counter()
    for _, d, c in found:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in found), key=repr)


@pytest.mark.parametrize("block", [7, 4096])
def test_clusters_agree_with_a_plain_version(spark, block):
    random = np.random.default_rng(5)
    how = heap_kmeans.HeapKMeans(width=4, clusters=5, rounds=6, block=block)
    grid = [(i, [float(x) for x in random.integers(-3, 3, 4) / 4]) for i in range(150)]  # many ties
    odd = [(200, None), (201, []), (202, [0.1] * 3), (203, [0.1, None, 0.2, 0.3]), (204, [0.0, float("nan"), 0.0, 0.0])]
    odd += [(205, [float("inf")] * 4), (7, grid[7][1]), (7, grid[8][1]), (None, [0.5] * 4), (206, [3000.25] * 4)]
    given = [(i, v, 1, "x") for i, v in grid + odd]
    out = heap_kmeans.cluster(spark.createDataFrame(given, VECTORS), how)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows(out) == plain_clusters(grid + odd, how)


def test_clusters_of_few_or_no_vectors(spark):
    how = heap_kmeans.HeapKMeans(width=2)
    one = [(4, [0.5, -0.5])]
    for given in ([], one, one * 3, [(1, [1e30, 0.0])], [(None, [0.0, 0.0])], [(i, [1.0, 1.0]) for i in range(20)]):
        out = heap_kmeans.cluster(spark.createDataFrame([(i, v, 0, "") for i, v in given], VECTORS), how)
        fine = [(i, v) for i, v in given if max(map(abs, v)) < 1e5]
        assert rows(out) == plain_clusters(fine, how)


def test_exact_distances_beyond_doubles():
    how = heap_kmeans.HeapKMeans()
    x = np.full((2, how.width), how.largest(), np.int64)
    x[1] -= 1
    far = heap_kmeans.squared(x.astype(np.int32), -x)
    assert far.tolist() == [[sum((int(a) + int(b)) ** 2 for a, b in zip(p, q)) for q in x] for p in x]


def test_heap_keeps_its_order_and_entries():
    random = np.random.default_rng(1)
    keys, names = np.zeros(0), np.zeros(0, np.int32)
    held = {}
    for turn in range(60):
        limit = np.quantile(keys, random.random() * 0.9) if len(keys) else 0.0
        gone = heap_kmeans.expired(keys, limit)
        assert sorted(names[gone]) == sorted(n for n, key in held.items() if key <= limit)
        for n in names[gone].tolist():
            del held[n]
        new = random.random(int(random.integers(0, 40))) + turn / 20
        fresh = np.arange(turn * 100, turn * 100 + len(new), dtype=np.int32)
        keys, names = heap_kmeans.exchange(keys, names, gone, new, fresh)
        held |= dict(zip(fresh.tolist(), new.tolist()))
        assert dict(zip(names.tolist(), keys.tolist())) == held
        below = np.arange(1, len(keys))
        assert (keys[(below - 1) // 2] <= keys[below]).all()
        rest = keys.tolist()
        heapq.heapify(rest)
        assert not rest or rest[0] == keys[0]


def test_only_expired_vectors_are_compared(monkeypatch):
    random = np.random.default_rng(2)
    middles = np.array([[0, 0], [4000, 0], [0, 4000]])
    x = (middles[random.integers(0, 3, 900)] + random.integers(-300, 300, (900, 2))).astype(np.int32)
    heaps, _ = heap_kmeans.advance(x, None, middles, np.zeros(3))
    looked = []
    real = heap_kmeans.squared
    monkeypatch.setattr(heap_kmeans, "squared", lambda a, c: (looked.append(len(a)), real(a, c))[1])
    drift = np.full(3, 2 * math.hypot(20, 10))
    heaps, moved = heap_kmeans.advance(x, heaps, middles + [20, 10], drift)
    assert looked == [0] and not moved.any()
    drift = drift + 2 * math.hypot(1300, 1300)
    heaps, _ = heap_kmeans.advance(x, heaps, middles + [1320, 1310], drift)
    assert 0 < looked[1] < 900
    assert (heaps.clusters(900) == real(x, middles + [1320, 1310]).argmin(1)).all()


# Order MinHash


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def plain_fingerprint(text, how):
    """Straight from the definition, with a public implementation of the hash."""
    if not text:
        return []
    raw, size = text.encode("utf-32-be"), 4 * how.k
    seen, elements = Counter(), []
    for at in range(0, max(len(text) - how.k, 0) + 1):
        h = xxhash.xxh64_intdigest(raw[4 * at : 4 * at + size], 42) >> 31
        seen[h] += 1
        if seen[h] > 1:
            base = xxhash.xxh64_intdigest(struct.pack("<q", signed(h << 31)), 42)
            h2 = xxhash.xxh64_intdigest(struct.pack("<i", seen[h]), base) >> 31
        else:
            h2 = h
        elements.append((signed(h2 << 31), 4 * at + 1, h2))
    bins = {}
    for order, at, h in sorted(elements):
        bins.setdefault(h >> (33 - how.bin_bits), []).append((at, h))
    out = []
    for b, found in bins.items():
        code = 42
        for _, h in sorted(found[: how.order]):
            code = xxhash.xxh64_intdigest(struct.pack("<q", h), code)
        out.append(b << 32 | code & 0xFFFFFFFF)
    return sorted(out)


def plain_likeness(a, b, how):
    if not a and not b:
        return 1.0
    either = {x >> 32 for x in a} | {x >> 32 for x in b}
    return (len(set(a) & set(b)) / len(either)) ** (1 / how.order)


def plain_fingerprints(docs, how):
    """For distinct ids."""
    docs = sorted(((i, t or "") for i, t in docs), reverse=True)
    out = []
    for n, (i, text) in enumerate(docs):
        after = docs[(n + 1) % len(docs)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        prints = [plain_fingerprint(t, how) for t in (text, edited, after)]
        shown = ["".join(f"{x:010x}" for x in p) for p in prints]
        likes = [plain_likeness(prints[0], p, how) for p in prints[1:]]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), digest, shown[0], shown[1], *likes))
    return sorted(out, key=repr)


def texts():
    random = np.random.default_rng(3)
    words = ["alpha", "beta", "garçon", "日本", "é", "😀😀", "of", "the", "\n", "z" * 40]
    made = [" ".join(random.choice(words, int(n))) for n in random.integers(1, 200, 60)]
    return [*made, "", None, "a", "abcdefg", "aaaaaaaaaaaaaaaaaaaa", "ab" * 500, made[0], made[0] + "x", "é" * 9, "\x00퟿"]


@pytest.mark.parametrize("how", [order_minhash.OrderMinHash(), order_minhash.OrderMinHash(k=3, order=3, bin_bits=3)])
def test_fingerprints_agree_with_a_plain_version(spark, how):
    docs = [(3 * i - 40, t) for i, t in enumerate(texts())]
    given = spark.createDataFrame([(i, t, "r", 1) for i, t in docs], DOCS).repartition(5)
    out = order_minhash.fingerprint_documents(given, how)
    found = rows(out)
    want = plain_fingerprints(docs, how)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert [r[5:] for r in found] == [pytest.approx(r[5:]) for r in want]


def test_fingerprints_of_long_texts_and_moved_passages(spark):
    random = np.random.default_rng(8)
    long = "".join(chr(x) for x in random.integers(97, 123, 150_000))
    moved = long[75_000:] + long[:75_000]
    given = spark.createDataFrame([(2, long), (1, moved)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in order_minhash.fingerprint_documents(given).collect()}
    assert found[2]["fingerprint"] == "".join(f"{x:010x}" for x in plain_fingerprint(long, order_minhash.OrderMinHash()))
    # The same k-mers in another order: a tuple is kept only where both of its k-mers lie in one half.
    assert 0.5 < found[2]["near_next"] < 0.9


def test_next_document_with_repeated_and_missing_ids(spark):
    ids = [5, 5, 5, 9, 9, 1, None, None, 30, 7, 7, 7, 7, 2]
    given = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "doc_id long, text string")
    met = order_minhash.with_next(given, "doc_id", ["text"], "next_").collect()
    assert len(met) == len(ids)
    after, key = {r["text"]: r["next_text"] for r in met}, {f"text {n}": i for n, i in enumerate(ids)}
    # One ring through all rows, in descending order of ids, those without one last.
    ring = [next(t for t, i in key.items() if i == 30)]
    while len(ring) < len(ids):
        ring.append(after[ring[-1]])
    assert len(set(ring)) == len(ids) and after[ring[-1]] == ring[0]
    assert [key[t] for t in ring] == [30, 9, 9, 7, 7, 7, 7, 5, 5, 5, 2, 1, None, None]


def test_fingerprints_of_odd_tables(spark):
    none = order_minhash.fingerprint_documents(spark.createDataFrame([], DOCS))
    assert none.collect() == []
    for docs in ([(None, "some text"), (None, "other text"), (None, None)], [(4, "alone here")], [(1, "same")] * 3):
        found = order_minhash.fingerprint_documents(spark.createDataFrame([(i, t, "", 0) for i, t in docs], DOCS)).collect()
        assert sorted((r["doc_id"], r["n_chars"]) for r in found if r["doc_id"]) == sorted((i, len(t)) for i, t in docs if i)
        assert len(found) == len(docs)
    assert {r["near_next"] for r in found} == {1.0}


# Ranked search


def plain_ranks(items, docs, k):
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = [(i, Counter(pattern.findall((t or "").translate(lower)))) for i, t in docs]
    big_n = sum(1 for _, c in held if c)
    big_l = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(pattern.findall((t or "").translate(lower)))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 50 + (50 * sum(c.values()) * big_n) // big_l if big_l else 0
            weigh = lambda t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
            score = sum(weigh(t) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort()
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def corpus():
    random = np.random.default_rng(4)
    common = ["the", "of", "a", "Éa", "été"]
    rare = [f"w{n}" for n in range(60)]
    made = []
    for n in random.integers(0, 60, 300):
        made.append(" ".join([*random.choice(common, int(n)), *random.choice(rare, int(n) // 3)]))
    docs = [(i * 7 % 301, t) for i, t in enumerate(made)]
    docs += [(400, None), (401, ""), (402, "--- !!"), (None, "w1 the W2"), (3, made[0]), (3, made[0]), (403, "W1,w1;the" * 4000)]
    items = [(n, " ".join(random.choice(rare + common, 12))) for n in range(12)]
    items += [(50, "the THE the"), (51, None), (52, "nowhere"), (53, "..."), (0, "w5 w6"), (None, "w7 été")]
    return items, docs


@pytest.mark.parametrize("how", [best_position.Ranking(k=7, shard=40, reads=2), best_position.Ranking(k=50, terms=30, portion=100)])
def test_ranks_agree_with_a_plain_version(spark, how):
    items, docs = corpus()
    asked = spark.createDataFrame([(i, t, "s") for i, t in items], ITEMS)
    given = spark.createDataFrame([(i, t, "r", 1) for i, t in docs], DOCS).repartition(3)
    out = best_position.rank_documents(asked, given, how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(out) == plain_ranks(items, docs, how.k)


def test_ranks_of_empty_tables(spark):
    items, docs = spark.createDataFrame([], ITEMS), spark.createDataFrame([], DOCS)
    full_items = spark.createDataFrame([(1, "a b", "")], ITEMS)
    full_docs = spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    for a, b in ((items, docs), (full_items, docs), (items, full_docs), (full_items, spark.createDataFrame([(1, None, "", 0)], DOCS))):
        assert best_position.rank_documents(a, b).collect() == []


def test_search_stops_early_and_keeps_ties():
    rows_, k = 5000, 10
    random = np.random.default_rng(6)
    term = np.repeat(np.arange(3), rows_)
    doc = np.tile(np.arange(rows_), 3)
    impact = np.concatenate([random.permutation(rows_), random.permutation(rows_), np.full(rows_, 7)]).astype(np.int64) + 1
    lists = best_position.Lists(term, doc, impact, rows_)
    looked = []
    real = lists.find
    lists.find = lambda at, docs: (looked.append(len(docs)), real(at, docs))[1]
    docs, scores = lists.best(np.array([0, 1, 2, 9]), k, 4)
    total = impact.reshape(3, rows_).sum(0)
    kth = np.sort(total)[-k]
    assert sum(looked) < rows_ // 2
    assert (total[docs] == scores).all()
    assert set(np.flatnonzero(total >= kth)) <= set(docs.tolist())
