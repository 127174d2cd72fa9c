"""Near duplicates of documents and of embeddings against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.llm import minmax, multi_index
from meterline.llm.arrow import prepare
from meterline.llm.components import components, deal_of
from meterline.llm.words import hashes, shingle_sets, spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=2):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(text)
    return {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def smallest(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(rows, width=2, percent=80):
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    links = []
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a == b or (x and y and 100 * len(x & y) >= percent * len(x | y)):
                links.append((a, b))
    return smallest({i for i, _ in sets}, links)


def corpus(seed=1):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(25):
        base = [pick.choice(words) for _ in range(pick.choice([3, 8, 60, 200]))]
        for _ in range(pick.choice([1, 2, 9])):
            text = list(base)
            for _ in range(pick.choice([0, 1, 3, 10])):
                text[pick.randrange(len(text))] = pick.choice(words)
            rows.append(" ".join(text))
    shared = [pick.choice(words) for _ in range(120)]
    for _ in range(90):  # alike, but not enough: a passage and own words
        rows.append(" ".join(shared + [f"own{pick.randrange(10**6)}" for _ in range(pick.choice([20, 24, 26, 30]))]))
    near = [pick.choice(words) for _ in range(150)]
    for _ in range(90):  # each near the original, not always near one another
        text = list(near)
        for _ in range(pick.randrange(12)):
            text[pick.randrange(len(text))] = f"new{pick.randrange(10**6)}"
        rows.append(" ".join(text))
    rows += ["", None, " \n\t", "Single", "single", "A b", "a B\x0bc", "é é x", "e"]
    rows += [rows[0]] * 7
    ids = list(range(len(rows)))
    pick.shuffle(ids)
    return list(zip(ids, rows, strict=True))


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.mark.parametrize("width,stars", [(2, 3), (2, 1), (5, 2)])
def test_documents_agree_with_all_pairs(spark, width, stars):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, kept boolean")
    found = minmax.near_duplicates(docs.repartition(5), minmax.MinMax(width=width, stars=stars)).collect()
    want = brute(rows, width)
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    texts = dict(rows)
    assert all(r.n_shingles == len(shingles(texts[r.doc_id], width)) for r in found)


def test_prefixes_keep_every_pair(spark):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "id long, text string")
    how = minmax.MinMax()
    facts = minmax.describe(docs, how, "id", "text").filter("n_shingles > 0")
    members = facts.selectExpr("1L AS bucket", "doc_id AS id", "sketch", "doc_id AS component")
    found = {tuple(r) for r in minmax.prefix_pairs(members, docs, how).collect()}
    sets = [(i, shingles(t)) for i, t in sorted(rows)]
    for k, (b, y) in enumerate(sets):
        for a, x in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                assert (a, b) in found


def test_documents_with_repeated_and_null_ids(spark):
    rows = [(5, "a b c"), (3, "a b c"), (5, "x y z"), (9, "x y z"), (None, "a b c"), (None, None), (7, "q r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minmax.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, r.component_id, r.kept) for r in found}
    assert got == {(3, 3, True), (5, 3, False), (9, 3, False), (7, 7, True), (None, None, True)}


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minmax.near_duplicates(docs).collect() == []


def test_a_very_long_text(spark):
    text = " ".join(f"w{k % 5000}" for k in range(300_000))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minmax.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("stars", [0, 2])
def test_texts_that_share_an_id_link_each(spark, stars):
    one, two = (" ".join(f"{p}{i}" for i in range(200)) for p in "ab")
    rows = [(1, one), (1, two), (5, one + " x"), (6, two + " x"), (7, one + " y"), (8, "apart from all"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    how = minmax.MinMax(stars=stars)
    found = minmax.near_duplicates(docs.repartition(3), how).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (5, 1), (6, 1), (7, 1), (8, 8)}
    apart = minmax.near_duplicates(docs.repartition(3), how, ids_link=False)
    groups = {}
    for r in apart.join(docs.selectExpr("doc_id", "xxhash64(text) AS text_hash", "text"), ["doc_id", "text_hash"]).collect():
        groups.setdefault((r.component_id, (r.text or "-")[0]), []).append((r.doc_id, r.kept_text))
    assert sorted(groups[1, "a"]) == [(1, True), (5, False), (7, False)]
    assert sorted(groups[1, "b"]) == [(1, True), (6, False)]
    assert groups[8, "-"] == [(8, True)] and groups[8, "a"] == [(8, True)]


@given(st.lists(st.text(st.sampled_from("aAbZ \t\n\x0b\x0c\ré \x1f"), max_size=12), max_size=8))
@settings(max_examples=200, deadline=None)
def test_words_and_sets(texts):
    encoded = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, encoded)]).astype(np.int64)
    data = np.frombuffer(b"".join(encoded), np.uint8)
    starts, ends, first = spans(data, offsets)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert words == [w for t in texts for w in WORD.findall(t)]
    assert np.diff(first).tolist() == [len(WORD.findall(t)) for t in texts]
    known = {}
    for w, h in zip(words, hashes(data, starts, ends).tolist(), strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    sets = shingle_sets(data, offsets)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert both == len(shingles(texts[i]) & shingles(texts[j]))


@pytest.mark.parametrize("links", [[], [(1, 1)], [(2, 1), (1, 2), (3, 2), (9, 8)], [(k, k + 1) for k in range(40)]])
def test_components(spark, links):
    frame = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    got = {r.id: r.component for r in components(spark, frame).collect()}
    want = smallest({x for pair in links for x in pair}, links)
    assert got == {i: c for i, c in want.items() if i != c}


def vectors(dims=16, seed=3):
    random_ = np.random.default_rng(seed)
    rows = []
    for g in range(30):
        base = random_.normal(size=dims)
        for _ in range(random_.choice([1, 2, 12])):
            rows.append((base + random_.normal(size=dims) * random_.choice([0, 0.05, 0.15])).tolist())
    hot = random_.normal(size=dims)
    rows += [(hot + random_.normal(size=dims) * 0.1).tolist() for _ in range(150)]
    rows += [(np.array(rows[0]) * 7).tolist(), rows[1], rows[1], (np.array(rows[2]) * -1).tolist()]
    label = [int(x) for x in random_.integers(0, 2, len(rows))]
    out = [(k, r, c) for k, (r, c) in enumerate(zip(rows, label, strict=True))]
    odd = [None, [], [0.0] * dims, [float("nan")] * dims, [None] * dims, [float("inf")] + [1.0] * (dims - 1)]
    out += [(1000 + k, r, 0) for k, r in enumerate(odd)]
    out += [(1010, rows[1], None), (1011, rows[1], None), (1012, [1.0, 2.0], 0), (1013, [2.0, 4.0], 0)]
    return out


def brute_vectors(rows):
    sound = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v)
        sound.append((i, v / np.linalg.norm(v), label))
    links = [
        (a, b)
        for a, v, c in sound
        for b, w, d in sound
        if a != b and c == d and len(v) == len(w) and v @ w >= 0.98
    ]
    counts = {}
    for a, _ in links:
        counts[a] = counts.get(a, 0) + 1
    return counts, smallest({r[0] for r in rows}, links)


@pytest.mark.parametrize("per_cell,tile", [(512, 512), (8, 16)])
def test_vectors_agree_with_all_pairs(spark, per_cell, tile):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    how = multi_index.MultiIndex(per_cell=per_cell, tile=tile)
    found = multi_index.near_duplicates(frame.repartition(4), how).collect()
    counts, least = brute_vectors(rows)
    linked = sum(counts.values())
    got = sum(r.n_links for r in found)
    assert len(found) == len(rows) and 0.99 * linked <= got <= linked
    if got == linked:
        assert {r.vec_id: r.n_links for r in found} == {i: counts.get(i, 0) for i, _, _ in rows}
        assert {r.vec_id: r.component_id for r in found} == least
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_the_walk_visits_near_cells_first():
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = multi_index.fit(x, 50_000, multi_index.MultiIndex(per_cell=500))
    a, b = grid.margins(x[:20])
    rows, cells = grid.walk(x[:20])
    home = grid.homes(x[:20])
    for i in range(20):
        own = cells[rows == i]
        far = a[i][own // len(grid.second)] ** 2 + b[i][own % len(grid.second)] ** 2
        assert own[0] == home[i] and (np.diff(far) >= 0).all() and len(set(own)) == len(own)
        every = (a[i][:, None] ** 2 + b[i][None, :] ** 2) <= grid.reach + 1e-12
        assert len(own) == every.sum()


def test_vectors_without_ids_and_none_at_all(spark):
    schema = "vec_id long, embedding array<float>, label int"
    frame = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)], schema)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in multi_index.near_duplicates(frame).collect()}
    assert got == {(None, 0, None, True), (4, 0, 2, False), (4, 1, 2, False), (2, 1, 2, True)}
    assert multi_index.near_duplicates(frame.limit(0)).collect() == []
    nulls = frame.filter("vec_id IS NULL")
    assert [tuple(r) for r in multi_index.near_duplicates(nulls).collect()] == [(None, 0, None, True)]


def test_a_dealt_join_gives_the_rows_of_a_plain_one(spark):
    rows = spark.range(3000).selectExpr("id", "if(id < 1000, 0, id % 700) as bucket")
    facts = spark.range(0, 900, 2).selectExpr("id as bucket", "id * 3 as fact")
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    deal = deal_of(counts, 3000, "bucket", "id")
    slots = {r["bucket"]: r["slots"] for r in deal.hot.collect()}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert slots[0] > 1 and len(slots) <= 10 * tasks
    got = sorted(tuple(r) for r in deal.join(rows, facts).select("id", "bucket", "fact").collect())
    plain = sorted(tuple(r) for r in rows.join(facts, "bucket").select("id", "bucket", "fact").collect())
    assert got == plain
