"""Quality rules and classifier, URL filter, mixing, page text and chat format, against plain versions."""

import hashlib
import re
import time
import zlib
from collections import Counter
from itertools import islice

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.llm import boilerplate, byte_cnn, chat, labelled, pfair, tree_rules, url_model, words
from meterline.llm.arrow import keep_rows, prepare, utf8
from meterline.llm.queries import HARD_TEXT, URL_RULES

import pyarrow as pa

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


# Quality rules


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    inside = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)]


@given(st.lists(st.none() | st.text(st.sampled_from("aab \n\t\x0b#é|<\x1f中"), max_size=30), max_size=6))
@settings(max_examples=300, deadline=None)
def test_counts(texts):
    counts, features = tree_rules.statistics(*utf8(pa.array(texts, pa.string())))
    assert counts.tolist() == [plain_counts(t) for t in texts]
    assert np.isfinite(features).all()


def plain_margin(forest, row):
    total = forest.base
    for root in forest.roots:
        i = root
        while forest.left[i] != i:
            i = forest.left[i] if row[forest.feature[i]] <= forest.threshold[i] else forest.right[i]
        total += forest.value[i]
    return total


def test_trees_keep_their_directions():
    random = np.random.default_rng(1)
    x = random.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * np.sin(4 * x[:, 0]) + random.normal(size=600) * 0.5 > x[:, 1] ** 2).astype(float)
    forest = tree_rules.fit_forest(x, y, [1, 0, -1], tree_rules.TreeRules(trees=25))
    assert np.allclose(forest.margin(x), [plain_margin(forest, r) for r in x])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.8
    for feature, way in ((0, 1), (2, -1)):
        for row in x[:40]:
            line = np.repeat(row[None, :], 50, 0)
            line[:, feature] = np.linspace(-4, 4, 50)
            assert (way * np.diff(forest.margin(line)) >= -1e-12).all()


def test_rules_on_documents(spark, documents, labels):
    forest = tree_rules.fit(documents, labels)
    rows = {r.doc_id: r for r in tree_rules.apply_rules(documents, forest).collect()}
    for doc in documents.collect():
        got = rows[doc.doc_id]
        want = plain_counts(doc.text)
        assert [got[c] for c in tree_rules.COUNTS] == want
        assert got.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert got.kept == (not got.base_failed and got.score >= 0.3)
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in rows]
    right = [(rows[r.doc_id].score >= 0.3) == (r.quality == 1) for r in held]
    assert np.mean(right) > 0.97


def test_rules_on_odd_rows(spark, labels):
    long = " ".join(f"word{k}" for k in range(200_000))
    rows = [(1, None, 1), (1, "", 2), (None, " \n", 3), (4, long, 4), (4, long, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    forest = tree_rules.fit(docs, labels.limit(0))
    got = tree_rules.apply_rules(docs, forest)
    assert [r.n_words for r in got.orderBy("n_words").collect()] == [0, 0, 0, 200_000, 200_000]
    assert {r.base_failed for r in got.filter("n_words = 0").collect()} == {True}
    assert tree_rules.apply_rules(docs.limit(0), forest).collect() == []
    kept = keep_rows(docs, "text", tree_rules.verdict(forest))
    assert kept.columns == docs.columns and kept.count() == 2


def test_training_rows_skip_the_held_out_fold(spark, documents, labels):
    doubled = labels.unionByName(labels.limit(3).selectExpr("doc_id", "1 - quality AS quality", "toxic"))
    rows = labelled.training_rows(documents, doubled, 100).collect()
    assert len(rows) == 100 and len({r.doc_id for r in rows}) == 100
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)
    assert not {r.doc_id for r in rows} & {r.doc_id for r in labels.limit(3).collect()}


def test_training_rows_bound_rows_of_a_hot_id(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5][:20]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], "same")] * 500 + [(ids[1], f"other {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.text, r.quality) for r in labelled.training_rows(docs, labels, 50).collect()]
    assert len(got) == len(set(got)) == 50 and {r[0] for r in got} == set(ids)
    assert set(r[:2] for r in got) <= set(rows) and all(q == i % 2 for i, _, q in got)


# Quality classifier


def plain_score(net, text):
    """Chunk by chunk, filter by filter."""
    data = (text or "").encode()
    n = max(-(-(len(data) - 64) // 448), 1)
    data = data + bytes(n * 448 + 64 - len(data))
    values = []
    for i in range(n):
        best = np.full(net.top.shape[1], -np.inf)
        for t in range(i * 448, i * 448 + 512, 4):
            answer = net.letters[list(data[t : t + 4])].reshape(-1) @ net.top
            if t + 8 <= len(data):
                answer = answer + net.letters[list(data[t + 4 : t + 8])].reshape(-1) @ net.bottom
            best = np.maximum(best, answer)
        values.append(np.maximum(best + net.bias, 0))
    z = np.concatenate((np.max(values, 0), np.mean(values, 0)))
    return 1 / (1 + np.exp(-(z @ net.weights + net.intercept[0])))


TEXTS = ["", "short", "x" * 512, "y" * 513, "é" * 700, "many words " * 400, None]


@pytest.mark.parametrize("portion", [1 << 19, 900])
def test_network_covers_whole_texts(portion):
    net = byte_cnn.start(byte_cnn.ByteCnn(filters=6), 0.5)
    got = byte_cnn.score(net, *utf8(pa.array(TEXTS)), portion)
    assert np.allclose(got, [plain_score(net, t) for t in TEXTS], atol=1e-5)
    changed = "z" * 20_000
    tail = changed[:-8] + "##||##||"
    a, b = byte_cnn.score(net, *utf8(pa.array([changed, tail])), portion)
    assert a != b


def test_gradients_agree_with_differences():
    random = np.random.default_rng(0)
    net = byte_cnn.start(byte_cnn.ByteCnn(filters=3, embedding=2), 0.5)
    parts = [p.astype(np.float64) for p in net.parts()]
    parts[3] += 0.5
    net = byte_cnn.Network(*parts)
    texts = [bytes(random.integers(1, 256, n, dtype=np.uint8)) for n in (30, 700, 1300)]
    offsets = np.cumsum([0, *map(len, texts)])
    laid, chunks = byte_cnn.lay_out(np.frombuffer(b"".join(texts), np.uint8), offsets)
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        z = byte_cnn.features(byte_cnn.pooled(net, byte_cnn.answers(net, laid, chunks)[0], chunks)[0], chunks)
        m = z @ net.weights + net.intercept[0]
        return np.mean(np.log1p(np.exp(-m)) + (1 - y) * m)

    found = byte_cnn.gradients(net, laid, chunks, y)
    for part, gradient in list(zip(net.parts(), found, strict=True))[1:]:
        flat = part.reshape(-1)
        for i in random.choice(len(flat), min(6, len(flat)), replace=False):
            keep, step = flat[i], 1e-5
            flat[i] = keep + step
            up = loss()
            flat[i] = keep - step
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * step) - gradient.reshape(-1)[i]) < 1e-4


@pytest.mark.parametrize("portion", [900, 2500])
def test_gradients_of_long_texts_in_portions(portion):
    random = np.random.default_rng(1)
    net = byte_cnn.start(byte_cnn.ByteCnn(filters=5, embedding=3), 0.4)
    net = byte_cnn.Network(*(p.astype(np.float64) for p in net.parts()))
    texts = [bytes(random.integers(1, 256, n, dtype=np.uint8)) for n in (0, 40, 3000, 700, 20_000, 512)]
    texts.append(b"same words " * 900)  # the largest answers are in many chunks
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    y = np.array([1, 0, 1, 0, 0, 1, 1], np.float32)
    whole = byte_cnn.gradients(net, *byte_cnn.lay_out(data, offsets), y)
    for a, b in zip(whole, byte_cnn.batch_gradients(net, data, offsets, y, portion), strict=True):
        assert np.allclose(a, b, atol=1e-6)


def test_long_texts_are_learned_from(spark):
    mark = {0: "dull and plain ", 1: "#~#~ {} ^^ "}
    # What tells the labels apart stands behind the first 40,000 characters.
    rows = [(i, "filler words of no meaning " * 1500 + mark[i % 2] * 400, i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    how = byte_cnn.ByteCnn(epochs=15, batch=8, portion=1 << 15)
    got = {r.doc_id: r.score for r in byte_cnn.classify(docs, byte_cnn.fit(docs, labels, how), how).collect()}
    assert all((got[i] >= 0.5) == bool(label) for i, _, label in rows)
    # The bound of bytes ends the sample behind the row that passes it, so the first row always counts.
    one = byte_cnn.fit(docs.filter("doc_id % 2 = 1"), labels, byte_cnn.ByteCnn(sample_bytes=1))
    assert {round(r.score, 2) for r in byte_cnn.classify(docs, one).collect()} == {0.99}


def test_classifier_on_documents(spark, documents, labels):
    how = byte_cnn.ByteCnn(epochs=25)
    net = byte_cnn.fit(documents, labels, how)
    rows = {r.doc_id: r for r in byte_cnn.classify(documents, net, how).collect()}
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in rows]
    right = [rows[r.doc_id].predicted == r.quality for r in held]
    assert np.mean(right) > 0.9


def test_classifier_on_odd_rows(spark, labels):
    docs = spark.createDataFrame([(None, None, 0), (1, "", 1), (1, "", 1)], "doc_id long, text string, score int")
    net = byte_cnn.fit(docs, labels.limit(0))
    assert {r.score for r in byte_cnn.classify(docs, net).collect()} == {0.5}
    assert byte_cnn.classify(docs.limit(0), net).collect() == []


# URL filter


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule, _ in URL_RULES:
        at, _, tail = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + tail):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best


def plain_url_score(fitted, url, how):
    """Byte by byte, with the tables' own slots."""
    data, offsets = utf8(pa.array([url or ""]))
    total = 0.0
    slots = [(p, a) for _, p, a in url_model._steps(data, offsets, how)]
    for i in range(len(data)):
        chance = dict.fromkeys(fitted.tables, 1 / 256)
        for k, (pair, alone) in enumerate(slots):
            for name, table in fitted.tables.items():
                context = table[(2 * k + 1) * how.slots + alone[i]]
                both = min(table[2 * k * how.slots + pair[i]], context)
                chance[name] = (both + how.weight * chance[name]) / (context + how.weight)
        total += np.log(chance["allow"]) - np.log(chance["block"])
    return total / max(len(data), 1)


def test_urls(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    odd = [
        "HTTP://WWW.Example.COM/en/x?y",
        "http://example.com/en",
        "http://com/",
        "http://xcom/",
        "a://b://c.net/es/1",
        "no scheme",
        "",
        None,
        "http://x.net/fr/é\n/2#z",
        "http://É.net",
    ]
    more = spark.createDataFrame([(10_000 + k, u, "") for k, u in enumerate(odd)], "page_id long, url string, html string")
    pages = pages.unionByName(more).selectExpr("*", "'x' AS rule", "'y' AS verdict")
    how = url_model.UrlModel()
    rows = url_model.filter_urls(pages, URL_RULES, how).collect()
    urls = {r.page_id: r.url for r in pages.collect()}
    judged = url_model.filter_urls(pages, URL_RULES, how).filter("rule IS NOT NULL")
    assert judged.count() > 50
    for r in rows:
        host, path, rule = plain_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == dict(URL_RULES)[rule]
    examples = pages.select("url").join(
        spark.createDataFrame([(u, dict(URL_RULES)[plain_url(u)[2]]) for u in set(urls.values()) if plain_url(u)[2]], "url string, verdict string"), "url"
    )
    fitted = url_model.fit(examples, how)
    for r in rows[:25] + rows[-10:]:
        assert abs(r.score - plain_url_score(fitted, urls[r.page_id], how)) < 1e-6
        if r.rule is None:
            assert r.verdict == ("allow" if r.score >= fitted.limit else "block")
    # The models tell the examples of both verdicts apart.
    score = {r.page_id: r.score for r in rows}
    right = [
        (score[r.page_id] >= fitted.limit) == (r.verdict == "allow") for r in rows if r.rule is not None
    ]
    assert np.mean(right) > 0.9


def test_urls_without_examples(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (None, None)], "page_id long, url string")
    assert {r.verdict for r in url_model.filter_urls(pages, URL_RULES).collect()} == {"allow"}
    assert url_model.filter_urls(pages.limit(0), URL_RULES).collect() == []


def test_url_counts_are_exact_for_many_contexts(spark):
    random = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_~.%"))
    tails = ["".join(t) for t in random.choice(letters, (6000, 50))]
    urls = [f"http://{('a.com/', 'b.net/es/', 'c.org/')[k % 3]}{t}" for k, t in enumerate(tails)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    held = {r.page_id for r in pages.filter("pmod(xxhash64(url), 5) = 0").collect()}
    pairs, contexts = ([Counter(), Counter()] for _ in range(2))
    for k, u in enumerate(urls):
        if k % 3 < 2 and k not in held:
            for i in range(len(u)):
                for n in range(6):
                    context = u[max(i - n, 0) : i].rjust(n, "\0")
                    pairs[k % 3][context + u[i]] += 1
                    contexts[k % 3][n, context] += 1
    assert len(pairs[0]) > 1 << 17
    rows = {r.page_id: r for r in url_model.filter_urls(pages, URL_RULES).collect()}
    for k in range(30):
        total = 0.0
        for i, c in enumerate(urls[k]):
            chance = [1 / 256, 1 / 256]
            for n in range(6):
                context = urls[k][max(i - n, 0) : i].rjust(n, "\0")
                chance = [(pairs[v][context + c] + 2 * chance[v]) / (contexts[v][n, context] + 2) for v in (0, 1)]
            total += np.log(chance[0]) - np.log(chance[1])
        assert abs(rows[k].score - total / len(urls[k])) < 1e-6


# Mixing


@given(st.lists(st.integers(1, 60), min_size=1, max_size=9), st.integers(9, 80))
@settings(max_examples=200, deadline=None)
def test_schedule_keeps_to_the_weights(sizes, period):
    weights = {f"s{k}": n for k, n in enumerate(sizes)}
    slots = pfair.shares(weights, period)
    assert sum(slots.values()) == max(period, len(sizes)) and min(slots.values()) >= 1
    order = pfair.schedule(slots)
    had = dict.fromkeys(slots, 0)
    for t, s in enumerate(order, 1):
        had[s] += 1
        for k, n in slots.items():
            assert abs(had[k] - n * t / len(order)) < 1
    assert had == slots


KINDS = ["string", "int", "long", "double", "decimal(9,2)", "boolean", "date", "timestamp", "struct<a:int>"]


@pytest.mark.parametrize("kind", KINDS)
def test_plan_of_sources_needs_no_python_job(spark, kind):
    """A list of rows went through Python workers of its own on every executor."""
    texts = {"boolean": "true", "date": "2024-02-29", "timestamp": "2024-02-29 12:30:00.000001", "struct<a:int>": None}
    text = texts.get(kind, "12")
    value = F.named_struct(F.lit("a"), F.lit(7)) if text is None else F.lit(text).cast(kind)
    own = spark.range(2).select(F.when(F.col("id") == 0, value).alias("of_source"))
    rows = [(i, r[0], 40 + i, 1) for i, r in enumerate(own.collect())]
    plan = pfair._plan(spark, rows, own.schema[0].dataType)
    assert [tuple(r) for r in plan.orderBy("of_index").collect()] == rows
    assert own.join(plan, own.of_source.eqNullSafe(plan.of_source)).count() == 2
    if kind not in ("timestamp", "struct<a:int>"):
        assert "LogicalRDD" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_word_hashes_do_not_depend_on_the_span(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"abcdefg    \n", np.uint8), 5000)
    offsets = np.array([0, 1000, 1000, 5000])
    starts, ends, _ = words.spans(data, offsets)
    found = []
    for span in (16, 1000, 1 << 17, 1 << 20):
        monkeypatch.setattr(words, "_SPAN", span)
        monkeypatch.setattr(words, "_powers", [])
        found.append(words.hashes(data, starts, ends))
    assert all((f == found[0]).all() for f in found)
    assert len({bytes(data[a:b]) for a, b in zip(starts, ends)}) == len(set(found[0].tolist()))


def test_mix_of_documents(spark):
    rows = [(i, ["a", "a", "a", "b", None, "c"][i % 6] if i < 300 else "a", f"t{i}") for i in range(700)]
    rows += [(None, "b", "no id"), (5, "b", "same"), (5, "b", "same")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    how = pfair.Mix(block=3, period=40, rank_rows=20)
    weights = {"a": 0.5, "b": 0.3, "c": 0.1, None: 0.1}
    mixed = pfair.mix_sources(docs, how, weights).collect()
    assert [r.mix_position for r in mixed] == list(range(len(mixed)))
    given_ = Counter((r.doc_id, r.source, r.text) for r in mixed)
    wanted = Counter(rows)
    assert set(given_) == set(wanted)
    per_source = Counter(s for _, s, _ in rows)
    for row, n in wanted.items():
        rounds = Counter(r.mix_round for r in mixed if (r.doc_id, r.source, r.text) == row)
        assert rounds[0] == n
    # A source goes round: each of its documents comes as often as any other, or once more.
    for s in per_source:
        each = [c / wanted[k] for k, c in given_.items() if k[1] == s]
        assert max(each) - min(each) <= 1
    slots = pfair.shares(weights, 40)
    had = Counter()
    for t in range(len(mixed) // 3):
        block = mixed[3 * t : 3 * t + 3]
        assert len({r.source for r in block}) == 1 and {r.mix_slot for r in block} == {t}
        had[block[0].source] += 1
        assert all(abs(had[s] - slots[s] * (t + 1) / 40) < 1 for s in slots)


def test_mix_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a", 1)], "doc_id long, source string, mix_slot int")
    with pytest.raises(ValueError, match="mix_slot"):
        pfair.mix_sources(docs)
    assert pfair.mix_sources(docs.drop("mix_slot").limit(0)).collect() == []
    with pytest.raises(ValueError, match="no weight"):
        pfair.mix_sources(docs.drop("mix_slot"), weights={"b": 1})


# Page text


def page(article, host="h", extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>x='</p>'</script></head><body>"
        f"<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy now</div>{extra}"
        f"<article><h1>Head &amp; line</h1>{article}</article>"
        f"<section id='comments'><article><p>Nice!</p></article></section><footer>&copy; {host}</footer></body></html>"
    )


CASES = [
    (None, ""),
    ("", ""),
    (page("<p><b>One\n two&nbsp;three<br><p>four</p>"), "Head & line\nOne two three\nfour"),
    (page("<p>a<aside>b</aside><div class='cookie-notice'>c</div><form>d</form>e</p>"), "Head & line\na\ne"),
    (page("<!-- no --><p>x &lt;y&gt; &#233;<script>1<2</script> z", "h", "<header>top</header>"), "Head & line\nx <y> é z"),
    (page("<ul><li>1<li>2</ul><table><tr><td>3<td>4</table><pre> 5\n\n6 </pre>"), "Head & line\n1\n2\n3\n4\n5 6"),
    ("plain text, no tags", "plain text, no tags"),
    ("<p>a < b <p title='x>y'>c</p><nav>n", "a < b\nc"),
    ("<script>never closed <p>x", ""),
]


def test_page_text(spark):
    rows = [(k, f"http://h{k}.org/", h, "clash") for k, (h, _) in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in boilerplate.main_text(pages).collect()}
    for k, (_, want) in enumerate(CASES):
        assert got[k].text == want, k
        assert got[k].n_chars == len(want)


def test_repeated_text_goes_where_the_markup_is_silent(spark):
    banner = "this host says the very same thing on each of its many pages"
    rows = []
    for k in range(30):
        own = " ".join(f"own{k}word{j}" for j in range(20))
        rows.append((k, "http://one.org/x", f"<div>{banner}</div><div>{own}</div>"))
        rows.append((100 + k, "http://two.org/x", f"<article><p>{banner}</p></article>"))
    rows += [(None, None, f"<div>{banner}</div>"), (0, "http://one.org/x", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = boilerplate.main_text(pages, boilerplate.Boilerplate(pages=8)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is None:
            assert r.text == banner and r.n_repeated == 0
        elif r.page_id >= 100:
            assert r.text == banner and r.n_repeated == 13
        elif r.page_id:
            assert r.text.startswith(f"own{r.page_id}word0") and banner not in r.text
    assert boilerplate.main_text(pages.limit(0)).collect() == []


def test_repeated_runs_are_cut_beside_articles_and_inside_blocks(spark):
    notice = "all rights to this text are with the house that printed it"
    rows = [
        (k, "http://h.org/x", f"<div>own{k} lead {notice} tail{k}</div><article>body{k}</article><p>after{k}</p><p>{notice}</p>")
        for k in range(5)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in boilerplate.main_text(pages).collect():
        k = r.page_id
        # "lead" goes along: eight words from it on are in all pages.
        assert r.text == f"own{k} tail{k}\nbody{k}\nafter{k}" and r.n_repeated == 25


@pytest.mark.parametrize("how", [boilerplate.Boilerplate(pages=4), boilerplate.Boilerplate(most_words=60)])
def test_repetition_is_seen_across_a_large_host(spark, how):
    notice = "all rights to this text are with the house that printed it"
    rows = []
    for k in range(300):
        own = " ".join(f"own{k}word{j}" for j in range(20))
        rows.append((k, "http://h.org/x", f"<div>{own}</div><div>{notice if k % 100 == 7 else ''}</div>"))
    rows.append((300, "http://other.org/x", f"<div>{notice}</div>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r for r in boilerplate.main_text(pages, how).collect()}
    assert len(got) == 301 and got[300].text == notice and got[300].n_repeated == 0
    for k in range(300):
        assert got[k].text.split()[-1] == f"own{k}word19" and got[k].n_repeated == 12 * (k % 100 == 7)


def test_dealt_hosts_give_what_one_suffix_array_gives(spark):
    random = np.random.default_rng(7)
    rows = []
    for k in range(240):
        words = [f"w{w}" for w in random.integers(0, 3, random.integers(0, 60))]
        blocks = [f"<{t}>{' '.join(words[i::3])} é{k % 50}</{t}>" for i, t in enumerate(("div", "article", "nav"))]
        rows.append((None if k % 40 == 0 else k // 2, f"http://h{k % 3 % 2}.org/{k % 5}", None if k % 30 == 0 else "".join(blocks)))
    pages = spark.createDataFrame(rows + rows[:9], "page_id long, url string, html string").repartition(4)
    want = sorted(boilerplate.main_text(pages, boilerplate.Boilerplate(pages=1000)).collect(), key=str)
    assert len(want) == 249 and sum(r.n_repeated for r in want) > 1000
    for how in (boilerplate.Boilerplate(pages=10), boilerplate.Boilerplate(most_words=200)):
        assert sorted(boilerplate.main_text(pages, how).collect(), key=str) == want


@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 300)), unique=True, max_size=60))
@settings(max_examples=300, deadline=None)
def test_packed_numbers(numbers):
    given = np.array(sorted(numbers), np.uint64)
    assert boilerplate.unpack_numbers(boilerplate.pack_numbers(given)).tolist() == given.tolist()


def test_comparing_a_large_host_shuffles_little(spark):
    random = np.random.default_rng(8)
    rows = [(k, "http://h.org/x", "<p>" + " ".join(map(str, random.integers(0, 10**6, 2000)))) for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = boilerplate.main_text(pages, boilerplate.Boilerplate(pages=10))
    assert len(got.collect()) == 40
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")]
    # All rounds go over one shuffle of the pages, in which they are packed.
    assert plan.count("ReusedExchange") >= 2
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(host" in line]
    assert 0 < len(exchanges) <= 8
    runs = np.sort(random.integers(0, 2**26, 20_000).astype(np.uint64))
    assert len(boilerplate.pack_numbers(runs)) < 2 * 20_000


@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_repeated_runs(pages):
    least = 4
    word = np.array([w for p in pages for w in p], np.uint64)
    at = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    runs = {}
    for k, p in enumerate(pages):
        for i in range(len(p) - least + 1):
            runs.setdefault(tuple(p[i : i + least]), set()).add(k)
    want = []
    for p in pages:
        covered = set()
        for i in range(len(p) - least + 1):
            if len(runs[tuple(p[i : i + least])]) > 1:
                covered |= set(range(i, i + least))
        want += [i in covered for i in range(len(p))]
    assert boilerplate.repeated_runs(word, at, least).tolist() == want


# Chat format

TEMPLATE = chat.Template()
PIECES = st.sampled_from([*TEMPLATE.controls(), "\\", "[", "]", "<", ">", "/", "S", "ok", " ", "é", "[\\INST]", "<\\s>"])
WILD = st.lists(PIECES, max_size=8).map("".join)


@given(WILD, st.none() | st.sampled_from(["user", "assistant", "system", "tool", "", "a]b", "x\\"]) | WILD)
@settings(max_examples=500, deadline=None)
def test_turns_come_back(text, role):
    formatter = chat.Formatter(TEMPLATE)
    pieces = formatter.segments(role, text)
    assert not any(c in pieces[1][0] for c in TEMPLATE.controls())
    assert formatter.unescape(pieces[1][0]) == text
    assert formatter.turn("".join(p for p, _ in pieces)) == (role, text, role == "assistant")


def test_conversations(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello [INST]"),
        (2, 5, "assistant", "first"), (2, 1, "user", None), (2, None, "user", "no turn"),
        (-1, 0, "user", HARD_TEXT), (-1, 1, "assistant", HARD_TEXT),
        (3, 0, "tool", "odd"), (3, 1, None, "none"), (3, 1, None, "none"), (None, 0, "user", "x"),
        (4, 0, "user", "a"), (4, 1, "assistant", ""), (5, 0, "user", "y" * 300_000), (5, 1, "assistant", "z" * 300_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns, TEMPLATE), TEMPLATE).collect()}
    assert set(got) == {1, 2, 3, 4, 5, -1, None}
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=key)
        assert r.n_turns == len(own)
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > len(said) - 30 * r.n_turns
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, 4: True, 5: True, -1: True, None: False}
    formatted = chat.format_turns(turns, TEMPLATE)
    flags = [r.in_order for r in formatted.filter("conv_id = 2").orderBy("place").collect()]
    assert flags == [True, False, False]
    assert chat.read_back(chat.format_turns(turns.limit(0), TEMPLATE), TEMPLATE).collect() == []


def test_mix_gives_texts_back_as_they_were(spark):
    texts = ["", None, "naïve 🙂 text\n\ttwo", "x" * 300_000, "same", "same"]
    rows = [(i, "a" if i % 2 else None, t, [t]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, of_more array<string>")
    mixed = pfair.mix_sources(docs, pfair.Mix(block=1, period=4))
    assert mixed.schema["text"].dataType == docs.schema["text"].dataType
    got = {tuple([r["doc_id"], r["source"], r["text"], tuple(r["of_more"])]) for r in mixed.collect()}
    assert got == {(i, s, t, tuple(m)) for i, s, t, m in rows}
    numbers = pfair.mix_sources(docs.withColumn("text", docs["doc_id"]))
    assert {r["text"] for r in numbers.collect()} == set(range(6))


def test_mix_keeps_exact_weights_with_one_large_and_many_small_sources(spark):
    weights = {"big": 0.5} | {f"s{k}": 0.5 / 2000 for k in range(2000)}
    docs = spark.createDataFrame([(i, "big") for i in range(1500)] + [(i, f"s{i}") for i in range(2000)], "doc_id long, source string")
    mixed = pfair.mix_sources(docs, pfair.Mix(block=1), weights).orderBy("mix_position").collect()
    assert len(mixed) <= 4000 and {(r.doc_id, r.source) for r in mixed} == {tuple(r) for r in docs.collect()}
    had = Counter()
    for t, r in enumerate(mixed, 1):
        had[r.source] += 1
        assert abs(had["big"] - 0.5 * t) < 1 and abs(had[r.source] - weights[r.source] * t) < 1


def test_small_weights_do_not_drift():
    parts = list(pfair.whole({"a": 0.7, "b": 0.29994, "c": 6e-5}).values())
    had = [0, 0, 0]
    for t, (i, j) in enumerate(islice(pfair.slots_of(parts), 100_000), 1):
        assert j == had[i]
        had[i] += 1
        assert all(abs(n * sum(parts) - p * t) < sum(parts) for n, p in zip(had, parts, strict=True))


@pytest.mark.parametrize("unit", ["<script ", '<a "', '<a "" ">"', "<b></i>", "</x", "<!--", "<a x='\"", "<"])
def test_broken_pages_take_linear_time(unit):
    started = time.monotonic()
    boilerplate.parse(unit * (300_000 // len(unit)))
    boilerplate.parse(unit * (300_000 // len(unit)) + ">")
    boilerplate.parse("<i><div>" + "<b>" * 40_000 + "</i>" * 40_000)
    boilerplate.parse("<a " + "a" * 300_000 + ">")
    assert time.monotonic() - started < 10


def test_tags_end_outside_of_quotes():
    # The end of <i> is the first > outside of quotes after <a.
    page = """<p title="a > b">one</p><script x='</script>'>no</SCRIPT >two <a "" ">" three <i>four"""
    assert boilerplate.parse(page).texts == ["one", "two four"]
    assert boilerplate.parse("a < b <!-- c > d").texts == ["a < b"]
    assert boilerplate.parse("<title").texts == ["<title"]


@pytest.mark.parametrize(
    "page, texts",
    [
        ('<article class="newsletter">kept</article>', ["kept"]),
        ('<div id="main-content" class="login main-content">kept</div>', ["kept"]),
        ('<div class="newsletter">dropped</div>', []),
        ('<article class="comment">dropped</article>', []),
        ('<article>kept<article class="related">dropped</article></article>', ["kept"]),
        ('<div class="sidebar"><article>dropped</article></div>', []),
    ],
)
def test_names_of_articles(page, texts):
    assert [t for t, _ in boilerplate.extract([page], boilerplate.Boilerplate())] == ["\n".join(texts)]
