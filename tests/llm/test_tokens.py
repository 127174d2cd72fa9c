"""Token ids, packing and record files: against the tokenizers library, exact round trips, brute force."""

import zlib

import numpy as np
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterline.llm import packing, records, tokens
from meterline.llm.arrow import prepare
from meterline.llm.tokens import Encoder, encoder, tokenizer_path
from meterline.session import scratch_path

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    " ",
    "one two  three\n\nfour\tfive. Six?! 7 88 don't we'll <|endoftext|> a b\x1c c",
    "Évidemment, über alles; 中文字 и русский \U0001f600 ﬁ İ Σας",
    "repeat " * 3000,
    "x" * 5000,
]


def library(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], "again"), (None, "no id here.", None), (None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string")


@pytest.mark.parametrize("path", [WORD, BYTE])
@given(
    text=st.text(
        st.one_of(
            st.sampled_from("ab'sS tTréÉ²¼½ µ×÷ß\t\n\r\x0b\x0c\x1c\x1f\x85\xa0.,!#09"),
            st.characters(exclude_categories=["Cs"]),
        ),
        max_size=40,
    )
)
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_library_s_ids(path, text):
    coder = encoder(path)
    assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == library_cached(path, text)


_kept = {}


def library_cached(path, text):
    if path not in _kept:
        _kept[path] = Tokenizer.from_file(path)
        _kept[path].encode_special_tokens = True
    return _kept[path].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_remembered_pieces_are_bounded_and_common_ones_stay(monkeypatch, path):
    assert tokens.REMEMBERED <= 200_000  # two workers of an executor keep these between their tasks
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    coder = Encoder(path)
    common = " the and of"
    text = common + "".join(f" rare{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}{common}" for i in range(30))
    got = np.frombuffer(coder.encode(text), coder.dtype).tolist()
    assert got == library_cached(path, text)
    assert len(coder.pieces) == 20 and {p.strip() for p in coder.pieces} >= {"the", "and", "of"}
    for n in range(40):
        coder.encode(f" {'xyzuv'[n % 5]}{'abcdefgh'[n // 5]}next")
        assert len(coder.pieces) <= 20
    assert any(p.endswith("next") for p in coder.pieces)  # another kind of text: it started afresh


def test_unknown_patterns_go_to_the_library(monkeypatch):
    monkeypatch.setattr(Encoder, "_known", staticmethod(lambda spec: (None, False)))
    coder = Encoder(BYTE)
    assert np.frombuffer(coder.encode("a b"), coder.dtype).tolist() == library_cached(BYTE, "a b")


def cost_of(cuts, penalty, length):
    begin, total = 0, 0
    for c in cuts:
        if c - begin > length:
            return None
        total += length - (c - begin) + penalty[c]
        begin = c
    return total


@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 9)), min_size=1, max_size=9))
@settings(max_examples=200, deadline=None)
def test_cuts_are_the_cheapest(steps):
    at = np.cumsum([s for s, _ in steps])
    penalty = dict(zip(at.tolist(), (p for _, p in steps), strict=True))
    length, best = 7, None
    inner = at.tolist()[:-1]
    for chosen in range(1 << len(inner)):
        cuts = [c for k, c in enumerate(inner) if chosen >> k & 1] + [int(at[-1])]
        cost = cost_of(cuts, penalty, length)
        best = cost if best is None else best if cost is None else min(best, cost)
    found = packing.choose_cuts(at, np.array([p for _, p in steps]), length)
    assert cost_of(found, penalty, length) == best


@pytest.mark.parametrize("length", [64, 4096])
def test_packing_loses_nothing(spark, docs, length):
    how = packing.Packing(WORD, end_id=2, length=length, stride=8, block=4)
    rows = packing.pack(docs.coalesce(1), how).collect()
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append([*library(WORD, r.text), 2])
    by_sequence = {}
    got = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        got.setdefault(r.doc_id, []).append(r)
    for pieces in by_sequence.values():
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces[:-1])]).tolist()
        used = sum(p.length for p in pieces)
        assert used <= length and {p.padded for p in pieces} == {used if used & (used - 1) == 0 else length}
    for key, texts in want.items():
        left = sorted(texts)
        pieces, at, n = got[key], 0, 0
        # Pieces of rows with one key follow one another, each row from 0 to its end.
        copies = []
        for p in pieces:
            assert p.start == at
            n, at = p.doc_tokens, at + p.length
            copies.append((p.start, p.length, p.ids_crc32, n))
            if at == n:
                at = 0
        assert at == 0 and sum(p.length for p in pieces) == sum(map(len, left))
        possible = {
            (s, k, zlib.crc32(np.array(t[s : s + k], "<u4").tobytes()), len(t)) for s, k, _, _ in copies for t in left
        }
        assert set(copies) <= possible
    padding = sum(p[0].padded for p in by_sequence.values()) - sum(r.length for r in rows)
    if length == 64:
        assert padding < 0.15 * sum(r.length for r in rows)


def test_packing_of_nothing(spark, docs):
    how = packing.Packing(WORD, end_id=2)
    assert packing.pack(docs.limit(0), how).collect() == []


def brute_records(rows, order):
    out, start = [], 0
    for key, text in order(rows):
        ids = [*library(BYTE, text), 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records_come_back(spark, docs):
    folder = scratch_path(spark, "records-test")
    single = docs.filter("doc_id IS NOT NULL AND start = 'clash'").repartition(3)
    records.write_records(single, folder, BYTE, 0, file_bytes=3000)
    assert records.read_manifest(spark, folder).count() > 1
    want = brute_records([(i, t) for i, t in enumerate(TEXTS)], lambda r: r)
    got = sorted(tuple(r) for r in records.read_records(spark, folder).collect())
    assert got == want
    ids = {r.doc_id: r.ids for r in records.read_shuffled(spark, folder, 3).collect()}
    assert ids == {i: [*library(BYTE, t), 0] for i, t in enumerate(TEXTS)}
    one = [r.doc_id for r in records.read_shuffled(spark, folder, 3).collect()]
    two = [r.doc_id for r in records.read_shuffled(spark, folder, 4).collect()]
    assert sorted(one) == sorted(two) == list(range(len(TEXTS)))


def test_records_with_null_and_repeated_keys(spark, docs):
    folder = scratch_path(spark, "records-test")
    records.write_records(docs, folder, BYTE, 0)
    got = records.read_records(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 0, 1, 2, 3, 3, 4, 5, 6]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()


def test_records_of_nothing(spark, docs):
    folder = scratch_path(spark, "records-test")
    records.write_records(docs.limit(0), folder, BYTE, 0)
    assert records.read_records(spark, folder).collect() == []


@pytest.mark.parametrize("where", [4, 17, 22, 40, -1])
def test_damage_is_found(spark, docs, where):
    folder = scratch_path(spark, "records-test")
    records.write_records(docs.filter("doc_id = 3").limit(1), folder, BYTE, 0)
    path = records.read_manifest(spark, folder).first().path + ".rec"
    fs, plain = records.open_folder(path)
    with fs.open_input_stream(plain) as f:
        data = bytearray(f.read())
    data[where] ^= 255
    with fs.open_output_stream(plain) as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="DamagedRecord"):
        records.read_records(spark, folder).collect()


def test_frame_has_lengths_and_checksums():
    framed = records.frame(b"abc")
    assert len(framed) == 8 + 4 + 3 + 4
    assert records._payload(framed, "here") == b"abc"
    assert records.masked(b"") == 0xA282EAD8
    assert isinstance(records.open_folder("file:/tmp")[0], pyarrow.fs.FileSystem)
    assert F is not None
