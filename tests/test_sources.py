import gzip
import json
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterline.operators.nested import flatten
from meterline.schemas import GREEN, YELLOW, struct
from meterline.session import scratch_path, scratch_root
from meterline.sources import files as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_fixed_schema_and_all_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", "k,t\n1,2021-01-01 00:10:00\n2,\n")
    typed = S.read_csv(spark, path, struct("k int, t timestamp"))
    assert rows(typed) == [(1, datetime(2021, 1, 1, 0, 10)), (2, None)]
    assert rows(S.read_csv(spark, path)) == [("1", "2021-01-01 00:10:00"), ("2", None)]
    assert dict(S.read_csv(spark, path, infer=True).dtypes) == {"k": "int", "t": "timestamp"}


def test_lenient_rows(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,c\n1,x,3\n2,y\n3,z,4,5,6\nbad,w,1\n")
    got = S.read_csv(spark, path, struct("a int, b string, c int"))
    assert rows(got) == [(1, "x", 3), (2, "y", None), (3, "z", 4), (None, "w", 1)]


def test_gzip_is_spread(spark, tmp_path):
    path = tmp_path / "a.csv.gz"
    path.write_bytes(gzip.compress(b"k\n" + b"\n".join(b"%d" % i for i in range(1000))))
    df = S.read_csv(spark, str(path), struct("k int"), spread=6)
    assert df.rdd.getNumPartitions() == 6
    assert df.count() == 1000


def test_trip_schemas():
    assert len(YELLOW) == 18 and len(GREEN) == 20
    assert {f.name for f in GREEN} - {f.name for f in YELLOW} == {
        "lpep_pickup_datetime",
        "lpep_dropoff_datetime",
        "ehail_fee",
        "trip_type",
    }


def test_union_by_name_with_and_without_equal_types(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "k int, v string").write.parquet(a)
    spark.createDataFrame([(2.5, 7)], "w double, k bigint").write.parquet(b)
    got = S.read_by_name(spark, [a, b], struct("k bigint, v string, w double"))
    assert rows(got) == [(1, "x", None), (7, None, 2.5)]
    c = str(tmp_path / "c")
    spark.createDataFrame([(9, True)], "k int, flag boolean").write.parquet(c)
    assert rows(S.read_parquet(spark, a, c, by_name=True)) == [(1, "x", None), (9, None, True)]


def test_documents_whole_and_by_line(spark, tmp_path):
    doc = {"products": [{"brand": "x", "price": 1.5}, {"price": 2.0}], "total": 2}
    whole = write(tmp_path / "whole.json", json.dumps(doc, indent=2))
    got = S.read_documents(spark, whole, "products", whole_files=True)
    assert rows(got.select("brand", "price")) == [("x", 1.5), (None, 2.0)]
    lines = write(tmp_path / "lines.json", json.dumps(doc) + "\n" + json.dumps(doc))
    assert S.read_documents(spark, lines, "products").count() == 4


def test_pages_and_their_coverage(spark, tmp_path):
    for page, docs in enumerate(([{"k": 1}, {"k": 2}], [{"k": 3}], [])):
        write(tmp_path / f"page{page}.json", json.dumps({"numFound": 4, "docs": docs}))
    pages = S.read_documents(spark, str(tmp_path))
    got = S.page_coverage(pages, "docs", "numFound").first().asDict()
    assert got == {"pages": 3, "empty_pages": 1, "rows_read": 3, "rows_reported": 4}
    assert rows(S.entries_of(pages, "docs")) == [(1,), (2,), (3,)]


def test_month_paths_include_the_end_month():
    got = S.month_paths(
        ["green", "yellow"], date(2021, 11, 30), date(2022, 1, 1), "{type}_{year}-{month}.parquet"
    )
    assert got == [
        f"{kind}_{month}.parquet"
        for kind in ("green", "yellow")
        for month in ("2021-11", "2021-12", "2022-01")
    ]


def test_missing_file_policies(spark, tmp_path):
    good, bad = str(tmp_path / "good.parquet"), tmp_path / "bad.parquet"
    spark.range(3).write.parquet(good)
    bad.write_bytes(b"this is no parquet file")
    missing = str(tmp_path / "missing.parquet")
    schema = struct("id bigint")
    assert S.read_available(spark, [missing, good], schema).count() == 3
    assert S.read_available(spark, [missing, good, str(bad)], schema).count() == 3
    with pytest.raises(FileNotFoundError):
        S.read_available(spark, [missing], schema)
    with pytest.raises(FileNotFoundError):
        S.read_available(spark, [missing, str(bad)], schema)
    states = S.file_states(spark, [missing, good, str(bad)]).collect()
    assert sum(r["rows"] or 0 for r in states) == 3
    assert {(r["listed"], r["state"]) for r in states} == {
        (missing, "missing"), (good, "read"), (str(bad), "unreadable")
    }
    none = str(tmp_path / "none.parquet")
    spark.createDataFrame([], schema).coalesce(1).write.parquet(none)
    assert [(r["state"], r["rows"]) for r in S.file_states(spark, [none]).collect()] == [("read", 0)]
    empty = S.read_available(spark, [missing], schema, on_empty="empty")
    assert empty.schema == schema and empty.count() == 0
    with pytest.raises(ValueError):
        S.read_available(spark, [missing], schema, on_empty="skip")


def test_damaged_pages_are_an_error(spark, tmp_path):
    whole = tmp_path / "whole.parquet"
    pd.DataFrame({"id": range(5000)}).to_parquet(whole, compression=None)
    content = bytearray(whole.read_bytes())
    content[4:200] = b"\xff" * 196
    whole.write_bytes(content)
    assert [r["state"] for r in S.file_states(spark, [str(whole)]).collect()] == ["read"]
    with pytest.raises(Exception):
        S.read_available(spark, [str(whole)], struct("id bigint")).agg(F.sum("id")).collect()


def test_pages_end_at_the_first_empty_one(spark):
    pages = spark.createDataFrame(
        [(1, ["a"]), (2, ["b", "c"]), (3, []), (4, ["d"]), (5, None)], "page int, docs array<string>"
    )
    got = lambda df: sorted(r[0] for r in S.entries_until_empty(df, "docs", "page").collect())
    assert got(pages) == ["a", "b", "c"]
    assert got(pages.where("page <> 3")) == ["a", "b", "c", "d"]
    assert got(pages.where("page < 3")) == ["a", "b", "c"]
    assert got(pages.where("page = 3")) == got(pages.limit(0)) == []


def test_pandas_frame(spark):
    df = S.from_pandas(spark, pd.DataFrame({"k": [1, 2], "v": ["a", "b"], "x": [0.5, 1.5]}))
    assert dict(df.dtypes) == {"k": "bigint", "v": "string", "x": "double"}
    assert rows(df) == [(1, "a", 0.5), (2, "b", 1.5)]


def test_seed_needs_a_key(spark, database, tmp_path):
    schema = struct("code int, name string")
    good = write(tmp_path / "good.csv", "code,name\n0,Unknown\n5,Unknown\n")
    seed = S.load_seed(spark, good, f"{database}.seed", schema, ["code"])
    assert rows(seed) == [(0, "Unknown"), (5, "Unknown")]
    bad = write(tmp_path / "bad.csv", "code,name\n1,a\n1,b\n,c\n")
    with pytest.raises(ValueError, match=r"not_null\(code\): 1; unique\(code\): 1"):
        S.load_seed(spark, bad, f"{database}.seed", schema, ["code"])


def test_scratch_is_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(scratch_root(spark))


def test_flatten_landed_documents(spark, tmp_path):
    write(tmp_path / "docs.json", json.dumps({"k": 1, "tags": ["a"]}))
    docs = S.read_documents(spark, str(tmp_path))
    assert set(flatten(docs, "d", ["k"], "l")) == {"d", "d__tags"}
