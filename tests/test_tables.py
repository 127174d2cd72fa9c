from collections import Counter
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.operators import layout as L
from meterline.operators import materialize as M
from meterline.schemas import struct


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def dated(spark, data):
    return spark.createDataFrame(data, "k int, v string, d date")


D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def test_insert_only_merge_keeps_copies_and_repeats_safely(spark, database):
    name = f"{database}.merged"
    M.rebuild(spark.createDataFrame([("a", 1)], "key string, v int"), name)
    source = spark.createDataFrame(
        [("a", 2), ("b", 1), ("b", 1), (None, 3)], "key string, v int"
    )
    assert M.insert_only_merge(source.where("key is not null"), name, ["key"]) == 2
    assert rows(spark.table(name)) == [("a", 1), ("b", 1), ("b", 1)]
    assert M.insert_only_merge(source.where("key is not null"), name, ["key"]) == 0


def test_upsert_changes_moves_and_empties(spark, database):
    name = f"{database}.up"
    M.rebuild(dated(spark, [(1, "old", D1), (2, "old", D2), (3, "old", D3)]), name, "d")
    source = dated(spark, [(2, "new", D3), (4, "new", D1)])
    for _ in range(2):
        M.upsert(source, name, ["k"])
        assert rows(spark.table(name)) == [
            (1, "old", D1),
            (2, "new", D3),
            (3, "old", D3),
            (4, "new", D1),
        ]
    held = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert held == {"d=2024-01-01", "d=2024-01-03"}


def test_upsert_touches_no_other_partition(spark, database):
    name = f"{database}.quiet"
    M.rebuild(dated(spark, [(1, "old", D1), (2, "old", D2)]), name, "d")

    def files(day):
        table = spark.table(name).where(F.col("d") == F.lit(day))
        return {r[0] for r in table.select("_metadata.file_path").distinct().collect()}

    before = files(D1), files(D2)
    M.upsert(dated(spark, [(2, "new", D2)]), name, ["k"])
    assert files(D1) == before[0]
    assert files(D2) != before[1]


def test_upsert_refuses_repeated_source_keys(spark, database):
    name = f"{database}.strict"
    M.rebuild(dated(spark, [(1, "old", D1)]), name, "d")
    with pytest.raises(ValueError, match="share a key"):
        M.upsert(dated(spark, [(1, "a", D1), (1, "b", D2)]), name, ["k"])
    assert rows(spark.table(name)) == [(1, "old", D1)]


def test_upsert_without_partitions(spark, database):
    name = f"{database}.flat"
    M.rebuild(dated(spark, [(1, "old", D1), (2, "old", D2)]), name)
    M.upsert(dated(spark, [(2, "new", D3), (5, "new", D3)]), name, ["k"])
    assert rows(spark.table(name)) == [(1, "old", D1), (2, "new", D3), (5, "new", D3)]


def test_interval_edges(spark, database):
    start, end = datetime(2024, 1, 1, 12), datetime(2024, 1, 3, 12)
    name = f"{database}.window"
    schema = "t timestamp_ntz, v string"
    times = [start - timedelta(seconds=1), start, datetime(2024, 1, 2, 1), end]
    L.write_by_date(spark.createDataFrame([(t, "old") for t in times], schema), name, "t", "d")
    source = spark.createDataFrame(
        [(start, "new"), (end - timedelta(seconds=1), "new"), (end, "outside")], schema
    )
    for _ in range(2):
        M.replace_interval(source, name, "t", start, end)
        assert rows(spark.table(name).select("t", "v")) == [
            (start - timedelta(seconds=1), "old"),
            (start, "new"),
            (end - timedelta(seconds=1), "new"),
            (end, "old"),
        ]
    held = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert held == {"d=2024-01-01", "d=2024-01-03"}


def test_interval_with_nothing_new_empties_the_window(spark, database):
    name = f"{database}.gone"
    schema = "t timestamp_ntz, v string"
    old = spark.createDataFrame([(datetime(2024, 1, d), "old") for d in (1, 2, 3)], schema)
    L.write_by_date(old, name, "t", "d")
    M.replace_interval(spark.createDataFrame([], schema), name, "t", "2024-01-02", "2024-01-04")
    assert rows(spark.table(name).select("v", "d")) == [("old", D1)]


def test_increment_drops_the_mark_and_late_rows(spark, database):
    name = f"{database}.inc"
    M.rebuild(spark.createDataFrame([(1, D2)], "k int, d date"), name)
    source = spark.createDataFrame([(1, D2), (2, D1), (3, D3)], "k int, d date")
    assert rows(M.newer_rows(source, name, "d")) == [(3, D3)]
    assert rows(M.newer_rows(source, name, "d", timedelta(days=2))) == rows(source)


def test_increment_into_an_empty_table_takes_all(spark, database):
    name = f"{database}.first"
    source = spark.createDataFrame([(1, D2), (2, D1)], "k int, d date")
    M.rebuild(source.limit(0), name)
    assert M.newer_rows(source, name, "d").count() == 2


def test_delete_insert_by_key(spark, database):
    name = f"{database}.di"
    M.rebuild(dated(spark, [(1, "a", D1), (1, "b", D2), (2, "c", D2)]), name, "d")
    M.delete_insert(dated(spark, [(1, "new", D3), (1, "new", D3)]), name, ["k"])
    assert rows(spark.table(name)) == [(1, "new", D3), (1, "new", D3), (2, "c", D2)]


def test_append_matches_names_and_drift_adds_columns(spark, database):
    name = f"{database}.drift"
    M.rebuild(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    M.append(spark.createDataFrame([("b", 2)], "v string, k int"), name)
    M.append_with_drift(spark.createDataFrame([(True, 3)], "flag boolean, k int"), name)
    assert rows(spark.table(name)) == [(1, "a", None), (2, "b", None), (3, None, True)]


def test_refill_reads_its_own_table(spark, database):
    name = f"{database}.self"
    M.rebuild(spark.createDataFrame([(1,), (2,)], "k int"), name)
    M.refill(spark.table(name).where("k = 2"), name)
    assert rows(spark.table(name)) == [(2,)]


def test_contract(spark):
    contract = struct("k int, v string")
    df = spark.createDataFrame([("a", 1)], "v string, k int")
    assert M.enforce_contract(df, contract).columns == ["k", "v"]
    with pytest.raises(TypeError, match="k is bigint, not int"):
        M.enforce_contract(df.withColumn("k", F.lit(1).cast("bigint")), contract)
    with pytest.raises(TypeError, match="missing v; unexpected w"):
        M.enforce_contract(df.withColumnRenamed("v", "w"), contract)


def test_write_modes_and_single_file(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100)
    L.write_parquet(df, path, overwrite=False)
    with pytest.raises(AnalysisException):
        L.write_parquet(df, path, overwrite=False)
    L.write_parquet(df, path, files=3)
    assert L.file_report(spark, path).count() == 3
    L.write_report(df, path)
    report = L.average_file_mb(spark, path).first()
    assert report["files"] == 1 and report["avg_mb"] > 0


def test_create_if_absent_keeps_comments_and_rows(spark, database):
    name = f"{database}.described"
    schema = struct("k int, v string")
    L.create_if_absent(spark, name, schema, {"k": "The rider's key"})
    spark.createDataFrame([(1, "a")], schema).write.insertInto(name)
    L.create_if_absent(spark, name, schema)
    assert rows(spark.table(name)) == [(1, "a")]
    notes = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert notes["k"] == "The rider's key"


def test_copy_into_fills_and_truncate_clears(spark, database):
    name = f"{database}.staging"
    L.create_if_absent(spark, name, struct("id string, k int, v string"))
    source = spark.createDataFrame([("x", 7, "skipped")], "v string, k int, other string")
    L.copy_into(source, name, ["k", "v"])
    assert rows(spark.table(name)) == [(None, 7, "x")]
    L.truncate(spark, name)
    assert spark.table(name).count() == 0


def test_chunks_bound_the_files(spark, database):
    name = f"{database}.chunks"
    L.create_then_append(spark.range(0, 1050, 1, 1), name, chunk_rows=100)
    sizes = [r["count"] for r in spark.table(name).groupBy("_metadata.file_path").count().collect()]
    assert Counter(sizes) == Counter([100] * 10 + [50])


def test_constant_frame(spark):
    df = L.constant_frame(spark, [(1, 23), (2, 34)], "Day int, Num_Passengers int", Month="07")
    assert rows(df) == [(1, 23, "07"), (2, 34, "07")]


def test_archive_skips_what_is_done(spark, tmp_path):
    schema = struct("k int, v string")
    for service, month in (("green", "01"), ("green", "02"), ("yellow", "01")):
        folder = tmp_path / "raw" / service / "2021"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{month}.csv").write_text(f"k,v\n1,{service}{month}\n2,x\n")
    source = str(tmp_path / "raw") + "/{service}/{year}/{month}.csv"
    target = str(tmp_path / "archive")
    services = {"green": schema, "yellow": schema}
    first = L.archive_months(spark, services, [(2021, 1)], source, target, 1)
    assert len(first) == 2
    second = L.archive_months(spark, services, [(2021, 1), (2021, 2), (2021, 3)], source, target, 1)
    assert [p.rsplit("/", 1)[1] for p in second] == ["02.csv"]
    got = spark.read.parquet(target).where("k = 1").select("v", "service", "year", "month")
    assert rows(got) == [
        ("green01", "green", 2021, 1),
        ("green02", "green", 2021, 2),
        ("yellow01", "yellow", 2021, 1),
    ]


@pytest.mark.parametrize("kind", ["date", "string"])
def test_changes_keep_the_null_partition(spark, database, kind):
    for load in (M.upsert, M.delete_insert):
        name = f"{database}.nulls_{kind}_{load.__name__}"
        def frame(rows):
            return spark.createDataFrame(rows, "k long, d string").withColumn("d", F.col("d").cast(kind))

        M.rebuild(frame([(1, "2024-01-01"), (2, None), (3, None)]), name, "d")
        load(frame([(4, None)]), name, ["k"])
        assert {r.k for r in spark.table(name).collect()} == {1, 2, 3, 4}
        load(frame([(2, "2024-01-01")]), name, ["k"])
        got = {(r.k, None if r.d is None else str(r.d)) for r in spark.table(name).collect()}
        assert got == {(1, "2024-01-01"), (2, "2024-01-01"), (3, None), (4, None)}
        load(frame([(3, "2024-01-02"), (4, "2024-01-02")]), name, ["k"])
        got = {(r.k, None if r.d is None else str(r.d)) for r in spark.table(name).collect()}
        assert got == {(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-02")}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_the_mark_does_not_depend_on_the_driver_s_zone(spark, database, kind, monkeypatch):
    name = f"{database}.marks_{kind}"
    texts = ["2024-07-01 10:00:00.000001", "2024-07-01 10:00:00.000002", "2024-07-01 11:00:00", "2024-07-01 14:00:00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind))
    M.rebuild(rows.where("cast(t as string) <= '2024-07-01 10:00:00.000001'"), name)
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        got = M.newer_rows(rows, name, "t").select(F.col("t").cast("string")).collect()
        back = M.newer_rows(rows, name, "t", timedelta(hours=1)).count()
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert sorted(r[0] for r in got) == texts[1:]
    assert back == 4


def test_no_load_drops_a_column_in_silence(spark, database):
    def frame(text):
        return spark.sql(f"SELECT 1L AS k, timestamp_ntz'2024-01-01 00:00:00' AS t, {text} AS d")

    flat, parted = f"{database}.flat", f"{database}.parted"
    M.rebuild(frame("date'2024-01-01'"), flat)
    M.rebuild(frame("date'2024-01-01'"), parted, "d")
    more = frame("date'2024-01-01'").withColumn("k", F.lit(2).cast("long")).withColumn("extra", F.lit("x"))
    for table_name in (flat, parted):
        for load in (
            lambda n: M.append(more, n),
            lambda n: M.insert_only_merge(more, n, ["k"]),
            lambda n: M.upsert(more, n, ["k"]),
            lambda n: M.delete_insert(more, n, ["k"]),
        ):
            with pytest.raises(ValueError, match="extra"):
                load(table_name)
    with pytest.raises(ValueError, match="extra"):
        M.replace_interval(more, parted, "t", "2024-01-01", "2024-01-02")
    with pytest.raises(ValueError, match="not partitioned"):
        M.replace_interval(more.drop("extra"), flat, "t", "2024-01-01", "2024-01-02")
    M.upsert(more, parted, ["k"], widen=True)
    assert {(r.k, r.extra) for r in spark.table(parted).collect()} == {(1, None), (2, "x")}


def test_a_merge_refuses_null_keys(spark, database):
    name = f"{database}.keyless"
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    M.rebuild(rows.limit(0), name)
    with pytest.raises(ValueError, match="without a key"):
        M.insert_only_merge(rows, name, ["k"])
