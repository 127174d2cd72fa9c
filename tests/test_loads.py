"""Loads that read only what they change, and that survive a stop half-way."""

import glob
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterline.operators import key_index as K
from meterline.operators import layout as L
from meterline.operators import materialize as M

SCHEMA = "k long, t timestamp_ntz, v string"
JAN, FEB, MAR = datetime(2024, 1, 10), datetime(2024, 2, 10), datetime(2024, 3, 10)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def monthly(df):
    return df.withColumn("m", F.trunc("t", "month"))


def table_of(spark, database, rows, grain="month"):
    name = f"{database}.rows"
    L.write_by_date(frame(spark, rows), name, "t", "m", grain)
    return name


def content(spark, name):
    return sorted((r["k"], r["t"], r["v"]) for r in spark.table(name).collect())


def spoil(spark, name, month):
    """Make a partition's files unreadable: whoever reads them fails."""
    home = M._location(spark, name).removeprefix("file:")
    files = glob.glob(f"{home}/m={month}/*.parquet")
    assert files
    for file in files:
        with open(file, "wb") as out:
            out.write(b"no parquet")
    for crc in glob.glob(f"{home}/m={month}/.*.crc"):
        with open(crc, "wb") as out:
            out.write(b"")
    spark.catalog.refreshTable(name)


def test_merge_reads_the_partitions_of_its_source_only(spark, database):
    name = table_of(spark, database, [(1, JAN, "a"), (2, FEB, "b")])
    spoil(spark, name, "2024-01-01")
    source = monthly(frame(spark, [(2, FEB, "again"), (3, FEB, "new"), (4, MAR, "new")]))
    assert M.insert_only_merge(source, name, ["k"], fixed_partition=True) == 2
    with pytest.raises(Exception, match="2024-01-01|not a Parquet|magic"):
        M.insert_only_merge(source, name, ["k"])
    kept = spark.table(name).where("m >= '2024-02-01'")
    assert sorted((r["k"], r["v"]) for r in kept.collect()) == [(2, "b"), (3, "new"), (4, "new")]


def test_merge_without_rows_and_into_an_empty_table(spark, database):
    name = table_of(spark, database, [])
    none = monthly(frame(spark, []))
    assert M.insert_only_merge(none, name, ["k"], fixed_partition=True) == 0
    some = monthly(frame(spark, [(1, JAN, "a"), (2, None, "no time")]))
    assert M.insert_only_merge(some, name, ["k"], fixed_partition=True) == 2
    assert M.insert_only_merge(some, name, ["k"], fixed_partition=True) == 0


def test_merge_evaluates_its_source_once(spark, database):
    name = f"{database}.flat"
    L.create_if_absent(spark, name, frame(spark, []).schema, bucket_by=["k"], buckets=4)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = frame(spark, [(i, JAN, "a") for i in range(50)])
    assert M.insert_only_merge(source.mapInArrow(count, source.schema), name, ["k"]) == 50
    assert seen.value == 50
    with pytest.raises(ValueError, match="without a key"):
        M.insert_only_merge(frame(spark, [(None, JAN, "x"), (99, JAN, "y")]), name, ["k"])
    assert spark.table(name).count() == 50


def test_a_bucketed_target_is_not_shuffled(spark, database):
    name = f"{database}.flat"
    L.create_if_absent(spark, name, frame(spark, []).schema, bucket_by=["k"], buckets=4)
    M.insert_only_merge(frame(spark, [(i, JAN, "a") for i in range(200)]), name, ["k"])
    assert M.insert_only_merge(frame(spark, [(i, JAN, "b") for i in range(100, 300)]), name, ["k"]) == 100
    files = {r[0] for r in spark.table(name).select("_metadata.file_name").distinct().collect()}
    assert len(files) <= 8
    keys = spark.table(name).select("k").distinct()
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_upsert_by_the_key_index_reads_touched_partitions_only(spark, database):
    name = table_of(spark, database, [(1, JAN, "a"), (2, FEB, "b"), (3, FEB, "c"), (4, MAR, "d")])
    K.build_key_index(spark, name, ["k"], "m", prefixes=4)
    spoil(spark, name, "2024-01-01")
    # 2 moves to March and must leave February; January holds none of the keys.
    M.upsert(monthly(frame(spark, [(2, MAR, "moved"), (9, MAR, "new")])), name, ["k"])
    left = spark.table(name).where("m >= '2024-02-01'")
    want = [(2, MAR, "moved"), (3, FEB, "c"), (4, MAR, "d"), (9, MAR, "new")]
    assert sorted((r["k"], r["t"], r["v"]) for r in left.collect()) == want
    # What the first upsert has brought in is found by the second one.
    M.upsert(monthly(frame(spark, [(9, FEB, "back"), (2, FEB, "back")])), name, ["k"])
    want = [(2, FEB, "back"), (3, FEB, "c"), (4, MAR, "d"), (9, FEB, "back")]
    assert sorted((r["k"], r["t"], r["v"]) for r in spark.table(name).where("m >= '2024-02-01'").collect()) == want


def test_an_indexed_table_refuses_loads_that_pass_the_index_by(spark, database):
    name = table_of(spark, database, [(1, JAN, "a")])
    K.build_key_index(spark, name, ["k"], "m")
    more = monthly(frame(spark, [(2, JAN, "b")]))
    loads = [
        lambda: M.append(more, name),
        lambda: M.refill(more, name),
        lambda: M.insert_only_merge(more, name, ["k"]),
        lambda: M.replace_interval(more.drop("m"), name, "t", "2024-01-01", "2024-02-01"),
        lambda: M.upsert(more, name, ["k", "v"]),
    ]
    for load in loads:
        with pytest.raises(ValueError, match="key index"):
            load()
    assert content(spark, name) == [(1, JAN, "a")]


class Stopped(Exception):
    pass


def stop(*_):
    raise Stopped


@pytest.mark.parametrize("step", ["_drop_partitions", "finish_pending", "remove_folder"])
def test_a_load_that_stops_half_way_is_finished_by_the_next(spark, database, monkeypatch, step):
    name = table_of(spark, database, [(1, JAN, "a"), (2, FEB, "b"), (3, FEB, "c")])
    # All of February moves to March: its partition has to go.
    change = monthly(frame(spark, [(2, MAR, "moved"), (3, MAR, "moved")]))
    with monkeypatch.context() as patched:
        if step == "finish_pending":
            real = M.set_properties
            patched.setattr(M, "set_properties", lambda *a: (real(*a), stop()))
        else:
            patched.setattr(M, step, stop)
        with pytest.raises(Stopped):
            M.upsert(change, name, ["k"])
    M.append(monthly(frame(spark, [(7, JAN, "later")])), name)
    assert content(spark, name) == [(1, JAN, "a"), (2, MAR, "moved"), (3, MAR, "moved"), (7, JAN, "later")]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["m=2024-01-01", "m=2024-03-01"]
    assert not M.finish_pending(spark, name)


def test_a_window_inside_of_months_is_replaced(spark, database):
    days = [JAN + timedelta(days=5 * i) for i in range(14)]
    name = table_of(spark, database, [(i, d, "old") for i, d in enumerate(days)])
    source = frame(spark, [(100 + i, d, "new") for i, d in enumerate(days) if i % 2])
    for _ in range(2):
        M.replace_interval(source, name, "t", "2024-01-20 00:00:00", "2024-03-01 00:00:00")
    low, high = datetime(2024, 1, 20), datetime(2024, 3, 1)
    want = [(i, d, "old") for i, d in enumerate(days) if not low <= d < high]
    want += [(100 + i, d, "new") for i, d in enumerate(days) if i % 2 and low <= d < high]
    assert content(spark, name) == sorted(want)
    assert {r[0] for r in spark.table(name).select("m").distinct().collect()} <= {date(2024, m, 1) for m in (1, 2, 3)}


def test_rows_of_a_month_stand_in_the_order_of_time(spark, database):
    """Sorted rows give row groups with narrow ranges, so a window skips most of them."""
    import pyarrow.parquet as pq

    minutes = [(i, JAN + timedelta(minutes=(i * 7919) % 28_000), "x" * 50) for i in range(28_000)]
    name = f"{database}.rows"
    size = "spark.hadoop.parquet.block.size"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "65536")
    try:
        L.write_by_date(frame(spark, minutes), name, "t", "m", "month")
        M.append(monthly(frame(spark, [(-1, JAN, "y"), (-2, JAN - timedelta(days=3), "y")])), name)
    finally:
        hadoop.unset("parquet.block.size")
    assert size not in dict(spark.sparkContext.getConf().getAll())
    files = glob.glob(f"{M._location(spark, name).removeprefix('file:')}/m=2024-01-01/*.parquet")
    groups = []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index("t")
        ranges = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        assert all(a.max <= b.min for a, b in zip(ranges, ranges[1:]))
        groups += ranges
    day = JAN + timedelta(days=2)
    met = [g for g in groups if g.max >= day and g.min < day + timedelta(days=1)]
    assert len(groups) > 4 and len(met) < len(groups) / 2
