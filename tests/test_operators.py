import math
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.operators import aggregate as G
from meterline.operators import columns as C
from meterline.operators import dedup as D
from meterline.operators import filters as W
from meterline.operators import joins as J
from meterline.schemas import payment_types

relaxed = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return [tuple(r) for r in df.collect()]


small = st.one_of(st.none(), st.integers(0, 3))


@relaxed
@given(st.lists(st.tuples(small, small, st.integers(0, 2)), min_size=1, max_size=40))
def test_one_row_per_key_against_python(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v int").repartition(3)
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    first = {min(g, key=lambda r: (r[1] is None, r[1] or 0, r[2])) for g in groups.values()}
    last = {min(g, key=lambda r: (r[1] is None, -(r[1] or 0), r[2])) for g in groups.values()}
    assert Counter(rows(D.first_per_key(df, ["k"], "o"))) == Counter(first)
    assert Counter(rows(D.latest_per_key(df, ["k"], "o"))) == Counter(last)


@relaxed
@given(
    st.lists(st.tuples(small, st.integers(0, 9)), max_size=60),
    st.lists(small, max_size=20),
)
def test_anti_join_against_python(spark, left, right):
    l_df = spark.createDataFrame(left, "k int, v int").repartition(4)
    r_df = spark.createDataFrame([(k,) for k in right], "k int")
    got = rows(J.anti_join(l_df, r_df, ["k"]))
    held = {k for k in right if k is not None}
    assert Counter(got) == Counter(r for r in left if r[0] not in held)


def test_anti_join_has_one_plan_without_hints(spark):
    left = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    )
    got = J.anti_join(left, spark.range(1, 15000).select(F.col("id").alias("k")), ["k"])
    assert got.where("k = 0").count() == 10000
    assert got.where("k <> 0").count() == left.where("k >= 15000").count()
    assert "hint" not in got._jdf.queryExecution().logical().toString().lower()


def test_orphans_count_rows_and_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "p int")
    assert sorted(rows(J.orphans(child, parent, "k", "p"))) == [(1, 2), (9, 1)]


def test_two_roles_keep_or_drop_unmatched(spark):
    fact = spark.createDataFrame([(1, 1, 2), (2, 1, 9), (3, None, 2)], "id int, p int, d int")
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "z int, zone string")
    roles = {"pickup": "p", "dropoff": "d"}
    left = J.two_roles(fact, dim, "z", roles, ["zone"]).select("id", "pickup_zone", "dropoff_zone")
    assert sorted(rows(left)) == [(1, "A", "B"), (2, "A", None), (3, None, "B")]
    inner = J.two_roles(fact, dim, "z", roles, ["zone"], "inner")
    assert [r["id"] for r in inner.collect()] == [1]


def test_defaulted_lookup(spark):
    fact = spark.createDataFrame([(1, None), (2, 0), (3, 5), (4, 2), (5, 77)], "id int, code int")
    got = J.lookup_or_default(
        fact, payment_types(spark), "code", "payment_type", "label", "description", 0, "Unknown"
    )
    assert sorted(rows(got)) == [
        (1, 0, "Unknown"),
        (2, 0, "Unknown"),
        (3, 5, "Unknown"),
        (4, 2, "Cash"),
        (5, 77, "Unknown"),
    ]
    plain = J.lookup(fact, payment_types(spark), "code", "payment_type", {"label": "description"})
    assert {r["id"]: r["label"] for r in plain.collect()} == {
        1: None,
        2: "Unknown",
        3: "Unknown",
        4: "Cash",
        5: None,
    }


def test_union_refuses_silent_widening(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(TypeError, match="k: int against string"):
        D.union_aligned(a, spark.createDataFrame([("y", "2")], "v string, k string"))
    same = spark.createDataFrame([("y", 2)], "v string, k int")
    assert rows(D.union_aligned(a, same)) == [(1, "x"), (2, "y")]


def test_union_many_fills_missing(spark):
    frames = [
        spark.createDataFrame([(1, "a")], "k int, a string"),
        spark.createDataFrame([("b", 2)], "b string, k int"),
    ]
    assert rows(D.union_many(frames)) == [(1, "a", None), (2, None, "b")]


def test_rename_pick_and_shared(spark):
    df = spark.createDataFrame([(1, None, 3)], "VendorID int, brand string, price int")
    assert C.rename(df, C.SNAKE_NAMES).columns == ["vendor_id", "brand", "price"]
    assert rows(C.pick(df, ["brand", "sku", "price"])) == [(None, "N/A", 3)]
    other = spark.createDataFrame([(1, 2)], "price int, VendorID int")
    assert C.shared_columns(df, other) == ["VendorID", "price"]


def test_pick_json_missing_against_null(spark):
    df = spark.createDataFrame(
        [(1, '{"brand": "x"}'), (2, '{"brand": null}'), (3, "{}"), (4, None)], "id int, doc string"
    )
    got = C.pick_json(df, "doc", ["brand"]).select("id", "brand")
    assert sorted(rows(got)) == [(1, "x"), (2, None), (3, "N/A"), (4, "N/A")]


def test_windows_are_half_open(spark):
    times = [datetime(2024, 2, 1), datetime(2024, 2, 29, 23, 59), datetime(2024, 3, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert df.where(W.in_month("t", 2024, 2)).count() == 2
    assert df.where(W.on_day("t", "2024-03-01")).count() == 1
    assert df.where(W.in_window("t", times[0], times[2])).count() == 2
    december = spark.createDataFrame([(datetime(2024, 12, 31, 1),)], "t timestamp_ntz")
    assert december.where(W.in_month("t", 2024, 12)).count() == 1


def test_touched_days():
    days = W.touched_days("2024-01-05 06:30:00", "2024-01-07")
    assert [str(d) for d in days] == ["2024-01-05", "2024-01-06"]
    days = W.touched_days("2024-01-05", "2024-01-07 00:00:01")
    assert [str(d) for d in days] == ["2024-01-05", "2024-01-07"]


def test_validity_filter_drops_nulls(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 1.0), (None, 1.0)], "a double, b double")
    assert rows(df.where(W.none_negative("a", "b"))) == [(1.0, 0.0)]


def test_exact_sum_ignores_order_and_loses_nothing(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return tuple(df.agg(G.exact_sum(F.col("x")), G.exact_avg(F.col("x"))).first())

    assert total([0.1] * 1000 + [1e9, None]) == (1000000100.0, 1000000100.0 / 1001)
    assert total([0.0004] * 10000) == (4.0, 4.0 / 10000)
    assert abs(total([1e-9] * 1000)[0] - 1e-6) < 1e-18
    assert total([1e18, 1.5]) == (1e18 + 1.5, (1e18 + 1.5) / 2)
    assert total([float("inf"), 1.0])[0] == float("inf")
    assert math.isnan(total([float("nan"), 1.0])[0])
    assert total([None]) == (None, None)


def test_rollout_key_named_like_an_input(spark):
    df = spark.createDataFrame([(None, 1.0), ("Unknown", 2.0), ("A", 4.0)], "zone string, x double")
    merged = G.rollout(
        df, {"zone": F.coalesce("zone", F.lit("Unknown"))}, sums={"x": "x"}, counts={"n": "x"}
    )
    assert sorted(rows(merged)) == [("A", 4.0, 1), ("Unknown", 3.0, 2)]


def test_extremes_settle_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None)], "k string, n int")
    assert rows(G.extreme_rows(df, "n", 2, ties=["k"])) == [("c", 2), ("a", 1)]
    low = G.extreme_rows(df, "n", 2, descending=False, ties=["k"])
    assert rows(low) == [("a", 1), ("b", 1)]


def test_high_water_mark_of_nothing(spark):
    df = spark.createDataFrame([], "n int")
    assert G.high_water_mark(df, "n") is None
