from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterline.operators import quality as Q


def result(df):
    return {r["check"]: r["failures"] for r in df.collect()}


def test_all_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 0), (None, "a", -1), (None, None, None), (7, "z", 3)],
        "k int, v string, n int",
    )
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    got = result(
        Q.run_checks(
            df,
            [
                Q.not_null("k"),
                Q.unique("k"),
                Q.accepted_values("v", ["a", "b"]),
                Q.non_negative("n"),
                Q.positive("n"),
                Q.relationship("k", parent, "k"),
                Q.unique_combination("k", "v"),
            ],
        )
    )
    assert got == {
        "not_null(k)": 2,
        "unique(k)": 1,
        "accepted_values(v)": 1,
        "non_negative(n)": 1,
        "positive(n)": 2,
        "relationship(k)": 1,
        "unique_combination(k,v)": 0,
    }


def test_row_checks_take_one_pass(spark):
    df = spark.range(10).withColumn("v", F.col("id"))
    plan = Q.run_checks(df, [Q.not_null("id"), Q.positive("v"), Q.non_negative("v")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 1


def test_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "a int, b int")
    assert result(Q.run_checks(df, [Q.unique("a")])) == {"unique(a)": 0}
    assert result(Q.run_checks(df, [Q.unique_combination("a", "b")])) == {
        "unique_combination(a,b)": 1
    }


def test_require(spark):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    Q.require(df, [Q.positive("a")])
    with pytest.raises(ValueError, match=r"not_null\(a\): 1"):
        Q.require(df, [Q.not_null("a"), Q.positive("a")])


def test_query_returns(spark):
    df = spark.range(3)
    count = df.agg(F.count(F.lit(1)).alias("n"))
    assert result(Q.query_returns("three", count, 3)) == {"three": 0}
    assert result(Q.query_returns("none", count, 0)) == {"none": 1}
    nothing = df.where("id < 0").agg(F.max("id").alias("n"))
    assert result(Q.query_returns("max", nothing, 0)) == {"max": 1}


@pytest.mark.parametrize(
    ("hours", "status"), [(23, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")]
)
def test_freshness(spark, hours, status):
    now = datetime(2024, 1, 10)
    df = spark.createDataFrame([(now - timedelta(hours=hours),), (datetime(2000, 1, 1),)], "t timestamp")
    got = Q.freshness(df, "t", now).first()
    assert (got["status"], got["hours_behind"]) == (status, float(hours))


def test_freshness_of_nothing(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert Q.freshness(empty, "t", datetime(2024, 1, 1)).first()["status"] == "error"


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in Q.profile(df).orderBy("position").collect()] == [
        (1, "a", "int", 2, 2),
        (2, "b", "string", 2, 1),
    ]


def test_all_checks_share_one_scan_and_one_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as g", "cast(id % 3 as string) as s")
    parent = spark.createDataFrame([(0,), (1,)], "p int")
    checks = [
        Q.unique("id"), Q.unique_combination("g", "s"), Q.relationship("g", parent, "p"),
        Q.not_null("g"), Q.accepted_values("s", ["0", "1"]), Q.unique("g"),
    ]
    report = Q.run_checks(df, checks)
    text = report._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert result(report) == {
        "unique(id)": 0,
        "unique_combination(g,s)": 21,
        "relationship(g)": 70,
        "not_null(g)": 0,
        "accepted_values(s)": 33,
        "unique(g)": 7,
    }


def test_keys_are_compared_as_spark_groups_them(spark):
    df = spark.createDataFrame(
        [(0.0, "a", "bc", b"x", [1]), (-0.0, "ab", "c", b"x", [1]), (float("nan"), None, "abc", None, None), (float("nan"), "", "abc", b"", [])],
        "d double, s string, t string, b binary, l array<int>",
    )
    checks = [Q.unique("d"), Q.unique_combination("s", "t"), Q.unique_combination("b"), Q.unique_combination("l"), Q.unique("s")]
    counts = {}
    for c in checks:
        keys = df.where(" and ".join(f"{n} is not null" for n in c.columns)) if c.skip_nulls else df
        counts[c.name] = keys.groupBy(*c.columns).count().where("count > 1").count()
    assert result(Q.run_checks(df, checks)) == counts == {
        "unique(d)": 2, "unique_combination(s,t)": 0, "unique_combination(b)": 1, "unique_combination(l)": 1, "unique(s)": 0,
    }


def test_parents_of_another_type_and_empty_tables(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    for kind in ("bigint", "double", "decimal(9,2)"):
        parent = spark.createDataFrame([(1,)], "p int").selectExpr(f"cast(p as {kind}) as p")
        assert result(Q.run_checks(child, [Q.relationship("k", parent, "p")])) == {"relationship(k)": 1}
        assert result(Q.run_checks(child.limit(0), [Q.relationship("k", parent, "p"), Q.unique("k")])) == {
            "relationship(k)": 0,
            "unique(k)": 0,
        }
    assert Q.run_checks(child, []).collect() == []


def test_the_suite_of_the_fact_computes_it_once(spark):
    from meterline.queries import REGISTRY

    text = REGISTRY["suite_fact"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [row_number()") == 1
