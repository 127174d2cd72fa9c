"""Checks, freshness and profile."""

from datetime import datetime

from pyspark.sql import functions as F

from meterline.operators import quality as Q
from meterline.queries.registry import query, table


@query(
    "Q1 Q3 Q6 Q7",
    """SELECT 'not_null(code)' AS "check", count(*) FILTER (l_suppkey % 10 = 0) AS failures FROM lineitem
UNION ALL SELECT 'accepted_values(l_returnflag)', count(*) FILTER (l_returnflag NOT IN ('A', 'N'))
FROM lineitem
UNION ALL SELECT 'non_negative(margin)', count(*) FILTER (l_discount - l_tax < 0) FROM lineitem
UNION ALL SELECT 'positive(l_tax)', count(*) FILTER (l_tax <= 0) FROM lineitem""",
)
def qc_rows(spark, sf):
    """Four checks in one pass."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "nullif(l_suppkey % 10, 0) as code", "l_returnflag", "l_discount - l_tax as margin", "l_tax"
    )
    return Q.run_checks(
        rows,
        [
            Q.not_null("code"),
            Q.accepted_values("l_returnflag", ["A", "N"]),
            Q.non_negative("margin"),
            Q.positive("l_tax"),
        ],
    )


@query(
    "Q2",
    """SELECT 'unique(p_name)' AS "check", count(*) AS failures
FROM (SELECT name FROM (SELECT nullif(p_name, 'red bolt') AS name FROM part) WHERE name IS NOT NULL
      GROUP BY 1 HAVING count(*) > 1)""",
)
def qc_unique(spark, sf):
    rows = table(spark, sf, "part").selectExpr("nullif(p_name, 'red bolt') as p_name")
    return Q.run_checks(rows, [Q.unique("p_name")])


@query(
    "Q5",
    """SELECT 'unique_combination(l_orderkey,l_linenumber)' AS "check", count(*) AS failures
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
)
def qc_unique_combination(spark, sf):
    return Q.run_checks(
        table(spark, sf, "lineitem"), [Q.unique_combination("l_orderkey", "l_linenumber")]
    )


@query(
    "Q4 J7",
    """SELECT 'relationship(code)' AS "check", count(*) AS failures FROM lineitem
WHERE l_suppkey % 30 <> 0 AND l_suppkey % 30 NOT IN (SELECT n_nationkey FROM nation)""",
)
def qc_relationship(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("cast(nullif(l_suppkey % 30, 0) as int) as code")
    return Q.run_checks(rows, [Q.relationship("code", table(spark, sf, "nation"), "n_nationkey")])


@query(
    "Q8",
    """SELECT 'every order has a customer' AS "check", CAST(0 AS BIGINT) AS failures
UNION ALL SELECT 'row count is above one', CAST(CASE WHEN count(*) > 1 THEN 0 ELSE 1 END AS BIGINT)
FROM orders
UNION ALL SELECT 'no open orders',
  CAST(CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN 0 ELSE 1 END AS BIGINT) FROM orders""",
)
def qc_custom(spark, sf):
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    lost = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").agg(
        F.count(F.when(F.col("c_custkey").isNull(), 1)).alias("n")
    )
    enough = orders.agg((F.count(F.lit(1)) > 1).cast("int").alias("n"))
    still_open = orders.agg(F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("n"))
    return (
        Q.query_returns("every order has a customer", lost, 0)
        .unionAll(Q.query_returns("row count is above one", enough, 1))
        .unionAll(Q.query_returns("no open orders", still_open, 0))
    )


@query(
    "Q9",
    """SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest,
       round((epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9, 6) AS hours_behind,
       CASE WHEN (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9 > 48 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9 > 24 THEN 'warn'
            ELSE 'pass' END AS status
FROM events""",
)
def qc_freshness(spark, sf):
    state = Q.freshness(table(spark, sf, "events"), "ts", datetime(2024, 2, 1, 12))
    return state.withColumn("hours_behind", F.round("hours_behind", 6))


@query(
    "Q10",
    """SELECT 1 AS position, 'o_orderkey' AS name, 'bigint' AS type, count(*) AS rows,
       count(o_orderkey) AS non_null FROM orders
UNION ALL SELECT 2, 'code', 'bigint', count(*), count(nullif(o_custkey % 10, 0)) FROM orders
UNION ALL SELECT 3, 'status', 'string', count(*), count(nullif(o_orderstatus, 'P')) FROM orders
UNION ALL SELECT 4, 'o_totalprice', 'double', count(*), count(o_totalprice) FROM orders""",
)
def profile(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_custkey % 10, 0) as code",
        "nullif(o_orderstatus, 'P') as status",
        "o_totalprice",
    )
    return Q.profile(rows)
