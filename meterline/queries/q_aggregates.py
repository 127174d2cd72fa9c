"""Aggregates, one row per key, extreme rows, unions."""

from pyspark.sql import functions as F

from meterline.operators import aggregate as G
from meterline.operators import dedup as D
from meterline.queries.registry import query, table


@query("A1", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def count_by_group(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "A2",
    "SELECT p_brand, count(nullif(p_type, 'SMALL')) AS n FROM part GROUP BY 1",
)
def count_non_null(spark, sf):
    rows = table(spark, sf, "part").selectExpr("p_brand", "nullif(p_type, 'SMALL') as type")
    return rows.groupBy("p_brand").agg(F.count("type").alias("n"))


@query(
    "A3",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
)
def distinct_by_group(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct("l_partkey").alias("parts")
    )


@query(
    "A4",
    """SELECT count(*) AS n, count(DISTINCT user_id) AS users,
       count(DISTINCT nullif(event_type, 'error')) AS types FROM events""",
)
def global_counts(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "user_id", "nullif(event_type, 'error') as event_type"
    )
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("event_type").alias("types"),
    )


@query(
    "A5",
    """SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY 1""",
)
def sum_by_group(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        G.exact_sum(F.col("l_extendedprice")).alias("total")
    )


@query("A6", "SELECT user_id, max(value) AS top FROM events GROUP BY 1")
def max_by_group(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.max("value").alias("top"))


@query("A7", "SELECT max(l_extendedprice) AS top FROM lineitem")
def global_max(spark, sf):
    return table(spark, sf, "lineitem").agg(F.max("l_extendedprice").alias("top"))


@query(
    "A8 X13",
    """SELECT p_brand, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean,
       round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS rounded
FROM part GROUP BY 1""",
)
def average_by_group(spark, sf):
    mean = G.exact_avg(F.col("p_retailprice"))
    return table(spark, sf, "part").groupBy("p_brand").agg(
        mean.alias("mean"), F.round(mean, 2).alias("rounded")
    )


@query(
    "A9",
    """SELECT l_suppkey AS zone, l_returnflag AS flag, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount,
       CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax,
       count(l_orderkey) AS n,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS mean_quantity
FROM lineitem GROUP BY 1, 2, 3""",
)
def wide_rollout(spark, sf):
    return G.rollout(
        table(spark, sf, "lineitem"),
        keys={
            "zone": F.col("l_suppkey"),
            "flag": F.col("l_returnflag"),
            "year": F.year("l_shipdate"),
        },
        sums={"price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"},
        averages={"mean_quantity": "l_quantity"},
        counts={"n": "l_orderkey"},
        scale=2,
    )


@query(
    "A10",
    """SELECT coalesce(zone, 'Unknown Zone') AS zone, count(*) AS n
FROM (SELECT CASE WHEN n_nationkey < 3 THEN NULL WHEN n_nationkey < 5 THEN 'Unknown Zone'
                  ELSE n_name END AS zone
      FROM customer JOIN nation ON c_nationkey = n_nationkey) AS t
GROUP BY t.zone""",
)
def group_by_input_column(spark, sf):
    """Grouping by a name that is both an input column and an output alias means the input."""
    zone = F.expr(
        "case when n_nationkey < 3 then null when n_nationkey < 5 then 'Unknown Zone' "
        "else n_name end"
    )
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    counts = rows.groupBy(zone.alias("zone")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("zone", F.coalesce("zone", F.lit("Unknown Zone")))


@query(
    "A10",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def group_by_position(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("meterline_group_by_position")
    return spark.sql(
        "SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS n "
        "FROM meterline_group_by_position GROUP BY 1, 2"
    )


@query(
    "A11",
    "SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS high FROM orders",
)
def high_water(spark, sf):
    return table(spark, sf, "orders").agg(F.max("o_orderdate").alias("high"))


@query(
    "W1",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) = 1""",
)
def latest_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    return D.latest_per_key(
        rows, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey", "l_quantity"]
    )


@query(
    "W1",
    """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def latest_event_by_user(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return D.latest_per_key(rows, ["user_id", "event_type"], "ts")


@query(
    "W2",
    """SELECT l_returnflag, l_suppkey, l_orderkey, l_linenumber, l_extendedprice
FROM (SELECT l_returnflag, l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
             CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS o FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_suppkey
  ORDER BY o ASC NULLS LAST, l_orderkey, l_linenumber, l_extendedprice) = 1""",
)
def first_rows(spark, sf):
    """Few keys with many rows each, and nulls in the order column."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice",
        "case when l_linestatus = 'O' then l_shipdate end as o",
    )
    return D.first_per_key(
        rows, ["l_returnflag", "l_suppkey"], "o", ["l_orderkey", "l_linenumber", "l_extendedprice"]
    ).drop("o")


@query(
    "O1",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type",
)
def ordered_by_count(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "event_type")


@query("O2", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey")
def ordered_by_key(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey")


@query(
    "O3",
    """SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 15""",
)
def top_k(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return G.extreme_rows(counts, "n", 15, ties=["user_id"])


@query(
    "O4",
    """SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n ASC, user_id LIMIT 5""",
)
def bottom_k(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return G.extreme_rows(counts, "n", 5, descending=False, ties=["user_id"])


@query("O5", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def preview(spark, sf):
    """A preview; ordered, so that the SQL side shows the same rows."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query(
    "U1",
    """SELECT c_custkey AS key, c_acctbal AS balance, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""",
)
def aligned_union(spark, sf):
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey as key", "c_acctbal as balance", "'customer' as kind"
    )
    suppliers = table(spark, sf, "supplier").selectExpr(
        "'supplier' as kind", "s_acctbal as balance", "s_suppkey as key"
    )
    return D.union_aligned(customers, suppliers)


@query(
    "U2",
    """SELECT o_orderkey AS key, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS flag FROM orders
UNION ALL SELECT l_orderkey, NULL, l_returnflag FROM lineitem
UNION ALL SELECT event_id, NULL, event_type FROM events""",
)
def union_with_missing(spark, sf):
    return D.union_many(
        [
            table(spark, sf, "orders").selectExpr("o_orderkey as key", "o_orderstatus as status"),
            table(spark, sf, "lineitem").selectExpr("l_orderkey as key", "l_returnflag as flag"),
            table(spark, sf, "events").selectExpr("event_id as key", "event_type as flag"),
        ]
    )


@query("U3", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
