"""Joins against lookups and anti joins."""

from pyspark.sql import functions as F

from meterline import functions as fn
from meterline.operators import joins as J
from meterline.queries import adapters as A
from meterline.queries.registry import query, table


def _coded_orders(spark, sf):
    """Orders with a code 1..9 or null out of the customer key."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(nullif(o_custkey % 10, 0) as int) as code"
    )


CODED_SQL = """coded AS (
  SELECT o_orderkey, CAST(nullif(o_custkey % 10, 0) AS INTEGER) AS code FROM orders)"""


@query(
    "J1",
    """SELECT l_orderkey, l_linenumber, s_name AS supplier
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
)
def inner_lookup(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    named = J.lookup(
        rows, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", {"supplier": "s_name"}, "inner"
    )
    return named.drop("l_suppkey")


def _role_rows(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "cast(l_suppkey % 30 as int) as pickup_id",
        "cast(l_partkey % 27 as int) as dropoff_id",
    )


def _roles_sql(kind: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, p.n_name AS pickup_n_name, d.n_name AS dropoff_n_name
FROM lineitem {kind} JOIN nation p ON l_suppkey % 30 = p.n_nationkey
              {kind} JOIN nation d ON l_partkey % 27 = d.n_nationkey"""


def _roles(spark, sf, how):
    rows = J.two_roles(
        _role_rows(spark, sf),
        table(spark, sf, "nation"),
        "n_nationkey",
        {"pickup": "pickup_id", "dropoff": "dropoff_id"},
        ["n_name"],
        how,
    )
    return rows.drop("pickup_id", "dropoff_id")


@query("J2", _roles_sql("INNER"))
def two_roles_inner(spark, sf):
    return _roles(spark, sf, "inner")


@query("J3", _roles_sql("LEFT"))
def two_roles_left(spark, sf):
    return _roles(spark, sf, "left")


@query(
    "J4 X12",
    f"""WITH {CODED_SQL},{A.PAYMENT_SQL}
SELECT o_orderkey, coalesce(coded.code, 0) AS code, coalesce(label, 'Unknown') AS label
FROM coded LEFT JOIN payment ON coalesce(coded.code, 0) = payment.code""",
)
def defaulted_lookup(spark, sf):
    return J.lookup_or_default(
        _coded_orders(spark, sf),
        A.schemas.payment_types(spark),
        "code",
        "payment_type",
        "label",
        "description",
        0,
        "Unknown",
    )


@query(
    "J5 S27",
    f"""WITH {CODED_SQL},{A.PAYMENT_SQL}
SELECT o_orderkey, label FROM coded LEFT JOIN payment ON coded.code = payment.code""",
)
def left_lookup(spark, sf):
    named = J.lookup(
        _coded_orders(spark, sf),
        A.schemas.payment_types(spark),
        "code",
        "payment_type",
        {"label": "description"},
    )
    return named.drop("code")


@query(
    "J6",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
)
def rows_without_match(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    target = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return J.anti_join(rows, target.selectExpr("o_orderkey as l_orderkey"), ["l_orderkey"])


@query(
    "J6",
    """SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 5000)""",
)
def rows_without_match_hot(spark, sf):
    """As above with few, heavy keys."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    target = table(spark, sf, "supplier").where("s_acctbal > 5000")
    target = target.selectExpr("s_suppkey as l_suppkey")
    return J.anti_join(rows, target, ["l_suppkey"])


@query(
    "J7 Q4",
    """SELECT o_custkey AS key, count(*) AS rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
GROUP BY 1""",
)
def orphan_keys(spark, sf):
    parent = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return J.orphans(table(spark, sf, "orders"), parent, "o_custkey", "c_custkey")


@query(
    "J8",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' ELSE lang END
  AS language FROM documents""",
)
def mapped_labels(spark, sf):
    label = fn.label_or_self(F.col("lang"), {"en": "English", "es": "Spanish"})
    return table(spark, sf, "documents").select("doc_id", label.alias("language"))
