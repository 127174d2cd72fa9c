"""Projections, filters and scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from meterline import functions as fn
from meterline.operators import columns as C
from meterline.operators import filters as W
from meterline.queries import adapters as A
from meterline.queries.registry import query, table
from meterline.schemas import VENDORS


@query("P1", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def column_subset(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@query("P2", "SELECT * FROM customer")
def all_columns(spark, sf):
    return table(spark, sf, "customer").select("*")


@query(
    "P3",
    """SELECT o_orderkey AS order_id, o_custkey AS vendor_id, o_totalprice AS total_amount
FROM orders""",
)
def renamed_columns(spark, sf):
    names = {"o_orderkey": "order_id", "o_custkey": "vendor_id", "o_totalprice": "total_amount"}
    orders = C.rename(table(spark, sf, "orders"), {**names, "not_there": "ignored"})
    return orders.select(*names.values())


@query("P4", "SELECT event_id, 'green' AS service_type FROM events")
def literal_tag(spark, sf):
    return C.tag(table(spark, sf, "events").select("event_id"), "service_type", "green")


@query(
    "P5",
    """SELECT count(*) AS n, count(*) AS with_file, count(*) AS with_time FROM lineitem""",
)
def lineage_columns(spark, sf):
    rows = C.with_lineage(table(spark, sf, "lineitem"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("filename").contains("parquet"), 1)).alias("with_file"),
        F.count("extracted_at").alias("with_time"),
    )


@query(
    "P6",
    f"""WITH {A.RAW_SQL}
SELECT vendor_id AS "VendorID", trip_distance, CAST(payment_type AS VARCHAR) AS payment_type
FROM raw WHERE l_linestatus = 'O'""",
)
def shared_columns(spark, sf):
    green = A.green(spark, sf).drop("fare_amount", "store_and_fwd_flag")
    yellow = A.yellow(spark, sf).select("payment_type", "trip_distance", "VendorID")
    shared = green.select(*C.shared_columns(green, yellow))
    return C.cast_columns(shared, {"payment_type": "string"})


@query(
    "P7",
    """SELECT CAST(l_orderkey AS INTEGER) AS vendor_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18,3)) AS DOUBLE) AS fare_amount,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS pickup_datetime,
       CAST(l_linenumber AS VARCHAR) AS flag
FROM lineitem""",
)
def typed_columns(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as vendor_id",
        "l_extendedprice as fare_amount",
        "l_shipdate as pickup_datetime",
        "l_linenumber as flag",
    )
    return C.cast_columns(
        rows,
        {
            "vendor_id": "int",
            "fare_amount": "decimal(18,3)",
            "pickup_datetime": "timestamp",
            "flag": "string",
        },
    )


@query(
    "P8 X16",
    """SELECT p_partkey,
       CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(p_size AS VARCHAR) END
         AS code
FROM part""",
)
def safe_casts(spark, sf):
    texts = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "case p_partkey % 4 when 0 then cast(p_size as string) when 1 then p_size || '.0' "
        "when 2 then p_name end as text",
    )
    return texts.select("p_partkey", fn.safe_int(F.col("text")).cast("string").alias("code"))


@query(
    "P9",
    "SELECT s_suppkey, CAST(1 AS INTEGER) AS trip_type, CAST(0 AS DOUBLE) AS ehail_fee FROM supplier",
)
def filled_columns(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey")
    return C.fill_columns(rows, {"trip_type": (1, "int"), "ehail_fee": (0, "decimal(18,3)")})


@query(
    "P10 S9",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, 'N/A' AS brand FROM events""",
)
def json_pick_default(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "props")
    return C.pick_json(rows, "props", ["k", "brand"]).drop("props")


@query("F1 P1", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def equality_filter(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("F2", "SELECT event_id, value FROM events WHERE value <= 1")
def comparison_filter(spark, sf):
    return table(spark, sf, "events").where(F.col("value") <= 1).select("event_id", "value")


@query(
    "F3",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01'""",
)
def time_window(spark, sf):
    orders = table(spark, sf, "orders")
    window = W.in_window("o_orderdate", "1997-02-01", "1997-03-01")
    return orders.where(window).select("o_orderkey", "o_custkey")


@query("F4", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def closed_range(spark, sf):
    return table(spark, sf, "part").where(F.col("p_size").between(10, 20)).select(
        "p_partkey", "p_size"
    )


@query("F5", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def single_day(spark, sf):
    return table(spark, sf, "events").where(W.on_day("ts", "2024-01-10")).select("event_id")


@query(
    "F6",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
WHERE event_type <> 'error'""",
)
def not_null_filter(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").cast("int")).alias(
            "k"
        ),
    )
    return rows.where(W.no_nulls("k"))


@query(
    "F7",
    """SELECT c_custkey, c_acctbal FROM customer
WHERE c_mktsegment <> 'BUILDING' AND c_acctbal >= 0""",
)
def validity_filter(spark, sf):
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_acctbal", "case when c_mktsegment <> 'BUILDING' then c_acctbal end as checked"
    )
    return rows.where(W.none_negative("c_acctbal", "checked")).drop("checked")


@query(
    "F8 A11",
    """SELECT o_orderkey FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F'
                       AND o_orderdate < TIMESTAMP '2000-01-01')""",
)
def past_target_max(spark, sf):
    orders = table(spark, sf, "orders")
    target = orders.where(
        "o_orderstatus = 'F' and o_orderdate < timestamp_ntz'2000-01-01 00:00:00'"
    )
    return W.newer_than(orders, "o_orderdate", target).select("o_orderkey")


@query(
    "X1",
    """SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S.%f') AS month FROM events""",
)
def month_truncation(spark, sf):
    return table(spark, sf, "events").select("event_id", fn.month_of(F.col("ts")).alias("month"))


@query("X2", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def timestamp_dates(spark, sf):
    return table(spark, sf, "events").select("event_id", fn.date_of(F.col("ts")).alias("day"))


SPAN_SQL = """span AS (
  SELECT event_id, ts AS a, ts + to_microseconds(CAST(value * 1000000 AS BIGINT) - 30000000) AS b
  FROM events)"""


def _spans(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id",
        "ts as a",
        "ts + make_dt_interval(0, 0, 0, cast(value as decimal(18,6)) - 30) as b",
    )


@query(
    "X3",
    f"WITH {SPAN_SQL} SELECT event_id, date_diff('minute', a, b) AS minutes FROM span",
)
def minutes_crossed(spark, sf):
    return _spans(spark, sf).select(
        "event_id", fn.minutes_crossed(F.col("a"), F.col("b")).alias("minutes")
    )


@query(
    "X4",
    f"""WITH {SPAN_SQL}
SELECT event_id, CAST((epoch_us(b) - epoch_us(a)) / 60000000.0 AS INTEGER) AS minutes FROM span""",
)
def elapsed_minutes(spark, sf):
    return _spans(spark, sf).select(
        "event_id", fn.elapsed_minutes(F.col("a"), F.col("b")).alias("minutes")
    )


@query(
    "X5",
    """SELECT l_orderkey, l_linenumber, (epoch(l_shipdate) - epoch(o_orderdate)) / 3600 AS hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def elapsed_hours(spark, sf):
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    hours = fn.elapsed_hours(F.col("o_orderdate"), F.col("l_shipdate"))
    return rows.select("l_orderkey", "l_linenumber", hours.alias("hours"))


@query(
    "X6",
    """SELECT event_id, CASE WHEN event_type <> 'error'
       THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events""",
)
def parsed_timestamps(spark, sf):
    text = F.when(
        F.col("event_type") != "error", F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    ).otherwise("not a time")
    return table(spark, sf, "events").select(
        "event_id", fn.parse_timestamp(text, "dd/MM/yyyy HH:mm:ss").alias("parsed")
    )


@query(
    "X7",
    """SELECT event_id, strftime(ts + INTERVAL 5 HOURS, '%Y-%m-%d %H:%M:%S.%f') AS utc FROM events""",
)
def utc_naive(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fn.as_utc_naive(F.col("ts"), "America/New_York").alias("utc")
    )


KEY_COLUMNS = ["l_orderkey", "l_linenumber", "l_shipdate", "code", "l_extendedprice"]
KEY_ROWS_SQL = """(SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity, l_suppkey,
       nullif(l_partkey % 10, 0) AS code FROM lineitem)"""


def _key_rows(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity", "l_suppkey",
        "nullif(l_partkey % 10, 0) as code",
    )


@query(
    "X8 X14",
    f"""SELECT l_orderkey, l_linenumber,
       md5(CAST(l_orderkey AS VARCHAR) || CAST(l_shipdate AS VARCHAR)
           || CAST(l_shipdate AS VARCHAR) || CAST(l_suppkey AS VARCHAR)
           || coalesce(CAST(code AS VARCHAR), '')
           || CAST(l_extendedprice AS VARCHAR)
           || CAST(l_quantity AS VARCHAR)) AS unique_row_id
FROM {KEY_ROWS_SQL}""",
)
def natural_keys(spark, sf):
    rows = _key_rows(spark, sf)
    names = [
        "l_orderkey",
        "l_shipdate",
        "l_shipdate",
        "l_suppkey",
        "code",
        "l_extendedprice",
        "l_quantity",
    ]
    return rows.select("l_orderkey", "l_linenumber", fn.natural_key(names).alias("unique_row_id"))


@query(
    "X9 X14",
    f"""SELECT l_orderkey, l_linenumber,
       md5(CAST(l_orderkey AS VARCHAR) || CAST(l_shipdate AS VARCHAR)
           || CAST(l_shipdate AS VARCHAR) || CAST(l_suppkey AS VARCHAR)
           || coalesce(CAST(code AS VARCHAR), '')) AS unique_row_id
FROM {KEY_ROWS_SQL}""",
)
def natural_key_bytes(spark, sf):
    rows = _key_rows(spark, sf)
    names = ["l_orderkey", "l_shipdate", "l_shipdate", "l_suppkey", "code"]
    return rows.select(
        "l_orderkey", "l_linenumber", fn.natural_key_bytes(names).alias("unique_row_id")
    )


@query(
    "X10",
    f"""SELECT l_orderkey, l_linenumber,
       md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_shipdate AS VARCHAR),
                     coalesce(CAST(code AS VARCHAR), '_null_'),
                     CAST(l_extendedprice AS VARCHAR))) AS trip_id
FROM {KEY_ROWS_SQL}""",
)
def surrogate_keys(spark, sf):
    rows = _key_rows(spark, sf)
    return rows.select(
        "l_orderkey", "l_linenumber", fn.surrogate_key(KEY_COLUMNS).alias("trip_id")
    )


@query(
    "X11",
    """SELECT s_suppkey, CASE s_suppkey % 5 WHEN 1 THEN 'Creative Mobile Technologies'
       WHEN 2 THEN 'VeriFone Inc.' WHEN 4 THEN 'Unknown/Other' END AS vendor_name FROM supplier""",
)
def code_names(spark, sf):
    name = fn.code_name(F.col("s_suppkey") % 5, VENDORS)
    return table(spark, sf, "supplier").select("s_suppkey", name.alias("vendor_name"))


@query(
    "X12",
    "SELECT p_partkey, coalesce(nullif(p_type, 'SMALL'), 'Unknown') AS type FROM part",
)
def null_defaults(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", fn.or_default(F.expr("nullif(p_type, 'SMALL')"), "Unknown").alias("type")
    )


@query(
    "X13",
    "SELECT o_orderkey, round(o_totalprice / 7, 2) AS share FROM orders",
)
def rounded_money(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.round_money(F.col("o_totalprice") / 7).alias("share")
    )


@query(
    "X15",
    """SELECT p_partkey,
       CASE WHEN p_partkey % 7 = 0 THEN 's/' WHEN p_partkey % 3 = 0 THEN 'a/' ELSE 'e/' END
         || CASE WHEN p_partkey < 4096 THEN lpad(lower(to_hex(p_partkey)), 3, '0')
                 ELSE lower(to_hex(p_partkey)) END AS base_id
FROM part""",
)
def code_transform(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", fn.base_id(F.format_string("B%05d", "p_partkey")).alias("base_id")
    )
