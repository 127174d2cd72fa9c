"""Table loads: the table is filled, changed and read back."""

from datetime import date

from pyspark.sql import functions as F

from meterline import functions as fn
from meterline.operators import materialize as M
from meterline.operators.layout import write_by_date
from meterline.plans import raw_load, reports, trips
from meterline.plans.backfill import backfill_months, ledger_state
from meterline.queries import adapters as A
from meterline.queries.q_reports import fact, staged
from meterline.queries.registry import query, table
from meterline.schemas import struct
from meterline.session import scratch_database, scratch_path
from meterline.streaming.loader import load_new_files


def _orders(spark, sf):
    """Orders with the year they are partitioned by."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.year("o_orderdate").alias("y")
    )


ORDERS_SQL = """o AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus,
         CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)"""
STAMP = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate"


@query("M1", "SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY 1")
def view_query(spark, sf):
    M.view(table(spark, sf, "events").where("value > 10"), "meterline_large_events")
    return spark.sql("SELECT event_type, count(*) AS n FROM meterline_large_events GROUP BY 1")


@query("M2 M9", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def refilled_table(spark, sf):
    name = f"{scratch_database(spark, 'refilled')}.orders"
    orders = table(spark, sf, "orders")
    M.rebuild(orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), name)
    M.refill(spark.table(name).where("o_orderstatus = 'O'"), name)
    return spark.table(name).select("o_orderkey", "o_totalprice")


@query("M3", "SELECT event_id, value FROM events UNION ALL SELECT event_id, value FROM events")
def appended_table(spark, sf):
    name = f"{scratch_database(spark, 'appended')}.events"
    events = table(spark, sf, "events")
    M.rebuild(events.select("event_id", "value"), name)
    M.append(events.select("value", "event_id"), name)
    return spark.table(name)


def _keyed_lines(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(
        fn.natural_key(["l_orderkey", "l_linenumber"]).alias("unique_row_id"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_shipdate",
    )


@query(
    "M4 J6 X8",
    """WITH l AS (
  SELECT md5(CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR)) AS unique_row_id,
         l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem),
target AS (SELECT * FROM l WHERE l_shipdate < TIMESTAMP '1998-01-01'),
source AS (SELECT * FROM l WHERE l_shipdate >= TIMESTAMP '1997-01-01')
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate) FROM (
  SELECT * FROM target UNION ALL
  SELECT * FROM source WHERE unique_row_id NOT IN (SELECT unique_row_id FROM target))""",
)
def insert_only_merge(spark, sf):
    """Merged twice: the second run finds every key and adds nothing."""
    name = f"{scratch_database(spark, 'merged')}.lineitem"
    rows = _keyed_lines(spark, sf)
    M.rebuild(rows.where("l_shipdate < timestamp_ntz'1998-01-01 00:00:00'"), name)
    source = rows.where("l_shipdate >= timestamp_ntz'1997-01-01 00:00:00'")
    M.insert_only_merge(source, name, ["unique_row_id"])
    if M.insert_only_merge(source, name, ["unique_row_id"]):
        raise AssertionError("a repeated merge inserted rows")
    return spark.table(name)


def _changed(orders):
    """Later orders at a new price; some of them move to the next year."""
    moved = F.col("o_custkey") > 500
    later = F.when(moved, F.expr("o_orderdate + interval 365 days")).otherwise(F.col("o_orderdate"))
    return (
        orders.where("o_orderdate >= timestamp_ntz'1997-06-01 00:00:00'")
        .withColumns({"o_totalprice": F.col("o_totalprice") + 100, "o_orderdate": later})
        .withColumn("y", F.year("o_orderdate"))
    )


UPSERT_SQL = f"""WITH {ORDERS_SQL},
target AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
moved AS (
  SELECT * REPLACE (o_totalprice + 100 AS o_totalprice,
    CASE WHEN o_custkey > 500 THEN o_orderdate + INTERVAL 365 DAYS ELSE o_orderdate END AS o_orderdate)
  FROM o WHERE o_orderdate >= TIMESTAMP '1997-06-01'),
source AS (SELECT * REPLACE (CAST(year(o_orderdate) AS INTEGER) AS y) FROM moved)
SELECT * EXCLUDE (o_orderstatus) REPLACE ({STAMP}) FROM (
  SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
  UNION ALL SELECT * FROM source)"""


@query("M5", UPSERT_SQL)
def upsert_merge(spark, sf):
    name = f"{scratch_database(spark, 'upsert')}.orders"
    orders = _orders(spark, sf)
    M.rebuild(orders.where("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'"), name, "y")
    for _ in range(2):
        M.upsert(_changed(orders), name, ["o_orderkey"])
    return spark.table(name)


@query("M5", UPSERT_SQL)
def upsert_merge_unpartitioned(spark, sf):
    name = f"{scratch_database(spark, 'upsert_flat')}.orders"
    orders = _orders(spark, sf)
    M.rebuild(orders.where("o_orderdate < timestamp_ntz'1999-01-01 00:00:00'"), name)
    M.upsert(_changed(orders), name, ["o_orderkey"])
    return spark.table(name)


WINDOW = ("2024-01-05 06:30:00", "2024-01-20 18:00:00")


@query(
    "M6",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS pickup_date
FROM (
  SELECT event_id, ts, value FROM events
  WHERE ts < TIMESTAMP '{WINDOW[0]}' OR ts >= TIMESTAMP '{WINDOW[1]}'
  UNION ALL
  SELECT event_id, ts, value + 1 FROM events
  WHERE ts >= TIMESTAMP '{WINDOW[0]}' AND ts < TIMESTAMP '{WINDOW[1]}'
    AND event_type <> 'error' AND CAST(ts AS DATE) <> DATE '2024-01-12')""",
)
def interval_replaced(spark, sf):
    """A window with uneven edges, run twice; one day inside it ends up without rows."""
    name = f"{scratch_database(spark, 'interval')}.events"
    events = table(spark, sf, "events").select("event_id", "ts", "value", "event_type")
    write_by_date(events.drop("event_type"), name, "ts")
    fresh = events.where("event_type <> 'error' and to_date(ts) <> date'2024-01-12'").withColumn(
        "value", F.col("value") + 1
    )
    for _ in range(2):
        M.replace_interval(fresh.drop("event_type"), name, "ts", *WINDOW)
    return spark.table(name)


@query(
    "M7 A11 F8",
    f"""WITH {ORDERS_SQL},
loaded AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus <> 'P')
SELECT * EXCLUDE (o_orderstatus) REPLACE ({STAMP}) FROM (
  SELECT * FROM loaded
  UNION ALL
  SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM o
  WHERE o_orderdate > (SELECT max(o_orderdate) FROM loaded))""",
)
def watermark_increment(spark, sf):
    """The rows left out of the first load are late in the second one and stay out."""
    name = f"{scratch_database(spark, 'increment')}.orders"
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderdate",
        F.year("o_orderdate").alias("y"),
        "o_orderstatus",
    )
    first = orders.where(
        "o_orderdate < timestamp_ntz'1998-01-01 00:00:00' and o_orderstatus <> 'P'"
    ).drop("o_orderstatus")
    M.rebuild(first, name, "y")
    again = orders.drop("o_orderstatus").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    M.upsert(M.newer_rows(again, name, "o_orderdate"), name, ["o_orderkey"])
    return spark.table(name)


@query(
    "M8",
    """WITH source AS (SELECT event_id + 1000000 AS event_id, user_id, value FROM events
                WHERE event_type = 'signup' AND value > 20)
SELECT event_id, user_id, value FROM events WHERE user_id NOT IN (SELECT user_id FROM source)
UNION ALL SELECT event_id, user_id, value FROM source""",
)
def delete_insert(spark, sf):
    name = f"{scratch_database(spark, 'delete_insert')}.events"
    events = table(spark, sf, "events")
    write_by_date(events.select("event_id", "user_id", "value", "ts"), name, "ts")
    source = events.where("event_type = 'signup' and value > 20").select(
        (F.col("event_id") + 1000000).alias("event_id"),
        "user_id",
        "value",
        "ts",
        F.to_date("ts").alias("pickup_date"),
    )
    M.delete_insert(source, name, ["user_id"])
    return spark.table(name).select("event_id", "user_id", "value")


@query(
    "M10",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END AS ordered
FROM orders""",
)
def drifted_table(spark, sf):
    name = f"{scratch_database(spark, 'drift')}.orders"
    orders = table(spark, sf, "orders")
    M.rebuild(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice"), name)
    later = orders.where("o_orderstatus <> 'F'").selectExpr(
        "o_orderpriority as priority", "o_orderdate as ordered", "o_totalprice", "o_orderkey"
    )
    M.append_with_drift(later, name)
    return spark.table(name)


@query(
    "M11",
    "SELECT c_custkey AS vendor_id, c_name AS vendor_name FROM customer",
)
def contracted_output(spark, sf):
    
    contract = struct("vendor_id bigint, vendor_name string")
    rows = table(spark, sf, "customer").selectExpr("c_name as vendor_name", "c_custkey as vendor_id")
    return M.enforce_contract(rows, contract)


def _landed_orders(spark, sf):
    """All orders landed as files by month, loaded in three runs: years up to 1994, then all of them, then 1996 with files that have changed."""
    base = scratch_path(spark, "landed_months")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    months = orders.withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    early = F.when(F.year("o_orderdate") == 1996, F.col("o_totalprice") < 150_000).otherwise(True)
    months.where(early).hint("rebalance", "ym").write.partitionBy("ym").parquet(base)
    database = scratch_database(spark, "backfill")
    name, ledger = f"{database}.orders", f"{database}.ledger"
    write_by_date(orders.limit(0), name, "o_orderdate", "order_month", "month")
    days = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()

    def run(end):
        read = lambda paths: spark.read.schema(orders.schema).parquet(*paths)
        return backfill_months(
            spark, "orders", base + "/ym={year}-{month}", days.lo.date(), end, read, name, "o_orderdate", ledger, 48
        )

    first, rest = run(date(1994, 12, 31)), run(days.hi.date())
    if set(first) & set(rest) or run(days.hi.date()):
        raise AssertionError("a month was loaded again without need")
    late = months.where("year(o_orderdate) = 1996 and o_totalprice >= 150000")
    late.hint("rebalance", "ym").write.mode("append").partitionBy("ym").parquet(base)
    if any(year != 1996 for year, _ in run(days.hi.date())):
        raise AssertionError("a month was loaded again without need")
    return name, ledger


@query(
    "M12 S11 M6",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate FROM orders""",
)
def period_backfill(spark, sf):
    name, _ = _landed_orders(spark, sf)
    return spark.table(name).drop("order_month")


@query(
    "M12 N6",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, 'loaded' AS state,
       count(*) AS rows,
       CAST(CASE WHEN min(year(o_orderdate)) = 1996 AND bool_or(o_totalprice < 150000) AND bool_or(o_totalprice >= 150000)
            THEN 2 ELSE 1 END AS BIGINT) AS loads
FROM orders GROUP BY 1, 2""",
)
def backfill_ledger(spark, sf):
    """The ledger after the same runs: months whose files have changed are loaded twice, all others once."""
    _, ledger = _landed_orders(spark, sf)
    return ledger_state(spark, ledger).select("year", "month", "state", "rows", "loads")


@query(
    "R6 M5 M7 M11",
    f"""WITH {A.FACT_SQL} SELECT trip_id, pickup_zone, dropoff_zone, trip_duration_minutes,
       CAST(total_amount AS DOUBLE) AS total_amount FROM fact""",
)
def fact_incremental(spark, sf):
    """The fact loaded in two steps: trips up to a day, then those past the newest one loaded."""
    name = f"{scratch_database(spark, 'fact')}.trips"
    rows = fact(spark, sf)
    trips.load_fact(rows.where("pickup_datetime < timestamp'1998-01-01 00:00:00'"), name)
    trips.load_fact(rows, name)
    return spark.table(name).select(
        "trip_id", "pickup_zone", "dropoff_zone", "trip_duration_minutes", "total_amount"
    )


@query(
    "R4 M6",
    f"""WITH {A.STAGED_SQL}
SELECT * REPLACE (strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS pickup_datetime,
                  strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S.%f') AS dropoff_datetime)
FROM staged""",
)
def staged_load(spark, sf):
    """The whole staging table, loaded year by year; the windows in the middle come again with other edges."""
    name = f"{scratch_database(spark, 'staging')}.trips"
    raw = A.extracted_trips(spark, sf)
    empty = trips.stage(raw, A.payment_lookup(spark), "1996-01-01", "1996-01-01")
    write_by_date(empty, name, "pickup_datetime", "pickup_month", "month")
    first, last = int(A.STAGE_START[:4]), int(A.STAGE_END[:4])
    edges = [A.STAGE_START, *[f"{year}-01-01" for year in range(first + 1, last)], A.STAGE_END]
    for start, end in [*zip(edges, edges[1:]), (f"{first}-03-05 12:00:00", f"{last - 1}-02-10")]:
        trips.load_stage(raw, A.payment_lookup(spark), name, start, end)
    return spark.table(name).drop("pickup_month")


@query(
    "R3 M6",
    f"""WITH {A.STAGED_SQL}
SELECT CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS pickup_date, taxi_type, payment_type_name,
       count(*) AS trip_count,
       CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_fare_amount,
       CAST(sum(CAST(tip_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_tip_amount,
       CAST(sum(CAST(trip_distance AS DECIMAL(18,2))) AS DOUBLE) / count(trip_distance)
         AS avg_trip_distance,
       CAST(sum(trip_duration_minutes) AS DOUBLE) / count(trip_duration_minutes)
         AS avg_trip_duration_minutes
FROM staged
WHERE pickup_datetime >= TIMESTAMP '1997-01-01' AND pickup_datetime < TIMESTAMP '1998-01-01'
   OR pickup_datetime >= TIMESTAMP '1994-01-01' AND pickup_datetime < TIMESTAMP '1997-01-01'
  AND taxi_type = 'yellow'
GROUP BY 1, 2, 3""",
)
def daily_report_load(spark, sf):
    """The daily report as a table: years of one taxi type, then one year of all types over their end, twice."""
    name = f"{scratch_database(spark, 'daily')}.report"
    rows = staged(spark, sf)
    yellow = rows.where("taxi_type = 'yellow'")
    reports.load_daily_report(yellow, name, date(1994, 1, 1), date(1997, 7, 1))
    for _ in range(2):
        reports.load_daily_report(rows, name, date(1997, 1, 1), date(1998, 1, 1))
    return spark.table(name).drop("pickup_month")


@query(
    "ST1 M4",
    "SELECT o_orderkey, o_totalprice FROM orders",
)
def stream_file_load(spark, sf):
    """Files picked up in two runs; the second brings one status again, and nothing doubles."""
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    name = f"{scratch_database(spark, 'streamed')}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    M.rebuild(orders.limit(0), name)
    for statuses in (["F", "O"], ["O", "P"]):
        landed = orders.where(F.col("o_orderstatus").isin(statuses))
        landed.write.mode("append").parquet(folder)
        load_new_files(
            spark, folder, orders.schema, name, ["o_orderkey"], checkpoint, files_per_batch=2
        )
    return spark.table(name).select("o_orderkey", "o_totalprice")


@query(
    "ST1 M4",
    "SELECT o_orderstatus, count(*) AS n_rows, count(*) AS n_merged FROM orders GROUP BY o_orderstatus",
)
def stream_repeated_files(spark, sf):
    """Files that are all sent twice, in two runs of a stream with a memory: their rows reach the merge once."""
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    base = scratch_database(spark, "repeated")
    name, merged = f"{base}.orders", f"{base}.merged"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    M.rebuild(orders.limit(0), name)
    M.rebuild(orders.limit(0), merged)

    def note(batch):
        batch.write.insertInto(merged)
        return batch

    for _ in range(2):
        orders.write.mode("append").parquet(folder)
        load_new_files(
            spark, folder, orders.schema, name, ["o_orderkey"], checkpoint, prepare=note, remember="7 days"
        )
    spark.catalog.refreshTable(merged)
    rows = spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))
    noted = spark.table(merged).groupBy("o_orderstatus").agg(F.count("*").alias("n_merged"))
    return rows.join(noted, "o_orderstatus")


def _raw_load_sql(row_id: str, status: str = "F", prefix: str = "tpep") -> str:
    return f"""WITH {A.RAW_SQL}
SELECT {row_id} AS unique_row_id, CAST(vendor_id AS VARCHAR) AS "VendorID",
       strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS {prefix}_pickup_datetime,
       CAST(pickup_location_id AS VARCHAR) AS "PULocationID", fare_amount
FROM raw WHERE l_linestatus = '{status}'"""


KEY_TEXT = (
    "CAST(vendor_id AS VARCHAR) || CAST(pickup_datetime AS VARCHAR) "
    "|| CAST(dropoff_datetime AS VARCHAR) || CAST(pickup_location_id AS VARCHAR) "
    "|| CAST(dropoff_location_id AS VARCHAR)"
)


FULL_KEY = f"md5({KEY_TEXT} || CAST(fare_amount AS VARCHAR) || CAST(trip_distance AS VARCHAR))"
SHORT_KEY = f"md5({KEY_TEXT})"


def _load_raw(spark, sf, warehouse, service="yellow", grain="day"):
    folder = scratch_path(spark, "raw_csv")
    trip_schema, prefix = raw_load.SERVICES[service]
    rows = A.yellow(spark, sf) if service == "yellow" else A.green(spark, sf)
    rows = rows.select(*trip_schema.names)
    rows.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss").csv(folder)
    name = f"{scratch_database(spark, 'raw')}.{service}"
    for _ in range(2):
        raw_load.load_files(spark, folder, service, name, warehouse, grain)
    rows = spark.table(name).where("filename is not null")
    return rows.select(
        "unique_row_id", "VendorID", f"{prefix}_pickup_datetime", "PULocationID", "fare_amount"
    )


@query("M4 X8 P5 S21 S25 S2", _raw_load_sql(FULL_KEY))
def raw_file_load(spark, sf):
    """Raw CSV files of the yellow service staged, keyed and merged, twice."""
    return _load_raw(spark, sf, warehouse=False)


@query("M4 X8 P5 S21 S25 S2", _raw_load_sql(FULL_KEY, "O", "lpep"))
def raw_file_load_green(spark, sf):
    """As above for the green service."""
    return _load_raw(spark, sf, warehouse=False, service="green")


@query("M4 X9 S21 S22", _raw_load_sql(SHORT_KEY))
def raw_file_load_warehouse(spark, sf):
    """As above into the form with a binary key, in partitions by month."""
    return _load_raw(spark, sf, warehouse=True, grain="month")


@query("M4 X9 S21 S22", _raw_load_sql(SHORT_KEY, "O", "lpep"))
def raw_file_load_warehouse_green(spark, sf):
    """The partitioned form of the green service."""
    return _load_raw(spark, sf, warehouse=True, service="green", grain="month")
