"""The named reports on the given tables."""

from pyspark.sql import functions as F

from meterline.operators.nested import child_values
from meterline.plans import reports, trips
from meterline.queries import adapters as A
from meterline.queries.registry import query, table

REVENUE_SQL = """
       CAST(sum(CAST(fare_amount AS DECIMAL(18,3))) AS DOUBLE) AS revenue_monthly_fare,
       CAST(sum(CAST(extra AS DECIMAL(18,3))) AS DOUBLE) AS revenue_monthly_extra,
       CAST(sum(CAST(mta_tax AS DECIMAL(18,3))) AS DOUBLE) AS revenue_monthly_mta_tax,
       CAST(sum(CAST(tip_amount AS DECIMAL(18,3))) AS DOUBLE) AS revenue_monthly_tip_amount,
       CAST(sum(CAST(tolls_amount AS DECIMAL(18,3))) AS DOUBLE) AS revenue_monthly_tolls_amount,
       CAST(sum(CAST(improvement_surcharge AS DECIMAL(18,3))) AS DOUBLE)
         AS revenue_monthly_improvement_surcharge,
       CAST(sum(CAST(total_amount AS DECIMAL(18,3))) AS DOUBLE) AS revenue_monthly_total_amount,
       CAST(sum(CAST(passenger_count AS DECIMAL(18,3))) AS DOUBLE) / count(passenger_count)
         AS avg_monthly_passenger_count,
       CAST(sum(CAST(trip_distance AS DECIMAL(18,3))) AS DOUBLE) / count(trip_distance)
         AS avg_monthly_trip_distance"""


def fact(spark, sf):
    united = trips.unite(A.green(spark, sf), A.yellow(spark, sf))
    enriched = trips.enrich(united, A.schemas.payment_types(spark))
    return trips.trip_fact(enriched, trips.zone_dimension(A.zones(spark, sf)))


def staged(spark, sf):
    return trips.stage(
        A.extracted_trips(spark, sf), A.payment_lookup(spark), A.STAGE_START, A.STAGE_END
    )


def simple_trips(spark, sf):
    """The yellow and green rows side by side under plain names."""
    return reports.align_services(A.green(spark, sf), A.yellow(spark, sf)).withColumnsRenamed(
        {"PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id"}
    )


@query(
    "R1 A9 X1 U1 P3 P4 P6 S7",
    f"""WITH {A.RAW_SQL}
SELECT pickup_location_id AS revenue_zone,
       strftime(date_trunc('month', pickup_datetime), '{A.SECONDS}') AS revenue_month,
       CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS service_type,{REVENUE_SQL},
       CAST(sum(CAST(congestion_surcharge AS DECIMAL(18,3))) AS DOUBLE)
         AS revenue_monthly_congestion_surcharge
FROM raw GROUP BY 1, 2, 3""",
)
def monthly_revenue(spark, sf):
    return reports.monthly_revenue(A.green(spark, sf), A.yellow(spark, sf))


@query(
    "R2 X12 X1 A2 A9",
    f"""WITH {A.FACT_SQL}
SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
       strftime(date_trunc('month', pickup_datetime), '{A.SECONDS}') AS revenue_month,
       service_type,{REVENUE_SQL},
       CAST(sum(ehail_fee) AS DOUBLE) AS revenue_monthly_ehail_fee,
       count(trip_id) AS total_monthly_trips
FROM fact GROUP BY fact.pickup_zone, 2, 3""",
)
def monthly_zone_mart(spark, sf):
    return reports.monthly_zone_revenue(fact(spark, sf))


@query(
    "R3 F3 X2 A1 A5 A8",
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
GROUP BY 1, 2, 3""",
)
def daily_report(spark, sf):
    return reports.daily_report(staged(spark, sf), "1997-01-01", "1998-01-01")


@query(
    "R4 W1 F3 F6 F7 J5 X4",
    f"""WITH {A.STAGED_SQL}
SELECT * REPLACE (strftime(pickup_datetime, '{A.SECONDS}') AS pickup_datetime,
                  strftime(dropoff_datetime, '{A.SECONDS}') AS dropoff_datetime)
FROM staged""",
)
def staged_trips(spark, sf):
    return staged(spark, sf)


@query(
    "U1 P3 P4 P7 P8 P9 F6",
    f"""WITH {A.UNIONED_SQL}, shown AS (
  SELECT * REPLACE (CAST(payment_type AS VARCHAR) AS payment_type) FROM unioned)
SELECT * {A.STAMP_COLUMNS} FROM shown""",
)
def unioned_trips(spark, sf):
    united = trips.unite(A.green(spark, sf), A.yellow(spark, sf))
    return united.withColumn("payment_type", F.col("payment_type").cast("string"))


@query(
    "R5 U1 P7 P8 P9 J4 X10 W2",
    f"""WITH {A.ENRICHED_SQL} SELECT * {A.STAMP_COLUMNS} FROM trips""",
)
def unified_trips(spark, sf):
    united = trips.unite(A.green(spark, sf), A.yellow(spark, sf))
    return trips.enrich(united, A.schemas.payment_types(spark))


@query("R6 J3 X3 M11", f"""WITH {A.FACT_SQL} SELECT * {A.STAMP_COLUMNS} FROM fact""")
def trip_fact(spark, sf):
    return fact(spark, sf)


@query(
    "R7 X11 U3",
    """SELECT DISTINCT CAST(l_suppkey % 5 AS INTEGER) AS vendor_id,
       CASE l_suppkey % 5 WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
                          WHEN 4 THEN 'Unknown/Other' END AS vendor_name
FROM lineitem""",
)
def vendor_dim(spark, sf):
    return trips.vendor_dimension(trips.unite(A.green(spark, sf), A.yellow(spark, sf)))


@query(
    "R8 P3",
    f"""WITH {A.ZONES_SQL} SELECT * FROM zones""",
)
def zone_dim(spark, sf):
    return trips.zone_dimension(A.zones(spark, sf))


@query(
    "R9 F2 F3 P2",
    f"""WITH {A.RAW_SQL}
SELECT pickup_location_id, trip_distance, fare_amount,
       strftime(pickup_datetime, '{A.SECONDS}') AS pickup_datetime
FROM raw
WHERE pickup_datetime >= TIMESTAMP '1996-11-01' AND pickup_datetime < TIMESTAMP '1996-12-01'
  AND trip_distance <= 1""",
)
def short_in_window(spark, sf):
    return reports.short_trips(simple_trips(spark, sf), 1996, 11).select(
        "pickup_location_id", "trip_distance", "fare_amount", "pickup_datetime"
    )


@query(
    "R10 F2 X2 A6 O1",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, max(value) AS max_trip_distance
FROM events WHERE value < 100 GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def max_per_day(spark, sf):
    events = table(spark, sf, "events").selectExpr("ts as pickup_datetime", "value as trip_distance")
    return reports.longest_by_day(events)


@query(
    "R11 J1 F5 A5 O1",
    """SELECT n_name AS pickup_zone,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS takings
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE CAST(o_orderdate AS DATE) = DATE '1996-01-02' GROUP BY 1""",
)
def takings_one_day(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    rides = orders.selectExpr(
        "o_orderdate as pickup_datetime",
        "c_nationkey as pickup_location_id",
        "o_totalprice as total_amount",
    )
    zones = trips.zone_dimension(A.zones(spark, sf))
    return reports.takings_by_zone(rides, zones, "1996-01-02")


@query(
    "R12 J2 F1 F3 A6 O1",
    f"""WITH {A.RAW_SQL},{A.ZONES_SQL}
SELECT dz.zone AS dropoff_zone, max(tip_amount) AS max_tip
FROM raw JOIN zones pz ON pickup_location_id = pz.location_id
         JOIN zones dz ON dropoff_location_id = dz.location_id
WHERE pz.zone = 'NATION_7'
  AND pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '1997-01-01'
GROUP BY 1""",
)
def two_role_inner_max(spark, sf):
    zones = trips.zone_dimension(A.zones(spark, sf))
    return reports.largest_tips(
        simple_trips(spark, sf), zones, "NATION_7", "1996-01-01", "1997-01-01"
    )


def _extremes_sql(order: str) -> str:
    return f"""WITH {A.RAW_SQL},{A.ZONES_SQL}
SELECT zone, count(*) AS trip_count
FROM raw JOIN zones ON pickup_location_id = location_id
GROUP BY zone ORDER BY trip_count {order}, zone LIMIT 5"""


@query("R13 A1 J1 O4", _extremes_sql("ASC"))
def zones_fewest_trips(spark, sf):
    zones = trips.zone_dimension(A.zones(spark, sf))
    return reports.zone_extremes(simple_trips(spark, sf), zones)


@query("R13 A1 J1 O3", _extremes_sql("DESC"))
def zones_most_trips(spark, sf):
    zones = trips.zone_dimension(A.zones(spark, sf))
    return reports.zone_extremes(simple_trips(spark, sf), zones, descending=True)


@query(
    "R14 F5 A4",
    "SELECT count(*) AS trips FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
)
def one_day_count(spark, sf):
    return reports.trips_on_day(table(spark, sf, "events"), "2024-01-15", "ts")


@query(
    "R15 X5 A7",
    f"""WITH {A.RAW_SQL}
SELECT max((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600) AS longest_hours FROM raw""",
)
def longest_hours(spark, sf):
    return reports.longest_hours(simple_trips(spark, sf))


@query(
    "R16 P10 A8 X13 O1",
    """SELECT p_brand AS brand,
       round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(p_retailprice), 2)
         AS avg_price
FROM part GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def price_by_brand(spark, sf):
    products = table(spark, sf, "part").selectExpr("p_brand as brand", "p_retailprice as price")
    return reports.price_by_brand(products)


def _part_words(spark, sf):
    parts = table(spark, sf, "part").selectExpr("p_partkey", "split(p_name, ' ') as words")
    return child_values(parts, "p_partkey", "words")


@query(
    "R17 N1 A2 O3",
    """SELECT value, count(value) AS book_count
FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def top_values(spark, sf):
    return reports.top_values(_part_words(spark, sf))


@query(
    "R17 N1 A3 O3",
    """SELECT value, count(DISTINCT p_partkey) AS book_count
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS value FROM part)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_values_by_parent(spark, sf):
    return reports.top_values_by_parent(_part_words(spark, sf))


def _order_years(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "case when o_orderstatus <> 'P' then year(o_orderdate) end as first_publish_year"
    )


@query(
    "R18 F4 F6 A2 O2 X16",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS items FROM orders
WHERE o_orderstatus <> 'P' AND year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1 ORDER BY 1""",
)
def items_per_year_range(spark, sf):
    return reports.items_per_year(_order_years(spark, sf), 1996, 2000)


@query(
    "R18 F6 A2 O2 X16",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS items FROM orders
WHERE o_orderstatus <> 'P' GROUP BY 1 ORDER BY 1""",
)
def items_per_year(spark, sf):
    return reports.items_per_year(_order_years(spark, sf))


# Names of the language codes in `documents`; one is left out on purpose.
DOCUMENT_LANGUAGES = {"en": "English", "de": "German", "fr": "French"}


@query(
    "R19 A2 O3 J8",
    """SELECT lang AS value, count(lang) AS count,
       CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French'
                 ELSE lang END AS language
FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def language_shares(spark, sf):
    languages = table(spark, sf, "documents").selectExpr("lang as value")
    return reports.language_shares(languages, labels=DOCUMENT_LANGUAGES)


@query(
    "R20 A4",
    """SELECT (SELECT count(*) FROM part) AS total_books,
       (SELECT count(DISTINCT w) FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part))
         AS unique_authors,
       (SELECT count(DISTINCT lang) FROM documents) AS languages""",
)
def summary_counts(spark, sf):
    return reports.summary(
        table(spark, sf, "part"),
        _part_words(spark, sf),
        table(spark, sf, "documents").selectExpr("lang as value"),
    )


@query("R21 A1", "SELECT event_type AS name, count(*) AS player_count FROM events GROUP BY 1")
def name_counts(spark, sf):
    return reports.name_counts(table(spark, sf, "events"), "event_type")


BASE_SQL = """SELECT CASE WHEN l_suppkey % 7 = 0 THEN 's/' WHEN l_suppkey % 3 = 0 THEN 'a/' ELSE 'e/' END
         || CASE WHEN l_suppkey < 4096 THEN lpad(lower(to_hex(l_suppkey)), 3, '0')
                 ELSE lower(to_hex(l_suppkey)) END AS base_id,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS pickup_date,
       CAST(CAST(l_shipdate + to_hours(l_orderkey % 48) AS DATE) AS VARCHAR) AS dropoff_date,
       l_linenumber AS "PULocationID", l_partkey AS "DOLocationID"
FROM lineitem"""


def _base_trips(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "concat('B', lpad(l_suppkey, greatest(5, length(l_suppkey)), '0')) as dispatching_base_num",
        "l_shipdate as pickup_datetime",
        "timestampadd(HOUR, l_orderkey % 48, l_shipdate) as dropoff_datetime",
        "l_linenumber as PULocationID",
        "l_partkey as DOLocationID",
    )


@query("R22 X15 X2 P1", BASE_SQL)
def base_ids(spark, sf):
    return reports.base_ids(_base_trips(spark, sf))


@query("R22 D1 X2 P1", BASE_SQL)
def base_ids_arrow(spark, sf):
    return reports.base_ids(_base_trips(spark, sf), arrow=True)
