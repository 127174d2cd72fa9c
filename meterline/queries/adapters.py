"""The given tables seen as trip tables, once for Spark and once as SQL text.

`lineitem` plays the trip files: line status O is the green service, F the yellow one. The nations
are the zones; location codes 25 to 29 have no zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import schemas
from meterline.queries.registry import table

PICKUP = "timestampadd(HOUR, l_orderkey % 4, l_shipdate)"
DROPOFF = f"timestampadd(SECOND, l_partkey * 7 % 7200 - 60, {PICKUP})"


def _raw(spark: SparkSession, sf: str, status: str, prefix: str, *extra: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .where(F.col("l_linestatus") == status)
        .selectExpr(
            "cast(l_suppkey % 5 as int) as VendorID",
            f"{PICKUP} as {prefix}_pickup_datetime",
            f"{DROPOFF} as {prefix}_dropoff_datetime",
            "l_returnflag as store_and_fwd_flag",
            "l_linenumber as RatecodeID",
            "cast(l_suppkey % 30 as int) as PULocationID",
            "cast(l_partkey % 27 as int) as DOLocationID",
            "cast(l_quantity as int) % 7 as passenger_count",
            "l_quantity as trip_distance",
            "l_extendedprice as fare_amount",
            "l_discount as extra",
            "l_tax as mta_tax",
            "l_discount as tip_amount",
            "l_tax as tolls_amount",
            "cast(0.3 as double) as improvement_surcharge",
            "l_extendedprice as total_amount",
            "cast(nullif((l_linenumber + l_suppkey) % 9, 0) as int) as payment_type",
            "cast(2.5 as double) as congestion_surcharge",
            *extra,
        )
    )


def green(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(
        spark, sf, "O", "lpep", "nullif(l_tax, 0) as ehail_fee", "l_linenumber % 2 + 1 as trip_type"
    )


def yellow(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf, "F", "tpep")


RAW_SQL = """
raw AS (
  SELECT l_linestatus,
         CAST(l_suppkey % 5 AS INTEGER) AS vendor_id,
         l_shipdate + to_hours(l_orderkey % 4) AS pickup_datetime,
         l_shipdate + to_hours(l_orderkey % 4) + to_seconds(l_partkey * 7 % 7200 - 60)
           AS dropoff_datetime,
         l_returnflag AS store_and_fwd_flag,
         l_linenumber AS rate_code_id,
         CAST(l_suppkey % 30 AS INTEGER) AS pickup_location_id,
         CAST(l_partkey % 27 AS INTEGER) AS dropoff_location_id,
         CAST(l_quantity AS INTEGER) % 7 AS passenger_count,
         l_quantity AS trip_distance,
         l_extendedprice AS fare_amount,
         l_discount AS extra,
         l_tax AS mta_tax,
         l_discount AS tip_amount,
         l_tax AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         l_extendedprice AS total_amount,
         CAST(nullif((l_linenumber + l_suppkey) % 9, 0) AS INTEGER) AS payment_type,
         CAST(2.5 AS DOUBLE) AS congestion_surcharge,
         nullif(l_tax, 0) AS ehail_fee,
         l_linenumber % 2 + 1 AS trip_type
  FROM lineitem
)"""


def money(name: str) -> str:
    return f"CAST({name} AS DECIMAL(18,3)) AS {name}"


UNIONED_SQL = f"""{RAW_SQL},
unioned AS (
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id,
         pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count,
         {money('trip_distance')},
         CASE WHEN l_linestatus = 'O' THEN trip_type ELSE 1 END AS trip_type,
         {money('fare_amount')}, {money('extra')}, {money('mta_tax')}, {money('tip_amount')},
         {money('tolls_amount')},
         CAST(CASE WHEN l_linestatus = 'O' THEN ehail_fee ELSE 0 END AS DECIMAL(18,3)) AS ehail_fee,
         {money('improvement_surcharge')}, {money('total_amount')},
         payment_type,
         CASE WHEN l_linestatus = 'O' THEN 'Green' ELSE 'Yellow' END AS service_type
  FROM raw WHERE vendor_id IS NOT NULL
)"""

PAYMENT_SQL = """
payment AS (
  SELECT * FROM (VALUES (0, 'Unknown'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
                        (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')) AS v(code, label)
)"""

ZONES_SQL = """
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         CASE WHEN n_regionkey = 1 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

ENRICHED_SQL = f"""{UNIONED_SQL},{PAYMENT_SQL},
trips AS (
  SELECT md5(concat_ws('-', CAST(u.vendor_id AS VARCHAR),
                       CAST(u.pickup_datetime AS VARCHAR),
                       CAST(u.pickup_location_id AS VARCHAR), u.service_type)) AS trip_id,
         u.* REPLACE (coalesce(u.payment_type, 0) AS payment_type),
         coalesce(p.label, 'Unknown') AS payment_type_description
  FROM unioned u LEFT JOIN payment p ON coalesce(u.payment_type, 0) = p.code
  QUALIFY row_number() OVER (
    PARTITION BY u.vendor_id, u.pickup_datetime, u.pickup_location_id, u.service_type
    ORDER BY u.dropoff_datetime NULLS LAST, u.rate_code_id NULLS LAST,
             u.dropoff_location_id NULLS LAST, u.store_and_fwd_flag NULLS LAST,
             u.passenger_count NULLS LAST, u.trip_distance NULLS LAST, u.trip_type NULLS LAST,
             u.fare_amount NULLS LAST, u.extra NULLS LAST, u.mta_tax NULLS LAST,
             u.tip_amount NULLS LAST, u.tolls_amount NULLS LAST, u.ehail_fee NULLS LAST,
             u.improvement_surcharge NULLS LAST, u.total_amount NULLS LAST,
             u.payment_type NULLS LAST) = 1
)"""

FACT_SQL = f"""{ENRICHED_SQL},{ZONES_SQL},
fact AS (
  SELECT t.trip_id, t.vendor_id, t.service_type, t.rate_code_id, t.pickup_location_id,
         pz.borough AS pickup_borough, pz.zone AS pickup_zone, t.dropoff_location_id,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
         t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag, t.passenger_count,
         t.trip_distance, t.trip_type,
         date_diff('minute', t.pickup_datetime, t.dropoff_datetime) AS trip_duration_minutes,
         t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount, t.ehail_fee,
         t.improvement_surcharge, t.total_amount, t.payment_type, t.payment_type_description
  FROM trips t
  LEFT JOIN zones pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON t.dropoff_location_id = dz.location_id
)"""

SECONDS = "%Y-%m-%d %H:%M:%S.%f"
STAMP_COLUMNS = (
    "REPLACE (strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS pickup_datetime, "
    "strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S.%f') AS dropoff_datetime, "
    "CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(fare_amount AS DOUBLE) AS fare_amount, "
    "CAST(extra AS DOUBLE) AS extra, CAST(mta_tax AS DOUBLE) AS mta_tax, "
    "CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount, "
    "CAST(ehail_fee AS DOUBLE) AS ehail_fee, "
    "CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge, "
    "CAST(total_amount AS DOUBLE) AS total_amount)"
)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as the zone file: locationid, borough, zone, service zone."""
    region = table(spark, sf, "region")
    return (
        table(spark, sf, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "n_nationkey as locationid",
            "r_name as borough",
            "n_name as zone",
            "case when n_regionkey = 1 then 'Yellow Zone' else 'Boro Zone' end as service_zone",
        )
    )


def payment_lookup(spark: SparkSession) -> DataFrame:
    return schemas.payment_types(spark).withColumnsRenamed(
        {"payment_type": "payment_type_id", "description": "payment_type_name"}
    )


def extracted_trips(spark: SparkSession, sf: str) -> DataFrame:
    """`lineitem` as extracted trips with coordinates, repeated extractions and bad rows."""
    return (
        table(spark, sf, "lineitem")
        .withColumn(
            "dropoff", F.expr("timestampadd(SECOND, l_partkey % 4 * 90 - 30, l_shipdate)")
        )
        .selectExpr(
            "cast(l_suppkey % 4 as int) as vendor_id",
            "l_shipdate as pickup_datetime",
            "dropoff as dropoff_datetime",
            "l_linenumber as passenger_count",
            "cast(floor(l_quantity / 10) - 1 as double) as trip_distance",
            "cast(l_suppkey % 2 as double) as pickup_longitude",
            "cast(l_partkey % 2 as double) as pickup_latitude",
            "l_linenumber as rate_code_id",
            "l_returnflag as store_and_fwd_flag",
            "cast(l_suppkey % 2 as double) as dropoff_longitude",
            "cast(0.5 as double) as dropoff_latitude",
            "cast((l_linenumber + l_suppkey) % 8 as int) as payment_type",
            "cast(l_linenumber * 10 - 15 as double) as fare_amount",
            "l_discount as extra",
            "l_tax as mta_tax",
            "l_discount as tip_amount",
            "l_tax as tolls_amount",
            "cast(0.3 as double) as improvement_surcharge",
            "l_extendedprice as total_amount",
            "cast(2.5 as double) as congestion_surcharge",
            "case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type",
            "timestampadd(SECOND, l_orderkey, timestamp_ntz'2024-01-01 00:00:00') as extracted_at",
        )
    )


STAGE_START, STAGE_END = "1996-01-01", "1999-01-01"

STAGED_SQL = f"""{PAYMENT_SQL},
extracted AS (
  SELECT CAST(l_suppkey % 4 AS INTEGER) AS vendor_id,
         l_shipdate AS pickup_datetime,
         l_shipdate + to_seconds(l_partkey % 4 * 90 - 30) AS dropoff_datetime,
         l_linenumber AS passenger_count,
         CAST(floor(l_quantity / 10) - 1 AS DOUBLE) AS trip_distance,
         CAST(l_suppkey % 2 AS DOUBLE) AS pickup_longitude,
         CAST(l_partkey % 2 AS DOUBLE) AS pickup_latitude,
         l_linenumber AS rate_code_id, l_returnflag AS store_and_fwd_flag,
         CAST(l_suppkey % 2 AS DOUBLE) AS dropoff_longitude,
         CAST(0.5 AS DOUBLE) AS dropoff_latitude,
         CAST((l_linenumber + l_suppkey) % 8 AS INTEGER) AS payment_type,
         CAST(l_linenumber * 10 - 15 AS DOUBLE) AS fare_amount,
         l_discount AS extra, l_tax AS mta_tax, l_discount AS tip_amount, l_tax AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge, l_extendedprice AS total_amount,
         CAST(2.5 AS DOUBLE) AS congestion_surcharge,
         CASE WHEN l_linestatus = 'F' THEN 'yellow' ELSE 'green' END AS taxi_type,
         TIMESTAMP '2024-01-01' + to_seconds(l_orderkey) AS extracted_at
  FROM lineitem
),
single AS (
  SELECT * FROM extracted
  WHERE pickup_datetime >= TIMESTAMP '{STAGE_START}' AND pickup_datetime < TIMESTAMP '{STAGE_END}'
    AND vendor_id IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0
  QUALIFY row_number() OVER (
    PARTITION BY vendor_id, pickup_datetime, dropoff_datetime, pickup_longitude, pickup_latitude,
                 dropoff_longitude, dropoff_latitude, passenger_count, trip_distance, fare_amount
    ORDER BY extracted_at DESC NULLS LAST, rate_code_id, store_and_fwd_flag, payment_type, extra,
             mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
             congestion_surcharge, taxi_type) = 1
),
staged AS (
  SELECT s.* EXCLUDE (extracted_at), p.label AS payment_type_name,
         CAST((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60 AS INTEGER)
           AS trip_duration_minutes
  FROM single s LEFT JOIN payment p ON s.payment_type = p.code
)"""
