"""Fixed input schemas, output contracts and small lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = "decimal(18,3)"

KINDS = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(18, 3),
}


def struct(columns: str) -> T.StructType:
    """A schema from "name kind, name kind". Unlike `fromDDL` it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind], True) for name, kind in pairs])


# Column names, order and types of the public trip files.
YELLOW = struct(
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double"
)
GREEN = struct(
    "VendorID int, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, "
    "store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int, "
    "passenger_count int, trip_distance double, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
    "improvement_surcharge double, total_amount double, payment_type int, trip_type int, "
    "congestion_surcharge double"
)
FOR_HIRE = struct(
    "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string"
)
WINDOWED_TRIPS = struct(
    "vendor_id int, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int, "
    "trip_distance float, pickup_longitude float, pickup_latitude float, rate_code_id int, "
    "store_and_fwd_flag string, dropoff_longitude float, dropoff_latitude float, "
    "payment_type int, fare_amount float, extra float, mta_tax float, tip_amount float, "
    "tolls_amount float, improvement_surcharge float, total_amount float, "
    "congestion_surcharge float, taxi_type string, extracted_at timestamp"
)
ZONES = struct("locationid int, borough string, zone string, service_zone string")

# Contract of the trip fact: 27 columns.
FACT = struct(
    "trip_id string, vendor_id int, service_type string, rate_code_id int, "
    "pickup_location_id int, pickup_borough string, pickup_zone string, "
    "dropoff_location_id int, dropoff_borough string, dropoff_zone string, "
    "pickup_datetime timestamp, dropoff_datetime timestamp, store_and_fwd_flag string, "
    "passenger_count int, trip_distance money, trip_type int, trip_duration_minutes bigint, "
    "fare_amount money, extra money, mta_tax money, tip_amount money, "
    "tolls_amount money, ehail_fee money, improvement_surcharge money, "
    "total_amount money, payment_type int, payment_type_description string"
)

# Payment codes. Codes 0 and 5 share one label.
PAYMENT_TYPES = {
    0: "Unknown",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Vendor codes.
VENDORS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}

# Language codes of book documents.
LANGUAGES = {
    "eng": "English",
    "ger": "German",
    "fre": "French",
    "spa": "Spanish",
    "ita": "Italian",
    "chi": "Chinese",
    "por": "Portuguese",
    "rus": "Russian",
    "kor": "Korean",
    "pol": "Polish",
}


def payment_types(spark: SparkSession) -> DataFrame:
    """The payment lookup as (payment_type, description).

    Written as literal rows, whose size Spark knows, so joins with it are broadcast.
    """
    rows = ", ".join(f"({code}, '{name}')" for code, name in PAYMENT_TYPES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(payment_type, description)")
