"""Idempotent load of raw trip files: read, key by content, insert what the table lacks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions import natural_key, natural_key_bytes
from meterline.operators.filters import partition_date
from meterline.operators.layout import GRAIN, ORDERED, create_if_absent
from meterline.operators.materialize import insert_only_merge
from meterline.schemas import GREEN, YELLOW
from meterline.sources.files import existing_paths, month_paths, read_csv

SERVICES = {"yellow": (YELLOW, "tpep"), "green": (GREEN, "lpep")}
TEXT_IDS = ["VendorID", "RatecodeID", "PULocationID", "DOLocationID"]
ROW_ID, FILE_NAME = "unique_row_id", "filename"
PARTITIONS = {"day": "pickup_date", "month": "pickup_month"}

NOTES = {
    ROW_ID: "Hash of the values that identify the trip",
    FILE_NAME: "File the trip was read from",
    "VendorID": "Code of the provider of the record",
    "passenger_count": "Passengers as entered by the driver",
    "trip_distance": "Distance in miles",
    "PULocationID": "Zone in which the meter was started",
    "DOLocationID": "Zone in which the meter was stopped",
    "payment_type": "Code of the way the trip was paid",
    "fare_amount": "Fare by time and distance",
    "tip_amount": "Tip, without cash tips",
    "total_amount": "Total charged, without cash tips",
}


def key_columns(service: str, short: bool = False) -> list[str]:
    """The columns that identify a raw trip; the short form leaves fare and distance out."""
    prefix = SERVICES[service][1]
    names = [
        "VendorID",
        f"{prefix}_pickup_datetime",
        f"{prefix}_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
    ]
    return names if short else [*names, "fare_amount", "trip_distance"]


def raw_schema(service: str, warehouse: bool = False, grain: str = "day") -> T.StructType:
    """Raw table of a service: row id and file name ahead of the file's columns, ids as text.

    The warehouse form has a binary row id, decimal money and the day or month of the pickup to partition by.
    """
    source, _ = SERVICES[service]

    def kind(field: T.StructField) -> T.DataType:
        if field.name in TEXT_IDS:
            return T.StringType()
        if warehouse and isinstance(field.dataType, T.DoubleType):
            return T.DecimalType(38, 9)
        return field.dataType

    head = [
        T.StructField(ROW_ID, T.BinaryType() if warehouse else T.StringType()),
        T.StructField(FILE_NAME, T.StringType()),
    ]
    tail = [T.StructField(PARTITIONS[grain], T.DateType())] if warehouse else []
    return T.StructType([*head, *[T.StructField(f.name, kind(f)) for f in source.fields], *tail])


def create_raw_table(
    spark: SparkSession, table: str, service: str, warehouse: bool = False, grain: str = "day"
) -> None:
    """The raw table, if it is not there: the warehouse form in partitions by pickup time, the plain one in buckets of the row id."""
    if warehouse:
        kept = {GRAIN: grain, ORDERED: f"{SERVICES[service][1]}_pickup_datetime"}
        schema = raw_schema(service, True, grain)
        create_if_absent(spark, table, schema, NOTES, [PARTITIONS[grain]], properties=kept)
    else:
        create_if_absent(spark, table, raw_schema(service), NOTES, bucket_by=[ROW_ID])


def keyed_rows(
    spark: SparkSession, paths: str | list[str], service: str, warehouse: bool = False, grain: str = "day"
) -> DataFrame:
    """Rows of raw CSV files in the form of the raw table."""
    source, prefix = SERVICES[service]
    rows = read_csv(spark, paths, source).select("*", F.col("_metadata.file_name").alias(FILE_NAME))
    hashed = natural_key_bytes if warehouse else natural_key
    rows = rows.withColumn(ROW_ID, hashed(key_columns(service, short=warehouse)))
    rows = rows.withColumn(PARTITIONS[grain], partition_date(f"{prefix}_pickup_datetime", grain))
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in raw_schema(service, warehouse, grain)]
    )


def load_files(
    spark: SparkSession,
    paths: str | list[str],
    service: str,
    table: str,
    warehouse: bool = False,
    grain: str = "day",
) -> int:
    """Load CSV files into the raw table of a service; loading a file again adds nothing.

    The row id holds the pickup time, so it has one partition only, and a load reads those of its own rows.
    """
    create_raw_table(spark, table, service, warehouse, grain)
    rows = keyed_rows(spark, paths, service, warehouse, grain)
    return insert_only_merge(rows, table, [ROW_ID], fixed_partition=warehouse)


def backfill(
    spark: SparkSession,
    service: str,
    start: date,
    end: date,
    template: str,
    table: str,
    warehouse: bool = False,
    grain: str = "day",
) -> int:
    """All months from `start` to `end` in one load; months without a file are passed over."""
    found = existing_paths(spark, month_paths([service], start, end, template))
    return load_files(spark, found, service, table, warehouse, grain) if found else 0
