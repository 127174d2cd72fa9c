"""From raw trip files to the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions import (
    code_name,
    decimal_of,
    elapsed_minutes,
    minutes_crossed,
    safe_int,
    surrogate_key,
)
from meterline.operators.columns import SNAKE_NAMES, cast_columns, fill_columns, rename, tag
from meterline.operators.dedup import first_per_key, latest_per_key, union_aligned
from meterline.operators.filters import in_window, no_nulls, none_negative, partition_date
from meterline.operators.joins import lookup, lookup_or_default, two_roles
from meterline.operators.key_index import build_key_index
from meterline.operators.layout import write_by_date
from meterline.operators.materialize import (
    enforce_contract,
    newer_rows,
    replace_interval,
    upsert,
)

IDS = ["vendor_id", "pickup_location_id", "dropoff_location_id", "passenger_count"]
CODES = ["rate_code_id", "payment_type", "trip_type"]
MONEY = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "ehail_fee",
    "improvement_surcharge",
    "total_amount",
]
STAMPS = ["pickup_datetime", "dropoff_datetime"]

# Column order of the unified trip.
UNIFIED = [
    "vendor_id",
    "rate_code_id",
    "pickup_location_id",
    "dropoff_location_id",
    *STAMPS,
    "store_and_fwd_flag",
    "passenger_count",
    "trip_distance",
    "trip_type",
    *MONEY,
    "payment_type",
    "service_type",
]


def standardise(raw: DataFrame, service: str, window: tuple | None = None) -> DataFrame:
    """One raw source in the common vocabulary and types, tagged with its service.

    Columns the source lacks are filled: street hail as trip type, no hail fee. Rows without a
    vendor are left out. `window` restricts the pickup time, for work on a sample.
    """
    named = rename(raw, SNAKE_NAMES)
    absent = {"trip_type": (1, "int"), "ehail_fee": (0, schemas.MONEY)}
    named = fill_columns(named, {n: v for n, v in absent.items() if n not in named.columns})
    if window:
        named = named.where(in_window("pickup_datetime", *window))
    kinds = dict(named.dtypes)
    whole = {n: F.rint(F.col(n)) for n in IDS if kinds[n] in ("double", "float")}
    typed = cast_columns(named.withColumns(whole) if whole else named, {n: "int" for n in IDS})
    typed = typed.withColumns({n: safe_int(F.col(n), kinds[n] == "string") for n in CODES})
    typed = typed.withColumns({n: decimal_of(F.col(n)) for n in [*MONEY, "trip_distance"]})
    typed = cast_columns(typed, {n: "timestamp" for n in STAMPS} | {"store_and_fwd_flag": "string"})
    return tag(typed.where(no_nulls("vendor_id")), "service_type", service).select(*UNIFIED)


def unite(green: DataFrame, yellow: DataFrame, window: tuple | None = None) -> DataFrame:
    return union_aligned(
        standardise(green, "Green", window), standardise(yellow, "Yellow", window)
    )


TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]


def enrich(trips: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Trip id, payment label, and the first row of each key.

    Rows are deduplicated before the lookup so that the sort carries no label text.
    """
    single = first_per_key(trips, TRIP_KEY, "dropoff_datetime")
    named = lookup_or_default(
        single,
        payment_types,
        "payment_type",
        "payment_type",
        "payment_type_description",
        "description",
        0,
        "Unknown",
    )
    return named.select(surrogate_key(TRIP_KEY).alias("trip_id"), *named.columns)


def zone_dimension(zones: DataFrame) -> DataFrame:
    return rename(zones, {"locationid": "location_id"})


def trip_fact(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Both zones and the duration; trips without a known zone are kept. Meets the contract."""
    placed = two_roles(
        trips,
        zones,
        "location_id",
        {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
        ["borough", "zone"],
    )
    timed = placed.withColumn(
        "trip_duration_minutes",
        minutes_crossed(F.col("pickup_datetime"), F.col("dropoff_datetime")),
    )
    return enforce_contract(timed.select(*schemas.FACT.names), schemas.FACT)


FACT_PARTITION = "pickup_month"


def load_fact(fact: DataFrame, table: str) -> None:
    """Bring the fact into its table: first run all rows, later runs the rows past its newest.

    New rows replace those with the same trip id. An index of trip ids, kept by the loads, tells which months hold them, so a later run
    reads the index and those months. Columns the table lacks are added to it.
    """
    spark = fact.sparkSession
    if not spark.catalog.tableExists(table):
        write_by_date(fact, table, "pickup_datetime", FACT_PARTITION, "month")
        build_key_index(spark, table, ["trip_id"], FACT_PARTITION)
        return
    dated = fact.withColumn(FACT_PARTITION, partition_date("pickup_datetime", "month"))
    upsert(newer_rows(dated, table, "pickup_datetime"), table, ["trip_id"], widen=True)


def vendor_dimension(fact: DataFrame) -> DataFrame:
    """Vendors that occur, with their names; the few codes are made distinct before naming."""
    codes = fact.select("vendor_id").distinct()
    return codes.withColumn("vendor_name", code_name(F.col("vendor_id"), schemas.VENDORS))


STAGING_KEY = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
    "trip_distance",
    "fare_amount",
]
STAGED = [f.name for f in schemas.WINDOWED_TRIPS.fields if f.name != "extracted_at"]


def stage(raw: DataFrame, payment_lookup: DataFrame, start, end) -> DataFrame:
    """Valid trips of a window, the last extracted copy of each, with payment name and duration."""
    valid = raw.where(
        in_window("pickup_datetime", start, end)
        & no_nulls("vendor_id", "dropoff_datetime")
        & none_negative("trip_distance", "fare_amount", "total_amount")
    )
    single = latest_per_key(valid, STAGING_KEY, "extracted_at")
    named = lookup(
        single.select(*STAGED),
        payment_lookup,
        "payment_type",
        "payment_type_id",
        {"payment_type_name": "payment_type_name"},
    )
    return named.withColumn(
        "trip_duration_minutes",
        elapsed_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime")),
    )


def load_stage(raw: DataFrame, payment_lookup: DataFrame, table: str, start, end) -> None:
    """Replace one window of the staging table; safe to repeat."""
    replace_interval(stage(raw, payment_lookup, start, end), table, "pickup_datetime", start, end)
