"""The checks that each table has to pass after its load.

A suite gives one row per check with the number of failures; `quality.passed` turns failures into an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.quality import (
    accepted_values,
    non_negative,
    not_null,
    positive,
    query_returns,
    relationship,
    run_checks,
    unique,
    unique_combination,
)

#: The services a trip can belong to.
SERVICE_TYPES = ["Green", "Yellow"]


def staging(staged: DataFrame) -> DataFrame:
    """Required columns, amounts that are not negative, and a payment name for every trip."""
    required = ["vendor_id", "pickup_datetime", "dropoff_datetime", "payment_type", "taxi_type"]
    amounts = ["passenger_count", "trip_distance", "fare_amount", "total_amount", "trip_duration_minutes"]
    unnamed = staged.agg(F.count(F.when(F.col("payment_type_name").isNull(), 1)))
    return run_checks(
        staged, [*(not_null(c) for c in required), *(non_negative(c) for c in amounts)]
    ).unionAll(query_returns("valid_payment_types", unnamed, 0))


def fact(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per trip id, required columns, known services, and zones that exist at both ends."""
    required = ["trip_id", "vendor_id", "service_type", "pickup_datetime", "total_amount"]
    ends = ["pickup_location_id", "dropoff_location_id"]
    return run_checks(
        trips,
        [
            unique("trip_id"),
            *(not_null(c) for c in required),
            accepted_values("service_type", SERVICE_TYPES),
            *(relationship(c, zones, "location_id") for c in ends),
        ],
    )


def dimension(rows: DataFrame, key: str) -> DataFrame:
    """The key of a lookup is complete and unique."""
    return run_checks(rows, [unique(key), not_null(key)])


def monthly_mart(mart: DataFrame) -> DataFrame:
    """One row per zone, month and service; totals and trip counts are there."""
    key = ["pickup_zone", "revenue_month", "service_type"]
    required = [*key, "revenue_monthly_total_amount", "total_monthly_trips"]
    return run_checks(
        mart,
        [
            unique_combination(*key),
            *(not_null(c) for c in required),
            accepted_values("service_type", SERVICE_TYPES),
        ],
    )


def name_counts(counts: DataFrame) -> DataFrame:
    """Names are complete and unique, counts positive, and there is more than one row."""
    enough = counts.agg((F.count(F.lit(1)) > 1).cast("int"))
    checks = [not_null("name"), unique("name"), not_null("player_count"), positive("player_count")]
    return run_checks(counts, checks).unionAll(
        query_returns("row count is greater than zero", enough, 1)
    )
