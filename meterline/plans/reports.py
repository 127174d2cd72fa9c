"""Named reports over trips, documents and simple tables. Each takes and returns frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions import (
    base_id,
    base_id_arrow,
    date_of,
    elapsed_hours,
    label_or_self,
    month_of,
    or_default,
    year_int,
)
from meterline.operators.aggregate import exact_avg, exact_sum, extreme_rows, rollout
from meterline.operators.columns import COMMON_NAMES, pick, rename, shared_columns, tag
from meterline.operators.dedup import union_aligned
from meterline.operators.filters import in_month, in_window, no_nulls, on_day
from meterline.operators.joins import lookup, two_roles
from meterline.operators.layout import write_by_date
from meterline.operators.materialize import replace_interval

REVENUE_PARTS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
}
MONTHLY_AVERAGES = {
    "avg_monthly_passenger_count": "passenger_count",
    "avg_monthly_trip_distance": "trip_distance",
}


def align_services(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Two raw sources under one vocabulary: shared columns, service tag, union."""
    g, y = rename(green, COMMON_NAMES), rename(yellow, COMMON_NAMES)
    names = shared_columns(g, y)
    return union_aligned(
        tag(g.select(*names), "service_type", "green"),
        tag(y.select(*names), "service_type", "yellow"),
    )


def monthly_revenue(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Revenue parts and averages by zone id, month and service."""
    return rollout(
        align_services(green, yellow),
        keys={
            "revenue_zone": F.col("PULocationID"),
            "revenue_month": month_of(F.col("pickup_datetime")),
            "service_type": F.col("service_type"),
        },
        sums={**REVENUE_PARTS, "revenue_monthly_congestion_surcharge": "congestion_surcharge"},
        averages=MONTHLY_AVERAGES,
    )


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue parts, trips and averages by zone name, month and service.

    Grouping is on the stored zone name and the default is put in afterwards, so trips without a
    zone stay apart from a zone that happens to be called "Unknown Zone".
    """
    grouped = rollout(
        fact,
        keys={
            "pickup_zone": F.col("pickup_zone"),
            "revenue_month": month_of(F.col("pickup_datetime")),
            "service_type": F.col("service_type"),
        },
        sums={**REVENUE_PARTS, "revenue_monthly_ehail_fee": "ehail_fee"},
        counts={"total_monthly_trips": "trip_id"},
        averages=MONTHLY_AVERAGES,
    )
    return grouped.withColumn("pickup_zone", or_default(F.col("pickup_zone"), "Unknown Zone"))


def daily_report(staged: DataFrame, start, end) -> DataFrame:
    """Trips, takings and averages by day, taxi type and payment name, for a window."""
    return (
        staged.where(in_window("pickup_datetime", start, end))
        .groupBy(
            date_of(F.col("pickup_datetime")).alias("pickup_date"),
            "taxi_type",
            "payment_type_name",
        )
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact_sum(F.col("fare_amount")).alias("total_fare_amount"),
            exact_sum(F.col("tip_amount")).alias("total_tip_amount"),
            exact_avg(F.col("trip_distance")).alias("avg_trip_distance"),
            exact_avg(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
        )
    )


def load_daily_report(staged: DataFrame, table: str, start: date, end: date) -> None:
    """Replace the days from `start` up to but without `end` of the report's table; safe to repeat.

    The window is of whole days, as a day's row holds the whole day. Other days keep their rows. A day has few
    rows, so the table is partitioned by month.
    """
    rows = daily_report(staged, start, end)
    if not staged.sparkSession.catalog.tableExists(table):
        write_by_date(rows, table, "pickup_date", "pickup_month", "month")
    else:
        replace_interval(rows, table, "pickup_date", start, end)


def short_trips(trips: DataFrame, year: int, month: int, limit: float = 1.0) -> DataFrame:
    return trips.where(
        in_month("pickup_datetime", year, month) & (F.col("trip_distance") <= limit)
    )


def longest_by_day(trips: DataFrame, sane: float = 100.0) -> DataFrame:
    """Largest sane distance of each pickup day, longest first."""
    return (
        trips.where(F.col("trip_distance") < sane)
        .groupBy(date_of(F.col("pickup_datetime")).alias("day"))
        .agg(F.max("trip_distance").alias("max_trip_distance"))
        .orderBy(F.desc("max_trip_distance"), "day")
    )


def takings_by_zone(trips: DataFrame, zones: DataFrame, day: str) -> DataFrame:
    """Total takings of one day by pickup zone, highest first.

    Takings are added up by location first, so the join sees one row per location.
    """
    by_location = (
        trips.where(on_day("pickup_datetime", day))
        .groupBy("pickup_location_id")
        .agg(exact_sum(F.col("total_amount")).alias("part"))
    )
    named = lookup(
        by_location, zones, "pickup_location_id", "location_id", {"pickup_zone": "zone"}, "inner"
    )
    return (
        named.groupBy("pickup_zone")
        .agg(exact_sum(F.col("part")).alias("takings"))
        .orderBy(F.desc("takings"), "pickup_zone")
    )


def largest_tips(trips: DataFrame, zones: DataFrame, zone: str, start, end) -> DataFrame:
    """Largest tip by drop-off zone for trips picked up in one zone, highest first."""
    placed = two_roles(
        trips.where(in_window("pickup_datetime", start, end)),
        zones,
        "location_id",
        {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
        ["zone"],
        "inner",
    )
    return (
        placed.where(F.col("pickup_zone") == zone)
        .groupBy("dropoff_zone")
        .agg(F.max("tip_amount").alias("max_tip"))
        .orderBy(F.desc("max_tip"), "dropoff_zone")
    )


def zone_extremes(
    trips: DataFrame, zones: DataFrame, k: int = 5, descending: bool = False
) -> DataFrame:
    """The k zones with the fewest (or most) pickups."""
    counts = trips.groupBy("pickup_location_id").agg(F.count(F.lit(1)).alias("trip_count"))
    named = lookup(counts, zones, "pickup_location_id", "location_id", {"zone": "zone"}, "inner")
    return extreme_rows(
        named.select("zone", "trip_count"), "trip_count", k, descending=descending, ties=["zone"]
    )


def trips_on_day(trips: DataFrame, day: str, column: str = "pickup_datetime") -> DataFrame:
    return trips.where(on_day(column, day)).agg(F.count(F.lit(1)).alias("trips"))


def longest_hours(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.max(elapsed_hours(F.col("pickup_datetime"), F.col("dropoff_datetime"))).alias(
            "longest_hours"
        )
    )


def price_by_brand(products: DataFrame) -> DataFrame:
    """Average price by brand to two digits, highest first."""
    kept = pick(products, ["brand", "price"])
    return (
        kept.groupBy("brand")
        .agg(F.round(exact_avg(F.col("price")), 2).alias("avg_price"))
        .orderBy(F.desc("avg_price"), "brand")
    )


def top_values(child: DataFrame, k: int = 15) -> DataFrame:
    """The most frequent values of a child table."""
    counts = child.groupBy("value").agg(F.count("value").alias("book_count"))
    return extreme_rows(counts, "book_count", k, ties=["value"])


def top_values_by_parent(child: DataFrame, k: int = 10) -> DataFrame:
    """The values that occur under the most distinct parents."""
    counts = child.groupBy("value").agg(F.countDistinct("_parent_id").alias("book_count"))
    return extreme_rows(counts, "book_count", k, ties=["value"])


def items_per_year(items: DataFrame, first: int | None = None, last: int | None = None):
    """Items by year in a closed range, or all with a known year."""
    year = "first_publish_year"
    rows = items.where(no_nulls(year))
    if first is not None:
        rows = rows.where(F.col(year).between(first, last))
    return (
        rows.groupBy(year_int(F.col(year)).alias("year"))
        .agg(F.count(year).alias("items"))
        .orderBy("year")
    )


def language_shares(
    child: DataFrame, k: int = 10, labels: dict[str, str] = schemas.LANGUAGES
) -> DataFrame:
    """The most frequent language codes with their names; unnamed codes stay as they are."""
    counts = child.groupBy("value").agg(F.count("value").alias("count"))
    top = extreme_rows(counts, "count", k, ties=["value"])
    return top.withColumn("language", label_or_self(F.col("value"), labels))


def summary(items: DataFrame, authors: DataFrame, languages: DataFrame) -> DataFrame:
    """Items, distinct authors and distinct languages in one row.

    Each count is its own aggregate; the three one-row results are turned into columns.
    """
    parts = [
        items.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total_books").alias("what"), "n"),
        authors.agg(F.countDistinct("value").alias("n")).select(
            F.lit("unique_authors").alias("what"), "n"
        ),
        languages.agg(F.countDistinct("value").alias("n")).select(
            F.lit("languages").alias("what"), "n"
        ),
    ]
    return (
        parts[0]
        .unionAll(parts[1])
        .unionAll(parts[2])
        .groupBy()
        .pivot("what", ["total_books", "unique_authors", "languages"])
        .agg(F.first("n"))
    )


def name_counts(players: DataFrame, name: str = "name") -> DataFrame:
    return players.groupBy(F.col(name).alias("name")).agg(
        F.count(F.lit(1)).alias("player_count")
    )


def base_ids(trips: DataFrame, arrow: bool = False) -> DataFrame:
    """Short base ids with the dates of the trip, natively or through the Arrow function."""
    base = F.col("dispatching_base_num")
    return trips.select(
        (base_id_arrow(base) if arrow else base_id(base)).alias("base_id"),
        date_of(F.col("pickup_datetime")).alias("pickup_date"),
        date_of(F.col("dropoff_datetime")).alias("dropoff_date"),
        "PULocationID",
        "DOLocationID",
    )
