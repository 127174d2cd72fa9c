"""The check suites on their tables, into which failures have been put."""

from pyspark.sql import functions as F

from meterline.plans import reports, suites, trips
from meterline.queries import adapters as A
from meterline.queries.q_reports import fact, staged
from meterline.queries.registry import query, table


def _rows_sql(checks: dict[str, str], source: str) -> str:
    """One line per row check: its name and the number of rows of which the condition holds."""
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "check", count(*) FILTER ({failing}) AS failures FROM {source}"""
        for name, failing in checks.items()
    )


def _repeats_sql(name: str, source: str, *columns: str, where: str = "TRUE") -> str:
    keys = ", ".join(columns)
    return f"""SELECT '{name}' AS "check", count(*) AS failures
FROM (SELECT {keys} FROM {source} WHERE {where} GROUP BY {keys} HAVING count(*) > 1)"""


def _nulls(*columns: str) -> dict[str, str]:
    return {f"not_null({c})": f"{c} IS NULL" for c in columns}


STAGING_FAULTS = {
    "vendor_id": "nullif(vendor_id, 3)",
    "taxi_type": "nullif(taxi_type, 'green')",
    "passenger_count": "CASE WHEN passenger_count = 2 THEN -1 ELSE passenger_count END",
    "trip_duration_minutes": "trip_duration_minutes - 1",
}
STAGING_AMOUNTS = ("passenger_count", "trip_distance", "fare_amount", "total_amount", "trip_duration_minutes")
STAGING_CHECKS = _nulls("vendor_id", "pickup_datetime", "dropoff_datetime", "payment_type", "taxi_type") | {
    f"non_negative({c})": f"{c} < 0" for c in STAGING_AMOUNTS
}


def _replaced(faults: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in faults.items())


@query(
    "Q1 Q6 Q8 R4",
    f"""WITH {A.STAGED_SQL}, faulty AS (SELECT * REPLACE ({_replaced(STAGING_FAULTS)}) FROM staged)
{_rows_sql(STAGING_CHECKS, "faulty")}
UNION ALL SELECT 'valid_payment_types',
  CAST(count(*) FILTER (payment_type_name IS NULL) > 0 AS BIGINT) FROM faulty""",
)
def suite_staging(spark, sf):
    rows = staged(spark, sf)
    return suites.staging(rows.withColumns({n: F.expr(e) for n, e in STAGING_FAULTS.items()}))


FACT_FAULTS = {
    "service_type": "CASE WHEN vendor_id = 2 THEN 'Blue' WHEN vendor_id = 4 THEN NULL ELSE service_type END",
    "total_amount": "nullif(total_amount, 901.00)",
    "vendor_id": "nullif(vendor_id, 3)",
}
KNOWN = ("Green", "Yellow")


@query(
    "Q1 Q2 Q3 Q4 R6",
    f"""WITH {A.FACT_SQL}, given AS (
  SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE vendor_id = 1),
faulty AS (SELECT * REPLACE ({_replaced(FACT_FAULTS)}) FROM given)
{_repeats_sql("unique(trip_id)", "faulty", "trip_id", where="trip_id IS NOT NULL")}
UNION ALL {_rows_sql(
        _nulls("trip_id", "vendor_id", "service_type", "pickup_datetime", "total_amount")
        | {"accepted_values(service_type)": f"service_type NOT IN {KNOWN}"}
        | {
            f"relationship({end}_location_id)": f"{end}_location_id IS NOT NULL AND {end}_location_id NOT IN "
            "(SELECT n_nationkey FROM nation)"
            for end in ("pickup", "dropoff")
        },
        "faulty",
    )}""",
)
def suite_fact(spark, sf):
    rows = fact(spark, sf)
    copies = F.when(F.col("vendor_id") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("copy", F.explode(copies)).drop("copy")
    faulty = rows.select(*[F.expr(FACT_FAULTS.get(c, c)).alias(c) for c in rows.columns])
    return suites.fact(faulty, trips.zone_dimension(A.zones(spark, sf)))


@query(
    "Q1 Q2 R7 R8",
    f"""WITH {A.FACT_SQL}, vendors AS (
  SELECT vendor_id FROM (SELECT DISTINCT vendor_id FROM fact), range(2) AS r(i) WHERE i = 0 OR vendor_id = 1),
codes AS (SELECT nullif(vendor_id, 0) AS vendor_id FROM vendors)
{_repeats_sql("unique(location_id)", "zones", "location_id", where="location_id IS NOT NULL")}
UNION ALL {_rows_sql(_nulls("location_id"), "zones")}
UNION ALL {_repeats_sql("unique(vendor_id)", "codes", "vendor_id", where="vendor_id IS NOT NULL")}
UNION ALL {_rows_sql(_nulls("vendor_id"), "codes")}""",
)
def suite_dimensions(spark, sf):
    vendors = trips.vendor_dimension(fact(spark, sf))
    faulty = vendors.unionAll(vendors.where("vendor_id = 1")).withColumn("vendor_id", F.expr("nullif(vendor_id, 0)"))
    zones = suites.dimension(trips.zone_dimension(A.zones(spark, sf)), "location_id")
    return zones.unionAll(suites.dimension(faulty, "vendor_id"))


@query(
    "Q1 Q3 Q5 R2",
    f"""WITH {A.FACT_SQL}, mart AS (
  SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone, date_trunc('month', pickup_datetime) AS revenue_month,
         service_type, sum(total_amount) AS revenue_monthly_total_amount, count(trip_id) AS total_monthly_trips
  FROM fact GROUP BY fact.pickup_zone, 2, 3),
given AS (SELECT * FROM mart UNION ALL SELECT * FROM mart WHERE service_type = 'Green'),
faulty AS (SELECT * REPLACE (nullif(pickup_zone, 'Unknown Zone') AS pickup_zone,
                             nullif(total_monthly_trips, 2) AS total_monthly_trips) FROM given)
{_repeats_sql(
        "unique_combination(pickup_zone,revenue_month,service_type)",
        "faulty", "pickup_zone", "revenue_month", "service_type",
    )}
UNION ALL {_rows_sql(
        _nulls("pickup_zone", "revenue_month", "service_type", "revenue_monthly_total_amount", "total_monthly_trips")
        | {"accepted_values(service_type)": f"service_type NOT IN {KNOWN}"},
        "faulty",
    )}""",
)
def suite_monthly_mart(spark, sf):
    mart = reports.monthly_zone_revenue(fact(spark, sf))
    given = mart.unionAll(mart.where("service_type = 'Green'"))
    faulty = given.withColumns(
        {
            "pickup_zone": F.expr("nullif(pickup_zone, 'Unknown Zone')"),
            "total_monthly_trips": F.expr("nullif(total_monthly_trips, 2)"),
        }
    )
    return suites.monthly_mart(faulty)


@query(
    "Q1 Q2 Q7 Q8 R21",
    f"""WITH counts AS (SELECT event_type AS name, count(*) AS player_count FROM events GROUP BY 1),
faulty AS (SELECT nullif(name, 'signup') AS name, player_count FROM counts
           UNION ALL SELECT name, 0 - player_count FROM counts WHERE name <> 'signup')
{_rows_sql(_nulls("name", "player_count") | {"positive(player_count)": "player_count <= 0"}, "faulty")}
UNION ALL {_repeats_sql("unique(name)", "faulty", "name", where="name IS NOT NULL")}
UNION ALL SELECT 'row count is greater than zero', CAST(count(*) <= 1 AS BIGINT) FROM faulty""",
)
def suite_name_counts(spark, sf):
    counts = reports.name_counts(table(spark, sf, "events"), "event_type")
    again = counts.where("name <> 'signup'").selectExpr("name", "0 - player_count")
    return suites.name_counts(counts.selectExpr("nullif(name, 'signup') as name", "player_count").unionAll(again))
