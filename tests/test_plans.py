"""What the physical plans must look like, and the trip loads end to end."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterline.plans import reports, trips
from meterline.queries import REGISTRY
from meterline.schemas import FACT, GREEN, WINDOWED_TRIPS, YELLOW, ZONES, payment_types

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql and "M" not in q.covers[0]))
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(REGISTRY[name].run(spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["latest_rows", "first_rows", "unified_trips", "staged_trips"])
def test_groups_are_limited_ahead_of_the_shuffle(spark, name):
    text = plan(REGISTRY[name].run(spark, SF_DIR))
    assert "row_number(), 1, Partial" in text
    assert "row_number(), 1, Final" in text


@pytest.mark.parametrize("name", ["trip_fact", "defaulted_lookup", "two_roles_left"])
def test_small_lookups_are_broadcast(spark, name):
    text = plan(REGISTRY[name].run(spark, SF_DIR))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("time_window", "GreaterThanOrEqual(o_orderdate"),
        ("single_day", "LessThan(ts"),
        ("equality_filter", "EqualTo(o_orderstatus,F)"),
        ("closed_range", "LessThanOrEqual(p_size,20)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    df = REGISTRY[name].run(spark, SF_DIR)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert pushed in text.split("PushedFilters: ")[1]


def test_only_needed_columns_are_read(spark):
    text = plan(REGISTRY["distinct_by_group"].run(spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


T0 = datetime(2021, 1, 1, 10, 0, 59)


def green_row(**over):
    row = dict(
        VendorID=1,
        lpep_pickup_datetime=T0,
        lpep_dropoff_datetime=T0 + timedelta(seconds=2),
        store_and_fwd_flag="N",
        RatecodeID=1,
        PULocationID=1,
        DOLocationID=2,
        passenger_count=1,
        trip_distance=1.25,
        fare_amount=10.5,
        extra=0.5,
        mta_tax=0.5,
        tip_amount=1.0,
        tolls_amount=0.0,
        ehail_fee=None,
        improvement_surcharge=0.3,
        total_amount=12.8,
        payment_type=None,
        trip_type=2,
        congestion_surcharge=None,
    )
    return tuple({**row, **over}.values())


def yellow_row(**over):
    row = dict(
        VendorID=2,
        tpep_pickup_datetime=T0,
        tpep_dropoff_datetime=T0 + timedelta(minutes=10),
        passenger_count=1,
        trip_distance=2.5,
        RatecodeID=1,
        store_and_fwd_flag="N",
        PULocationID=2,
        DOLocationID=264,
        payment_type=1,
        fare_amount=20.0,
        extra=0.0,
        mta_tax=0.5,
        tip_amount=3.0,
        tolls_amount=0.0,
        improvement_surcharge=0.3,
        total_amount=23.8,
        congestion_surcharge=2.5,
    )
    return tuple({**row, **over}.values())


@pytest.fixture(scope="module")
def zones(spark):
    data = [(1, "Queens", "First", "Boro Zone"), (2, "Bronx", "Second", "Boro Zone")]
    return trips.zone_dimension(spark.createDataFrame(data, ZONES))


def build_fact(spark, zones, green, yellow):
    united = trips.unite(spark.createDataFrame(green, GREEN), spark.createDataFrame(yellow, YELLOW))
    return trips.trip_fact(trips.enrich(united, payment_types(spark)), zones)


def test_fact_from_raw_files(spark, zones):
    fact = build_fact(
        spark,
        zones,
        [
            green_row(),
            green_row(lpep_dropoff_datetime=T0 + timedelta(hours=1)),
            green_row(VendorID=None),
        ],
        [yellow_row()],
    )
    assert fact.schema.names == FACT.names and len(FACT) == 27
    got = {r["service_type"]: r for r in fact.collect()}
    assert fact.count() == 2
    green, yellow = got["Green"], got["Yellow"]
    assert green["trip_duration_minutes"] == 1
    assert (green["payment_type"], green["payment_type_description"]) == (0, "Unknown")
    assert (green["pickup_zone"], green["dropoff_borough"]) == ("First", "Bronx")
    assert (yellow["trip_type"], yellow["ehail_fee"], yellow["dropoff_zone"]) == (1, 0, None)
    assert yellow["payment_type_description"] == "Credit card"


def test_fact_is_loaded_step_by_step(spark, zones, database):
    name = f"{database}.fact"
    first = build_fact(spark, zones, [green_row()], [])
    trips.load_fact(first, name)
    later = T0 + timedelta(days=1)
    late = T0 - timedelta(days=1)
    second = build_fact(
        spark,
        zones,
        [green_row(), green_row(lpep_pickup_datetime=late)],
        [yellow_row(tpep_pickup_datetime=later)],
    )
    for _ in range(2):
        trips.load_fact(second, name)
        times = sorted(r[0] for r in spark.table(name).select("pickup_datetime").collect())
        assert times == [T0, later]


def test_monthly_reports(spark, zones):
    green = spark.createDataFrame([green_row(), green_row(tip_amount=2.0)], GREEN)
    yellow = spark.createDataFrame([yellow_row(passenger_count=None)], YELLOW)
    got = {r["service_type"]: r for r in reports.monthly_revenue(green, yellow).collect()}
    assert got["green"]["revenue_monthly_tip_amount"] == 3.0
    assert got["green"]["revenue_month"] == datetime(2021, 1, 1)
    assert got["green"]["revenue_monthly_congestion_surcharge"] is None
    assert got["yellow"]["avg_monthly_passenger_count"] is None
    fact = build_fact(spark, zones, [green_row(PULocationID=265)], [yellow_row()])
    mart = {r["pickup_zone"]: r for r in reports.monthly_zone_revenue(fact).collect()}
    assert set(mart) == {"Unknown Zone", "Second"}
    assert mart["Second"]["total_monthly_trips"] == 1


def test_staged_window(spark, database):
    from meterline.operators.layout import write_by_date

    base = dict.fromkeys(WINDOWED_TRIPS.names)
    base.update(vendor_id=1, pickup_datetime=T0, dropoff_datetime=T0 + timedelta(seconds=150))
    base.update(trip_distance=1.0, fare_amount=5.0, total_amount=6.0, tip_amount=0.5)
    base.update(payment_type=2, taxi_type="green", extracted_at=datetime(2022, 1, 1))
    again = {**base, "extracted_at": datetime(2022, 1, 2), "tip_amount": 0.75}
    bad = {**base, "fare_amount": -1.0}
    unpaid = {**base, "vendor_id": 2, "payment_type": 9}
    outside = {**base, "pickup_datetime": datetime(2021, 2, 1)}
    raw = spark.createDataFrame(
        [tuple(r.values()) for r in (base, again, bad, unpaid, outside)], WINDOWED_TRIPS
    )
    lookup = payment_types(spark).toDF("payment_type_id", "payment_type_name")
    name = f"{database}.staged"
    window = ("2021-01-01", "2021-02-01")
    write_by_date(trips.stage(raw.limit(0), lookup, *window), name, "pickup_datetime")
    for _ in range(2):
        trips.load_stage(raw, lookup, name, *window)
        got = {r["vendor_id"]: r for r in spark.table(name).collect()}
        assert spark.table(name).count() == 2
    assert (got[1]["tip_amount"], got[1]["trip_duration_minutes"]) == (0.75, 2)
    assert (got[1]["payment_type_name"], got[2]["payment_type_name"]) == ("Cash", None)
    report = reports.daily_report(spark.table(name), *window)
    assert {(r["payment_type_name"], r["trip_count"]) for r in report.collect()} == {
        ("Cash", 1),
        (None, 1),
    }
