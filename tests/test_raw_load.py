from datetime import date
from decimal import Decimal

from meterline.plans import raw_load as R
from meterline.schemas import YELLOW

LINE = "1,2021-01-01 00:10:00,2021-01-01 00:20:00,1,2.10,1,N,142,43,2,8,3,0.5,0,0,0.3,11.8,2.5"
OTHER = LINE.replace("142", "7")
FARE = LINE.replace(",8,3,", ",9,3,")


def land(folder, month, *lines):
    folder.mkdir(exist_ok=True)
    text = "\n".join([",".join(YELLOW.names), *lines]) + "\n"
    (folder / f"yellow_tripdata_2021-{month}.csv").write_text(text)


def test_load_twice_and_backfill(spark, database, tmp_path):
    folder = tmp_path / "raw"
    land(folder, "01", LINE, LINE, FARE)
    land(folder, "03", OTHER)
    template = str(folder) + "/{type}_tripdata_{year}-{month}.csv"
    name = f"{database}.yellow"
    january = template.format(type="yellow", year="2021", month="01")
    assert R.load_files(spark, january, "yellow", name) == 3
    assert R.load_files(spark, january, "yellow", name) == 0
    assert R.backfill(spark, "yellow", date(2021, 1, 15), date(2021, 3, 1), template, name) == 1
    assert R.backfill(spark, "yellow", date(2022, 1, 1), date(2022, 3, 1), template, name) == 0
    table = spark.table(name)
    assert table.schema.names == R.raw_schema("yellow").names
    files = {r["filename"]: r["count"] for r in table.groupBy("filename").count().collect()}
    assert files == {"yellow_tripdata_2021-01.csv": 3, "yellow_tripdata_2021-03.csv": 1}
    assert table.select("unique_row_id").distinct().count() == 3
    assert table.first()["PULocationID"] in ("142", "7")


def test_warehouse_form(spark, database, tmp_path):
    folder = tmp_path / "raw"
    land(folder, "01", LINE, FARE)
    name = f"{database}.yellow_wh"
    path = str(folder / "yellow_tripdata_2021-01.csv")
    assert R.load_files(spark, path, "yellow", name, warehouse=True) == 2
    assert R.load_files(spark, path, "yellow", name, warehouse=True) == 0
    rows = spark.table(name).collect()
    # Without the fare the two rows share one key; both came in one batch, so both are in.
    assert len({bytes(r["unique_row_id"]) for r in rows}) == 1
    assert len(rows[0]["unique_row_id"]) == 16
    assert rows[0]["trip_distance"] == Decimal("2.100000000")
    assert rows[0]["pickup_date"] == date(2021, 1, 1)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["pickup_date=2021-01-01"]
