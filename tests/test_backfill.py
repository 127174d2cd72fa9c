"""Months that are loaded once, again when their files change, and further after a stop."""

from collections import Counter
from datetime import date

import pytest

from meterline.operators import layout as L
from meterline.plans import backfill as B
from meterline.schemas import struct

ROW = "k long, t timestamp_ntz"


@pytest.fixture
def landed(spark, database, tmp_path):
    home = tmp_path / "in"

    def land(month, keys, name="a"):
        folder = home / "taxi" / f"2024-{month:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [f"{k},2024-{month:02d}-15 10:00:00" for k in keys]
        (folder / f"{name}.csv").write_text("\n".join(["k,t", *lines]) + "\n")

    name, ledger = f"{database}.rows", f"{database}.ledger"
    L.write_by_date(spark.createDataFrame([], ROW), name, "t", "m", "month")

    def run(months_a_load=2, read=None):
        plain = lambda paths: spark.read.schema(ROW).csv(paths, header=True)
        return B.backfill_months(
            spark, "taxi", str(home) + "/{service}/{year}-{month}", date(2024, 1, 1), date(2024, 8, 31),
            read or plain, name, "t", ledger, months_a_load,
        )

    def keys():
        return sorted(r["k"] for r in spark.table(name).collect())

    return land, run, keys, ledger


def test_only_new_and_changed_months_are_loaded(spark, landed):
    land, run, keys, ledger = landed
    assert run() == []
    for month in (1, 2, 3, 5):
        land(month, [month * 10, month * 10 + 1])
    assert run() == [(2024, 1), (2024, 2), (2024, 3), (2024, 5)]
    assert run() == []
    land(2, [22], "late")
    land(7, [])
    assert run() == [(2024, 2), (2024, 7)]
    assert keys() == [10, 11, 20, 21, 22, 30, 31, 50, 51]
    state = {r["month"]: (r["rows"], r["loads"], r["files"]) for r in B.ledger_state(spark, ledger).collect()}
    assert state == {1: (2, 1, 1), 2: (3, 2, 2), 3: (2, 1, 1), 5: (2, 1, 1), 7: (0, 1, 1)}


def test_a_backfill_that_stops_goes_on_behind_its_last_load(spark, landed):
    land, run, keys, ledger = landed
    for month in range(1, 7):
        land(month, [month])
    calls = Counter()

    def failing(paths):
        calls["loads"] += 1
        if calls["loads"] == 3:
            raise OSError("gone")
        return spark.read.schema(ROW).csv(paths, header=True)

    with pytest.raises(OSError, match="gone"):
        run(read=failing)
    assert keys() == [1, 2, 3, 4]
    assert run() == [(2024, 5), (2024, 6)]
    assert keys() == [1, 2, 3, 4, 5, 6]


def test_a_stop_between_rows_and_ledger_loads_again_without_doubles(spark, landed, monkeypatch):
    land, run, keys, _ = landed
    land(1, [1, 2])
    real = B.replace_interval

    def stopping(*given):
        real(*given)
        raise OSError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(B, "replace_interval", stopping)
        with pytest.raises(OSError, match="stopped"):
            run()
    assert keys() == [1, 2]
    assert run() == [(2024, 1)]
    assert keys() == [1, 2]


def test_the_archive_takes_in_files_that_come_late(spark, tmp_path):
    schema, target = struct("k int, v string"), str(tmp_path / "archive")
    source = str(tmp_path / "raw") + "/{service}/{year}-{month}"

    def land(month, name, keys):
        folder = tmp_path / "raw" / "green" / f"2021-{month:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("k,v\n" + "".join(f"{k},{month}\n" for k in keys))

    def run():
        paths = L.archive_months(spark, {"green": schema}, [(2021, m) for m in (1, 2, 3)], source, target, 2)
        return [p.rsplit("/", 1)[1] for p in paths]

    def held():
        return sorted((r["month"], r["k"]) for r in spark.read.parquet(target).collect())

    assert run() == []
    land(1, "a.csv", [1, 2])
    land(2, "a.csv", [3])
    assert run() == ["2021-01", "2021-02"] and run() == []
    land(1, "b.csv", [4])
    assert run() == ["2021-01"] and run() == []
    assert held() == [(1, 1), (1, 2), (1, 4), (2, 3)]
    # A file that is replaced by an empty one, and one that goes.
    land(2, "a.csv", [])
    (tmp_path / "raw" / "green" / "2021-01" / "b.csv").unlink()
    assert run() == ["2021-01", "2021-02"]
    assert held() == [(1, 1), (1, 2)]
    assert run() == []
