"""Backfill of monthly files into a table, with a ledger of the months that are loaded."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.filters import in_window, partition_window
from meterline.operators.layout import GRAIN, create_if_absent, table_properties
from meterline.operators.materialize import finish_pending, partition_column, replace_interval
from meterline.schemas import struct
from meterline.sources.files import month_contents, months_touched

LEDGER = struct(
    "service string, year int, month int, files bigint, bytes bigint, content bigint, rows bigint, state string, turn bigint"
)
KEY = ["service", "year", "month"]


def ledger_state(spark: SparkSession, ledger: str) -> DataFrame:
    """The last line of each month."""
    lines = spark.table(ledger).groupBy(*KEY)
    last = F.max_by(F.struct("files", "bytes", "content", "rows", "state", "turn"), "turn")
    return lines.agg(last.alias("last"), F.count(F.lit(1)).alias("loads")).select(*KEY, "last.*", "loads")


def backfill_months(
    spark: SparkSession,
    service: str,
    template: str,
    start: date,
    end: date,
    read: Callable[[list[str]], DataFrame],
    table: str,
    column: str,
    ledger: str,
    months_a_load: int = 12,
) -> list[tuple[int, int]]:
    """Bring the table up to date with the files of all months from that of `start` to that of `end`; returns the months loaded.

    Wanted months are joined with the ledger: those whose files are as they were at their last load are left alone, what is new or has
    changed is loaded, up to `months_a_load` neighbouring months at a time. A load replaces the window of these months and then adds its lines to the ledger,
    so a backfill that stops goes on behind its last load, and a load that stopped before its lines is done again with the same result.
    A month without files keeps its rows. `read` turns paths into rows; rows outside of their months are not taken.
    """
    create_if_absent(spark, ledger, LEDGER)
    finish_pending(spark, table)
    there = month_contents(spark, template, service, months_touched(start, end))
    known = ledger_state(spark, ledger).where("state = 'loaded'").select(*KEY, "content")
    due = there.join(known, [*KEY, "content"], "left_anti")
    due = due.select(*KEY, "files", "bytes", "content").orderBy("year", "month").collect()
    part, grain = partition_column(spark, table), table_properties(spark, table).get(GRAIN, "day")
    done = []
    for load in _neighbours(due, months_a_load):
        first, after = date(load[0]["year"], load[0]["month"], 1), _next_month(load[-1])
        paths = [
            template.format(service=service, year=f"{r['year']:04d}", month=f"{r['month']:02d}") for r in load
        ]
        replace_interval(read(paths), table, column, first, after)
        held = spark.table(table).where(partition_window(part, first, after, grain))
        held = held.where(in_window(column, first, after)).groupBy(F.year(column), F.month(column)).count()
        counts = {(r[0], r[1]): r[2] for r in held.collect()}
        turn = spark.table(ledger).agg(F.coalesce(F.max("turn"), F.lit(0))).first()[0] + 1
        lines = [(*r, counts.get((r["year"], r["month"]), 0), "loaded", turn) for r in load]
        spark.createDataFrame(lines, LEDGER).coalesce(1).write.insertInto(ledger)
        done += [(r["year"], r["month"]) for r in load]
    return done


def _neighbours(due: list, most: int) -> list[list]:
    """Runs of months without a gap, of bounded length."""
    runs: list[list] = []
    for r in due:
        number = r["year"] * 12 + r["month"]
        if runs and len(runs[-1]) < most and runs[-1][-1]["year"] * 12 + runs[-1][-1]["month"] == number - 1:
            runs[-1].append(r)
        else:
            runs.append([r])
    return runs


def _next_month(r) -> date:
    return date(r["year"] + r["month"] // 12, r["month"] % 12 + 1, 1)
