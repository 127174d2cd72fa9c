"""Run registered queries next to DuckDB and compare rows.

    python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterline.queries import REGISTRY  # noqa: E402
from meterline.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(cell(r[n]) for n in names) for r in df.collect()), key=sort_key)


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = (tuple(cell(r[i]) for i in order) for r in result.fetchall())
    return sorted(names), sorted(rows, key=sort_key)


def differences(query, spark, con, sf_dir) -> str | None:
    """None when both sides agree, else a short description."""
    names, rows = spark_rows(query.run(spark, sf_dir))
    if query.sql is None:
        return None if rows else "no rows"
    want_names, want = sql_rows(con, query.sql)
    if names != want_names:
        return f"columns {names} against {want_names}"
    if len(rows) != len(want):
        return f"{len(rows)} rows against {len(want)}"
    for a, b in zip(rows, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference\n  spark {a}\n  sql   {b}"
    return None if rows else "no rows on either side"


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    picked = args[1:] or list(REGISTRY)
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in picked:
        start = time.time()
        try:
            problem = differences(REGISTRY[name], spark, con, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name}", flush=True)
        if problem:
            print("     " + problem, flush=True)
    print(f"{len(picked) - bad} of {len(picked)} agree")


if __name__ == "__main__":
    main()
