"""Ways to bring a result into a table: rebuild, append, merge, window, increment.

Plain Parquet tables know no MERGE or DELETE, so a change rewrites the partitions it touches and
no others. Dynamic partition overwrite writes the new files aside and swaps them in when the job
commits, which is why a table may be read and partly overwritten in one statement. Only names of
partitions ever reach the driver.

A change that rewrites partitions and removes others takes two statements. So its rows and the names of the partitions to remove are
written beside the table first, and the table is marked; a load that finds the mark finishes the change before its own. Whatever a stop
leaves half done so is done again, from the same rows.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampType

from meterline.operators.filters import in_window, partition_date, partition_window, touched_days
from meterline.operators.joins import anti_join
from meterline.operators.key_index import keys_of, note_keys, partitions_of, refuse_indexed
from meterline.operators.layout import GRAIN, ORDERED, set_properties, table_properties
from meterline.session import remove_folder, remove_scratch, scratch_path, setting

#: Names the folder of a change that is not finished.
PENDING = "meterline.pending"


def view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def rebuild(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Drop and rebuild."""
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(
            partition_by
        ).saveAsTable(table)
    else:
        df.write.mode("overwrite").saveAsTable(table)


def refill(df: DataFrame, table: str) -> None:
    """Truncate and insert: the table definition stays, its rows are replaced."""
    spark = df.sparkSession
    finish_pending(spark, table)
    refuse_indexed(spark, table)
    path = scratch_path(spark, "staged")
    staged = _positional(_staged(df, path), table)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        staged.write.insertInto(table, overwrite=True)
    remove_scratch(spark, path)


def append(df: DataFrame, table: str) -> None:
    """Add rows; columns are matched by name."""
    finish_pending(df.sparkSession, table)
    refuse_indexed(df.sparkSession, table)
    _gathered(df, table).write.insertInto(table)


def append_with_drift(df: DataFrame, table: str) -> None:
    """Add rows whose frame has columns the table lacks; older rows read as null there."""
    append(widened(df, table), table)


def widened(df: DataFrame, table: str) -> DataFrame:
    """Give the table the columns it lacks, and the frame those it lacks, as nulls."""
    spark = df.sparkSession
    new = _unknown(df, table)
    if new:
        fields = [f for f in df.schema.fields if f.name in new]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    given = {c.lower() for c in df.columns}
    missing = {
        f.name: F.lit(None).cast(f.dataType)
        for f in spark.table(table).schema.fields
        if f.name.lower() not in given
    }
    return df.withColumns(missing) if missing else df


def insert_only_merge(source: DataFrame, table: str, key: list[str], fixed_partition: bool = False) -> int:
    """Insert the source rows whose key the table does not hold yet; returns how many.

    The source is evaluated once: it is written out, its null keys and its partitions are counted in the same write. The source
    is not deduplicated: two new rows with one key both land. Running the same source again inserts nothing. A null in the
    key raises an error before the table is touched, as such a row would come in again each time.

    With `fixed_partition` the caller states that a key always has the same partition, as when it holds the time that the
    table is partitioned by. Then only the partitions that the source has rows for are read. Without, the keys of the whole
    table are; a table without partitions is not shuffled for that if it is bucketed by the key.
    """
    spark = source.sparkSession
    finish_pending(spark, table)
    refuse_indexed(spark, table)
    part = partition_column(spark, table) if fixed_partition else None
    if fixed_partition and part is None:
        raise ValueError(f"{table} has no partitions")
    no_key = F.lit(False)
    for name in key:
        no_key = no_key | F.col(name).isNull()
    path, found = scratch_path(spark, "staged"), Observation()
    counts = [F.count(F.when(no_key, 1)).alias("nulls")]
    if part:
        counts.append(F.collect_set(F.struct(F.col(part).cast("string"))).alias("parts"))
    watched = source.observe(found, *counts)
    staged = _staged(watched, path)
    if found.get["nulls"]:
        raise ValueError(f"source rows without a key {key}")
    target = spark.table(table)
    if part:
        kind = target.schema[part].dataType
        values = [None if r[0] is None else F.lit(r[0]).cast(kind) for r in found.get["parts"]]
        target = target.where(_among(part, values))
    seen = Observation()
    counted = _gathered(anti_join(staged, target, key), table).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.insertInto(table)
    remove_scratch(spark, path)
    return seen.get["rows"]


def upsert(
    source: DataFrame, table: str, key: list[str], stage: bool = True, widen: bool = False
) -> None:
    """Replace the rows whose key the source holds and insert the others.

    The source key must be unique. A row whose key moves to another partition leaves the old one.
    The source is looked at several times, so it is written out once first, unless it already is a
    stored table and `stage` is turned off. With `widen`, columns that the table lacks are added to it; without, they raise an
    error.
    """
    source = widened(source, table) if widen else source
    path = scratch_path(source.sparkSession, "staged")
    source = _staged(source, path) if stage else source
    repeated = source.groupBy(*key).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"source rows share a key {key}: {repeated.first()}")
    _replace_keys(source, table, key)
    if stage:
        remove_scratch(source.sparkSession, path)


def delete_insert(source: DataFrame, table: str, key: list[str], stage: bool = True) -> None:
    """Delete every target row whose key occurs in the source, then insert the source.

    Neither side needs a unique key. As for `upsert`, the source is written out once first.
    """
    path = scratch_path(source.sparkSession, "staged")
    _replace_keys(_staged(source, path) if stage else source, table, key)
    if stage:
        remove_scratch(source.sparkSession, path)


def _replace_keys(source: DataFrame, table: str, key: list[str]) -> None:
    """The partitions that hold a key of the source come from the key index, if the table has one on these columns, else from all keys."""
    spark = source.sparkSession
    finish_pending(spark, table)
    target = spark.table(table)
    part = partition_column(spark, table)
    if part is None:
        merged = anti_join(target, source, key).unionByName(_positional(source, table))
        refill(merged, table)
        return
    indexed = keys_of(spark, table)
    if indexed == key:
        held = partitions_of(source, table, key, part)
        note_keys(source, table, key, part)
    else:
        refuse_indexed(spark, table)
        # One row per key and partition keeps a hot key small.
        held = target.select(*dict.fromkeys([*key, part])).distinct()
        held = held.join(source.select(*key).distinct(), key, "left_semi").select(part)
    touched = [r[0] for r in held.union(source.select(part)).distinct().collect()]
    kept = anti_join(target.where(_among(part, touched)), source, key)
    _overwrite(kept.unionByName(_positional(source, table)), table, part, touched)


def _among(part: str, values: list) -> Column:
    """The partition column holds one of these values; null is one like any other."""
    known = [v for v in values if v is not None]
    found = F.coalesce(F.col(part).isin(known), F.lit(False))
    return found | F.col(part).isNull() if len(known) < len(values) else found


def replace_interval(source: DataFrame, table: str, column: str, start, end) -> None:
    """Delete the target rows in [start, end) and insert the source rows of that window.

    The table is partitioned by the day or month of `column`. Partitions at the edges of the window keep their
    rows outside it.
    """
    spark = source.sparkSession
    finish_pending(spark, table)
    refuse_indexed(spark, table)
    part = partition_column(spark, table)
    if part is None:
        raise ValueError(f"{table} is not partitioned by the date of {column}")
    grain = table_properties(spark, table).get(GRAIN, "day")
    target = spark.table(table)
    window = in_window(column, start, end)
    days = partition_window(part, start, end, grain)
    kept = target.where(days).where(~F.coalesce(window, F.lit(False)))
    fresh = _positional(source.where(window).withColumn(part, partition_date(column, grain)), table)
    first, last = touched_days(start, end, grain)
    touched = [d for d in _days_held(spark, table, part) if first <= d <= last]
    _overwrite(kept.unionByName(fresh), table, part, touched)


def newer_rows(
    source: DataFrame, table: str, column: str, lookback: timedelta = timedelta(0)
) -> DataFrame:
    """Source rows past the newest target row; everything while the target is empty.

    Rows that arrive late are left out, unless a lookback reaches them. The mark goes into the
    filter as a literal, so files and partitions before it are not read. It comes to the driver as text or as
    microseconds, never as a Python time, whose zone would be the driver's.
    """
    target = source.sparkSession.table(table)
    kind = target.schema[column].dataType
    newest = F.max(column)
    zoned = isinstance(kind, TimestampType)
    mark = target.agg(F.unix_micros(newest) if zoned else newest.cast("string")).first()[0]
    if mark is None:
        return source
    mark = F.timestamp_micros(F.lit(mark)) if zoned else F.lit(mark).cast(kind)
    if lookback:
        mark = F.date_sub(mark, lookback.days) if isinstance(kind, DateType) else mark - F.lit(lookback)
    return source.where(F.col(column) > mark)


def enforce_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """The frame in the order of the contract; names and types must agree exactly."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    faults = [f"missing {n}" for n in want if n not in have]
    faults += [f"unexpected {n}" for n in have if n not in want]
    faults += [
        f"{n} is {have[n].simpleString()}, not {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    if faults:
        raise TypeError("; ".join(faults))
    return df.select(*contract.names)


def _overwrite(df: DataFrame, table: str, part: str, touched: list) -> None:
    """Replace whole partitions by the rows of the frame, and drop those of `touched` for which it has none.

    Rows and dropped names are written beside the table ahead of the change; which partitions have rows is observed in that write.
    """
    spark = df.sparkSession
    seen = Observation()
    result = _gathered(df, table).observe(
        seen,
        F.collect_set(F.col(part).cast("string")).alias("parts"),
        F.count(F.when(F.col(part).isNull(), 1)).alias("nulls"),
    )
    path = f"{_location(spark, table)}/_pending-{uuid.uuid4().hex[:12]}"
    result.write.parquet(f"{path}/rows")
    written = {*seen.get["parts"], *([None] if seen.get["nulls"] else [])}
    texts = [None if value is None else str(value) for value in touched]
    emptied = [(text,) for text in texts if text not in written]
    spark.createDataFrame(emptied, "part string").coalesce(1).write.parquet(f"{path}/emptied")
    set_properties(spark, table, {PENDING: path})
    finish_pending(spark, table)


def finish_pending(spark: SparkSession, table: str) -> bool:
    """Finish the change that the table is marked with, if it is: each step may have been taken before and is taken again."""
    path = table_properties(spark, table).get(PENDING)
    if path is None:
        return False
    target = spark.table(table)
    rows = spark.read.schema(target.schema).parquet(f"{path}/rows")
    order = table_properties(spark, table).get(ORDERED)
    parts = _partition_columns(spark, table)
    if order in target.columns:
        rows = rows.sortWithinPartitions(*parts, order)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.insertInto(table, overwrite=True)
    emptied = [r[0] for r in spark.read.schema("part string").parquet(f"{path}/emptied").collect()]
    _drop_partitions(spark, table, parts[0], emptied)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('{PENDING}')")
    remove_folder(spark, path)
    return True


def _drop_partitions(spark: SparkSession, table: str, part: str, names: list[str | None]) -> None:
    if names:
        values = ["null" if text is None else "'" + text.replace("'", "\\'") + "'" for text in names]
        specs = ", ".join(f"PARTITION ({part} = {value})" for value in values)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    return described["data_type"].rstrip("/")


def _gathered(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order, and the rows of a partition or bucket together, in the table's order of rows if it has one.

    Otherwise every task would write a file into every partition. A count of what is written has to
    be taken after this step: adaptive execution may drop an empty input, and a count below with it.
    """
    spark = df.sparkSession
    listed = spark.catalog.listColumns(table)
    parts = [c.name for c in listed if c.isPartition]
    buckets = [c.name for c in listed if c.isBucket]
    out = _positional(df, table)
    if parts:
        order = table_properties(spark, table).get(ORDERED)
        out = out.hint("rebalance", *parts)
        out = out.sortWithinPartitions(*parts, order) if order in df.columns else out
    elif buckets:
        described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Num Buckets'").first()
        out = out.repartition(int(described["data_type"]), *buckets)
    return out


def _unknown(df: DataFrame, table: str) -> list[str]:
    """Columns of the frame that the table lacks."""
    have = {c.lower() for c in df.sparkSession.table(table).columns}
    return [c for c in df.columns if c.lower() not in have]


def _positional(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order, as `insertInto` goes by position. A column the table lacks is never dropped."""
    if unknown := _unknown(df, table):
        raise ValueError(f"{table} lacks columns {unknown}")
    return df.select(*df.sparkSession.table(table).columns)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partition_column(spark: SparkSession, table: str) -> str | None:
    """The table's partition column, if it has one."""
    names = _partition_columns(spark, table)
    if len(names) > 1:
        raise ValueError("tables with one partition column only")
    return names[0] if names else None


def _days_held(spark: SparkSession, table: str, part: str) -> list[date]:
    """The partitions of a table as the catalog lists them; no file is opened."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = [r[0].split("=", 1)[1] for r in listed]
    return [date.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__"]


def _staged(df: DataFrame, path: str) -> DataFrame:
    """The frame written out and read back, so that its sources may be overwritten."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
