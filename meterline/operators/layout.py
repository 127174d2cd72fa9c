"""File and table layout: part files, archives, table definitions, staging, seeds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.operators.filters import partition_date
from meterline.session import remove_folder, setting
from meterline.sources.files import existing_paths, month_contents, month_pattern, read_csv

#: Table properties that loads follow: the partitions' grain, and the column that rows are sorted by inside of them.
GRAIN, ORDERED = "meterline.grain", "meterline.ordered"


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, values: Mapping[str, str]) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def write_parquet(
    df: DataFrame, path: str, files: int | None = None, overwrite: bool = True
) -> None:
    """Parquet output, in a given number of files if wanted; fails on an existing path unless
    told to overwrite."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A finished report as one file.

    `repartition(1)` moves only the result rows to one task; `coalesce(1)` would also pull the
    aggregation before it into that task.
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def write_by_date(
    df: DataFrame, table: str, ts: str, date_column: str = "pickup_date", grain: str = "day"
) -> None:
    """A managed table partitioned by the day or month of a time, its rows in the order of time inside each partition.

    Choose the grain so that a partition has many rows: each one is a folder with a file. A window inside of a month still
    skips the row groups outside of it, as rows are sorted. The rebalance hint gathers the rows of a partition into few files and lets
    adaptive execution split one that is far larger than the others. The table keeps grain and order; later loads follow them.
    """
    dated = df.withColumn(date_column, partition_date(ts, grain))
    dated = dated.hint("rebalance", date_column).sortWithinPartitions(date_column, ts)
    dated.write.mode("overwrite").partitionBy(date_column).saveAsTable(table)
    set_properties(df.sparkSession, table, {GRAIN: grain, ORDERED: ts})


ARCHIVED = "service string, year int, month int, files bigint, bytes bigint, content bigint, run bigint"


def archive_months(
    spark: SparkSession,
    services: Mapping[str, StructType],
    months: Iterable[tuple[int, int]],
    source: str,
    target: str,
    files_per_month: int = 4,
) -> list[str]:
    """CSV files by service and month into a Parquet archive, one job per service.

    `source` is a template with {service}, {year}, {month}. The archive keeps a manifest of what each month was made from. Months
    whose files are as the manifest has them are skipped before anything is read; a month with a file more, or another one, is written anew, and
    only that month. The manifest follows the data, so a run that stops in between does its months again. Returns the paths converted.
    """
    wanted, converted = list(months), []
    manifest = f"{target}/_manifest"
    for service, schema in services.items():
        there = month_contents(spark, source, service, wanted)
        runs = 0
        if existing_paths(spark, [manifest]):
            kept = spark.read.schema(ARCHIVED).parquet(manifest).where(F.col("service") == service)
            runs = kept.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]
            key = ["service", "year", "month"]
            last = kept.groupBy(*key).agg(F.max_by("content", "run").alias("content"))
            there = there.join(last, [*key, "content"], "left_anti")
        # A row a month: the work of this run.
        columns = ["service", "year", "month", "files", "bytes", "content"]
        changed = there.select(columns).orderBy("year", "month").collect()
        if not changed:
            continue
        inputs = [
            source.format(service=service, year=f"{r['year']:04d}", month=f"{r['month']:02d}") for r in changed
        ]
        pattern, year_group, month_group = month_pattern(source, service)
        path = F.col("_metadata.file_path")
        rows = read_csv(spark, inputs, schema).select(
            "*",
            F.lit(service).alias("service"),
            F.regexp_extract(path, pattern, year_group).cast("int").alias("year"),
            F.regexp_extract(path, pattern, month_group).cast("int").alias("month"),
        )
        # Row numbers of a file scan deal the rows of each month over its output files.
        slot = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_month))
        written = Observation()
        dealt = rows.repartition(len(inputs) * files_per_month, "year", "month", slot)
        (
            dealt.observe(written, F.collect_set(F.struct("year", "month")).alias("months"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("service", "year", "month")
            .parquet(target)
        )
        filled = {(r[0], r[1]) for r in written.get["months"]}
        for r in changed:
            if (r["year"], r["month"]) not in filled:
                remove_folder(spark, f"{target}/service={service}/year={r['year']}/month={r['month']}")
        spark.createDataFrame([(*r, runs + 1) for r in changed], ARCHIVED).coalesce(1).write.mode("append").parquet(manifest)
        converted += inputs
    return converted


def create_then_append(df: DataFrame, table: str, chunk_rows: int = 100_000) -> None:
    """An empty table first, then its rows, with at most `chunk_rows` to a file."""
    df.limit(0).write.mode("overwrite").saveAsTable(table)
    with setting(df.sparkSession, "spark.sql.files.maxRecordsPerFile", str(chunk_rows)):
        df.write.insertInto(table)


def create_if_absent(
    spark: SparkSession,
    table: str,
    schema: StructType,
    comments: Mapping[str, str] | None = None,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    buckets: int = 16,
    properties: Mapping[str, str] | None = None,
) -> None:
    """A typed table with described columns, left alone if it is there.

    A table that is merged by a key without partitions is best bucketed by that key: a merge then shuffles its source only.
    """
    comments = comments or {}

    def line(field) -> str:
        note = comments.get(field.name, "").replace("'", "\\'")
        return f"`{field.name}` {field.dataType.simpleString()}" + (
            f" COMMENT '{note}'" if note else ""
        )

    columns = ", ".join(line(f) for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    dealt = f" CLUSTERED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS" if bucket_by else ""
    noted = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    noted = f" TBLPROPERTIES ({noted})" if noted else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parts}{dealt}{noted}")


def external_csv_table(spark: SparkSession, table: str, path: str, schema: StructType) -> DataFrame:
    """A table over CSV files that stay where they are; surplus values in a row are ignored."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING csv "
        f"OPTIONS (header 'true', mode 'PERMISSIVE') LOCATION '{path}'"
    )
    return spark.table(table)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def copy_into(df: DataFrame, table: str, columns: list[str]) -> None:
    """Append the listed columns; further columns of the table get typed nulls."""
    target = df.sparkSession.table(table)
    given = set(columns)
    df.select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    ).write.insertInto(table)


def constant_frame(spark: SparkSession, rows: list[tuple], schema: str, **tags) -> DataFrame:
    """A handful of literal rows with constant columns added."""
    return spark.createDataFrame(rows, schema).withColumns(
        {name: F.lit(value) for name, value in tags.items()}
    )


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """Part files of a Parquet output with their sizes in bytes; reads no data columns."""
    return (
        spark.read.parquet(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
        )
        .distinct()
    )


def average_file_mb(spark: SparkSession, path: str) -> DataFrame:
    return file_report(spark, path).agg(
        F.count(F.lit(1)).alias("files"), (F.avg("bytes") / F.lit(1024.0 * 1024.0)).alias("avg_mb")
    )
