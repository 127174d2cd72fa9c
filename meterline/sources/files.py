"""Readers for CSV, Parquet, JSON documents and landed pages."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable
from datetime import date
from functools import reduce

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

LOG = logging.getLogger(__name__)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    *,
    infer: bool = False,
    timestamp_format: str | None = None,
    spread: int | None = None,
) -> DataFrame:
    """CSV with a header row.

    With a schema the header is skipped and nothing is scanned twice; without one every column is
    text, or guessed from the data when `infer` is set. Rows that are too short get nulls and
    surplus values are ignored. A gzip file cannot be split, so `spread` deals its rows out to that
    many tasks.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("enforceSchema", True)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.repartition(spread) if spread else df


def read_parquet(
    spark: SparkSession, *paths: str, by_name: bool = False, base: str | None = None
) -> DataFrame:
    """Parquet files or globs; `by_name` merges the columns of files that differ."""
    reader = spark.read
    if by_name:
        reader = reader.option("mergeSchema", True)
    if base:
        reader = reader.option("basePath", base)
    return reader.parquet(*paths)


def read_by_name(spark: SparkSession, paths: Iterable[str], schema: StructType) -> DataFrame:
    """Parquet files whose column *types* differ as well, brought to one schema.

    Merging inside the reader only works while equal names have equal types. Here the paths are
    grouped by the schema they are stored under; each group is one scan, cast before the union. The
    casts do not hinder column pruning. Nested columns are told apart by their whole type.
    """
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path in paths:
        stored = spark.read.parquet(path).schema
        groups.setdefault(stored.json(), (stored, []))[1].append(path)
    frames = []
    for stored, members in groups.values():
        df = spark.read.schema(stored).parquet(*members)
        have = {name.lower() for name in df.columns}
        frames.append(
            df.select(
                *[
                    (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in schema.fields
                ]
            )
        )
    return reduce(DataFrame.unionAll, frames)


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    selector: str | None = None,
    schema: StructType | None = None,
    *,
    whole_files: bool = False,
) -> DataFrame:
    """JSON documents; with a selector, one row per entry of that top-level list.

    One document per line is splittable and the default; `whole_files` is for a file that is one
    document.
    """
    reader = spark.read.option("multiLine", whole_files)
    if schema is not None:
        reader = reader.schema(schema)
    docs = reader.json(path)
    return entries_of(docs, selector) if selector else docs


def entries_of(docs: DataFrame, selector: str) -> DataFrame:
    """One row per entry of a list column, structs opened into columns."""
    entry = docs.select(F.explode(F.col(selector)).alias("entry"))
    element = docs.schema[selector].dataType
    if isinstance(element, ArrayType) and isinstance(element.elementType, StructType):
        return entry.select("entry.*")
    return entry


def page_coverage(pages: DataFrame, selector: str, total: str | None = None) -> DataFrame:
    """One row on a set of landed pages: pages, empty pages, rows and the reported total.

    The walk over an interface ends at the first empty page; on landed files that page is simply
    one with no entries. `total` names the column in which each page repeats the overall count.
    """
    entries = F.coalesce(F.size(F.col(selector)), F.lit(0))
    entries = F.when(entries < 0, 0).otherwise(entries).cast("bigint")
    measures = [
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.when(entries == 0, 1).otherwise(0)).cast("bigint").alias("empty_pages"),
        F.sum(entries).alias("rows_read"),
    ]
    if total:
        measures.append(F.max(F.col(total)).cast("bigint").alias("rows_reported"))
    return pages.agg(*measures)


def entries_until_empty(pages: DataFrame, selector: str, page: str) -> DataFrame:
    """The entries of landed pages in page order, up to the first page without any.

    An empty or a null list ends the walk; what was landed behind it does not count. The number of
    that page is a scalar inside the plan, and Spark reads only the pages before it.
    """
    number, entries = F.col(f"`{page}`"), F.coalesce(F.size(F.col(selector)), F.lit(0))
    first_empty = pages.agg(F.min(F.when(entries <= 0, number))).scalar()
    return entries_of(pages.where(F.coalesce(number < first_empty, first_empty.isNull())), selector)


def months_touched(start: date, end: date) -> list[tuple[int, int]]:
    """Every (year, month) from the month of `start` to the month of `end`, both included."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [(m // 12, m % 12 + 1) for m in range(first, last + 1)]


def month_paths(types: Iterable[str], start: date, end: date, template: str) -> list[str]:
    """One path per type and month, from a template with {type}, {year} and {month}."""
    months = months_touched(start, end)
    return [
        template.format(type=kind, year=f"{year:04d}", month=f"{month:02d}")
        for kind in types
        for year, month in months
    ]


def month_pattern(template: str, service: str) -> tuple[str, int, int]:
    """The part of a path template from its first placeholder on, as a pattern with two groups: which is the year, which the month."""
    year_first = template.index("{year}") < template.index("{month}")
    pattern = re.escape(template[template.index("{") :])
    for name, group in (("service", re.escape(service)), ("year", r"(\d{4})"), ("month", r"(\d{2})")):
        pattern = pattern.replace(re.escape("{" + name + "}"), group)
    return pattern, (1 if year_first else 2), (2 if year_first else 1)


def month_contents(spark: SparkSession, template: str, service: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """What is there for each of the months: (service, year, month, files, bytes, content); months without files have no row.

    `content` is a hash over paths, sizes and times of the files, so it changes with any file that is added, replaced or
    removed. Spark lists the folder, in parallel where it has many folders; no file is opened and no list of files comes to the driver.
    """
    pattern, year, month = month_pattern(template, service)
    base = template[: template.index("{year}" if year == 1 else "{month}")].format(service=service).rpartition("/")[0]
    shape = "service string, year int, month int, files bigint, bytes bigint, content bigint"
    if not existing_paths(spark, [base]):
        return spark.createDataFrame([], shape)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    whole = pattern + "(?:/.*)?$"
    files = files.select(
        F.lit(service).alias("service"),
        F.regexp_extract("path", whole, year).try_cast("int").alias("year"),
        F.regexp_extract("path", whole, month).try_cast("int").alias("month"),
        "length",
        F.xxhash64("path", "length", "modificationTime").alias("print"),
    )
    wanted = [y * 12 + m for y, m in months]
    files = files.where((F.col("year") * 12 + F.col("month")).isin(wanted))
    return files.groupBy("service", "year", "month").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor("print").alias("content")
    )


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that exist, asked of the file system each path belongs to."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        if hadoop_path.getFileSystem(conf).exists(hadoop_path):
            found.append(path)
    return found


def file_states(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One row per file of the listed paths: listed path, file, state and rows.

    The state is `read`, `missing` (nothing at the path) or `unreadable` (no Parquet footer that could
    be read). One job looks at the footers of all files. A file of which it saw no row is empty or
    unreadable, so those few are opened singly.
    """
    paths = list(paths)
    found = existing_paths(spark, paths)
    lines = [(path, None, "missing", None) for path in paths if path not in found]
    files = []
    if found:
        listed = spark.read.format("binaryFile").load(found).select("path")
        files = [r["path"] for r in listed.collect()]
    held = _footer_rows(spark, files)
    homes = {_plain(path).rstrip("/"): path for path in found}
    for file in files:
        home = _plain(file)
        while home not in homes:
            home = home.rpartition("/")[0]
        rows = held.get(_plain(file))
        state = "read" if rows is not None or _opens(spark, file) else "unreadable"
        lines.append((homes[home], file, state, (rows or 0) if state == "read" else None))
    return spark.createDataFrame(lines, "listed string, file string, state string, rows bigint")


def _plain(path: str) -> str:
    """A file's path without its scheme and host, which listings leave out or write differently."""
    return re.sub("^[a-z0-9]+:(//[^/]*)?", "", path)


def _footer_rows(spark: SparkSession, files: list[str]) -> dict[str, int]:
    """Rows by file as the footers tell; files without a readable footer have no entry."""
    if not files:
        return {}
    rows = spark.read.option("ignoreCorruptFiles", True).schema(StructType([])).parquet(*files)
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file")).count()
    return {_plain(r["file"]): r["count"] for r in counted.collect()}


def _opens(spark: SparkSession, file: str) -> bool:
    """Whether the footer can be read; an error of any other kind is raised again."""
    try:
        spark.read.option("ignoreCorruptFiles", False).parquet(file)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_READ_FILE_FOOTER" not in str(error):
            raise
        return False
    return True


def read_available(
    spark: SparkSession,
    paths: Iterable[str],
    schema: StructType | None = None,
    *,
    on_empty: str = "error",
    skip_corrupt: bool = True,
    base: str | None = None,
) -> DataFrame:
    """Parquet files out of a list, leaving out those that are missing or unreadable.

    What is left out is logged as a warning, file by file, and `file_states` lists it. A file is read
    whole or not at all: one whose footer can be read and whose pages are damaged raises an error. If
    nothing can be read, `on_empty` decides between an error and an empty frame of the given schema.
    Without `skip_corrupt` an unreadable file is an error as well.
    """
    if on_empty not in ("error", "empty"):
        raise ValueError("on_empty must be 'error' or 'empty'")
    paths = list(paths)
    if skip_corrupt:
        states = file_states(spark, paths).collect()
        for r in states:
            if r["state"] != "read":
                LOG.warning("%s file left out: %s", r["state"], r["file"] or r["listed"])
        readable = [r["file"] for r in states if r["state"] == "read"]
    else:
        readable = existing_paths(spark, paths)
    if not readable:
        if on_empty == "error":
            raise FileNotFoundError("none of the listed files can be read")
        if schema is None:
            raise ValueError("an empty result needs a schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("ignoreCorruptFiles", False)
    if base:
        reader = reader.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*readable)


def from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    """A small pandas frame with inferred types, such as a file header sample."""
    return spark.createDataFrame(frame)


def load_seed(
    spark: SparkSession, path: str, table: str, schema: StructType, primary_key: list[str]
) -> DataFrame:
    """A lookup file as a table; its key must be complete and unique."""
    from meterline.operators.quality import not_null, require, unique

    df = read_csv(spark, path, schema)
    require(df, [*(not_null(c) for c in primary_key), unique(*primary_key)])
    df.write.mode("overwrite").saveAsTable(table)
    return spark.table(table)
