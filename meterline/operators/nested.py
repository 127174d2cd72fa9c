"""Nested documents into linked flat tables."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

ROW_ID = "_row_id"
PARENT_ID = "_parent_id"
LIST_IDX = "_list_idx"
LOAD_ID = "_load_id"
JOINER = "__"


def row_identity(*parts: Column) -> Column:
    """A row id from what identifies the row. The same input gives the same id on every run.

    Each part goes in behind its length, so no text of one part can stand for another part or a null.
    """
    texts = [p.cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*marked), 256)


def land(df: DataFrame, path: str) -> DataFrame:
    """Write documents as Parquet and read them back with file name and position in the file.

    Documents without a key, identical ones included, get their identity from where they lie.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_position"),
    )


def child_values(df: DataFrame, parent_id: str, field: str) -> DataFrame:
    """A list of plain values as a child table: parent id, index, value.

    Null and empty lists have no child rows.
    """
    return df.select(F.col(parent_id).alias(PARENT_ID), F.posexplode(field).alias(LIST_IDX, "value"))


def text_summary(child: DataFrame) -> DataFrame:
    """One row for each parent of a child table of texts: number of texts, last position, lowest and highest text, characters.

    Texts of a parent lie together, so each Arrow batch is summed up first. A group by alone would sort all texts by their
    parents' ids ahead of the shuffle, as Spark keeps lowest and highest texts only in sorted order.
    """
    names = [PARENT_ID, "n", "last", "low", "high", "chars"]

    def summed(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch]).append_column("chars", pc.utf8_length(batch.column("value")))
            found = rows.group_by(PARENT_ID).aggregate(
                [([], "count_all"), (LIST_IDX, "max"), ("value", "min"), ("value", "max"), ("chars", "sum")]
            )
            found = found.rename_columns(names)
            yield from found.set_column(5, "chars", found["chars"].cast(pa.int64())).to_batches()

    texts = child.select(PARENT_ID, LIST_IDX, "value")
    shape = f"{PARENT_ID} string, n long, last int, low string, high string, chars long"
    return texts.mapInArrow(summed, shape).groupBy(PARENT_ID).agg(
        F.sum("n").alias("n"),
        F.max("last").alias("last"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("chars").alias("chars"),
    )


def flatten(
    df: DataFrame, name: str, identity: list[str], load_id: str, drop: list[str] | None = None
) -> dict[str, DataFrame]:
    """All tables a nested frame unfolds into, by name.

    Structs open into columns joined by `__`. Each list becomes a child table `table__field` with
    the id of its parent row and the position in the list; lists inside it become grandchildren.
    Every table has a row id and the load id. Ids derive from the identity columns and positions
    alone, so each table can be computed on its own, reading only the columns it needs.

    The id of a plain value, which has no rows below it, is written out: parent id, list, position.
    Values outnumber all other rows, and a hash of each does not compress.
    """
    rows = df.withColumn(ROW_ID, row_identity(*[F.col(c) for c in identity]))
    if drop:
        rows = rows.drop(*drop)
    tables: dict[str, DataFrame] = {}
    _unfold(rows, name, [ROW_ID], load_id, tables)
    return tables


def _unfold(rows: DataFrame, name: str, links: list[str], load_id: str, tables: dict) -> None:
    plain, lists = _open(rows, links)
    tables[name] = rows.select(*links, *plain, F.lit(load_id).alias(LOAD_ID))
    for field, path, element in lists:
        entry = rows.select(F.col(ROW_ID).alias(PARENT_ID), F.posexplode(path).alias(LIST_IDX, "value"))
        if isinstance(element, StructType | ArrayType):
            identity = row_identity(F.col(PARENT_ID), F.lit(field), F.col(LIST_IDX))
        else:
            identity = F.concat(F.col(PARENT_ID), F.lit(f":{field}:"), F.col(LIST_IDX).cast("string"))
        child = entry.withColumn(ROW_ID, identity)
        links_below = [ROW_ID, PARENT_ID, LIST_IDX]
        if isinstance(element, StructType):
            child = child.select(*links_below, "value.*")
        elif isinstance(element, ArrayType):
            child = child.withColumnRenamed("value", "list")
        _unfold(child, f"{name}{JOINER}{field}", links_below, load_id, tables)


def _open(rows: DataFrame, links: list[str]):
    """Plain columns and list columns of a frame, looking into structs."""
    plain: list[Column] = []
    lists: list[tuple[str, str, object]] = []

    def walk(schema: StructType, path: list[str]) -> None:
        for field in schema.fields:
            if not path and field.name in links:
                continue
            here = [*path, field.name]
            flat, access = JOINER.join(here), ".".join(f"`{p}`" for p in here)
            if isinstance(field.dataType, StructType):
                walk(field.dataType, here)
            elif isinstance(field.dataType, ArrayType):
                lists.append((flat, access, field.dataType.elementType))
            else:
                plain.append(F.col(access).alias(flat))

    walk(rows.schema, [])
    return plain, lists


@dataclass(frozen=True)
class LoadResult:
    load_id: str
    rows: dict[str, int]


AUDIT_SCHEMA = "load_id string, table_name string, row_count bigint, loaded_at timestamp"


def load_tables(
    spark: SparkSession, tables: dict[str, DataFrame], database: str, load_id: str
) -> LoadResult:
    """Replace every table and append one audit line per table to `_loads`.

    Row counts are observed while writing; nothing is scanned again for them. Ids are hex text, of which
    zstd stores half. A list that the documents no
    longer have leaves a child table of an earlier load behind: it is dropped, with the tables below it.
    """
    rows = {}
    roots = [name for name in tables if not any(name.startswith(other + JOINER) for other in tables)]
    for held in spark.catalog.listTables(database):
        below = any(held.name.startswith(root.lower() + JOINER) for root in roots)
        if below and not held.isTemporary and held.name not in {name.lower() for name in tables}:
            spark.sql(f"DROP TABLE {database}.`{held.name}`")
    for name, df in tables.items():
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").option("compression", "zstd").saveAsTable(f"{database}.{name}")
        rows[name] = seen.get["rows"]
    audit = spark.createDataFrame(
        [(load_id, name, n) for name, n in rows.items()],
        "load_id string, table_name string, row_count bigint",
    ).withColumn("loaded_at", F.current_timestamp())
    audit.write.mode("append").saveAsTable(f"{database}._loads")
    return LoadResult(load_id, rows)
