"""The registered queries: a name, a Spark function and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.session import ship_package


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return portable(self.build(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name; `covers` lists the inventory ids."""

    def add(build):
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"two queries named {name}")
        REGISTRY[name] = Query(name, tuple(covers.split()), build, sql)
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Types that read the same from every engine: decimals as doubles, dates and times as text."""

    def plain(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.BinaryType):
            col = F.lower(F.hex(col))
        return col.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])
