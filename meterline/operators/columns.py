"""Projections: subset, rename, tags, lineage, shared columns, casts, defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names in the public files and the names used here.
COMMON_NAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
}
SNAKE_NAMES = {
    **COMMON_NAMES,
    "VendorID": "vendor_id",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; names that are absent are passed over."""
    return df.withColumnsRenamed(dict(names))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def with_lineage(df: DataFrame, file_column: str = "filename", time_column: str = "extracted_at"):
    """Add the source file name and the time of the run. Works on a direct file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias(file_column),
        F.current_timestamp().alias(time_column),
    )


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of `a` that `b` has too, in the order of `a`."""
    other = set(b.columns)
    return [name for name in a.columns if name in other]


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def fill_columns(df: DataFrame, values: Mapping[str, tuple]) -> DataFrame:
    """Add constant columns of a stated type: name -> (value, type)."""
    return df.withColumns({n: F.lit(v).cast(kind) for n, (v, kind) in values.items()})


def pick(df: DataFrame, names: list[str], default: str = "N/A") -> DataFrame:
    """Keep the listed columns; one the frame lacks becomes the default text.

    A column that is there but null stays null.
    """
    have = set(df.columns)
    return df.select(*[F.col(n) if n in have else F.lit(default).alias(n) for n in names])


def pick_json(df: DataFrame, column: str, names: list[str], default: str = "N/A") -> DataFrame:
    """Pick keys out of a JSON text column as text; per document, a missing key gives the default.

    Null-ness needs care: a key that is present but null stays null.
    """
    doc = F.from_json(F.col(column), "map<string,string>")
    opened = df.withColumn("_doc", doc)
    picked = [
        F.when(F.map_contains_key("_doc", F.lit(n)), F.try_element_at("_doc", F.lit(n)))
        .otherwise(F.lit(default))
        .alias(n)
        for n in names
    ]
    return opened.select(*df.columns, *picked)
