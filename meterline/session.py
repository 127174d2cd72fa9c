"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "meterline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes.

    No master is set unless asked for, so `spark-submit` decides where the job runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, shared by all executors.

    Only a local session may fall back to a folder of its own: on a cluster a machine-local
    folder would not be visible to the other nodes.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="meterline-")
        context.setCheckpointDir(_local_scratch[app])
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose managed tables live below the scratch folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_root(spark)}/{name}'")
    return name


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete one of the folders that `scratch_path` named."""
    if not path.startswith(f"{scratch_root(spark)}/"):
        raise ValueError(f"{path} is not below the scratch folder")
    remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one session option for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed for the Arrow functions where the package is not installed on the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="meterline-package-")
    archive = shutil.make_archive(
        os.path.join(folder, "meterline"), "zip", os.path.dirname(home), os.path.basename(home)
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
