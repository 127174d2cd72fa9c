"""Pick up new files of a folder and merge them into a table."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.operators.materialize import insert_only_merge
from meterline.session import setting

#: For the length of a stream with a memory: rows are kept on the executors' disks, and no batch runs only to forget some.
MEMORY = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def _first_seen(files: DataFrame, remember: str) -> DataFrame:
    """Rows that did not come within the span `remember` before, with all their columns equal.

    The clock is the time of the batch, not one of the data. It never runs behind, so no row is late and none is lost:
    what repeats after the span passes once more.
    """
    clock = "taken_at"
    while clock in files.columns:
        clock += "_"
    timed = files.withColumn(clock, F.current_timestamp()).withWatermark(clock, remember)
    return timed.dropDuplicatesWithinWatermark(files.columns).drop(clock)


def load_new_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    table: str,
    key: list[str],
    checkpoint: str,
    *,
    file_format: str = "parquet",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
    options: dict[str, str] | None = None,
    remember: str | None = None,
) -> None:
    """Merge every file not seen before, then stop.

    The checkpoint remembers which files were taken. A batch that is run again after a failure
    finds its keys in the table and inserts nothing twice.

    With `remember`, a span such as "7 days", the rows of that span are kept in the stream's state, dealt over the tasks by their
    values: rows of a file that is sent again do not reach the merge with the table. Rows that differ in any column do, also
    if they share a key, and so do repeats after the span; the merge settles them by key as it does without. A
    checkpoint goes with or without a memory from its first run on. Columns of maps cannot be remembered.
    """
    files = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**(options or {}))
        .load(folder)
    )

    def merge(batch: DataFrame, _batch_id: int) -> None:
        insert_only_merge(prepare(batch) if prepare else batch, table, key)

    rows = _first_seen(files, remember) if remember else files
    with ExitStack() as block:
        for name, value in MEMORY.items() if remember else ():
            block.enter_context(setting(spark, name, value))
        query = (
            rows.writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    # A stream works in a session of its own; this one may still hold the old list of files.
    spark.catalog.refreshTable(table)
