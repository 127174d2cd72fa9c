"""Token ids in files of length-delimited binary records, with an offset index beside each file.

A file `part-PPPPP-NNNN-A.rec` holds a header and then one record for each document, in ascending order of the key:

    header  8 bytes MAGIC, u32 bytes of an id (2 or 4), u32 end id
    record  u64 bytes of the payload
            u32 masked checksum of those 8 bytes
            payload: u8 1 if there is a key, i64 key, the ids
            u32 masked checksum of the payload

Numbers are little-endian. The checksum is CRC-32, rotated right by 15 bits plus a constant, so that a checksum
over data that holds checksums stays meaningful. `part-….idx` has 32 bytes for each record: i64 key, u64 1 if there
is a key, u64 offset, u64 bytes of the whole record. Files are written by the tasks through pyarrow's file systems
into the shared folder, under names that no other attempt uses; the manifest, a Parquet table, lists those of the
attempts that Spark has accepted, so files of lost attempts are never read.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.tokens import encoder

MAGIC = b"TOKREC01"
MASK = 0xA282EAD8
HEADER = struct.Struct("<8sII")
LENGTH = struct.Struct("<Q")
CHECK = struct.Struct("<I")
KEY = struct.Struct("<Bq")
ENTRY = struct.Struct("<qQQQ")
MANIFEST = "task int, part int, path string, n_docs long, n_ids long, n_bytes long"


class DamagedRecord(ValueError):
    """A checksum or a length of a record does not fit."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = LENGTH.pack(len(payload))
    return b"".join((size, CHECK.pack(masked(size)), payload, CHECK.pack(masked(payload))))


def open_folder(path: str):
    """File system and plain path of a URI or a local path."""
    path = re.sub(r"^file:/+", "file:///", path)
    return pyarrow.fs.FileSystem.from_uri(path)


class _Writer:
    """Writes one task's documents, a new file after `most` bytes."""

    def __init__(self, folder: str, task: int, attempt: int, width: int, end: int, most: int):
        self.fs, self.path = open_folder(folder)
        self.folder, self.task, self.attempt, self.most = folder, task, attempt, most
        self.header = HEADER.pack(MAGIC, width, end)
        self.width, self.part, self.out, self.done = width, -1, None, []

    def add(self, key, ids: bytes):
        if self.out is None:
            self.part += 1
            name = f"part-{self.task:05d}-{self.part:04d}-{self.attempt}"
            self.name = name
            self.out = self.fs.open_output_stream(f"{self.path}/{name}.rec")
            self.out.write(self.header)
            self.at, self.index, self.n_ids = len(self.header), [], 0
        record = frame(KEY.pack(key is not None, key or 0) + ids)
        self.out.write(record)
        self.index.append(ENTRY.pack(key or 0, key is not None, self.at, len(record)))
        self.at += len(record)
        self.n_ids += len(ids) // self.width
        if self.at >= self.most:
            self.close()

    def close(self):
        if self.out is None:
            return
        self.out.close()
        with self.fs.open_output_stream(f"{self.path}/{self.name}.idx") as f:
            f.write(b"".join(self.index))
        self.done.append(
            (self.task, self.part, f"{self.folder}/{self.name}", len(self.index), self.n_ids, self.at)
        )
        self.out = None


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    file_bytes: int = 64 << 20,
) -> DataFrame:
    """Encode whole texts and write them in ascending order of `key`; returns the manifest.

    Null keys come first; rows with the same key follow an order that only their texts decide. A null or empty
    text has the end id only. Rows that repeat are written each. An empty table writes an empty manifest.
    Other columns are not read.
    """
    spark = docs.sparkSession
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)

    def run(batches):
        coder = encoder(tokenizer)
        end = np.array([end_id], coder.dtype).tobytes()
        context = TaskContext.get()
        out = _Writer(
            folder, context.partitionId(), context.taskAttemptId(), coder.dtype.itemsize, end_id, file_bytes
        )
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out.add(k, coder.encode(t or "") + end)
        out.close()
        columns = list(zip(*out.done, strict=True)) or [()] * 6
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["task", "part", "path", "n_docs", "n_ids", "n_bytes"],
        )

    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    # The hash of the text spreads a key that very many rows share, as a null key may be.
    order = [F.col(key).asc_nulls_first(), F.xxhash64(text)]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order, text)
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, each with the number of ids in the files before it (`start`).

    The running sum is over one row for each file, not over documents.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _payload(record: bytes, where: str) -> bytes:
    size = record[:8]
    if len(record) < 16 or CHECK.unpack(record[8:12])[0] != masked(size):
        raise DamagedRecord(f"{where}: damaged length")
    n = LENGTH.unpack(size)[0]
    payload, check = record[12 : 12 + n], record[12 + n : 16 + n]
    if len(payload) != n or len(check) != 4 or CHECK.unpack(check)[0] != masked(payload):
        raise DamagedRecord(f"{where}: damaged payload")
    return payload


def _next(f, where: str) -> bytes:
    """The next record of an open file, its length verified before it is trusted."""
    size = f.read(12)
    if len(size) < 12 or CHECK.unpack(size[8:])[0] != masked(size[:8]):
        raise DamagedRecord(f"{where}: damaged length")
    return size + f.read(LENGTH.unpack(size[:8])[0] + 4)


def _entries(path: str, rows: int):
    """Blocks of (key, path, offset, bytes) from an index file."""
    fs, plain = open_folder(f"{path}.idx")
    with fs.open_input_stream(plain) as f:
        while data := f.read(ENTRY.size * rows):
            yield [(k if has else None, path, o, n) for k, has, o, n in ENTRY.iter_unpack(data)]


def _header(f, where: str):
    head = f.read(HEADER.size)
    if len(head) < HEADER.size or head[:8] != MAGIC:
        raise DamagedRecord(f"{where}: not a record file")
    _, width, _ = HEADER.unpack(head)
    return np.dtype(f"<u{width}")


def _split(payload: bytes, dtype):
    has, key = KEY.unpack(payload[: KEY.size])
    return key if has else None, np.frombuffer(payload[KEY.size :], dtype)


#: Most tasks that read files at a time.
READERS = 10_000
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
READ_TYPES = [pa.int64()] * 4
READ_NAMES = ["doc_id", "start", "n_tokens", "ids_crc32"]


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record, from the files: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers). Every checksum is verified.
    """

    def run(batches):
        for batch in batches:
            for path, n_docs, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                fs, plain = open_folder(f"{path}.rec")
                rows = []
                with fs.open_input_stream(plain, buffer_size=1 << 20) as f:
                    dtype = _header(f, path)
                    for _ in range(n_docs):
                        key, ids = _split(_payload(_next(f, path), path), dtype)
                        rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 5000:
                            yield _batch(rows, READ_TYPES, READ_NAMES)
                            rows = []
                    if f.read(1):
                        raise DamagedRecord(f"{path}: more records than listed")
                yield _batch(rows, READ_TYPES, READ_NAMES)

    return _dealt(read_manifest(spark, folder).select("path", "n_docs", "start")).mapInArrow(run, READ)


def _dealt(files: DataFrame) -> DataFrame:
    """Files dealt over as many tasks as there are files, up to READERS; a given number is not merged again at run time."""
    tasks = min(max(files.count(), 1), READERS)
    return files.repartitionByRange(tasks, "path")


def _batch(rows, types, names):
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record, from the index files alone: doc_id, path, offset, n_bytes."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for rows in _entries(path, 5000):
                    yield _batch(
                        rows,
                        [pa.int64(), pa.string(), pa.int64(), pa.int64()],
                        ["doc_id", "path", "offset", "n_bytes"],
                    )

    files = _dealt(read_manifest(spark, folder).select("path"))
    return files.mapInArrow(run, "doc_id long, path string, offset long, n_bytes long")


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """(doc_id, ids) in an order that only the seed and the records decide, each record read at its offset."""

    def run(batches):
        opened: dict[str, tuple] = {}
        try:
            for batch in batches:
                rows = []
                for path, offset, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if path not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened)))[0].close()
                        fs, plain = open_folder(f"{path}.rec")
                        f = fs.open_input_file(plain)
                        opened[path] = (f, _header(f, path))
                    f, dtype = opened[path]
                    key, ids = _split(_payload(f.read_at(n, offset), path), dtype)
                    rows.append((key, ids.astype(np.int64)))
                yield _batch(rows, [pa.int64(), pa.list_(pa.int64())], ["doc_id", "ids"])
        finally:
            for f, _ in opened.values():
                f.close()

    index = read_index(spark, folder)
    dealt = index.repartitionByRange(F.xxhash64(F.lit(seed), "path", "offset"))
    ordered = dealt.sortWithinPartitions(F.xxhash64(F.lit(seed), "path", "offset"))
    return ordered.select("path", "offset", "n_bytes").mapInArrow(run, "doc_id long, ids array<long>")
