"""What the operators of this subpackage share: tables, shared storage, Arrow helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = "4m"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``. Only a local master may leave it unset: then a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tierflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found if "://" in found else found.replace("file:", "file://", 1) if found.startswith("file:") else "file://" + found


def bounded(spark: SparkSession) -> None:
    """Bounds the bytes of Arrow batches, so that long rows stay small in the buffers of JVM and Python; results don't change."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def rows_of(docs: DataFrame, *extra: str) -> DataFrame:
    """(doc_id long, text string) of the documents that an operator reads in Arrow batches, and the ``extra`` columns."""
    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)


class Workspace:
    """Written tables of one operator call in the shared folder: they cut lineage and outlive a lost executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.uri = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes and reads back a table."""
        bounded(self.spark)
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Deletes tables that no returned plan reads."""
        jvm = self.spark._jvm
        for name in names:
            at = jvm.org.apache.hadoop.fs.Path(self.path(name))
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI in the shared folder; works on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def one_thread() -> None:
    """Keeps numpy's matrix products of this worker on one thread: a task has one core, and waiting threads would burn others."""
    for path in Path(np.__file__).parents[1].glob("numpy.libs/*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, row offsets) of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if col.buffers()[2] is None else np.frombuffer(col.buffers()[2], np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def row_chunks(offs: np.ndarray, most: int = 1 << 20):
    """Row ranges of at most ``most`` bytes; a longer row stands alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column of consecutive runs of ``values``."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def crc_mod(col, n: int):
    """crc32 of the id as text, modulo n: the folds of the contracts."""
    return F.crc32(F.encode(F.coalesce(col.cast("string"), F.lit("")), "UTF-8")) % n
