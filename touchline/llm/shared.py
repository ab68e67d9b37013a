"""Shared by the operators: tables, intermediate results, and code that travels to the tasks."""

from __future__ import annotations

import ctypes
import pickle
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def ship(module: str) -> None:
    """Send a module's functions to the tasks by value: executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast a model of proven size; its classes travel along."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpack(sent: Broadcast):
    return pickle.loads(sent.value)


def release() -> None:
    """Return freed memory of this process to the system, which Arrow and C would keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` that ends by returning freed memory to the system.

    A Python worker outlives its task and would hold the most that any task took, also while tasks
    without Python run beside it.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; a session without one (tests) gets a folder of its own."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = sc.getCheckpointDir()
    return root


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors.

    Floats and ids take the space of their Parquet encoding, so this is smaller than ``checkpoint``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/touchline-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32(doc_id as text) mod divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, end to end, and the ``n + 1`` places where they meet. NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_pieces(batches: Iterator[pa.RecordBatch], limit: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not len(batch):
            continue
        offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < len(batch):
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(batch))
            yield batch.slice(at, to - at)
            at = to


ship(__name__)
