"""Blocks: rows packed into compressed pieces of a few MB, so that one task can combine what many rows share
before anything is shuffled, and so that whole texts move between tasks compressed.

``pack`` gives (block, payload) rows and checkpoints them, so a block's number and content stay the same
however often executors are lost. ``replies`` joins answers, addressed to blocks, back to them."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.textbytes import groups
from lakeops.session import ensure_checkpoint_dir, release_paths, scratch_path

BLOCK_BYTES = 4 << 20
_ZSTD = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
#: While a step is stored: its shuffle files go as soon as it is written, and batches sent to Python hold few of these
#: rows, which are blocks, messages and sets of up to some MB (without a limit in bytes, 10,000 of them).
STEP_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def to_bytes(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=_ZSTD) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def from_bytes(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as reader:
        return reader.read_next_batch()


def rows_of(batches):
    """Rows as tuples, one at a time: a batch holds many blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column.slice(i, 1).to_pylist()[0] for column in batch.columns)
    release()


def release() -> None:
    """Gives freed memory back to the system, at the end of a task: the same Python process serves the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pack_sorted(values: np.ndarray) -> np.ndarray:
    """Differences of sorted 64-bit values, byte planes apart: the high planes are zeros and compress away."""
    step = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).reshape(-1)


def unpack_sorted(planes: np.ndarray) -> np.ndarray:
    step = np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64)
    return np.cumsum(step, dtype=np.uint64)


def columns_to_bytes(**columns: np.ndarray) -> bytes:
    """Arrays of any lengths, by name."""
    arrays = [pa.array([c], pa.list_(pa.from_numpy_dtype(c.dtype))) for c in columns.values()]
    return to_bytes(pa.RecordBatch.from_arrays(arrays, list(columns)))


def columns_from_bytes(payload: bytes) -> dict[str, np.ndarray]:
    batch = from_bytes(payload)
    return {name: batch.column(i).values.to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}


def _packed(batches, size_column: int, block_bytes: int):
    task, number = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0

    def row():
        nonlocal held, size, number
        table = pa.Table.from_batches(held).combine_chunks()
        batch = table.to_batches()[0]
        out = pa.RecordBatch.from_arrays([pa.array([(task << 32) | number], pa.int64()), pa.array([to_bytes(batch)], pa.binary())], ["block", "payload"])
        held, size, number = [], 0, number + 1
        return out

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(size_column)), 0).to_pylist()
        for lo, hi in groups(sizes, block_bytes // 4):
            held.append(batch.slice(lo, hi - lo))
            size += sum(sizes[lo:hi])
            if size >= block_bytes * 3 // 4:
                yield row()
    if sum(b.num_rows for b in held):
        yield row()
    release()


def pack(df: DataFrame, text: str, keep=lambda t: t.checkpoint(), scale: int = 1) -> DataFrame:
    """(block, payload): all columns of ``df`` in blocks of about ``scale`` times ``BLOCK_BYTES`` of text; a longer text
    is one block. ``keep`` stores them."""
    ensure_checkpoint_dir(df.sparkSession)
    at, block_bytes = df.columns.index(text), scale * BLOCK_BYTES
    return keep(df.mapInArrow(lambda batches: _packed(batches, at, block_bytes), "block long, payload binary"))


def replies(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """(block, payload, answers): every block with the array of its answers' payloads, empty if it has none.
    A block has one answer per bucket at most, so the array is bounded by the number of buckets."""
    mine = answers.groupBy("block").agg(F.collect_list("payload").alias("answers"))
    return blocks.join(mine, "block", "left")


def bucket_count(blocks: DataFrame) -> int:
    """Buckets for what blocks scatter: so many that a bucket gathers about what two blocks send."""
    return -(-blocks.count() // 2) or 1


@contextmanager
def step_settings(spark):
    """``STEP_SETTINGS`` for what runs inside; the session's own settings come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in STEP_SETTINGS}
    for name, value in STEP_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class Store:
    """Tables written for one computation in the shared scratch folder, and read back: lost executors repeat single
    steps, and plans start afresh (a checkpoint would carry the constraints of all earlier steps along)."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, "step"))
        with step_settings(self.spark):
            df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def result(self, df: DataFrame) -> DataFrame:
        """``df``, written; everything kept before is deleted."""
        done, self.paths = self.paths, []
        out = self.keep(df)
        release_paths(self.spark, done)
        return out
