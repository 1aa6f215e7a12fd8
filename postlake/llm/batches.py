"""Arrow batches inside a task: slices of bounded size, and memory handed back when a task ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes that one step holds; a longer single text is a step of its own.
STEP_BYTES = 1 << 21
#: Vocabularies and memos of a worker, kept between tasks until one that needs none of them runs there.
LOADED: dict = {}


def forget() -> None:
    """Empties LOADED; a nested function would see a copy of it."""
    LOADED.clear()


def release() -> None:
    """Hands memory that is free back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def steps(batch: pa.RecordBatch, column: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose texts have about `size` bytes together."""
    if not batch.num_rows:
        return
    at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, (at[start - 1] if start else 0) + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Strings of a column, null as empty; bytes that aren't UTF-8 are replaced."""
    values = pc.fill_null(batch.column(column), "")
    try:
        return values.to_pylist()
    except UnicodeDecodeError:
        return [x.decode("utf-8", "replace") for x in values.cast(pa.binary()).to_pylist()]


def joined(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, a line feed after each, and where each starts (one more entry than rows)."""
    raw = batch.column(column)
    raw = raw.cast(pa.large_binary())
    raw = pc.fill_null(raw, b"")
    ended = pc.binary_join_element_wise(raw, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    if isinstance(ended, pa.ChunkedArray):
        ended = ended.combine_chunks()
    at = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
    if not len(ended):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(ended.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each list."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))


def in_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str, loads: bool = False) -> DataFrame:
    """df through run(record batches of a task) -> record batches. loads: run keeps something in LOADED.

    Spark bounds a batch by bytes (spark.sql.execution.arrow.maxBytesPerBatch). Workers live on between tasks, so each task hands
    back what it freed, and one that loads nothing empties LOADED first.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loads:
            forget()
        yield from run(batches)
        release()

    return df.mapInArrow(tidy, schema)


def map_batches(df: DataFrame, step: Callable, schema: T.StructType | str, text: str, size: int = STEP_BYTES) -> DataFrame:
    """df through step(record batch of about `size` text bytes) -> record batch, in Arrow batches inside Spark's tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text, size):
                yield step(part)

    return in_batches(df, run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it until no column of df has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
