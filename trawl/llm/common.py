"""Helpers of the operators: added columns in Arrow batches, task dictionaries, shared folders.

Rows pass through ``add_columns`` in batches and slices of bounded text size, so that one batch
of long texts doesn't decide how much memory a task needs.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trawl.operators.sizing import scratch_folder

SLICE_BYTES = 1 << 20
#: Bytes of rows that a task gathers for its Python worker, unless the session says how many. Spark's
#: own bound of 64 MB leaves most tasks one batch, held by the executor beside its heap and by the worker.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(frame: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the rows once to the shared folder and read them back. Lost executors cost
    no recomputation, and no later use evaluates the plan again."""
    path = scratch_folder(frame.sparkSession, name)
    frame.write.partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def slices(batch: pa.RecordBatch, sized: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows holding about ``limit`` bytes of column ``sized``; a longer value
    is a slice of its own."""
    column = batch.column(sized)
    if not len(column):
        return
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(column)]):
        yield batch.slice(start, end - start)


def add_columns(
    frame: DataFrame, fields: list[T.StructField], reads: list[str],
    start: Callable[[], Callable[..., list[pa.Array]]], drop: tuple[str, ...] = (),
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``frame`` with ``fields`` added. ``start`` is called once in each task; what it returns
    gets the columns ``reads`` of a slice (cut by the size of the first) and gives the new
    columns. An input column named like a new one is replaced; ``drop`` names others to leave out."""
    gone = {f.name.lower() for f in fields} | {c.lower() for c in drop}
    kept = [i for i, c in enumerate(frame.columns) if c.lower() not in gone]
    inputs = [_position(frame, c) for c in reads]
    schema = T.StructType([frame.schema.fields[i] for i in kept] + fields)

    def run(batches):
        step = start()
        try:
            for batch in batches:
                for part in slices(batch, inputs[0], limit):
                    made = step(*(part.column(i) for i in inputs))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(i) for i in kept] + made, names=schema.names)
        finally:
            del step
            give_back()

    bound_batches(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def bound_batches(spark) -> None:
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a task's Python worker for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _position(frame: DataFrame, name: str) -> int:
    names = [c.lower() for c in frame.columns]
    if name.lower() not in names:
        raise ValueError(f"no column {name}")
    return names.index(name.lower())


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values as one array, and where each value starts (one more at the end)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values out of one byte array and the values' byte offsets."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)],
    ).cast(pa.binary())


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[s : s + n]`` of all pairs, one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def ends_to_offsets(counts) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


class Numbers(dict):
    """Word to number; a word not yet seen gets the next one and is noted in ``new``."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, word):
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


class Growing:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.held, self.n = np.zeros(1024, dtype), 0

    def append(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            wider = np.zeros(max(2 * len(self.held), self.n + len(more)), self.held.dtype)
            wider[: self.n] = self.held[: self.n]
            self.held = wider
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.n]


def range_parts(frame: DataFrame, key: str, parts: int) -> Column:
    """The number, from 0 and in the order of ``key``, of the contiguous part a row is in; null
    keys are in part 0. Bounds are approximate percentiles, so parts are about equal."""
    shares = [i / parts for i in range(1, parts)]
    bounds = frame.agg(F.percentile_approx(key, shares, 20 * parts).alias("b")).first()["b"] if shares else []
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.lit(sorted(set(bounds))), lambda b: b < F.col(key)))
