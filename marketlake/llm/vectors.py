"""Vectors in numpy blocks, and sums of arrays that tasks hold in part."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows of one numpy block.
BLOCK = 4096


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``BLOCK`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def by_length(lists: pa.ListArray, scale: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, x) for each length of vector in an Arrow list column: the places of its valid rows
    and their entries as whole steps ``floor(scale * entry)``, a row each (int64).

    Valid is a vector that is not null or empty and holds no null, no non-finite entry and none of
    ``limit`` steps or more on either side of zero."""
    starts, ends = (np.asarray(lists.offsets)[s] for s in (slice(None, -1), slice(1, None)))
    base = starts[0] if len(starts) else 0
    flat = lists.values.slice(base, (ends[-1] - base) if len(ends) else 0).cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # null entries come as NaN
    sizes = np.where(np.asarray(lists.is_valid()), ends - starts, 0)
    for size in np.unique(sizes[sizes > 0]):
        places = np.flatnonzero(sizes == size)
        raw = values[(starts[places] - base)[:, None] + np.arange(size)]
        with np.errstate(over="ignore", invalid="ignore"):
            steps = np.floor(raw * scale)
            good = (np.abs(steps) < limit).all(1)
        yield places[good], steps[good].astype(np.int64)


def packed(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    x = np.ascontiguousarray(x)
    width = x.itemsize * (x.shape[1] if x.ndim > 1 else 1)
    offsets = pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(x.tobytes())])


def unpacked(column: pa.Array, dtype: type, dims: int) -> np.ndarray:
    """The matrix of a column that :func:`packed` wrote, all of ``dims`` entries."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dims)


def added_up(partials: DataFrame, dtype: type) -> list[tuple[int, np.ndarray]]:
    """The sums of ``value`` (packed rows) by ``key`` (int) over all tasks, on the driver: as many rows
    as there are keys, which the caller bounds. ``partials`` has a row per task and key; they
    are added one by one as they arrive, so no group is ever gathered."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = np.frombuffer(value, dtype)
                sums[key] = sums[key] + row if key in sums else row
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([sums[k].tobytes() for k in keys], pa.binary())], names=["key", "value"])

    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("value", T.BinaryType())])
    total = partials.select("key", "value").repartition("key").mapInArrow(add, schema)
    return sorted((r.key, np.frombuffer(bytes(r.value), dtype)) for r in total.collect())
