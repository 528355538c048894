"""Small helpers for functions on Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Batches = Iterator[pa.RecordBatch]

# Text that is worked on at once inside a task; one longer text is taken alone.
SLICE_BYTES = 8 << 20


def give_back() -> None:
    """Return memory that is free inside the Python process to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The function, giving back its memory when a task ends: workers outlive tasks."""

    def inside(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()

    return inside


def released_after(run: Callable[[pa.Table], pa.Table], least: int = 1 << 20) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of a group, after groups of at least that many bytes."""

    def inside(group: pa.Table) -> pa.Table:
        found = run(group)
        if group.nbytes >= least:
            give_back()
        return found

    return inside


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; NULL counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about that much text each."""
    start, size = 0, 0
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def mapped(frame: DataFrame, run: Callable[[Batches], Batches], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name, dots and repeats included."""
    names = frame.columns
    inside = [f"c{i}" for i in range(len(schema))]

    run = released(run)

    def renamed(batches: Batches) -> Batches:
        for batch in run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=inside)

    plain = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(inside, schema, strict=True)])
    return frame.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, plain).toDF(*schema.names)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of the four kinds of columns as a batch."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])
