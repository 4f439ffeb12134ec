"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brinkcast.session import bounded_batches  # noqa: F401 - operators take it from here


#: What operators keep in a worker process between their tasks: {operator: {key: value}}.
_KEPT: dict[str, dict] = {}


def begin(operator: str) -> None:
    """Start of a task: a worker process serves the tasks of many operators in turn, so
    what others kept in it goes, and memory that is free returns to the machine."""
    for other in set(_KEPT) - {operator}:
        del _KEPT[other]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def kept(operator: str, key: str, make: Callable[[], object]):
    """``make()``, once a worker process as long as only tasks of ``operator`` run there."""
    mine = _KEPT.setdefault(operator, {})
    if key not in mine:
        mine[key] = make()
    return mine[key]


def chunks(batch: pa.RecordBatch, sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose ``sizes`` add up to about ``most``; a larger
    row has a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def slices(batches: Iterable[pa.RecordBatch], column: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts (string or binary) of ``column`` take about ``most``
    bytes, which bounds the Python objects made of them."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for a, b in chunks(batch, sizes, most):
            yield batch.slice(a, b - a)


def with_columns_schema(df: DataFrame, extra: dict[str, T.DataType]) -> tuple[DataFrame, T.StructType]:
    """``df`` without the columns that ``extra`` names (any case), and the schema with them."""
    taken = {name.lower() for name in extra}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
    return kept, T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in extra.items()]])


def runs_of(batches: Iterable[pa.RecordBatch], key: int, found: Callable[[list[tuple]], Iterator]) -> Iterator:
    """What ``found(rows)`` yields for each run of rows with one value in column ``key``."""
    held, value = [], None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and row[key] != value:
                yield from found(held)
                held = []
            value = row[key]
            held.append(row)
    if held:
        yield from found(held)
