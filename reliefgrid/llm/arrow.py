"""Helpers for operators that hand whole Arrow batches to Python tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from inspect import signature

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Text bytes that one step of a task holds at once; a longer single text is a step of its own.
STEP_BYTES = 2 << 20


def texts(batch: pa.RecordBatch, column: str | int) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    values = batch.column(column)
    return values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()).to_pylist()


def steps(batches: Iterator[pa.RecordBatch], column: str | int, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece stay near ``most`` bytes."""
    for batch in batches:
        begin = size = 0
        for i, v in enumerate(batch.column(column)):
            n = v.as_buffer().size if v.is_valid else 0
            if size and size + n > most:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def release() -> None:
    """Give freed memory back to the system; Python workers live on from task to task and keep it else."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(fn: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``fn`` of a group's table, or of two arguments, which gives back what it has freed."""

    def run(table):
        try:
            return fn(table)
        finally:
            release()

    def run_two(first, second):
        try:
            return fn(first, second)
        finally:
            release()

    return run if len(signature(fn).parameters) == 1 else run_two


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores before it where the caller's columns hold it already."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name = f"_{name}"
    return name


def append(rows: DataFrame, text: str, values: Callable[[list[bytes | None]], Sequence], name: str, kind: T.DataType) -> DataFrame:
    """All columns of ``rows`` and one more, made from the texts of each step of a batch; a column of that name raises an error."""
    if name.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"the input already has {name!r}")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, kind)])
    at = rows.columns.index(text)
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, at):
            made = pa.array(values(texts(batch, at)), arrow_kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    return rows.mapInArrow(run, schema)
