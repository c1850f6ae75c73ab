"""Helpers the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Rows of a batch that are in work at once where each row is worked on alone. Bounds memory only.
PIECE_ROWS = 1000
#: Bytes of an Arrow batch that a task hands to Python, unless one row is longer. A task has a batch outside the
#: executor's heap and in its Python worker at once. Bounds memory only.
BATCH_BYTES = 4 << 20
BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores before it until no column of the table is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Bytes at or above 0x80 belong to letters of other scripts and stay.
def byte_table(keep: Callable[[int], bool]) -> bytes:
    """Translation of UTF-8 bytes: A-Z to a-z, bytes that `keep` rejects to a space."""
    lowered = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if keep(b) else 32 for b in lowered)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a string column, NULL as the empty text."""
    return [x or "" for x in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column behind each other, and where each begins (and the last
    ends). NULL is an empty text."""
    column = pc.fill_null(column, "")
    if column.type == pa.large_string():
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(places, kind, count=column.offset + len(column) + 1)[column.offset:].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a Spark DDL string, for batches built inside tasks."""
    kinds = {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.FloatType: pa.float32(),
        T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(),
    }

    def kind(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(kind(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([(f.name, kind(f.dataType)) for f in t.fields])
        return kinds[type(t)]

    return pa.schema([(f.name, kind(f.dataType)) for f in T.StructType.fromDDL(ddl).fields])


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """From now on, the session's Arrow batches have about `size` bytes at most. A bound that the session was
    given already stays."""
    if BYTES_PER_BATCH not in spark.conf.getAll:
        spark.conf.set(BYTES_PER_BATCH, size)


def pieces(batches: Iterable[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, at most `rows` at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def released(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last, memory that is free goes back to the system, as Python workers stay
    for later tasks."""
    yield from made
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict[str, list] | None]], ddl: str
) -> DataFrame:
    """mapInArrow over functions that yield columns as a dict of lists or Arrow arrays."""

    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            if columns is not None:
                arrays = [
                    columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
                    for f in schema
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(lambda batches: released(run(batches)), ddl)


def with_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], ddl: str) -> DataFrame:
    """The table and new columns that `fn` computes from each Arrow batch."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            new = fn(batch)
            arrays = [new[f.name] if isinstance(new[f.name], pa.Array) else pa.array(new[f.name], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *schema.names])

    return df.mapInArrow(lambda batches: released(run(batches)), T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields]))
