"""Clean vectors for the two embedding operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_kind(df: DataFrame, vector_col: str = "embedding") -> str:
    """'<f4' for vectors of floats, else '<f8': what holds the numbers as they are."""
    return "<f4" if df.schema[vector_col].dataType.elementType == T.FloatType() else "<f8"


def _packed(column: pa.ListArray, kind: str) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)  # null numbers become NaN
    values = values + values.dtype.type(0)  # no negative zero
    ends = np.cumsum(sizes)
    odd, some = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0))
    good = (odd[ends] == odd[ends - sizes]) & (some[ends] > some[ends - sizes])
    offsets = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int64)
    packed = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
    return pc.if_else(pa.array(good), packed.cast(pa.binary()), pa.scalar(None, pa.binary()))


def packed_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors as packed numbers of their kind; null where one is null, zero, or holds null or non-finite numbers."""
    kind = number_kind(df, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(batch.column(1), kind)], names=["vec_id", "v"])

    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("e")).mapInArrow(run, "vec_id long, v binary")


def widths(vectors: DataFrame) -> dict[int, int]:
    """How many vectors there are of each number of bytes. Only vectors of one length can be compared, so each is a table of its own."""
    rows = vectors.filter("v is not null").groupBy(F.length("v").alias("n")).count().collect()  # a row for each length
    return {r.n: r["count"] for r in sorted(rows, key=lambda r: r.n)}


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind: str) -> np.ndarray:
    """Packed vectors of `width` bytes, none null, as the rows of a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    dims = width // np.dtype(kind).itemsize
    if not len(column):
        return np.zeros((0, dims))
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], kind, len(column) * dims, int(first)).astype(np.float64).reshape(-1, dims)
