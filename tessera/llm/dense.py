"""Vectors of Arrow batches as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

#: Integer components beyond are taken as this: the squared distance of two vectors of 64 still fits a long.
LARGEST = 1 << 27


def vectors(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vector has ``length`` components, none of them null or non-finite, and these as doubles."""
    rows = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == length)
    flat = pc.fill_null(pc.cast(column.values, pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    first = column.offsets.to_numpy()[rows].astype(np.int64)
    found = flat[first[:, None] + np.arange(length)] if len(rows) else np.empty((0, length))
    good = np.isfinite(found).all(1)
    return rows[good], found[good]


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as 64-bit integers, for a scale that is a power of two."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * float(scale)), -LARGEST, LARGEST).astype(np.int64)


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A row of the matrix as a list each."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).reshape(-1), kind))


def runs(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, size):
        yield batch.slice(k, size)


def kind_of(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def schema(**kinds: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


def many(kind: DataType) -> ArrayType:
    return ArrayType(kind)


def usual_length(df: DataFrame, vector: str, parts: int = 1) -> int:
    """The most frequent length that ``parts`` divides (of several, the largest), 0 without vectors."""
    size = F.size(vector)
    sizes = df.where(F.col(vector).isNotNull()).select(size.alias("size")).where((F.col("size") > 0) & (F.col("size") % parts == 0))
    found = sizes.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return found[0]["size"] if found else 0
