"""Helpers of the package: written intermediate tables and the driver's tables."""

from __future__ import annotations

from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources.tables import table

__all__ = ["discard", "marked", "marks", "stored", "table"]

#: Spark deletes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` under the shared checkpoint folder and reads it again: the lineage ends there, the
    files outlive a lost executor, the planner knows their size, and the shuffle files of the step are deleted."""
    spark: SparkSession = df.sparkSession
    path, was = scratch_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``stored`` returned, once all that is made of them is written."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop(t))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: 64-bit words of a table of marks: of fixed size, 8 MB.
MARKS = 1 << 20


def _places(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of hashes: 64-bit integers, or binary of at least 8 bytes, none null."""
    if pa.types.is_binary(keys.type):
        h = np.frombuffer(b"".join([k[:8] for k in keys.to_pylist()]), "<u8")
    else:
        h = keys.to_numpy().view(np.uint64)
    return (h >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64), np.uint64(1) << (h & np.uint64(63))


def marks(df: DataFrame, key: str) -> np.ndarray:
    """A bit for the hashes of ``key``: those without one don't occur in ``df``, some with one may not either.
    So rows that surely meet none need not be moved to a join; the join itself decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(MARKS, np.uint64)
        for b in batches:
            np.bitwise_or.at(bits, *_places(b.column(0)))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], names=["word", "bits"])

    words = df.select(key).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(MARKS, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def marked(bits: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Which of the hashes have a bit."""
    word, bit = _places(keys)
    return (bits[word] & bit) != 0
