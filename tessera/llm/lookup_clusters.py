"""Centroid clustering of integer vectors with scalar lookup tables.

A component becomes an integer, so a dimension has few values.  A task keeps, for each dimension, a table of the
squared differences between every value that occurred in it and every centroid: a vector's distances are then sums of
rows of these tables (gathers), without a multiplication per vector.  The tables of a round are made when a value
first occurs; they hold at most ``MOST`` values of a dimension besides those of the batch at hand, so that vectors
with any number of values take a bounded memory and give the same distances.

A round is one pass over the written integer vectors: each task sends a count and a sum vector per cluster, Spark
adds them, and the driver gets ``k`` rows.  Sums, floors and distances are exact integers, so the result doesn't depend
on the partitions.

Defined cases: rows whose vector is null, of another length, or with a null or non-finite component are left out.
Rows with a null or repeated key are clustered like others; such rows become starting centroids last, or in the order
of their vectors.  With fewer than ``k`` vectors there are as many clusters as vectors.  An integer beyond 2^27 counts
as 2^27, and an inertia that no long holds is null.  Columns other than the key's and the vector's are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from tessera.llm.dense import kind_of, lists, runs, schema, vectors, whole
from tessera.llm.shared import stored

#: Vectors that are measured at once, and values of a dimension that a task's tables keep.
RUN, MOST = 4096, 4096


class Tables:
    """The squared differences of each dimension's occurring values to each centroid."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.values = [np.empty(0, np.int64)] * centroids.shape[1]
        self.squares = [np.empty((0, len(centroids)), np.int64)] * centroids.shape[1]

    def places(self, d: int, column: np.ndarray) -> np.ndarray:
        """The rows of dimension d's table for these values; new values get rows."""
        values = self.values[d]
        place = np.searchsorted(values, column)
        if len(column) and (not len(values) or (values[np.minimum(place, len(values) - 1)] != column).any()):
            new = np.unique(column)
            values = self.values[d] = new if len(values) > MOST else np.union1d(values, new)
            self.squares[d] = (values[:, None] - self.centroids[None, :, d]) ** 2
            place = np.searchsorted(values, column)
        return place

    def distances(self, x: np.ndarray) -> np.ndarray:
        """(vectors, centroids): squared distances."""
        total = np.zeros((len(x), len(self.centroids)), np.int64)
        for d in range(x.shape[1]):
            place = self.places(d, x[:, d])  # may add rows to the table
            total += self.squares[d][place]
        return total


def nearest(tables: Tables, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's cluster, the smaller number of equally near ones, and squared distance."""
    found = tables.distances(x)
    cluster = found.argmin(1)
    return cluster, found[np.arange(len(x)), cluster]


def integers(df: DataFrame, key: str, vector: str, length: int, scale: int) -> DataFrame:
    """(key, v): the vectors that take part, as integers."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = vectors(batch.column(1), length)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists(whole(x, scale), pa.int32())], ["key", "v"])

    return df.select(key, vector).mapInArrow(convert, schema(key=kind_of(df, key), v=ArrayType(IntegerType())))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length).astype(np.int64)


def sums(ints: DataFrame, centroids: np.ndarray) -> list:
    """(cluster, n, total of each dimension) of each cluster with vectors."""
    k, length = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, n, total = Tables(centroids), np.zeros(k, np.int64), np.zeros((k, length), np.int64)
        for batch in batches:
            for run in runs(batch, RUN):
                x = matrix(run.column(0), length)
                cluster, _ = nearest(tables, x)
                n += np.bincount(cluster, minlength=k)
                np.add.at(total, cluster, x)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used]), lists(total[used], pa.int64())], ["cluster", "n", "total"])

    parts = ints.select("v").mapInArrow(add, schema(cluster=IntegerType(), n=LongType(), total=ArrayType(LongType())))
    each = F.array(*[F.sum(F.col("total")[d]) for d in range(length)])
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), each.alias("total")).collect()


def fit(ints: DataFrame, length: int, k: int, rounds: int, seed: int) -> np.ndarray:
    """The final centroids, at most ``k``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    start = ints.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in start], np.int64).reshape(len(start), length)
    for _ in range(rounds if len(start) else 0):
        moved = centroids.copy()
        for r in sums(ints, centroids):
            moved[r["cluster"]] = [t // r["n"] for t in r["total"]]
        centroids = moved
    return centroids


def assign(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(key, cluster, distance) of each vector."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(centroids)
        for batch in batches:
            for run in runs(batch, RUN):
                cluster, distance = nearest(tables, matrix(run.column(1), centroids.shape[1]))
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], ["key", "cluster", "distance"])

    return ints.mapInArrow(label, schema(key=kind_of(ints, "key"), cluster=IntegerType(), distance=LongType()))


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", length: int = 64, scale: int = 64, k: int = 16,
            rounds: int = 3, seed: int = 1) -> DataFrame:
    """(key, cluster, distance, n, cluster_inertia, inertia, centroid) of each vector; the key keeps its name.

    Components are floor(scale * x).  The ``k`` vectors whose key has the smallest SHA-256 of ``seed:key`` start as
    centroids; each round assigns all vectors and moves the centroids to the floors of the means.
    """
    spark = df.sparkSession
    ints = stored(integers(df, key, vector, length, scale), "integer-vectors")
    centroids = fit(ints, length, k, rounds, seed)
    totals = "cluster int, n long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return ints.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(spark.createDataFrame([], totals), "cluster").withColumnRenamed("key", key)
    found = stored(assign(ints, centroids), "clusters")
    each = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    fits = lambda x: x if x < 1 << 63 else None
    inertia = sum(int(r["s"]) for r in each)
    rows = [(r["cluster"], r["n"], fits(int(r["s"])), fits(inertia), centroids[r["cluster"]].tolist()) for r in each]
    named = spark.createDataFrame(rows, totals)  # a row per cluster
    return found.join(F.broadcast(named), "cluster").select(F.col("key").alias(key), "cluster", "distance", "n", "cluster_inertia", "inertia", "centroid")

