"""Approximate nearest neighbours by cosine: collision counting over sorted single projections.

The rows are written as shards.  A shard holds, for each of ``LINES`` random lines, its unit vectors' projections in
sorted order and the rows in that order.  A query opens a window around its own projection on every line, and counts
in how many windows a row lies.  Virtual rehashing: the windows of the next of ``RADII`` are wider, and only the rows
between the old and the new borders are counted.  A row with ``COLLISIONS`` or more collisions is verified once by
its exact cosine.  A query stops at the first radius within which k verified rows lie.

A window reaches ``REACH`` x radius to both sides, so a row within the radius collides on a line with probability
erf(REACH / sqrt 2) = 0.683 whatever the data are (projections of a difference are normal), and ``COLLISIONS`` is set so that
it is verified with a probability of 0.975 or more: the expected recall is at least that.  The number of rows to verify
has no limit, and the last radius verifies all rows that are left, so a query finds k rows whenever there are k.

The query set is met with all shards in blocks (each shard's own queries are one).  While a shard is made, its queries
are searched in it.  A row's need is the radius at which it is both verified and within reach; the k-th smallest need
bounds the query's radius, and in the other shards its windows open to that radius at once.  Each shard answers with rows
and their needs; the query's final radius is the k-th smallest need of all shards, and rows that need more don't count.
So the result doesn't depend on how the rows are dealt out.  Spark broadcasts the queries only if it measures them to be
small.

Defined cases: vectors that are null, zero, hold a null or non-finite component, or haven't the most frequent length take
no part, as queries or candidates.  A query's own row is left out, other rows with its key aren't.  Equal scores go by
key, null keys last.  Columns other than the key's and the vector's are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType

from tessera.llm.dense import kind_of, runs, schema, usual_length, vectors
from tessera.llm.shared import stored

#: Rows of a shard, lines, reach of a window in radii, chance that a row within the radius is verified.
SHARD, LINES, REACH, SURE = 4096, 128, 1.0, 0.975


def threshold(lines: int, reach: float, sure: float) -> int:
    """The largest number of collisions that a row at the radius's distance reaches with probability ``sure``."""
    p = erf(reach / sqrt(2))
    tail = 0.0
    for n in range(lines, -1, -1):
        tail += comb(lines, n) * p**n * (1 - p) ** (lines - n)
        if tail >= sure:
            return n
    return 0


COLLISIONS = threshold(LINES, REACH, SURE)
#: Distances of unit vectors, in growing steps; the last one verifies all rows.
RADII = [0.2 * 1.2**n for n in range(14)] + [float("inf")]


@lru_cache(maxsize=4)
def lines(length: int) -> np.ndarray:
    """(line, position): normal directions, the same in every task."""
    return np.random.default_rng(20260101).standard_normal((LINES, length))


def normal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-zero rows, scaled by powers of two so that their squares neither overflow nor vanish; their norms."""
    most = np.abs(x).max(1, initial=0)
    rows = np.flatnonzero(most > 0)
    _, power = np.frexp(most[rows])
    power = np.clip(power, -1000, 1000)
    scaled = np.where((np.abs(power) > 250)[:, None], np.ldexp(x[rows], -power[:, None]), x[rows])
    return rows, scaled, np.sqrt((scaled**2).sum(1))


def projections(x: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """(line, row): equal vectors get equal projections, in whatever batch they are (a matrix product's may differ)."""
    u = x / norms[:, None]
    return np.stack([(u * line).sum(1) for line in lines(x.shape[1])]).astype(np.float32)


class Shard:
    """Rows with sorted projections; ``places`` orders the rows by key, for ties."""

    def __init__(self, x: np.ndarray, norms: np.ndarray, values: np.ndarray, order: np.ndarray, places: np.ndarray):
        self.x, self.norms, self.values, self.order, self.places = x, norms, values, order.astype(np.int64), places
        self.seen = np.empty_like(values)  # (line, row)
        np.put_along_axis(self.seen, self.order, values, 1)

    @classmethod
    def build(cls, x: np.ndarray, norms: np.ndarray, places: np.ndarray) -> Shard:
        seen = projections(x, norms)
        order = np.argsort(seen, axis=1, kind="stable")
        return cls(x, norms, np.take_along_axis(seen, order, 1), order, places)

    def packed(self) -> list[bytes]:
        return [self.x.tobytes(), self.norms.tobytes(), self.values.tobytes(), self.order.astype(np.uint16).tobytes(), self.places.astype(np.uint16).tobytes()]

    @classmethod
    def read(cls, packed: list[bytes]) -> Shard:
        norms = np.frombuffer(packed[1])
        n = len(norms)
        return cls(np.frombuffer(packed[0]).reshape(n, -1), norms, np.frombuffer(packed[2], np.float32).reshape(LINES, n),
                   np.frombuffer(packed[3], np.uint16).reshape(LINES, n), np.frombuffer(packed[4], np.uint16))

    def borders(self, seen: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, query, radius): where each window begins and ends in the sorted arrays."""
        low = np.stack([np.searchsorted(v, at[:, None] - reach, "left") for v, at in zip(self.values, seen)])
        return low, np.stack([np.searchsorted(v, at[:, None] + reach, "right") for v, at in zip(self.values, seen)])

    def counted(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many of these windows (a begin and an end by line) each row lies; of a window with more than half of
        the rows, the others are counted."""
        n, wide = len(self.norms), high - low > len(self.norms) // 2
        inside = [self.order[i, low[i] : high[i]] for i in np.flatnonzero(~wide)]
        outside = [part for i in np.flatnonzero(wide) for part in (self.order[i, : low[i]], self.order[i, high[i] :])]
        count = lambda parts: np.bincount(np.concatenate(parts), minlength=n) if parts else 0
        return np.full(n, wide.sum()) + count(inside) - count(outside)

    def distances(self, rows: np.ndarray, q: np.ndarray, norm: float, within: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the rows that lie within this distance, with score and distance."""
        rows = rows[self.x[rows] @ q >= ((1 - within**2 / 2) - 1e-9) * self.norms[rows] * norm] if within < 2 else rows
        # Row by row, so that equal rows have equal scores, which a matrix product doesn't promise.
        score = (self.x[rows] * q).sum(1) / (self.norms[rows] * norm)
        far = np.sqrt(np.maximum(2 - 2 * score, 0))
        near = far <= within
        return rows[near], score[near], far[near]

    def needs(self, rows: np.ndarray, far: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The radius at which each row has ``COLLISIONS`` collisions with a query of these projections, or its distance if that is larger."""
        gaps = np.abs(self.seen[:, rows].astype(float) - at[:, None])
        return np.maximum(far, np.partition(gaps, COLLISIONS - 1, axis=0)[COLLISIONS - 1] / REACH)

    def expand(self, q: np.ndarray, norms: np.ndarray, k: int, own: np.ndarray) -> Iterator[float]:
        """The k-th smallest need of the rows of this shard for each query, one of its rows; infinite without k others."""
        seen = projections(q, norms)
        low, high = self.borders(seen, np.array(RADII, np.float32) * np.float32(REACH))
        for a in range(len(q)):
            open_ = np.ones(len(self.norms), bool)
            open_[own[a]] = False
            collisions, rows, far = 0, np.empty(0, int), np.empty(0)
            for at, radius in enumerate(RADII):
                if at:  # what lies between the old borders and the new ones
                    collisions = collisions + self.counted(low[:, a, at], low[:, a, at - 1]) + self.counted(high[:, a, at - 1], high[:, a, at])
                else:
                    collisions = self.counted(low[:, a, 0], high[:, a, 0])
                new = np.flatnonzero(open_ & (collisions >= COLLISIONS))
                open_[new] = False
                new, _, distance = self.distances(new, q[a], norms[a], np.inf)
                rows, far = np.concatenate([rows, new]), np.concatenate([far, distance])
                if (far <= radius).sum() >= k:
                    near = far <= radius
                    yield float(np.partition(self.needs(rows[near], far[near], seen[:, a]), k - 1)[k - 1])
                    break
            else:
                yield float("inf")

    def search(self, q: np.ndarray, norms: np.ndarray, k: int, own: np.ndarray, bound: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per query: places of rows, scores and needs, up to the bound; ``own``: the query's place in this shard or -1.
        A row that k others with a need no larger precede by score and key is left out: it can be in no result."""
        seen = projections(q, norms)
        # A hair wider than the bound, against rounding; the needs decide.
        reach = ((bound * (1 + 1e-5) + 1e-6) * REACH).astype(np.float32)
        low = np.stack([np.searchsorted(v, at - reach, "left") for v, at in zip(self.values, seen)])
        high = np.stack([np.searchsorted(v, at + reach, "right") for v, at in zip(self.values, seen)])
        for a in range(len(q)):
            rows = np.flatnonzero(self.counted(low[:, a], high[:, a]) >= COLLISIONS)
            rows, score, far = self.distances(rows[rows != own[a]], q[a], norms[a], bound[a])
            need = self.needs(rows, far, seen[:, a])
            some = need <= bound[a]
            yield self.best(rows[some], score[some], need[some], k)

    def best(self, rows: np.ndarray, score: np.ndarray, need: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((self.places[rows], -score))
        keep, needs = [], []
        for j in order:
            at = bisect_right(needs, need[j])
            if at < k:
                keep.append(j)
            needs.insert(at, need[j])
        return rows[keep], score[keep], need[keep]


def index(df: DataFrame, key: str, vector: str, asks: Column, length: int, k: int) -> DataFrame:
    """A row per shard: its number, keys, arrays, and its queries' places, bounds, vectors and norms."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for run in runs(batch, SHARD):
                rows, x = vectors(run.column(1), length)
                some, x, norms = normal(x)
                rows = rows[some]
                if not len(rows):
                    continue
                names = run.column(0).take(pa.array(rows))
                shard = Shard.build(x, norms, np.argsort(pc.sort_indices(names, null_placement="at_end").to_numpy()))
                asked = np.flatnonzero(run.column(2).to_numpy(zero_copy_only=False)[rows].astype(bool))
                bounds = list(shard.expand(x[asked], norms[asked], k, asked)) if len(asked) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), names), pa.array([shard.packed()], pa.list_(pa.binary())),
                     pa.array([asked.tolist()], pa.list_(pa.int32())), pa.array([bounds], pa.list_(pa.float64())), pa.array([x[asked].tobytes()], pa.binary()),
                     pa.array([norms[asked].tobytes()], pa.binary())],
                    ["shard", "keys", "arrays", "asked", "bounds", "vectors", "norms"])
                number += 1

    binary = BinaryType()
    kinds = schema(shard=LongType(), keys=ArrayType(kind_of(df, key)), arrays=ArrayType(binary), asked=ArrayType(IntegerType()),
                   bounds=ArrayType(DoubleType()), vectors=binary, norms=binary)
    return df.select(key, vector, F.coalesce(asks, F.lit(False))).mapInArrow(build, kinds)


def answers(shards: DataFrame, k: int) -> DataFrame:
    """(home, place, query, key, score, need): what each shard finds for each query; home and place name the query's row."""
    queries = shards.where(F.size("asked") > 0).select(
        F.col("shard").alias("home"), "asked", "bounds", F.transform("asked", lambda p: F.col("keys")[p]).alias("names"), "vectors", "norms")
    key = kind_of(shards, "keys").elementType

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, at = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                number, home = batch.column(0)[n].as_py(), batch.column(3)[n].as_py()
                if number != at:
                    read, at = Shard.read(batch.column(2)[n].as_py()), number
                places = batch.column(4)[n].values.to_numpy()
                norms = np.frombuffer(batch.column(8)[n].as_py())
                q = np.frombuffer(batch.column(7)[n].as_py()).reshape(len(norms), -1)
                own = places.astype(np.int64) if home == number else np.full(len(places), -1)
                found = list(read.search(q, norms, k, own, batch.column(5)[n].values.to_numpy()))
                who = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                if not len(who):
                    continue
                rows = np.concatenate([f[0] for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(who), home)), pa.array(places[who], pa.int32()), batch.column(6)[n].values.take(pa.array(who)), batch.column(1)[n].values.take(pa.array(rows)),
                     pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                    ["home", "place", "query", "key", "score", "need"])

    pairs = shards.select("shard", "keys", "arrays").crossJoin(queries)  # blocks of queries with shards of rows
    return pairs.mapInArrow(find, schema(home=LongType(), place=IntegerType(), query=key, key=key, score=DoubleType(), need=DoubleType()))


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", asks: Column | None = None, k: int = 5) -> DataFrame:
    """(query_id, rank, key, score): the k nearest rows found for each row for which ``asks`` holds (default: all)."""
    length = usual_length(df, vector)
    shards = stored(index(df, key, vector, F.lit(True) if asks is None else asks, length or 1, k), "shards")
    query = Window.partitionBy("home", "place")
    found = answers(shards, k).withColumn("_n", F.row_number().over(query.orderBy("need")))
    end = F.max(F.when(F.col("_n") <= k, F.col("need"))).over(query)
    found = found.withColumn("_end", end).where(F.col("need") <= F.col("_end"))
    rank = F.row_number().over(query.orderBy(F.desc("score"), F.col("key").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", F.col("key").alias(key), "score")
