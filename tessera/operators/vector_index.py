"""A vector index for cosine neighbours (SP8 at scale): random-hyperplane bands, probed, with exact re-ranking.

A vector's side of a hyperplane is a bit, ``bits`` of them are its bucket in a band.  Two vectors at angle ``a`` share a
bit with probability ``1 - a/pi``.  A query looks in its own bucket and in those that differ in one bit, in each band;
``bands_needed`` gives the number of bands for a wanted recall at a wanted similarity.  Buckets and the queries that look
in them are joined as blocks (no query meets all vectors); of each block a query's best by exact cosine are left, made
distinct and ranked.  Neither side of that join is broadcast: queries have a copy for each bucket in which they look, some
hundred times what the planner knows of them.

Equal vectors would fill a bucket and can't be told apart by any band, so of each only the ``copies`` smallest keys are
rows of the index: no more of them can be among the first ``copies`` neighbours, as ties go by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import acos, ceil, log, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tessera.operators.vectors import as_double, best_of_blocks, top, unit
from tessera.session import scratch_path

#: Rows (times the buckets of a band in which each of them is) that a task holds to make blocks: in a bucket of 256, some 256.
RUN = 65_536
#: Rows that are worth a task of their own.
LEAST_RUN = 8_192
#: Rows of blocks that are handed on together, unless one block has more.
_BATCH = 8_192


def bands_needed(cosine: float, bits: int, recall: float) -> int:
    """Bands in which a vector of this cosine shares a probed bucket at least once with probability ``recall``."""
    p = 1 - acos(cosine) / pi
    hit = p**bits + bits * p ** (bits - 1) * (1 - p)
    return ceil(log(1 - recall) / log(1 - hit))


def planes(n: int, length: int, seed: int = 42) -> np.ndarray:
    """(plane, position): +1 or -1 by rule H, so that any engine with md5 gets the same planes."""
    bit = lambda p, d: int(hashlib.md5(f"{seed}:{p}:{d}".encode()).hexdigest()[:8], 16) % 2
    return np.array([[1.0 - 2 * bit(p, d) for d in range(length)] for p in range(n)])


def band_codes(vec: str, bits: int, bands: int, length: int, seed: int = 42) -> Column:
    """The bucket of each band, ``array<int>``; null for a vector that is null, holds a null or has another length.

    A matrix product per batch: as generated code it would be ``bits * bands * length`` terms a row.
    """
    normals = planes(bits * bands, length, seed).T
    weight = 1 << np.arange(bits)

    @F.pandas_udf("array<int>")
    def codes(vectors: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(vectors), dtype=object)
        good = [k for k, v in enumerate(vectors) if v is not None and len(v) == length and not pd.isna(v).any()]
        if good:
            above = np.stack([vectors.iloc[k] for k in good]).astype(float) @ normals >= 0
            for k, row in zip(good, (above.reshape(-1, bands, bits) * weight).sum(2)):
                found[k] = row.astype(np.int32)
        return found

    return codes(vec)


@dataclass
class VectorIndex:
    rows: DataFrame  # key, u (unit vector), codes
    key: str
    bits: int
    bands: int
    length: int
    copies: int
    seed: int


def build_index(df: DataFrame, key: str, vec: str, length: int, bits: int = 8, bands: int | None = None, cosine: float = 0.3,
                recall: float = 0.95, copies: int = 16, seed: int = 42) -> VectorIndex:
    """Writes the index of all vectors to the shared folder.  ``bands``: by default those that give a neighbour of
    ``cosine`` this ``recall``.  Vectors that are null, hold a null, have another length or are zero aren't indexed."""
    spark = df.sparkSession
    bands = bands or bands_needed(cosine, bits, recall)
    same = Window.partitionBy("_v").orderBy(key)
    # Codes come first: a filter on them would be pushed below the window, and make them a second time.
    rows = df.select(key, F.col(vec).alias("_v")).withColumn("codes", band_codes("_v", bits, bands, length, seed)).where(F.col("codes").isNotNull())
    rows = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= copies).select(key, unit(as_double("_v")).alias("u"), "codes")
    path = scratch_path(spark, "vector-index")
    # A zero vector has no direction: its components are null.
    rows.where(F.get("u", F.lit(0)).isNotNull()).write.parquet(path)
    return VectorIndex(spark.read.parquet(path), key, bits, bands, length, copies, seed)


def _asked(index: VectorIndex, queries: DataFrame, qkey: str, qvec: str) -> DataFrame:
    """The queries that can be asked, written with unit vectors and codes: (qkey, qu, codes)."""
    path = scratch_path(queries.sparkSession, "vector-queries")
    asked = queries.select(F.col(qkey).alias(qkey), unit(as_double(qvec)).alias("qu"),
                           band_codes(qvec, index.bits, index.bands, index.length, index.seed).alias("codes"))
    asked.where(F.col("codes").isNotNull() & F.get("qu", F.lit(0)).isNotNull()).write.parquet(path)
    return queries.sparkSession.read.parquet(path)


def _probes(asked: DataFrame, bits: int, *keep: str) -> DataFrame:
    """(keep, band, code): the buckets in which a query looks."""
    masks = F.array(F.lit(0), *[F.lit(1 << b) for b in range(bits)])
    return (asked.select(*keep, F.posexplode("codes").alias("band", "code")).select(*keep, "band", "code", F.explode(masks).alias("mask"))
            .select(*keep, "band", F.col("code").bitwiseXOR(F.col("mask")).alias("code")))


def candidates(index: VectorIndex, queries: DataFrame, qkey: str, qvec: str) -> tuple[DataFrame, DataFrame]:
    """(distinct (qkey, key) pairs that share a probed bucket, the queries with unit vectors)."""
    asked = _asked(index, queries, qkey, qvec)
    buckets = index.rows.select(index.key, F.posexplode("codes").alias("band", "code"))
    # Neither side is an aggregate: AQE can split a bucket that many vectors share.
    return _probes(asked, index.bits, qkey).join(buckets, ["band", "code"]).select(qkey, index.key).distinct(), asked.select(qkey, "qu")


def _dealt(masks: np.ndarray, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (k, r, u, codes) as blocks (band, code, rows): ``most`` rows at a time, those of a bucket in the order in which
    they were read.  A row is in the bucket of its code and of those that differ from it by one of ``masks``."""

    def blocks(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        items = pa.StructArray.from_arrays([rows.column(c) for c in ("k", "r", "u")], names=["k", "r", "u"])
        codes = rows.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(len(items), -1)
        for band, own in enumerate(codes.T):
            code = (own[None, :] ^ masks[:, None]).ravel()
            place = np.tile(np.arange(len(own)), len(masks))
            order = np.lexsort((place, code))
            found, first = np.unique(code[order], return_index=True)
            ends, lo = np.append(first[1:], len(order)), 0
            while lo < len(found):
                hi = max(lo + 1, int(np.searchsorted(ends, first[lo] + _BATCH, side="right")))
                held = items.take(pa.array(place[order[first[lo] : ends[hi - 1]]]))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first[lo:hi], ends[hi - 1]) - first[lo], pa.int32()), held)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(hi - lo, band), pa.int32()), pa.array(found[lo:hi], pa.int32()), lists],
                                                 names=["band", "code", "rows"])
                lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - n)
                held, n, batch = [*held, part], n + len(part), batch.slice(len(part))
                if n == most:
                    yield from blocks(pa.concat_batches(held))
                    held, n = [], 0
        if held:
            yield from blocks(pa.concat_batches(held))

    return run


def _blocks(df: DataFrame, key: str, u: str, masks: list[int], out: str) -> DataFrame:
    """``(band, code, out)``: blocks of the rows ``(key, u, codes)`` of a bucket, in the order of their keys; a bucket has one
    or more.  Each task makes those of its own rows, which aren't shuffled for it."""
    spark, most = df.sparkSession, RUN // len(masks)
    rows = df.where(F.col(key).isNotNull())
    n = rows.count()
    # The more rows a task has, the larger are its blocks, and the fewer of them meet.
    tasks = max(ceil(n / most), min(spark.sparkContext.defaultParallelism, ceil(n / LEAST_RUN)), 1)
    rows = rows.coalesce(tasks).select(F.col(key).alias("k"), F.monotonically_increasing_id().alias("r"), F.col(u).alias("u"), "codes")
    kinds = rows.schema
    item = StructType([StructField("k", kinds["k"].dataType), StructField("r", LongType()), StructField("u", kinds["u"].dataType)])
    schema = StructType([StructField("band", IntegerType()), StructField("code", IntegerType()), StructField(out, ArrayType(item))])
    return rows.sortWithinPartitions("k", "r").mapInArrow(_dealt(np.array(masks, np.int32), most), schema)


def neighbours(index: VectorIndex, queries: DataFrame, qkey: str, qvec: str, k: int = 5) -> DataFrame:
    """``(qkey, rank, key, cosine)``: the ``k`` best of each query's candidates; a row with the query's own key is left
    out, ties go by key.  ``k`` can't exceed ``copies - 1``.

    Candidate pairs aren't rows.  A bucket's vectors, and the queries that look in it, are blocks of a row each; where
    they meet, each query's best of the block are found by a matrix product, and of a task's blocks only these are shuffled."""
    if k >= index.copies:
        raise ValueError("an index holds `copies` rows of equal vectors; build it with more than k")
    probes = _blocks(_asked(index, queries, qkey, qvec), qkey, "qu", [0, *(1 << b for b in range(index.bits))], "_qs")
    buckets = _blocks(index.rows, index.key, "u", [0], "_cs")
    # A merge: neither side goes through the driver, and Spark can split a bucket that many vectors share.
    pairs = probes.join(buckets.hint("merge"), ["band", "code"])
    # A candidate of several bands is found more than once.
    found = best_of_blocks(pairs, qkey, index.key, k, own=False).dropDuplicates(["_q", "_c"])
    return top(found, qkey, index.key, k).select(qkey, "rank", index.key, "cosine")


def recall(found: DataFrame, exact: DataFrame, qkey: str, key: str) -> DataFrame:
    """One row: how many of the exact neighbours (of rank up to ``k``) were found."""
    hit = found.select(qkey, key, F.lit(1).alias("_hit"))
    return exact.join(hit, [qkey, key], "left").agg(
        F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found"), F.try_divide(F.count("_hit"), F.count(F.lit(1))).alias("recall"))
