"""Dense-vector operators on ``array<float>`` columns (SF8, SP8, AG20, AG21).

Per-row maths uses higher-order array functions.  Grouped means explode to
``(group, dim, value)`` and aggregate with partial aggregation, so a hot group
costs one partial row per task and dimension.  Top-k cosine joins blocks of
queries with blocks of vectors; a pair of blocks is one matrix product, of which
only each query's best rows are left (``best_of_blocks``), and a task hands on only the
best of its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tessera.functions.text import _c

#: Queries of one block of the exact top-k search.
QUERY_BLOCK = 256
#: Vectors of one block of the exact top-k search.
VECTOR_BLOCK = 4096
#: Rows found that a task holds before it leaves only each query's best of them.
FOUND = 400_000


def as_double(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def norm(v) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x * x))


def unit(v) -> Column:
    """SF8: ``v / ||v||``; the components of a zero vector are null."""
    # The norm is evaluated once and paired with each element (a lambda that
    # referred to it would recompute it per element).
    v = _c(v)
    return F.zip_with(v, F.array_repeat(norm(v), F.size(v)), lambda x, n: F.try_divide(x, n))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a, b) -> Column:
    """SP8 pair form."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def explode_dims(df: DataFrame, keys, vec: str) -> DataFrame:
    return df.select(*keys, F.posexplode(vec).alias("dim", "value"))


def mean_inner(df: DataFrame, group: str, order: str, vec: str) -> DataFrame:
    """AG20: per group, the mean vector of its rows without the first and the
    last row (by ``order``, unique in a group) -> ``(group, dim, mean)``."""
    # One pass with partial aggregation: the sum of all rows minus those of the first and the last one.
    v = F.col("value").cast("double")
    sums = explode_dims(df, [group, order], vec).groupBy(group, "dim").agg(
        F.sum(v).alias("_s"), F.count(F.lit(1)).alias("_n"), F.min(order).alias("_lo"), F.max(order).alias("_hi"),
        F.min_by(v, order).alias("_a"), F.max_by(v, order).alias("_z"))
    return sums.where((F.col("_n") > 2) & (F.col("_lo") != F.col("_hi"))).select(
        group, "dim", ((F.col("_s") - F.col("_a") - F.col("_z")) / (F.col("_n") - 2)).alias("mean"))


def first_vectors(df: DataFrame, group: str, order: str, vec: str) -> DataFrame:
    """AG21: the first row's vector of each group."""
    return df.groupBy(group).agg(F.min_by(vec, order).alias(vec))


def _vectors(block: pa.StructArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (places, matrix) of a block's vectors; those that are null or hold a null are left out."""
    lists = block.field("u")
    lengths = np.where(lists.is_null().to_numpy(zero_copy_only=False), -1, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    values = lists.flatten()
    places = np.repeat(np.arange(len(lists)), np.maximum(lengths, 0))
    lengths[places[values.is_null().to_numpy(zero_copy_only=False)]] *= -1
    flat, out = values.fill_null(0.0).to_numpy(zero_copy_only=False), {}
    for n in np.unique(lengths[lengths > 0]):
        out[int(n)] = np.flatnonzero(lengths == n), flat[lengths[places] == n].reshape(-1, n)
    return out


def _chosen(mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` true places of each row."""
    return np.nonzero(mask & (np.cumsum(mask, axis=1) <= k))


def _left(found: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """Of found rows those that may be among a query's ``k`` best of them, once each: ties with the last one stay."""
    rows = pa.concat_batches(found)
    q, c, cosine = rows.column(1).to_numpy(), rows.column(3).to_numpy(), rows.column(4).to_numpy(zero_copy_only=False)
    # As ``top`` has it, a cosine that is NaN comes first and one that is null last.
    score = np.where(rows.column(4).is_null().to_numpy(zero_copy_only=False), -np.inf, np.where(np.isnan(cosine), np.inf, cosine))
    order = np.lexsort((c, -score, q))
    again = np.zeros(len(order), bool)
    again[1:] = (q[order[1:]] == q[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
    order = order[~again]
    first = np.flatnonzero(np.append(True, q[order[1:]] != q[order[:-1]]))
    sizes = np.diff(np.append(first, len(order)))
    least = score[order[first + np.minimum(sizes, k) - 1]]
    return rows.take(pa.array(order[score[order] >= np.repeat(least, sizes)]))


def _best(k: int, own: bool, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each query's best of a block of vectors, as ``best_of_blocks`` has it."""

    def found(queries: pa.StructArray, vectors: pa.StructArray) -> pa.RecordBatch:
        score = np.full((len(queries), len(vectors)), np.nan)
        known = np.zeros(score.shape, bool)
        asked, held = _vectors(queries), _vectors(vectors)
        for n in asked.keys() & held.keys():
            at = np.ix_(asked[n][0], held[n][0])
            score[at], known[at] = asked[n][1] @ held[n][1].T, True
        allowed = np.ones(score.shape, bool)
        if not own:
            places: dict = {}
            for c, key in enumerate(vectors.field("k").to_pylist()):
                places.setdefault(key, []).append(c)
            for q, key in enumerate(queries.field("k").to_pylist()):
                allowed[q, places.get(key, [])] = False
        usual = known & allowed & ~np.isnan(score)
        ranked = np.where(usual, score, -np.inf)
        least = np.partition(ranked, -k, axis=1)[:, -k] if k < ranked.shape[1] else np.full(len(ranked), -np.inf)
        # A product's last bits depend on a matrix's shape: near ties stay, and are added up in order below.
        pick = [np.nonzero(usual & (ranked >= least[:, None] - 1e-9)), _chosen(known & allowed & np.isnan(score), k), _chosen(~known & allowed, k)]
        q, c = (np.concatenate([p[i] for p in pick]) for i in (0, 1))
        exact, good = np.zeros(len(q)), known[q, c]
        for n in asked.keys() & held.keys():
            rows = np.flatnonzero(good & np.isin(q, asked[n][0]) & np.isin(c, held[n][0]))
            x, y = (m[np.searchsorted(at, i[rows])] for (at, m), i in ((asked[n], q), (held[n], c)))
            total = np.zeros(len(rows))
            for d in range(n):
                total = total + x[:, d] * y[:, d]
            exact[rows] = total
        qs, cs = queries.take(pa.array(q)), vectors.take(pa.array(c))
        columns = [qs.field("k"), qs.field("r"), cs.field("k"), cs.field("r"), pa.array(exact, mask=~good)]
        return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            queries, vectors = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                qs, cs = queries[i].values, vectors[i].values
                for j in range(0, len(qs), QUERY_BLOCK):
                    held.append(found(qs.slice(j, QUERY_BLOCK), cs))
                    n += held[-1].num_rows
                    if n >= FOUND:
                        held = [_left(held, k)]
                        n = held[0].num_rows
                        if n > FOUND // 2:
                            yield held[0]
                            held, n = [], 0
        if n:
            yield _left(held, k)

    return run


def block(key: str, row: str, u: str) -> Column:
    """The aggregate that makes a group of rows a block, in the order of their keys."""
    return F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(row).alias("r"), F.col(u).alias("u"))))


def best_of_blocks(pairs: DataFrame, qkey: str, key: str, k: int, own: bool) -> DataFrame:
    """``(qkey, _q, key, _c, cosine)`` from pairs of blocks ``(_qs, _cs)``: of each block of vectors, a query's rows that may
    be among its ``k`` best by (cosine descending, key), unless (``own``) they have its own key; of a task's blocks, each
    such row at least once.  ``_q`` and ``_c`` number the rows.  A cosine is null where a vector is null, holds a null or has another length."""
    item = {c: pairs.schema[c].dataType.elementType["k"].dataType for c in ("_qs", "_cs")}
    schema = StructType([StructField(qkey, item["_qs"]), StructField("_q", LongType()), StructField(key, item["_cs"]), StructField("_c", LongType()),
                         StructField("cosine", DoubleType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    return pairs.select("_qs", "_cs").mapInArrow(_best(k, own, to_arrow_schema(schema)), schema)


def cosine_topk(vectors: DataFrame, key: str, vec: str, queries: DataFrame, qkey: str, qvec: str,
                k: int = 5) -> DataFrame:
    """SP8: exact top-``k`` cosine neighbours of each query -> ``(qkey, rank,
    key, cosine)``; ties by ``key``.  Blocks of ``QUERY_BLOCK`` queries meet blocks of
    ``VECTOR_BLOCK`` vectors, each one row, of which there may be any number."""
    def blocks(df: DataFrame, name: str, v: str, size: int, out: str) -> DataFrame:
        # The id is the partition's number and the row's place in it: neighbours share a block.
        rows = df.select(F.col(name).alias("_k"), unit(as_double(v)).alias("_u"), F.monotonically_increasing_id().alias("_r"))
        return rows.groupBy(F.floor(F.col("_r") / size).alias("_block")).agg(block("_k", "_r", "_u").alias(out)).drop("_block")

    pairs = blocks(vectors, key, vec, VECTOR_BLOCK, "_cs").crossJoin(blocks(queries, qkey, qvec, QUERY_BLOCK, "_qs"))
    return top(best_of_blocks(pairs, qkey, key, k, own=True).drop("_q", "_c"), qkey, key, k)


def top(scored: DataFrame, qkey: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows of the largest cosine of each query with their rank; ties by ``key``."""
    w = Window.partitionBy(qkey).orderBy(F.desc("cosine"), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
