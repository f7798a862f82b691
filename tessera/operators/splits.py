"""Reproducible splits, samples and ordinals (SP1-SP6, SP9, WN3, AG19).

Randomness is replaced by rule H (md5 of ``seed:key``), so a split needs no
shuffle and does not move when rows are added.  Exact-size cuts are found by
selection on histograms of the hash (``select_ranks``); where every row's rank is
the result, ``ordinal`` sorts rows over range partitions and adds a partition's
offset to a row's place in it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.functions.text import _c
from tessera.session import scratch_path


def hash_order(*cols, seed: int = 42) -> Column:
    """A 32-bit rule-H value, uniform over [0, 2^32): a reproducible shuffle key."""
    key = F.concat_ws(":", F.lit(str(seed)), *[_c(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def ordinal(df: DataFrame, key: str, tiebreak: Sequence[str] = (), out: str = "ordinal") -> DataFrame:
    """Adds ``out``: the 1-based rank of each row by ``(key, *tiebreak)``.

    Rows are sorted over range partitions, whose bounds are sampled, so an outlier
    or a dense stretch of keys doesn't fill one of them, and written with their
    place in the partition; the partitions' sizes (one row each) give the offsets.
    The order in which rows were read is the last tie-break, so that the rows of a
    repeated or null key spread over partitions too.
    """
    order = [key, *tiebreak, "_read"]
    placed = (df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
              .drop("_read").withColumn("_id", F.monotonically_increasing_id()))
    return numbered(placed, out)


def numbered(df: DataFrame, out: str = "ordinal") -> DataFrame:
    """``df``, whose column ``_id`` is ``monotonically_increasing_id()``, with ``out``: 1-based numbers in that order.
    The rows are written once, so that a lost task can't number them anew."""
    path = scratch_path(df.sparkSession, "ordinal")
    df.write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    # The id is the partition's number and, in the lower 33 bits, the row's place in it.
    placed = placed.withColumn("_blk", F.shiftright("_id", 33))
    counts = placed.groupBy("_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = counts.select("_blk", (F.sum("_cnt").over(Window.orderBy("_blk")) - F.col("_cnt")).alias("_off"))
    return (placed.join(offs, "_blk")
            .withColumn(out, F.col("_off") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1)
            .drop("_blk", "_off", "_id"))


#: Bits of the hash order that a pass of the selection looks at: its histogram has 4096 rows.
DIGIT = 12


def select_ranks(hashed: DataFrame, column: str, ranks: Callable[[int], list[int]]) -> tuple[int, list[tuple[int, int, int]]]:
    """Distributed selection on a 32-bit column: (rows, for each rank r >= 1 the value of the r-th smallest row, how many
    rows have a smaller value, how many have this value).

    A histogram of the leading bits finds the bucket of each rank; only the rows of these few buckets are written and
    looked at again, by their next bits.  Nothing is sorted, and the driver gets histograms of fixed size.
    """
    spark = hashed.sparkSession
    rows, found, total = hashed.select(F.col(column).alias("h")), [], None
    shift = 32
    while shift > 0:
        below = max(0, shift - DIGIT)
        digit = F.shiftright("h", below)
        histogram = sorted((r["d"], r["n"]) for r in rows.groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())
        if total is None:
            total = sum(n for _, n in histogram)
            found = [[r, None, 0, 0] for r in ranks(total)]  # wanted rank, prefix so far, rows before it, rows in it
        for f in found:
            before = f[2]
            for d, n in histogram:
                if f[1] is not None and d >> (shift - below) != f[1]:
                    continue
                if before + n >= f[0]:
                    f[1:] = [d, before, n]
                    break
                before += n
        shift = below
        if shift:
            path = scratch_path(spark, "boundary")
            rows.where(F.shiftright("h", shift).isin(*{f[1] for f in found if f[1] is not None}) if found else F.lit(False)).write.parquet(path)
            rows = spark.read.schema("h long").parquet(path)
    return total or 0, [(f[1], f[2], f[3]) for f in found]


def sequential_split(df: DataFrame, key: str, train: float = 0.8) -> DataFrame:
    """SP1: by position in ``key`` order: first ``round(.8N)`` train, next
    ``round(round(.2N)/2)`` validation, rest test (half-even rounding)."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    o = ordinal(df, key).crossJoin(F.broadcast(n))
    n_train = F.bround(F.lit(train) * F.col("_n"), 0)
    n_val = F.bround(F.bround(F.lit(round(1 - train, 10)) * F.col("_n"), 0) / 2, 0)
    split = (F.when(F.col("ordinal") <= n_train, F.lit("train"))
             .when(F.col("ordinal") <= n_train + n_val, F.lit("validation")).otherwise(F.lit("test")))
    return o.withColumn("split", split).drop("_n")


def ratio_split(df: DataFrame, key: str, ratio: float = 0.7, seed: int = 42) -> DataFrame:
    """SP2: shuffled (rule-H order) split with exact sizes ``int(r*n)`` train,
    ``int((1-r)/2*n)`` validation, rest test; equal hashes go by key.

    The two cuts are found by selection, then each row compares its hash with them: no sort and no exchange of rows.
    Only the rows whose hash equals a cut's, if it falls among several, are ranked."""
    h = df.withColumn("_h", hash_order(key, seed=seed))
    sizes = {}

    def cuts(n: int) -> list[int]:
        train, validation = int(ratio * n), int((1 - ratio) / 2 * n)
        sizes.update({name: cut for name, cut in (("train", train), ("validation", train + validation)) if cut})
        return list(sizes.values())

    _, found = select_ranks(h, "_h", cuts)
    ends = [(name, cut, *f) for (name, cut), f in zip(sizes.items(), found)]
    # A cut inside a run of equal hashes.
    ties = {value: before for _, cut, value, before, same in ends if cut < before + same}
    split = F.lit("test")
    for name, cut, value, before, _ in reversed(ends):
        split = F.when((F.col("_h") < value) if value in ties else (F.col("_h") <= value), F.lit(name)).otherwise(split)
    if not ties:
        return h.withColumn("split", split).drop("_h")
    whole = h.where(~F.col("_h").isin(*ties)).withColumn("split", split)
    for value, before in ties.items():
        rank = ordinal(h.where(F.col("_h") == value), key)
        place = F.col("ordinal") + before
        cut = F.lit("test")
        for name, at, *_ in reversed(ends):
            cut = F.when(place <= at, F.lit(name)).otherwise(cut)
        whole = whole.unionByName(rank.withColumn("split", cut).drop("ordinal"))
    return whole.drop("_h")


def three_way_split(df: DataFrame, key: str, test_per_mille: int = 200, val_per_mille: int = 200,
                    seed: int = 42) -> DataFrame:
    """SP3: 80/20 train/test, then 20 % of train as validation (64/16/20), from
    two independent rule-H buckets."""
    b1 = hash_bucket(key, seed=seed)
    b2 = hash_bucket(key, seed=seed + 1)
    split = (F.when(b1 < test_per_mille, F.lit("test"))
             .when(b2 < val_per_mille, F.lit("validation")).otherwise(F.lit("train")))
    return df.withColumn("split", split)


def bucket_split(df: DataFrame, key: str, bounds=(700, 850), names=("train", "validation", "test"),
                 seed: int = 42) -> DataFrame:
    """Split by rule-H bucket thresholds (per mille)."""
    b = hash_bucket(key, seed=seed)
    e = F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds, names))):
        e = F.when(b < bound, F.lit(name)).otherwise(e)
    return df.withColumn("split", e)


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """AG19."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """SP5: ``n`` rows without replacement in rule-H order (a top-k, so the
    plan is ``TakeOrderedAndProject``: each task keeps ``n`` rows)."""
    return df.orderBy(hash_order(key, seed=seed), F.col(key)).limit(n)


def first_n_per_class(df: DataFrame, label: str, order: str, n: int) -> DataFrame:
    """WN3: first ``n`` rows of each class in ``order`` (a group limit)."""
    w = Window.partitionBy(label).orderBy(order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def first_n_distinct(df: DataFrame, value: str, order: str, n: int) -> DataFrame:
    """SP6 + AG13: distinct values by first occurrence, the first ``n`` of them,
    with their copy counts.  Values are grouped by a SHA-256 digest (plus
    length), so the shuffle carries the digest; the value itself rides along
    once per group via ``min_by``."""
    digest = F.struct(F.sha2(F.col(value), 256).alias("h"), F.length(value).alias("n"))
    firsts = df.groupBy(digest.alias("_d")).agg(
        F.min(order).alias(order), F.count(F.lit(1)).alias("copies"), F.min_by(value, order).alias(value))
    return firsts.drop("_d").orderBy(order).limit(n)
