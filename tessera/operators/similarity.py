"""Text and string similarity (SF1-SF6, JN3, JN4, SF12).

Pairs come from an exact equi-join on shared shingles (no cross product).  Set
measures are array functions on the pair row; count-clipped measures (ROUGE-1,
BLEU) count the n-grams of both sides of a pair in one grouping and sum
``least(...)`` per pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.sequences import ngrams
from tessera.functions.text import _c


def shingle_pairs(left: DataFrame, lkey: str, ltoks: str, right: DataFrame, rkey: str, rtoks: str,
                  n: int = 8) -> DataFrame:
    """Distinct ``(lkey, rkey)`` sharing at least one ``n``-token shingle.

    A plain equi-join: AQE broadcasts a side whose measured size is small and splits hot shingles."""
    ls = left.select(lkey, F.explode(F.array_distinct(ngrams(F.col(ltoks), n, sep=" "))).alias("_sh"))
    rs = right.select(rkey, F.explode(F.array_distinct(ngrams(F.col(rtoks), n, sep=" "))).alias("_sh"))
    return rs.join(ls, "_sh").select(lkey, rkey).distinct()


def jaccard(a, b) -> Column:
    """SF1: |A ∩ B| / |A ∪ B| over token sets (NULL when both are empty)."""
    a, b = _c(a), _c(b)
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)))


def clipped_counts(pairs: DataFrame, keys: Sequence[str], ctoks: str, rtoks: str, orders: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """``(keys, n, clipped, ref_total, cand_total)`` of rows that hold a pair's candidate and reference tokens: per pair
    and order, the sum over n-grams of ``min(ref count, candidate count)`` and the numbers of n-grams.

    Both sides' n-grams are rows of one frame, counted map-side by (pair, order, n-gram): the pairs are read once, and
    a pair's sums follow in the same partitioning as far as its keys go."""
    def of(toks: str, n: int, is_ref: int) -> Column:
        return F.transform(ngrams(F.col(toks), n, sep=" "), lambda g: F.struct(
            F.lit(n).alias("n"), g.alias("gram"), F.lit(is_ref).alias("r"), F.lit(1 - is_ref).alias("c")))

    # Outer: for an inner generator a filter on the array's size would be inferred, and evaluate the array once more.
    rows = pairs.select(*keys, F.inline_outer(F.concat(*[of(t, n, k) for n in orders for t, k in ((rtoks, 1), (ctoks, 0))])))
    grams = rows.groupBy(*keys, "n", "gram").agg(F.sum("r").alias("_r"), F.sum("c").alias("_c"))
    return grams.where(F.col("n").isNotNull()).groupBy(*keys, "n").agg(
        F.sum(F.least("_r", "_c")).alias("clipped"), F.sum("_r").alias("ref_total"), F.sum("_c").alias("cand_total"))


def rouge1(overlap, sys_len, ref_len) -> Column:
    """SF2: F1 of overlap/len(system) and overlap/len(reference); 0 if P+R=0."""
    p = F.try_divide(_c(overlap).cast("double"), _c(sys_len))
    r = F.try_divide(_c(overlap).cast("double"), _c(ref_len))
    return F.when(p + r != 0, 2 * (p * r / (p + r))).otherwise(F.lit(0.0))


def brevity_penalty(ref_len, cand_len, standard: bool = False) -> Column:
    """SF3 as the reference computes it: 1 when the reference is longer, else
    ``exp(1 - ref/cand)`` (>= 1).  ``standard=True``: 1 when the candidate is
    longer, else ``exp(1 - ref/cand)`` (<= 1)."""
    r, c = _c(ref_len), _c(cand_len)
    penal = F.exp(F.lit(1.0) - F.try_divide(r.cast("double"), c))
    if standard:
        return F.when(c > r, F.lit(1.0)).otherwise(penal)
    return F.when(r > c, F.lit(1.0)).otherwise(penal)


def bleu(clipped: dict, ref_len, cand_len, standard: bool = False) -> Column:
    """SF5: ``BP * geometric precision`` over n = 1..4.  ``clipped[n]`` is the
    clipped n-gram count (symmetric in reference and candidate).  As the
    reference computes it, level n divides by the *reference* n-gram count;
    ``standard=True`` divides by the candidate's and uses the standard penalty."""
    denom = _c(cand_len) if standard else _c(ref_len)
    ps = [F.try_divide(_c(clipped[n]).cast("double"), F.greatest(denom - (n - 1), F.lit(0)))
          for n in (1, 2, 3, 4)]
    return brevity_penalty(ref_len, cand_len, standard) * geometric_precision(*ps)


def geometric_precision(p1, p2, p3, p4) -> Column:
    """SF4: ``exp(sum 0.25 ln p_n)``; 0 when any level is 0; NULL when a level is undefined."""
    ps = [_c(p) for p in (p1, p2, p3, p4)]
    any_null = ps[0].isNull() | ps[1].isNull() | ps[2].isNull() | ps[3].isNull()
    any_zero = (ps[0] == 0) | (ps[1] == 0) | (ps[2] == 0) | (ps[3] == 0)
    s = sum((F.lit(0.25) * F.ln(p) for p in ps[1:]), F.lit(0.25) * F.ln(ps[0]))
    return F.when(any_null, F.lit(None).cast("double")).when(any_zero, F.lit(0.0)).otherwise(F.exp(s))


def nearest_string(df: DataFrame, col: str, lists: Sequence[Sequence[str]]) -> DataFrame:
    """JN3: closest word by Levenshtein over one or more fixed lists; ties go to
    the earlier list, then the earlier position (strict ``<`` scan).

    The lists are fixed and small, so they are one broadcast row; each input row
    is compared with every list word inside the row."""
    entries = [(li, pos, w) for li, words in enumerate(lists) for pos, w in enumerate(words)]
    arr = F.array(*[F.struct(F.lit(li).alias("l"), F.lit(pos).alias("p"), F.lit(w).alias("w"))
                    for li, pos, w in entries])
    scored = F.transform(arr, lambda e: F.struct(F.levenshtein(F.col(col), e["w"]).alias("d"), e["l"].alias("l"),
                                                 e["p"].alias("p"), e["w"].alias("w")))
    best = F.array_min(scored)
    return df.withColumn("_best", best).select(
        "*", F.col("_best.w").alias("nearest"), F.col("_best.d").alias("distance"),
        F.col("_best.l").alias("list_no"), F.col("_best.p").alias("list_pos")).drop("_best")
