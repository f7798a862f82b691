"""Array-valued sequence functions: hashing buckets, n-grams.

These work inside one row (one document), so they need no shuffle however large
the corpus grows; a document of 20,000 words is one 20,000-element array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import _c


def hash_bucket(*cols, seed: int = 42, buckets: int = 1000) -> Column:
    """Rule H: ``int(md5('<seed>:<key>')[:8], 16) % buckets``.

    Stable when rows are added, needs no shuffle, and is reproducible in any
    engine that has md5 (the SQL oracle computes the same value).
    """
    key = F.concat_ws(":", F.lit(str(seed)), *[_c(c).cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets)


def shifted(arr, k: int = 1) -> Column:
    """``arr`` without its first ``k`` elements (pair with ``zip_with`` to look ahead)."""
    arr = _c(arr)
    return F.slice(arr, k + 1, F.greatest(F.size(arr) - k, F.lit(0)))


def ngrams(toks, n: int, sep: str = "_") -> Column:
    """WN4: n-grams of a token array joined by ``sep`` (empty when size < n).

    ``toks`` should be a column reference (a materialised array): the n-gram at
    ``i`` is ``slice(toks, i, n)``, and a lambda that referred to an array
    *expression* would re-evaluate it per element.  Bigrams use ``zip_with``
    with a shifted copy and need no lambda reference at all."""
    toks = _c(toks)
    if n == 1:
        return toks
    if n == 2:
        return F.filter(F.zip_with(toks, shifted(toks), lambda a, b: F.concat(a, F.lit(sep), b)),
                        lambda x: x.isNotNull())
    k = F.size(toks) - n + 1
    idx = F.filter(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), lambda i: i <= k)
    return F.transform(idx, lambda i: F.array_join(F.slice(toks, i, n), sep))
