"""Data augmentation (SF9, SF10, SP9, ST3, UD1).

Random choices are rule-H hashes of ``(seed, key, step, kind)``, so a run is
reproducible and needs no shuffle.  Typos are a native ``aggregate`` over the
steps; the lexicon round trip is two equi-joins on the exploded tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.functions.text import _c

# The alphabet typos draw from (Russian lower case, 33 letters).
TYPO_ALPHABET = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"

_H = 1 << 32


def _h(key, step, kind: str, seed: int) -> Column:
    return hash_bucket(key, step, F.lit(kind), seed=seed, buckets=_H)


def apply_typos(text, key, num_changes: int = 2, seed: int = 9, alphabet: str = TYPO_ALPHABET) -> Column:
    """SF9: ``num_changes`` steps, each an insert, delete or substitute at a
    hashed position; a delete never empties the text; empty text is unchanged."""
    key = _c(key)

    def step(t, s):
        n = F.length(t)
        kind = _h(key, s, "k", seed) % 3
        idx = (_h(key, s, "p", seed) % F.greatest(n, F.lit(1))).cast("int")
        ch = F.substr(F.lit(alphabet), (_h(key, s, "c", seed) % len(alphabet) + 1).cast("int"), F.lit(1))
        head = F.substr(t, F.lit(1), idx)
        rest = lambda k: F.substr(t, idx + k, F.greatest(n - idx, F.lit(0)) + 1)
        return (F.when(n == 0, t)
                .when(kind == 0, F.concat(head, ch, rest(1)))
                .when((kind == 1) & (n > 1), F.concat(head, rest(2)))
                .when(kind == 2, F.concat(head, ch, rest(2)))
                .otherwise(t))
    return F.aggregate(F.sequence(F.lit(1), F.lit(num_changes)), _c(text), step)


def lexicon_round_trip(rows: DataFrame, key: str, pos: str, token: str, forward: DataFrame,
                       backward: DataFrame) -> DataFrame:
    """SF10 (re-aimed back-translation): token -> pivot -> token through two
    lexicons ``(word, pivot)`` and ``(pivot, word)``; tokens without an entry
    stay.  Returns ``(key, text)`` in token order."""
    # Compose the two lexicons first (vocabulary-sized), so the token rows are
    # joined once instead of twice.
    f = forward.select(F.col("word").alias("_w"), F.col("pivot").alias("_p"))
    b = backward.select(F.col("pivot").alias("_p"), F.col("word").alias("_bw"))
    mapping = f.join(b, "_p").select("_w", "_bw").hint("merge")  # vocabulary-sized
    j = rows.join(mapping, rows[token] == mapping["_w"], "left")
    out = j.select(key, pos, F.coalesce("_bw", token).alias("_t"))
    g = out.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(pos, "_t"))).alias("_l"))
    return g.select(key, F.array_join(F.transform("_l", lambda x: x["_t"]), " ").alias("text"))


def augment(df: DataFrame, key: str, text: str, branch_a: Callable[[DataFrame], DataFrame],
            branch_b: Callable[[DataFrame], DataFrame], a_per_mille: int = 200, b_per_mille: int = 200,
            seed: int = 42) -> DataFrame:
    """SP9 + ST3 + UD1: all rows (``orig``), plus 20 % through ``branch_a``
    (``a``), plus 20 % of the remaining 80 % through ``branch_b`` (``b``): 1.36x.
    Branches are caller-supplied ``DataFrame -> DataFrame`` functions returning
    ``(key, text)``."""
    b1 = hash_bucket(key, seed=seed)
    b2 = hash_bucket(key, seed=seed + 1)
    base = df.select(key, text)
    a = branch_a(base.where(b1 < a_per_mille))
    b = branch_b(base.where((b1 >= a_per_mille) & (b2 < b_per_mille)))
    return (base.withColumn("kind", F.lit("orig"))
            .unionByName(a.select(key, text).withColumn("kind", F.lit("a")))
            .unionByName(b.select(key, text).withColumn("kind", F.lit("b"))))
