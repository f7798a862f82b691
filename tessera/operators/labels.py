"""Label vocabularies, histograms and weights (AG5-AG9, JN5, SF13, ST2).

Counting runs over the (large) token table with partial aggregation; what
follows works on the label table, whose size is the label vocabulary (tens of
rows), so it is joined by broadcast and ranked in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import _c


def bio_expand(types: Column) -> Column:
    """SF13: ``[t1, t2] -> [B-t1, I-t1, B-t2, I-t2]``."""
    return F.flatten(F.transform(_c(types), lambda t: F.array(F.concat(F.lit("B-"), t), F.concat(F.lit("I-"), t))))


def entity_type(tag) -> Column:
    """``B-X``/``I-X`` -> ``X``; ``O`` -> NULL."""
    tag = _c(tag)
    return F.when(tag != "O", F.substring(tag, 3, 1 << 30))


def tag_counts(rows: DataFrame, tag: str = "tag") -> DataFrame:
    """``(label, n)`` over raw BIO tags."""
    return rows.groupBy(F.col(tag).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def label_universe(counts: DataFrame) -> DataFrame:
    """All labels that should exist: ``B-``/``I-`` of every type seen, plus ``O``."""
    types = counts.select(entity_type("label").alias("t")).where(F.col("t").isNotNull()).distinct()
    bio = types.select(F.explode(bio_expand(F.array("t"))).alias("label"))
    return bio.unionByName(counts.sparkSession.range(1).select(F.lit("O").alias("label"))).distinct()


def repaired_counts(counts: DataFrame) -> DataFrame:
    """JN5: labels absent from the data take the count of their B-/I- partner."""
    uni = label_universe(counts)
    partner = F.when(F.col("label").startswith("I-"), F.concat(F.lit("B-"), F.substring("label", 3, 1 << 30))) \
        .when(F.col("label").startswith("B-"), F.concat(F.lit("I-"), F.substring("label", 3, 1 << 30)))
    c = F.broadcast(counts.withColumnRenamed("label", "_l").withColumnRenamed("n", "_n"))
    own = uni.join(c, uni["label"] == c["_l"], "left").select("label", F.col("_n").alias("own"))
    p = F.broadcast(counts.withColumnRenamed("label", "_pl").withColumnRenamed("n", "_pn"))
    j = own.join(p, partner == p["_pl"], "left")
    return j.select("label", F.coalesce("own", "_pn").alias("n")).where(F.col("n").isNotNull())


def label_ids(counts: DataFrame, by: str = "frequency") -> DataFrame:
    """AG9: ``(label, label_id)``: frequency order (count desc, name) or name order."""
    order = [F.desc("n"), F.asc("label")] if by == "frequency" else [F.asc("label")]
    return counts.select("label", (F.row_number().over(Window.orderBy(*order)) - 1).alias("label_id"))


def log_weights(counts: DataFrame, smooth: float = 1e-5) -> DataFrame:
    """AG7: ``w = ln(total / (f + s)) / max``, total = sum of smoothed counts."""
    sm = counts.withColumn("_f", F.col("n") + F.lit(smooth))
    tot = sm.agg(F.sum("_f").alias("_tot"))
    w = sm.crossJoin(F.broadcast(tot)).withColumn("_w", F.ln(F.col("_tot") / F.col("_f")))
    mx = w.agg(F.max("_w").alias("_mx"))
    return w.crossJoin(F.broadcast(mx)).select("label", "n", (F.col("_w") / F.col("_mx")).alias("weight"))


def stats_label(tag) -> Column:
    """AG5 fold: ``O`` kept, ``B-X`` -> ``X``, ``I-`` dropped (NULL)."""
    tag = _c(tag)
    return F.when(tag == "O", tag).when(tag.startswith("B-"), F.substring(tag, 3, 1 << 30))


def tag_histogram(rows: DataFrame, tag: str = "tag") -> DataFrame:
    """AG5: ``(tag, n)`` of folded tags."""
    return (rows.select(stats_label(tag).alias("tag")).where(F.col("tag").isNotNull())
            .groupBy("tag").agg(F.count(F.lit(1)).alias("n")))


def tag_coverage(rows: DataFrame, split_col: str, splits: Sequence[str], tag: str = "tag") -> DataFrame:
    """AG6: folded-tag counts per split, zero-filled for tags absent there.
    The universe is the types seen anywhere plus ``O``."""
    folded = rows.select(split_col, stats_label(tag).alias("tag")).where(F.col("tag").isNotNull())
    counts = folded.groupBy(split_col, "tag").agg(F.count(F.lit(1)).alias("n"))
    uni = folded.select("tag").distinct()
    grid = F.broadcast(uni).crossJoin(
        rows.sparkSession.createDataFrame([(s,) for s in splits], [split_col]))
    return grid.join(counts, [split_col, "tag"], "left").select(split_col, "tag", F.coalesce("n", F.lit(0)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """AG8: balanced weights ``n / (2 * count_c)``."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    tot = df.agg(F.count(F.lit(1)).alias("_n"))
    return c.crossJoin(F.broadcast(tot)).select(label, (F.col("_n") / (F.lit(2) * F.col("_c"))).alias("weight"))


def missing_labels(expected: DataFrame, seen: DataFrame, col: str = "label") -> DataFrame:
    """ST2: labels expected but not seen."""
    return expected.select(col).exceptAll(seen.select(col)).distinct()


def by_frequency(df: DataFrame, col: str) -> DataFrame:
    """SP7: ``(col, n)`` by falling count, ties by value; a range-partitioned sort of the counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)
