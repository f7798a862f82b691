"""Relation triplets: parsing, pairing and scoring (SF7, TX16, JN7, AG11, AG15, AG16, ST5).

The linearised-triplet parser is a native ``aggregate`` fold over the runs of words
behind one text's markers (a state machine in a struct), so it runs inside the row; scoring is
joins and grouped sums over exploded relation rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import WS, _c

TRIPLET_TYPE = "array<struct<head:string,type:string,tail:string>>"
NO_RELATION = "no relation"


def _spaced(text) -> Column:
    """Space out ``<...>`` markers, drop ``<s>``, ``<pad>``, ``</s>``."""
    t = F.replace(F.replace(_c(text), F.lit(">"), F.lit("> ")), F.lit("<"), F.lit(" <"))
    for m in ("<s>", "<pad>", "</s>"):
        t = F.replace(t, F.lit(m), F.lit(""))
    return t


def triplet_tokens(text) -> Column:
    """Space out ``<...>`` markers, drop ``<s>``, ``<pad>``, ``</s>``, split."""
    return F.filter(F.split(_spaced(text), WS), lambda x: x != "")


def extract_triplets(text) -> Column:
    """SF7: ``<triplet> head <subj> tail <obj> type`` -> array of
    ``struct(head, type, tail)``.  Several ``<subj>`` after one head share it.

    A fold over the runs of words behind the markers, not over the words."""
    init = F.struct(F.array().cast(TRIPLET_TYPE).alias("out"), F.lit("").alias("subj"), F.lit("").alias("obj"), F.lit("").alias("rel"))
    # Spaced-out markers are whole tokens, and the text before the first one is the first run.
    runs = F.split(F.regexp_replace(_spaced(text), WS, " "), "(?=<(?:triplet|subj|obj)>)")

    def trip(acc):
        return F.array(F.struct(acc["subj"].alias("head"), acc["rel"].alias("type"), acc["obj"].alias("tail")))

    def step(acc, run):
        is_t, is_s, is_o = (run.startswith(m) for m in ("<triplet>", "<subj>", "<obj>"))
        words = F.trim(F.substring(run, F.instr(run, ">") + 1, F.length(run)))
        out = F.when((is_t | is_s) & (acc["rel"] != ""), F.concat(acc["out"], trip(acc))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.when(is_t, words).otherwise(acc["subj"]).alias("subj"),
                        F.when(is_s, words).otherwise(acc["obj"]).alias("obj"),
                        F.when(is_o, words).when(is_t, F.lit("")).otherwise(acc["rel"]).alias("rel"))

    def finish(acc):
        done = (acc["subj"] != "") & (acc["rel"] != "") & (acc["obj"] != "")
        return F.when(done, F.concat(acc["out"], trip(acc))).otherwise(acc["out"])

    return F.aggregate(runs, init, step, finish)


def explode_triplets(df: DataFrame, keys: Sequence[str], triplets: str) -> DataFrame:
    """``(keys..., idx, head, type, tail)``."""
    # Outer, so that no filter on the array's size is inferred, which would parse the text again.
    return (df.select(*keys, F.posexplode_outer(triplets).alias("idx", "t")).where(F.col("idx").isNotNull())
            .select(*keys, "idx", "t.head", "t.type", "t.tail"))


def paired_types(gold: str, pred: str) -> Column:
    """JN7: gold types paired by position with predicted types; missing
    predictions are NULL, extra predictions are cut."""
    return F.transform(gold, lambda g, i: F.struct(g["type"].alias("gold"), F.get(F.col(pred), i)["type"].alias("guess")))


def micro_scores(pairs: DataFrame, gold: str = "gold", guess: str = "guess",
                 no_relation: str = NO_RELATION) -> DataFrame:
    """AG15: per-relation (relations seen in gold) and ``micro`` precision /
    recall / F1.  A NULL guess counts as a guess; P = 1 when nothing was guessed.

    One pass: each pair emits up to three events (gold, guessed, correct) keyed
    by relation, summed in a single aggregation; the micro row sums that small
    per-relation table."""
    g, p = F.col(gold), F.col(guess)
    g_rel = g != F.lit(no_relation)
    p_rel = p.isNull() | (p != F.lit(no_relation))
    ev = lambda rel, a, b, c: F.struct(rel.alias("relation"), F.lit(a).alias("g"), F.lit(b).alias("u"),
                                       F.lit(c).alias("c"))
    events = F.array(ev(F.when(g_rel, g), 1, 0, 0), ev(F.when(p_rel, F.coalesce(p, F.lit("\u0000null"))), 0, 1, 0),
                     ev(F.when(g_rel & p_rel & (g == p), g), 0, 0, 1))
    e = pairs.select(F.explode(events).alias("e")).where(F.col("e.relation").isNotNull())
    per_rel = e.groupBy(F.col("e.relation").alias("relation")).agg(
        F.sum("e.g").alias("n_gold"), F.sum("e.u").alias("n_guessed"), F.sum("e.c").alias("n_correct"))

    def prf(c, gu, go):
        pr = F.when(gu > 0, c / gu).otherwise(F.lit(1.0))
        rc = F.when(go > 0, c / go).otherwise(F.lit(0.0))
        f1 = F.when(pr + rc > 0, 2.0 * pr * rc / (pr + rc)).otherwise(F.lit(0.0))
        return pr, rc, f1

    cols = ["relation", "n_gold", "n_guessed", "n_correct"]
    tot = per_rel.agg(F.lit("micro").alias("relation"), F.sum("n_gold").alias("n_gold"),
                      F.sum("n_guessed").alias("n_guessed"), F.sum("n_correct").alias("n_correct"))
    both = per_rel.where(F.col("n_gold") > 0).select(*cols).unionByName(tot.select(*cols))
    pr, rc, f1 = prf(F.col("n_correct"), F.col("n_guessed"), F.col("n_gold"))
    return both.select(*cols, pr.alias("precision"), rc.alias("recall"), f1.alias("f1"))


def set_scores(gold: DataFrame, pred: DataFrame, sent_keys: Sequence[str], relation_types: Sequence[str],
               mode: str = "boundaries") -> DataFrame:
    """AG16: per listed relation type and ``ALL`` (micro) TP/FP/FN and P/R/F1 in
    percent over per-sentence sets; ``MACRO`` averages every listed type, zeros
    included.  ``boundaries`` compares (head, tail); ``strict`` adds the types."""
    assert mode in ("strict", "boundaries")
    ent = ["head", "tail"] if mode == "boundaries" else ["head", "head_type", "tail", "tail_type"]
    keys = list(sent_keys) + ["type"] + ent
    tagged = (gold.select(*keys, F.lit(True).alias("_is_gold"))
              .unionByName(pred.select(*keys, F.lit(False).alias("_is_gold"))))
    return set_scores_tagged(tagged, "_is_gold", keys, relation_types)


def set_scores_tagged(rel: DataFrame, is_gold: str, keys: Sequence[str], relation_types: Sequence[str]) -> DataFrame:
    """AG16 core on one frame of relation rows flagged gold / predicted: set
    membership per key is one ``groupBy(keys)`` (no join of gold to pred)."""
    member = rel.groupBy(*keys).agg(F.max(F.col(is_gold).cast("int")).alias("_g"),
                                    F.max((~F.col(is_gold)).cast("int")).alias("_p"))
    counts = member.groupBy("type").agg(
        F.sum(F.when((F.col("_g") == 1) & (F.col("_p") == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_g") == 0, 1).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("_p") == 0, 1).otherwise(0)).alias("fn"))
    types = counts.sparkSession.createDataFrame([(t,) for t in relation_types], ["type"])
    per = F.broadcast(types).join(counts, "type", "left").na.fill(0, ["tp", "fp", "fn"])

    def pr(tp, fp, fn):
        p_ = F.when(tp > 0, 100.0 * tp / (tp + fp)).otherwise(F.lit(0.0))
        r_ = F.when(tp > 0, 100.0 * tp / (tp + fn)).otherwise(F.lit(0.0))
        f_ = F.when(p_ + r_ != 0, 2 * p_ * r_ / (p_ + r_)).otherwise(F.lit(0.0))
        return p_, r_, f_

    p_, r_, f_ = pr(F.col("tp"), F.col("fp"), F.col("fn"))
    per = per.select(F.col("type").alias("rel_type"), "tp", "fp", "fn", p_.alias("p"), r_.alias("r"), f_.alias("f1"))
    tot = per.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                  F.avg("p").alias("mp"), F.avg("r").alias("mr"), F.avg("f1").alias("mf"))
    p_, r_, f_ = pr(F.col("tp"), F.col("fp"), F.col("fn"))
    micro = tot.select(F.lit("ALL").alias("rel_type"), "tp", "fp", "fn", p_.alias("p"), r_.alias("r"), f_.alias("f1"))
    macro = tot.select(F.lit("MACRO").alias("rel_type"), "tp", "fp", "fn", F.col("mp").alias("p"),
                       F.col("mr").alias("r"), F.col("mf").alias("f1"))
    return per.unionByName(micro).unionByName(macro)


def type_histogram(rel: DataFrame, split: str = "split", total: str = "total") -> DataFrame:
    """AG11: ``(split, type, n)`` per split plus ``total`` over all splits: grouping sets, the rows are read once."""
    sets = rel.select(split, "type").groupingSets([[F.col(split), F.col("type")], [F.col("type")]], split, "type")
    counted = sets.agg(F.count(F.lit(1)).alias("n"), F.grouping(split).alias("_all"))
    return counted.select(F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(split)).alias(split), "type", "n")
