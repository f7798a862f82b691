"""Relation-extraction scoring on triplet texts derived from ``lineitem``.

A sentence is ``(l_orderkey, grp)`` with ``grp = (l_linenumber - 1) div 2``, so
it holds the lines of two line numbers (so it is bounded by the order's line
numbering, not by the table): the gold text has one
``<triplet> P<part> <subj> S<supplier> <obj> <type>`` per line (type from the
return flag); the predicted text drops lines with ``bucket % 11 = 0``, relabels
``bucket % 7 = 0`` as ``lost by`` and carries junk after ``</s>``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.functions.text import cut_at_marker
from tessera.operators import relations as R
from tessera.operators.splits import bucket_split
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket
from tessera.sources.tables import table

KEYS = ["l_orderkey", "grp"]
TYPES = ["accepted by", "lost by", "returned by", "shipped by"]
JUNK = " <triplet> junk <subj> pad <obj> noise"


def _lines(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    flag = F.col("l_returnflag")
    gtype = F.when(flag == "R", "returned by").when(flag == "A", "accepted by").otherwise("shipped by")
    b = hash_bucket("l_orderkey", "l_linenumber")
    piece = lambda t: F.concat(F.lit("<triplet> P"), F.col("l_partkey").cast("string"), F.lit(" <subj> S"),
                               F.col("l_suppkey").cast("string"), F.lit(" <obj> "), t)
    return li.select("l_orderkey", F.floor((F.col("l_linenumber") - 1) / 2).cast("int").alias("grp"), "l_linenumber",
                     "l_partkey", "l_suppkey",
                     piece(gtype).alias("gold"), piece(F.when(b % 7 == 0, "lost by").otherwise(gtype)).alias("pred"),
                     (b % 11 == 0).alias("dropped"))


def _texts(spark, sf):
    """``(l_orderkey, grp, gold_text, pred_text)``: one bounded group per sentence."""
    # (l_orderkey, l_linenumber, l_partkey, l_suppkey) is unique: a total order.
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "gold", "pred", "dropped")))
    s = _lines(spark, sf).groupBy(*KEYS).agg(items.alias("_it"))
    gold = F.concat(F.lit("<s>"), F.array_join(F.transform("_it", lambda x: x["gold"]), " "), F.lit("</s>"))
    kept = F.filter("_it", lambda x: ~x["dropped"])
    pred = F.concat(F.lit("<s>"), F.array_join(F.transform(kept, lambda x: x["pred"]), " "), F.lit("</s>" + JUNK))
    return s.select(*KEYS, gold.alias("gold_text"), pred.alias("pred_text"))


def _parsed(spark, sf):
    t = _texts(spark, sf)
    return t.select(*KEYS, R.extract_triplets("gold_text").alias("gold"),
                    R.extract_triplets(cut_at_marker("pred_text", "</s>")).alias("pred"))


_BASE = f"""
li AS (SELECT l_orderkey, ((l_linenumber - 1) // 2)::INTEGER AS grp, l_linenumber AS ln,
              'P' || CAST(l_partkey AS VARCHAR) AS head, 'S' || CAST(l_suppkey AS VARCHAR) AS tail, l_partkey AS pk, l_suppkey AS sk,
              CASE l_returnflag WHEN 'R' THEN 'returned by' WHEN 'A' THEN 'accepted by' ELSE 'shipped by' END AS gtype,
              (('0x' || substr(md5('42:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT % 1000) AS b
       FROM lineitem),
gold AS (SELECT l_orderkey, grp, (row_number() OVER (PARTITION BY l_orderkey, grp ORDER BY ln, pk, sk) - 1)::INTEGER AS idx,
                head, gtype AS type, tail FROM li),
pred AS (SELECT l_orderkey, grp, (row_number() OVER (PARTITION BY l_orderkey, grp ORDER BY ln, pk, sk) - 1)::INTEGER AS idx,
                head, CASE WHEN b % 7 = 0 THEN 'lost by' ELSE gtype END AS type, tail FROM li WHERE b % 11 <> 0)"""


@query("cut_at_marker", sql=f"""WITH {_BASE.strip()}
SELECT l_orderkey, grp, '<s>' || coalesce(string_agg('<triplet> ' || head || ' <subj> ' || tail || ' <obj> ' ||
       CASE WHEN b % 7 = 0 THEN 'lost by' ELSE gtype END, ' ' ORDER BY ln, pk, sk) FILTER (WHERE b % 11 <> 0), '') || '</s>' AS text
FROM li GROUP BY l_orderkey, grp""")
def q_cut_at_marker(spark, sf):
    return _texts(spark, sf).select(*KEYS, cut_at_marker("pred_text", "</s>").alias("text"))


@query("triplets", sql=f"WITH {_BASE.strip()} SELECT l_orderkey, grp, idx, head, type, tail FROM pred")
def q_triplets(spark, sf):
    return R.explode_triplets(_parsed(spark, sf), KEYS, "pred")


@query("relation_types", sql=f"""WITH {_BASE.strip()},
s AS (SELECT CASE WHEN {bucket('l_orderkey')} < 700 THEN 'train' WHEN {bucket('l_orderkey')} < 850 THEN 'validation'
             ELSE 'test' END AS split, type FROM gold)
SELECT split, type, count(*)::BIGINT AS n FROM s GROUP BY split, type
UNION ALL SELECT 'total', type, count(*)::BIGINT FROM s GROUP BY type""")
def q_relation_types(spark, sf):
    g = R.explode_triplets(_parsed(spark, sf), KEYS, "gold")
    return R.type_histogram(bucket_split(g, "l_orderkey"))


@query("paired_scores", sql=f"""WITH {_BASE.strip()},
pr AS (SELECT g.type AS gold, p.type AS guess FROM gold g LEFT JOIN pred p
       ON g.l_orderkey = p.l_orderkey AND g.grp = p.grp AND g.idx = p.idx),
gc AS (SELECT gold AS relation, count(*) AS n FROM pr WHERE gold <> 'no relation' GROUP BY gold),
uc AS (SELECT coalesce(guess, '__null__') AS relation, count(*) AS n FROM pr
       WHERE guess IS NULL OR guess <> 'no relation' GROUP BY 1),
cc AS (SELECT gold AS relation, count(*) AS n FROM pr WHERE gold <> 'no relation' AND gold = guess GROUP BY gold),
a AS (SELECT coalesce(gc.relation, uc.relation) AS relation, coalesce(gc.n, 0) AS n_gold, coalesce(uc.n, 0) AS n_guessed
      FROM gc FULL JOIN uc ON gc.relation = uc.relation),
b AS (SELECT a.*, coalesce(cc.n, 0) AS n_correct FROM a LEFT JOIN cc ON a.relation = cc.relation),
t AS (SELECT relation, n_gold, n_guessed, n_correct FROM b WHERE n_gold > 0
      UNION ALL SELECT 'micro', sum(n_gold), sum(n_guessed), sum(n_correct) FROM b),
m AS (SELECT relation, n_gold::BIGINT AS n_gold, n_guessed::BIGINT AS n_guessed, n_correct::BIGINT AS n_correct,
             CASE WHEN n_guessed > 0 THEN n_correct / n_guessed ELSE 1.0 END AS p,
             CASE WHEN n_gold > 0 THEN n_correct / n_gold ELSE 0.0 END AS r FROM t)
SELECT relation, n_gold, n_guessed, n_correct, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM m""")
def q_paired_scores(spark, sf):
    p = _parsed(spark, sf)
    # Outer, as in explode_triplets.
    pairs = p.select(F.explode_outer(R.paired_types("gold", "pred")).alias("x")).where(F.col("x").isNotNull()).select("x.gold", "x.guess")
    s = R.micro_scores(pairs)
    return s.select("relation", "n_gold", "n_guessed", "n_correct",
                    *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def _set_sql(mode: str) -> str:
    ent = "head, tail" if mode == "boundaries" else "head, head_type, tail, tail_type"
    on = " AND ".join(f"g.{c} = p.{c}" for c in ["l_orderkey", "grp", "type"] + [c.strip() for c in ent.split(",")])
    types = ", ".join(f"('{t}')" for t in TYPES)
    return f"""WITH {_BASE.strip()},
gr AS (SELECT DISTINCT l_orderkey, grp, type, {ent} FROM (SELECT *, 'part' AS head_type, 'supplier' AS tail_type FROM gold)),
pd AS (SELECT DISTINCT l_orderkey, grp, type, {ent} FROM (
         SELECT *, 'part' AS head_type,
                CASE WHEN {bucket("CAST(l_orderkey AS VARCHAR) || ':' || CAST(grp AS VARCHAR) || ':' || CAST(idx AS VARCHAR)")} % 13 = 0
                     THEN 'customer' ELSE 'supplier' END AS tail_type FROM pred)),
j AS (SELECT coalesce(g.type, p.type) AS type, g.l_orderkey IS NOT NULL AS in_g, p.l_orderkey IS NOT NULL AS in_p
      FROM gr g FULL JOIN pd p ON {on}),
c AS (SELECT type, sum(CASE WHEN in_g AND in_p THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN NOT in_g THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN NOT in_p THEN 1 ELSE 0 END) AS fn FROM j GROUP BY type),
per AS (SELECT t.type AS rel_type, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn
        FROM (VALUES {types}) t(type) LEFT JOIN c ON t.type = c.type),
pp AS (SELECT *, CASE WHEN tp > 0 THEN 100.0 * tp / (tp + fp) ELSE 0.0 END AS p,
              CASE WHEN tp > 0 THEN 100.0 * tp / (tp + fn) ELSE 0.0 END AS r FROM per),
pf AS (SELECT *, CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM pp),
tot AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(p) AS mp, avg(r) AS mr, avg(f1) AS mf FROM pf),
mi AS (SELECT *, CASE WHEN tp > 0 THEN 100.0 * tp / (tp + fp) ELSE 0.0 END AS p,
              CASE WHEN tp > 0 THEN 100.0 * tp / (tp + fn) ELSE 0.0 END AS r FROM tot),
al AS (SELECT rel_type, tp, fp, fn, p, r, f1 FROM pf
       UNION ALL SELECT 'ALL', tp, fp, fn, p, r, CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0.0 END FROM mi
       UNION ALL SELECT 'MACRO', tp, fp, fn, mp, mr, mf FROM tot)
SELECT rel_type, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, round(p, 6) AS p, round(r, 6) AS r,
       round(f1, 6) AS f1 FROM al"""


def _relation_rows(spark, sf):
    """Gold and predicted relation rows in one frame (one parse, one explode)."""
    p = _parsed(spark, sf)
    tag = lambda arr, g: F.transform(arr, lambda t, i: F.struct(
        F.lit(g).alias("is_gold"), i.alias("idx"), t["head"].alias("head"), t["type"].alias("type"),
        t["tail"].alias("tail")))
    rows = p.select(*KEYS, F.inline_outer(F.concat(tag(F.col("gold"), True), tag(F.col("pred"), False)))).where(F.col("is_gold").isNotNull())
    pred_tail = F.when(hash_bucket("l_orderkey", "grp", "idx") % 13 == 0, "customer").otherwise("supplier")
    return rows.withColumn("head_type", F.lit("part")).withColumn(
        "tail_type", F.when(F.col("is_gold"), F.lit("supplier")).otherwise(pred_tail))


def _set_query(mode):
    def run(spark, sf):
        rows = _relation_rows(spark, sf)
        ent = ["head", "tail"] if mode == "boundaries" else ["head", "head_type", "tail", "tail_type"]
        s = R.set_scores_tagged(rows, "is_gold", KEYS + ["type"] + ent, TYPES)
        return s.select("rel_type", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                        F.col("fn").cast("bigint").alias("fn"), *[F.round(c, 6).alias(c) for c in ("p", "r", "f1")])
    return run


query("set_scores_boundaries", sql=_set_sql("boundaries"))(_set_query("boundaries"))
query("set_scores_strict", sql=_set_sql("strict"))(_set_query("strict"))
