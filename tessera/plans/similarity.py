"""Similarity, date and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators import dates as DT
from tessera.operators import similarity as SM
from tessera.operators import vectors as V
from tessera.plans.registry import query
from tessera.plans.sqlparts import lit, toks
from tessera.session import stored
from tessera.sources.tables import table

SHINGLE = 8

_PAIRS = f"""
dt AS (SELECT doc_id, {toks('text')} AS t FROM documents),
bt AS (SELECT item_id, {toks('text')} AS t FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(t) - {SHINGLE - 2}), lambda i: array_to_string(t[i:i + {SHINGLE - 1}], ' '))) AS sh FROM dt),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(t) - {SHINGLE - 2}), lambda i: array_to_string(t[i:i + {SHINGLE - 1}], ' '))) AS sh FROM bt),
pairs AS (SELECT DISTINCT bs.item_id, ds.doc_id FROM bs JOIN ds ON bs.sh = ds.sh)"""


def _pairs(spark, sf):
    """(item_id, doc_id, bt, dt): the pairs with both token arrays, written once.  Only paired documents are tokenised
    for their arrays."""
    tokenised = lambda name, key: table(spark, sf, name).select(key, tokens("text").alias("t"))
    pairs = stored(SM.shingle_pairs(tokenised("benchmark", "item_id"), "item_id", "t", tokenised("documents", "doc_id"), "doc_id", "t", n=SHINGLE), "pairs")
    docs = table(spark, sf, "documents").join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", tokens("text").alias("dt"))
    bench = tokenised("benchmark", "item_id").withColumnRenamed("t", "bt")
    return stored(pairs.join(docs, "doc_id").join(bench, "item_id"), "paired-tokens")


@query("jaccard_pairs", sql=f"""WITH {_PAIRS.strip()}
SELECT p.item_id, p.doc_id,
       round(len(list_intersect(dt.t, bt.t)) / len(list_distinct(list_concat(dt.t, bt.t))), 6) AS jaccard
FROM pairs p JOIN dt ON p.doc_id = dt.doc_id JOIN bt ON p.item_id = bt.item_id""")
def q_jaccard_pairs(spark, sf):
    return _pairs(spark, sf).select("item_id", "doc_id", F.round(SM.jaccard("dt", "bt"), 6).alias("jaccard"))


def _grams_sql(tbl: str, key: str, n: int) -> str:
    return (f"SELECT {key}, {n} AS n, unnest(list_transform(range(1, len(t) - {n - 2}), "
            f"lambda i: array_to_string(t[i:i + {n - 1}], ' '))) AS gram FROM {tbl}")


_CLIP = f"""{_PAIRS},
rg AS (SELECT item_id, n, gram, count(*) AS cr FROM ({' UNION ALL '.join(_grams_sql('bt', 'item_id', n) for n in (1, 2, 3, 4))})
       WHERE item_id IN (SELECT item_id FROM pairs) GROUP BY ALL),
cg AS (SELECT doc_id, n, gram, count(*) AS cc FROM ({' UNION ALL '.join(_grams_sql('dt', 'doc_id', n) for n in (1, 2, 3, 4))})
       WHERE doc_id IN (SELECT doc_id FROM pairs) GROUP BY ALL),
clip AS (SELECT p.item_id, p.doc_id, rg.n, sum(least(rg.cr, coalesce(cg.cc, 0))) AS clipped, sum(rg.cr) AS ref_total
         FROM pairs p JOIN rg ON p.item_id = rg.item_id
         LEFT JOIN cg ON cg.doc_id = p.doc_id AND cg.n = rg.n AND cg.gram = rg.gram GROUP BY ALL),
lens AS (SELECT p.item_id, p.doc_id, len(dt.t) AS cand_len, len(bt.t) AS ref_len
         FROM pairs p JOIN dt ON p.doc_id = dt.doc_id JOIN bt ON p.item_id = bt.item_id)"""


def _clip(spark, sf, orders):
    """A row per pair: the lengths and the clipped count of each order."""
    pairs = _pairs(spark, sf)
    clip = SM.clipped_counts(pairs, ["item_id", "doc_id"], "dt", "bt", orders)
    of = lambda c, n, name: F.coalesce(F.max(F.when(F.col("n") == n, F.col(c))), F.lit(0)).alias(name)
    # Unigrams are the tokens: their totals are the lengths.
    return clip.groupBy("item_id", "doc_id").agg(of("cand_total", 1, "cand_len"), of("ref_total", 1, "ref_len"), *[of("clipped", n, f"c{n}") for n in orders])


@query("rouge1_pairs", sql=f"""WITH {_CLIP.strip()}
SELECT l.item_id, l.doc_id, coalesce(c.clipped, 0)::BIGINT AS overlap,
       round(CASE WHEN coalesce(c.clipped, 0) / l.cand_len + coalesce(c.clipped, 0) / l.ref_len <> 0 THEN
         2 * ((coalesce(c.clipped, 0) / l.cand_len) * (coalesce(c.clipped, 0) / l.ref_len)
              / (coalesce(c.clipped, 0) / l.cand_len + coalesce(c.clipped, 0) / l.ref_len)) ELSE 0 END, 6) AS rouge1
FROM lens l LEFT JOIN clip c ON l.item_id = c.item_id AND l.doc_id = c.doc_id AND c.n = 1""")
def q_rouge1_pairs(spark, sf):
    c = _clip(spark, sf, (1,))
    return c.select("item_id", "doc_id", F.col("c1").cast("bigint").alias("overlap"),
                    F.round(SM.rouge1("c1", "cand_len", "ref_len"), 6).alias("rouge1"))


@query("bleu_pairs", sql=f"""WITH {_CLIP.strip()},
pv AS (SELECT item_id, doc_id,
              max(CASE WHEN n = 1 THEN clipped / ref_total END) AS p1, max(CASE WHEN n = 2 THEN clipped / ref_total END) AS p2,
              max(CASE WHEN n = 3 THEN clipped / ref_total END) AS p3, max(CASE WHEN n = 4 THEN clipped / ref_total END) AS p4
       FROM clip GROUP BY item_id, doc_id),
g AS (SELECT l.item_id, l.doc_id,
             CASE WHEN l.ref_len > l.cand_len THEN 1.0 ELSE exp(1.0 - l.ref_len / l.cand_len) END AS bp,
             CASE WHEN p1 IS NULL OR p2 IS NULL OR p3 IS NULL OR p4 IS NULL THEN NULL
                  WHEN p1 = 0 OR p2 = 0 OR p3 = 0 OR p4 = 0 THEN 0.0
                  ELSE exp(0.25 * ln(p1) + 0.25 * ln(p2) + 0.25 * ln(p3) + 0.25 * ln(p4)) END AS prec
      FROM lens l LEFT JOIN pv ON l.item_id = pv.item_id AND l.doc_id = pv.doc_id)
SELECT item_id, doc_id, round(bp, 6) AS bp, round(prec, 6) AS precision, round(bp * prec, 6) AS bleu FROM g""")
def q_bleu_pairs(spark, sf):
    g = _clip(spark, sf, (1, 2, 3, 4)).select("item_id", "doc_id", SM.brevity_penalty("ref_len", "cand_len").alias("bp"),
                                              SM.bleu({n: f"c{n}" for n in (1, 2, 3, 4)}, "ref_len", "cand_len").alias("bleu"))
    return g.select("item_id", "doc_id", F.round("bp", 6).alias("bp"), F.round(F.try_divide("bleu", "bp"), 6).alias("precision"),
                    F.round("bleu", 6).alias("bleu"))


# Fixed values for the nearest-word query: English month names.  The SQL engine's
# edit distance counts bytes, so its side writes any other character as one byte.
EN_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
             "november", "december")
_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in EN_MONTHS) + "]"


@query("nearest_word", sql=f"""
WITH w AS (SELECT DISTINCT unnest({toks('text')}) AS token FROM documents),
a AS (SELECT token, regexp_replace(token, '[^\\x00-\\x7F]', '~', 'g') AS plain FROM w),
s AS (SELECT token, min({{'d': levenshtein(plain, m), 'p': i - 1, 'w': m}}) AS b
      FROM a, (SELECT unnest({_MONTHS_SQL}) AS m, generate_subscripts({_MONTHS_SQL}, 1) AS i) GROUP BY token)
SELECT token, b.w AS nearest, b.d::INTEGER AS distance, b.p::INTEGER AS list_pos FROM s""")
def q_nearest_word(spark, sf):
    w = table(spark, sf, "documents").select(F.explode(tokens("text")).alias("token")).distinct()
    return SM.nearest_string(w, "token", [EN_MONTHS]).select("token", "nearest", "distance", "list_pos")


# The SQL engine's edit distance counts bytes: its side writes each Cyrillic letter as one ASCII character.
_CYRILLIC = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"
_ONE_BYTE = "abcdefghijklmnopqrstuvwxyz0123456"


def _entries(*lists) -> str:
    return "[" + ", ".join(f"{{'l': {k}, 'p': {p}, 'w': translate({lit(w)}, '{_CYRILLIC}', '{_ONE_BYTE}')}}"
                           for k, words in enumerate(lists) for p, w in enumerate(words)) + "]"


def _nearest(word: str, *lists) -> str:
    near = f"list_transform({_entries(*lists)}, lambda e: {{'d': levenshtein({word}, e.w), 'l': e.l, 'p': e.p}})"
    return f"(list_min({near}).p + 1)"


def _cut(words, n: str) -> str:
    w = "[" + ", ".join(lit(x) for x in words) + f"][{n}]"
    return f"translate(substr({w}, 1, 2) || substr({w}, 4, 100), '{_CYRILLIC}', '{_ONE_BYTE}')"


@query("date_words", sql=f"""
WITH o AS (SELECT o_orderkey, o_orderdate AS t, {_cut(DT.MONTHS, 'month(o_orderdate)')} AS m, {_cut(DT.ORDINALS, 'day(o_orderdate)')} AS d FROM orders),
mw AS (SELECT m, {_nearest('m', DT.MONTHS)} AS mn FROM (SELECT DISTINCT m FROM o)),
dw AS (SELECT d, {_nearest('d', DT.ORDINALS, DT.NUMBERS)} AS dn FROM (SELECT DISTINCT d FROM o)),
s AS (SELECT o_orderkey, t, printf('%04d-%02d-%02d', year(t), mn, dn) AS s FROM o JOIN mw USING (m) JOIN dw USING (d))
SELECT o_orderkey, CASE WHEN try_cast(s AS DATE) IS NULL THEN {lit(DT.INVALID)} ELSE s END AS date, strftime(t, '%Y-%m-%d') AS truth FROM s""")
def q_date_words(spark, sf):
    """Russian month/day words (corrupted by a rule) parsed back to dates."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    y, m, d = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    month_word = F.element_at(F.array(*[F.lit(x) for x in DT.MONTHS]), m)
    day_word = F.element_at(F.array(*[F.lit(x) for x in DT.ORDINALS]), d)
    # Drop one character at a rule-chosen position: a misspelling to repair.
    cut = lambda w: F.concat(F.substring(w, 1, 2), F.substring(w, 4, 100))
    w = o.select("o_orderkey", y.cast("string").alias("y"), cut(month_word).alias("m"), cut(day_word).alias("d"),
                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("truth"))
    return DT.words_to_dates(w, "y", "m", "d").select("o_orderkey", "date", "truth")


_EMB = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"


@query("unit_vectors", sql=f"""
WITH v AS ({_EMB}), n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS nr FROM v)
SELECT vec_id, (generate_subscripts(e, 1) - 1)::INTEGER AS dim, round(unnest(e) / nr, 6) AS value FROM n""")
def q_unit_vectors(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", V.unit(V.as_double("embedding")).alias("u"))
    return V.explode_dims(e, ["vec_id"], "u").select("vec_id", "dim", F.round("value", 6).alias("value"))


@query("mean_vectors", sql=f"""
WITH v AS ({_EMB}), b AS (SELECT label, min(vec_id) AS lo, max(vec_id) AS hi FROM v GROUP BY label),
x AS (SELECT v.label, (generate_subscripts(e, 1) - 1)::INTEGER AS dim, unnest(e) AS val
      FROM v JOIN b ON v.label = b.label WHERE v.vec_id <> b.lo AND v.vec_id <> b.hi)
SELECT label, dim, round(avg(val), 6) AS mean FROM x GROUP BY label, dim""")
def q_mean_vectors(spark, sf):
    m = V.mean_inner(table(spark, sf, "embeddings"), "label", "vec_id", "embedding")
    return m.select("label", "dim", F.round("mean", 6).alias("mean"))


@query("first_vectors", sql=f"""
WITH v AS ({_EMB}), f AS (SELECT label, arg_min(e, vec_id) AS e FROM v GROUP BY label)
SELECT label, (generate_subscripts(e, 1) - 1)::INTEGER AS dim, round(unnest(e), 6) AS value FROM f""")
def q_first_vectors(spark, sf):
    f = V.first_vectors(table(spark, sf, "embeddings"), "label", "vec_id", "embedding")
    f = f.select("label", V.as_double("embedding").alias("e"))
    return V.explode_dims(f, ["label"], "e").select("label", "dim", F.round("value", 6).alias("value"))


@query("cosine_topk", sql=f"""
WITH v AS ({_EMB}), u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u FROM v),
q AS (SELECT label AS query_label, arg_min(u, vec_id) AS qu FROM u GROUP BY label),
s AS (SELECT q.query_label, u.vec_id, list_sum(list_transform(list_zip(q.qu, u.u), lambda z: z[1] * z[2])) AS c FROM q, u),
r AS (SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY c DESC, vec_id) AS rank FROM s)
SELECT query_label, rank::INTEGER AS rank, vec_id, round(c, 6) AS cosine FROM r WHERE rank <= 5""")
def q_cosine_topk(spark, sf):
    emb = table(spark, sf, "embeddings")
    queries = V.first_vectors(emb, "label", "vec_id", "embedding").withColumnRenamed("label", "query_label")
    t = V.cosine_topk(emb, "vec_id", "embedding", queries, "query_label", "embedding", k=5)
    return t.select("query_label", "rank", "vec_id", F.round("cosine", 6).alias("cosine"))
