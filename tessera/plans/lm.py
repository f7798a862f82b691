"""Language-model data and count-based perplexity queries on ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.sequences import hash_bucket
from tessera.operators import lm
from tessera.operators import vocabulary as VO
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket, toks
from tessera.sources.tables import table


def _docs(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.tokens("text").alias("t"))
    return d.withColumn("is_test", hash_bucket("doc_id") < 200)


_T = f"""
d AS (SELECT doc_id, {toks('text')} AS t, {bucket('doc_id')} < 200 AS is_test FROM documents),
bg AS (SELECT doc_id, is_test, (generate_subscripts(b, 1) - 1)::INTEGER AS pos, unnest(b) AS x
       FROM (SELECT doc_id, is_test, list_transform(range(1, len(t)), lambda i: {{'w1': t[i], 'w2': t[i + 1]}}) AS b FROM d)),
v AS (SELECT count(DISTINCT w) AS vv FROM (SELECT unnest(t) AS w FROM d WHERE NOT is_test)),
bi AS (SELECT x.w1 AS w1, x.w2 AS w2, count(*) AS c12 FROM bg WHERE NOT is_test GROUP BY 1, 2),
cx AS (SELECT x.w1 AS w1, count(*) AS c1 FROM bg WHERE NOT is_test GROUP BY 1),
lp AS (SELECT bg.doc_id, bg.pos, ln((coalesce(bi.c12, 0) + 1) / (coalesce(cx.c1, 0) + v.vv)) AS logp
       FROM bg LEFT JOIN bi ON bg.x.w1 = bi.w1 AND bg.x.w2 = bi.w2 LEFT JOIN cx ON bg.x.w1 = cx.w1, v
       WHERE bg.is_test)"""


def _bigram_lp(spark, sf):
    d = _docs(spark, sf)
    return lm.bigram_logprobs(d.where(~F.col("is_test")), d.where(F.col("is_test")), "doc_id", "t")


@query("bigram_perplexity", sql=f"""WITH {_T.strip()}
SELECT doc_id, count(logp)::BIGINT AS n, round(exp(-avg(logp)), 6) AS perplexity
FROM (SELECT doc_id FROM d WHERE is_test) LEFT JOIN lp USING (doc_id) GROUP BY doc_id""")
def q_bigram_perplexity(spark, sf):
    p = lm.perplexity(_bigram_lp(spark, sf), "doc_id")
    return p.select("doc_id", "n", F.round("perplexity", 6).alias("perplexity"))


@query("mean_loss_perplexity", sql=f"""WITH {_T.strip()}
SELECT count(*)::BIGINT AS n, round(avg(-logp), 6) AS mean_loss, round(exp(avg(-logp)), 6) AS perplexity FROM lp""")
def q_mean_loss_perplexity(spark, sf):
    losses = _bigram_lp(spark, sf).where(F.col("logp").isNotNull()).select((-F.col("logp")).alias("loss"))
    p = lm.mean_loss_perplexity(losses)
    return p.select("n", F.round("mean_loss", 6).alias("mean_loss"), F.round("perplexity", 6).alias("perplexity"))


@query("pseudo_perplexity", sql=f"""
WITH d AS (SELECT doc_id, {toks('text')} AS t, {bucket('doc_id')} < 200 AS is_test FROM documents),
tg AS (SELECT doc_id, is_test, unnest(list_transform(range(1, len(t) - 1), lambda i: {{'l': t[i], 'w': t[i + 1], 'r': t[i + 2]}})) AS x FROM d),
v AS (SELECT count(DISTINCT w) AS vv FROM (SELECT unnest(t) AS w FROM d WHERE NOT is_test)),
tri AS (SELECT x.l AS l, x.w AS w, x.r AS r, count(*) AS cw FROM tg WHERE NOT is_test GROUP BY 1, 2, 3),
cx AS (SELECT x.l AS l, x.r AS r, count(*) AS cc FROM tg WHERE NOT is_test GROUP BY 1, 2),
lp AS (SELECT tg.doc_id, ln((coalesce(tri.cw, 0) + 1) / (coalesce(cx.cc, 0) + v.vv)) AS logp
       FROM tg LEFT JOIN tri ON tg.x.l = tri.l AND tg.x.w = tri.w AND tg.x.r = tri.r
       LEFT JOIN cx ON tg.x.l = cx.l AND tg.x.r = cx.r, v WHERE tg.is_test)
SELECT doc_id, count(logp)::BIGINT AS n, round(exp(-avg(logp)), 6) AS perplexity
FROM (SELECT doc_id FROM d WHERE is_test) LEFT JOIN lp USING (doc_id) GROUP BY doc_id""")
def q_pseudo_perplexity(spark, sf):
    d = _docs(spark, sf)
    lp = lm.pseudo_logprobs(d.where(~F.col("is_test")), d.where(F.col("is_test")), "doc_id", "t")
    p = lm.perplexity(lp, "doc_id")
    return p.select("doc_id", "n", F.round("perplexity", 6).alias("perplexity"))


@query("strided_windows", sql=f"""
WITH n AS (SELECT doc_id, len({toks('text')})::INTEGER AS n FROM documents),
w AS (SELECT doc_id, n, unnest(range(0, n, 256))::INTEGER AS b FROM n),
x AS (SELECT doc_id, b AS "begin", least(b + 512, n) AS "end",
             CASE WHEN b = 0 THEN 0 ELSE least(b - 256 + 512, n) END AS prev_end, n FROM w)
SELECT doc_id, "begin", "end", ("end" - prev_end)::INTEGER AS trg_len FROM x WHERE prev_end < n""")
def q_strided_windows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.size(T.tokens("text")).alias("n"))
    return (d.select("doc_id", F.explode(lm.strided_windows(F.col("n"), 512, 256)).alias("w"))
            .select("doc_id", "w.begin", "w.end", "w.trg_len"))


@query("packed_blocks", sql=f"""
WITH d AS (SELECT doc_id // 1000 AS batch, doc_id, {toks('text')} AS t FROM documents),
o AS (SELECT *, coalesce(sum(len(t)) OVER (PARTITION BY batch ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
             sum(len(t)) OVER (PARTITION BY batch) AS tot FROM d),
x AS (SELECT batch, off + generate_subscripts(t, 1) - 1 AS g, unnest(t) AS tok, tot FROM o)
SELECT batch, (g // 128)::BIGINT AS block_no, count(*)::INTEGER AS n_tokens, string_agg(tok, ' ' ORDER BY g) AS text
FROM x WHERE g // 128 < tot // 128 GROUP BY batch, g // 128""")
def q_packed_blocks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.tokens("text").alias("t"))
    b = lm.pack_blocks(d, "doc_id", "t", F.floor(F.col("doc_id") / 1000), 128)
    return b.select("batch", "block_no", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("text"))


def _h(k: int, pos: str, seed: int = 11) -> str:
    return (f"(('0x' || substr(md5('{seed}:' || CAST(doc_id AS VARCHAR) || ':' || CAST({pos} AS VARCHAR)), {8 * k + 1}, 8))::BIGINT"
            " % 1000)")


@query("masked_tokens", sql=f"""
WITH d AS (SELECT doc_id, {toks('text')} AS t FROM documents),
m AS (SELECT doc_id, list_transform(t, lambda x, i: CASE WHEN {_h(0, 'i - 1')} >= 150 THEN x
                                                          WHEN {_h(1, 'i - 1')} % 10 < 8 THEN '[MASK]'
                                                          WHEN {_h(1, 'i - 1')} % 10 = 8 THEN t[{_h(2, 'i - 1')} % len(t) + 1]
                                                          ELSE x END) AS inp,
             list_filter(list_transform(t, lambda x, i: CASE WHEN {_h(0, 'i - 1')} < 150 THEN 1 ELSE 0 END), lambda z: z = 1) AS ch
      FROM d)
SELECT doc_id, len(ch)::INTEGER AS n_masked, array_to_string(inp, ' ') AS masked_text FROM m""")
def q_masked_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.tokens("text").alias("t"))
    m = lm.mask_tokens(d, "doc_id", "t")
    return m.select("doc_id", F.size(F.filter("labels", lambda x: x.isNotNull())).alias("n_masked"),
                    F.array_join("masked", " ").alias("masked_text"))


_VOCABULARY = f"""
d AS MATERIALIZED (SELECT doc_id, {toks('text')} AS t FROM documents),
counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(t) AS word FROM d) GROUP BY word),
vocab AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) + 1 AS id FROM counts)"""
_ENCODED = f"""{_VOCABULARY},
placed AS (SELECT doc_id, generate_subscripts(t, 1) AS i, unnest(t) AS word FROM d),
listed AS (SELECT doc_id, list(id ORDER BY i) AS ids FROM placed JOIN vocab USING (word) GROUP BY doc_id),
e AS (SELECT doc_id, coalesce(ids, []) AS ids FROM d LEFT JOIN listed USING (doc_id))"""


def _words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.tokens("text").alias("t"))


def _encoded(spark, sf):
    """(doc_id, ids) of all documents, and the vocabulary of all their words."""
    d = _words(spark, sf)
    vocab = VO.vocabulary(VO.word_counts(d, "t"))
    return VO.encode(d, "doc_id", "t", vocab), vocab


@query("vocabulary_ids", sql=f"WITH {_VOCABULARY.strip()} SELECT word, n::BIGINT AS n, id::BIGINT AS id FROM vocab")
def q_vocabulary_ids(spark, sf):
    return VO.vocabulary(VO.word_counts(_words(spark, sf), "t")).select("word", "n", "id")


@query("vocabulary_by_name", sql=f"""WITH {_VOCABULARY.strip()}
SELECT word, (row_number() OVER (ORDER BY word) - 1)::BIGINT AS id FROM vocab""")
def q_vocabulary_by_name(spark, sf):
    return VO.vocabulary(VO.word_counts(_words(spark, sf), "t"), by="name", reserved=0).select("word", "id")


@query("decoded_words", sql=f"SELECT doc_id, array_to_string({toks('text')}, ' ') AS text FROM documents")
def q_decoded_words(spark, sf):
    """Every document's words after encoding and decoding."""
    ids, vocab = _encoded(spark, sf)
    return VO.decode(ids, "doc_id", "ids", vocab).select("doc_id", F.array_join("words", " ").alias("text"))


@query("fixed_length", sql=f"""WITH {_ENCODED.strip()}
SELECT doc_id, array_to_string(list_concat(ids[1:512], list_transform(range(512 - len(ids)), lambda z: 0)), ' ') AS input_ids,
       array_to_string(list_transform(range(1, 513), lambda i: CASE WHEN i <= len(ids) THEN 1 ELSE 0 END), ' ') AS attention_mask
FROM e""")
def q_fixed_length(spark, sf):
    d, _ = _encoded(spark, sf)
    return d.select("doc_id", F.array_join(T.fixed_length("ids", 512, VO.PAD), " ").alias("input_ids"),
                    F.array_join(T.attention_mask("ids", 512), " ").alias("attention_mask"))


@query("pad_masked", sql=f"""WITH {_ENCODED.strip()}
SELECT doc_id, array_to_string(list_concat(ids[1:128], list_transform(range(128 - len(ids)), lambda z: -100)), ' ') AS labels
FROM e""")
def q_pad_masked(spark, sf):
    d, _ = _encoded(spark, sf)
    return d.select("doc_id", F.array_join(T.mask_pad(T.fixed_length("ids", 128, VO.PAD), F.size("ids")), " ").alias("labels"))
