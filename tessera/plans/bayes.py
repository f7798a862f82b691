"""Naive Bayes toxicity classifier on ``documents`` x ``labels`` (flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import bayes
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket, lit
from tessera.session import stored
from tessera.sources.tables import table

_STOP = "[" + ", ".join(lit(w) for w in bayes.ENGLISH_STOP_WORDS) + "]"
_PUNCT = lit("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_CLEAN = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(d.text, '\\$[\\p{L}\\p{N}_]*', '', 'g'), "
          "'^RT\\s+', ''), 'https?://.*[\\r\\n]*', '', 'g'), '#', '', 'g')")

_BASE = f"""
lab AS (SELECT d.doc_id, l.toxic AS label, {bucket('d.doc_id')} < 200 AS is_test,
               list_filter(regexp_extract_all(lower({_CLEAN}), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]'), lambda w: NOT list_contains({_STOP}, w) AND instr({_PUNCT}, w) = 0) AS words
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
cnt AS (SELECT word, label, count(*)::BIGINT AS n
        FROM (SELECT unnest(words) AS word, label FROM lab WHERE NOT is_test) GROUP BY word, label),
wd AS (SELECT word, sum(CASE WHEN label > 0 THEN n ELSE 0 END)::BIGINT AS n_pos,
              sum(CASE WHEN label > 0 THEN 0 ELSE n END)::BIGINT AS n_neg FROM cnt GROUP BY word),
tot AS (SELECT count(*) AS v, sum(n_pos) AS np, sum(n_neg) AS nn FROM wd),
pri AS (SELECT ln(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)) - ln(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)) AS logprior
        FROM lab WHERE NOT is_test),
model AS (SELECT word, n_pos, n_neg, ln((n_pos + 1) / (np + v)) - ln((n_neg + 1) / (nn + v)) AS loglik FROM wd, tot),
tw AS (SELECT doc_id, unnest(words) AS word FROM lab WHERE is_test),
sc AS (SELECT t.doc_id, coalesce(sum(m.loglik), 0) + (SELECT logprior FROM pri) AS score
       FROM (SELECT doc_id FROM lab WHERE is_test) t LEFT JOIN tw ON t.doc_id = tw.doc_id
       LEFT JOIN model m ON tw.word = m.word GROUP BY t.doc_id)"""


def _prepared(spark, sf):
    """(doc_id, label, is_test, words): tokenised once and written; counts, priors and scores read it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    lab = bayes.split_test(docs.join(labels, "doc_id"))
    return stored(lab.select("doc_id", "label", "is_test", bayes.classifier_tokens("text").alias("words")), "labelled-words")


def _trained(spark, sf):
    lab = _prepared(spark, sf)
    train = lab.where(~F.col("is_test"))
    counts = bayes.word_label_counts(train)
    model, prior = bayes.fit(counts, train)
    return lab, counts, model, prior


@query("nb_word_label_counts", sql=f"WITH {_BASE.strip()} SELECT word, label, n FROM cnt")
def q_counts(spark, sf):
    return _trained(spark, sf)[1]


@query("nb_model", sql=f"WITH {_BASE.strip()} SELECT word, n_pos, n_neg, round(loglik, 6) AS loglik FROM model")
def q_model(spark, sf):
    model = _trained(spark, sf)[2]
    return model.select("word", "n_pos", "n_neg", F.round("loglik", 6).alias("loglik"))


def _scores(spark, sf):
    lab, _, model, prior = _trained(spark, sf)
    return lab, bayes.predict(lab.where(F.col("is_test")), model, prior)


@query("nb_scores", sql=f"""WITH {_BASE.strip()}
SELECT doc_id, round(score, 6) AS score, CAST(score > 0 AS INTEGER) AS pred FROM sc""")
def q_scores(spark, sf):
    _, scored = _scores(spark, sf)
    return scored.select("doc_id", F.round("score", 6).alias("score"), "pred")


@query("nb_accuracy", sql=f"""WITH {_BASE.strip()}
SELECT count(*)::BIGINT AS n_test, round(1 - avg(abs(CAST(sc.score > 0 AS INTEGER) - lab.label)), 6) AS accuracy
FROM sc JOIN lab ON sc.doc_id = lab.doc_id""")
def q_accuracy(spark, sf):
    lab, scored = _scores(spark, sf)
    acc = bayes.accuracy(scored, lab.where(F.col("is_test")))
    return acc.select("n_test", F.round("accuracy", 6).alias("accuracy"))
