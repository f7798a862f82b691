"""Naive Bayes text classifier: AG1-AG4, JN1, TX3/TX4, SP4.

The model is a DataFrame ``(word, n_pos, n_neg, loglik)``, never a driver dict.
Scoring joins each document's distinct words to it once (so a hot word costs one
row per document) and sums; AQE turns the join into a broadcast when the model
turns out small at runtime and splits skewed word partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.functions.text import clean_tweet, not_punctuation, word_pieces

# The English stop-word list the classifier removes (179 words).
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at "
    "by for with about against between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn "
    "doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()


def classifier_tokens(text, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """TX3 + TX4: the cleaned, lower-cased text's words and punctuation marks, split from each other,
    minus stop words and punctuation (a token goes when it is a substring of the punctuation set)."""
    # ``isin`` over a literal list is planned as a hashed ``InSet``: O(1) per
    # token instead of a scan of the list.
    return F.filter(word_pieces(F.lower(clean_tweet(text))),
                    lambda w: ~w.isin(*stop_words) & not_punctuation(w))


def split_test(df: DataFrame, key: str = "doc_id", test_per_mille: int = 200, seed: int = 42) -> DataFrame:
    """SP4: rule-H split; ``is_test`` when the bucket is below ``test_per_mille``."""
    return df.withColumn("is_test", hash_bucket(key, seed=seed) < test_per_mille)


def word_label_counts(train: DataFrame, toks: str = "words", label: str = "label") -> DataFrame:
    """AG1: ``(word, label, n)``."""
    return (train.select(F.explode(toks).alias("word"), F.col(label).alias("label"))
            .groupBy("word", "label").agg(F.count(F.lit(1)).alias("n")))


def fit(counts: DataFrame, train: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """AG2: returns ``(model, prior)``.

    ``model``: ``(word, n_pos, n_neg, loglik)`` with add-one smoothing,
    ``loglik = ln((n_pos+1)/(N_pos+V)) - ln((n_neg+1)/(N_neg+V))``.
    ``prior``: one row ``(logprior, vocab, total_pos, total_neg, D_pos, D_neg)``.
    Positive means label > 0 for word totals and label == 1 for documents.
    """
    words = counts.groupBy("word").agg(
        F.sum(F.when(F.col("label") > 0, F.col("n")).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col("label") > 0, 0).otherwise(F.col("n"))).alias("n_neg"))
    # Spark names are case-insensitive: the totals get names distinct from n_pos/n_neg.
    totals = words.agg(F.count(F.lit(1)).alias("vocab"), F.sum("n_pos").alias("total_pos"),
                       F.sum("n_neg").alias("total_neg"))
    docs = train.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("D_pos"),
                     F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("D_neg"))
    prior = totals.crossJoin(docs).withColumn("logprior", F.ln("D_pos") - F.ln("D_neg"))
    # ``prior`` is one row: the cross join is a broadcast of a single row.
    model = words.crossJoin(F.broadcast(prior.select("vocab", "total_pos", "total_neg"))).select(
        "word", "n_pos", "n_neg",
        (F.ln((F.col("n_pos") + 1) / (F.col("total_pos") + F.col("vocab")))
         - F.ln((F.col("n_neg") + 1) / (F.col("total_neg") + F.col("vocab")))).alias("loglik"))
    return model, prior


def predict(docs: DataFrame, model: DataFrame, prior: DataFrame, key: str = "doc_id",
            toks: str = "words") -> DataFrame:
    """AG3 + JN1: ``score = logprior + sum(loglik)`` over the words found in the
    model (each occurrence counts, unknown words add nothing); ``pred = score > 0``."""
    # Counted map-side, so that each distinct word of a document is joined once.
    words = docs.select(key, F.explode_outer(toks).alias("word"))
    per_doc = words.groupBy(key, "word").agg(F.count("word").alias("c"))
    joined = per_doc.join(model.select("word", "loglik"), "word", "left")
    sums = joined.groupBy(key).agg(F.sum(F.col("c") * F.coalesce(F.col("loglik"), F.lit(0.0))).alias("s"))
    scored = sums.crossJoin(F.broadcast(prior.select("logprior")))
    score = F.col("logprior") + F.col("s")
    return scored.select(key, score.alias("score"), (score > 0).cast("int").alias("pred"))


def accuracy(scored: DataFrame, truth: DataFrame, key: str = "doc_id", label: str = "label") -> DataFrame:
    """AG4: ``1 - mean(|pred - label|)`` and the test size."""
    j = scored.join(truth.select(key, label), key)
    return j.agg(F.count(F.lit(1)).alias("n_test"),
                 (F.lit(1.0) - F.avg(F.abs(F.col("pred") - F.col(label)))).alias("accuracy"))
