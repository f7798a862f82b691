import math

from pyspark.sql import functions as F

from tessera.operators import bayes


def test_fit_predict_matches_formula(spark):
    train = spark.createDataFrame([(1, ["good", "fun"], 1), (2, ["bad", "fun"], 0), (3, ["bad"], 0)],
                                  "doc_id int, words array<string>, label int")
    counts = bayes.word_label_counts(train)
    model, prior = bayes.fit(counts, train)
    m = {r["word"]: r["loglik"] for r in model.collect()}
    V, npos, nneg = 3, 2, 3
    assert abs(m["good"] - (math.log(2 / (npos + V)) - math.log(1 / (nneg + V)))) < 1e-12
    assert abs(prior.first()["logprior"] - (math.log(1) - math.log(2))) < 1e-12
    test = spark.createDataFrame([(9, ["good", "good", "unknown"]), (10, [])], "doc_id int, words array<string>")
    s = {r["doc_id"]: r for r in bayes.predict(test, model, prior).collect()}
    assert abs(s[9]["score"] - (math.log(0.5) + 2 * m["good"])) < 1e-12
    assert s[10]["pred"] == 0 and abs(s[10]["score"] - math.log(0.5)) < 1e-12


def test_classifier_tokens(spark):
    df = spark.createDataFrame([("RT The cat, is #happy !",)], "t string")
    assert df.select(bayes.classifier_tokens("t")).first()[0] == ["cat", "happy"]
    _ = F
