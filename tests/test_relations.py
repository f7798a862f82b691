from pyspark.sql import functions as F

from tessera.operators import relations as R


def parse(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return [tuple(x) for x in df.select(R.extract_triplets("t")).first()[0]]


def test_triplet_example(spark):
    text = ("<s><triplet> Moscow <subj> Russia <obj> country <subj> Europe <obj> part of"
            "<triplet> Paris <subj> France <obj> capital of</s>")
    assert parse(spark, text) == [("Moscow", "country", "Russia"), ("Moscow", "part of", "Europe"),
                                  ("Paris", "capital of", "France")]
    assert parse(spark, "") == []


def test_micro_scores_null_guess_counts(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", None), ("b", "a"), ("no relation", "b")],
                                  "gold string, guess string")
    got = {r["relation"]: r for r in R.micro_scores(pairs).collect()}
    micro = got["micro"]
    assert (micro["n_gold"], micro["n_guessed"], micro["n_correct"]) == (3, 4, 1)
    assert abs(micro["precision"] - 0.25) < 1e-12 and abs(micro["recall"] - 1 / 3) < 1e-12
    assert got["b"]["n_guessed"] == 1 and got["b"]["precision"] == 0.0


def test_set_scores_macro_includes_zero_types(spark):
    keys = "s int, type string, head string, tail string, head_type string, tail_type string"
    gold = spark.createDataFrame([(1, "x", "A", "B", "p", "q"), (1, "y", "C", "D", "p", "q")], keys)
    pred = spark.createDataFrame([(1, "x", "A", "B", "p", "z")], keys)
    b = {r["rel_type"]: r for r in R.set_scores(gold, pred, ["s"], ["x", "y", "w"]).collect()}
    assert (b["x"]["tp"], b["y"]["fn"], b["ALL"]["tp"]) == (1, 1, 1)
    assert abs(b["MACRO"]["f1"] - 100.0 / 3) < 1e-9
    s = {r["rel_type"]: r for r in R.set_scores(gold, pred, ["s"], ["x", "y"], mode="strict").collect()}
    assert s["x"]["tp"] == 0 and s["x"]["fp"] == 1


def test_paired_types(spark):
    df = spark.createDataFrame([([("a", "t1", "b")], [("a", "t2", "b"), ("c", "t3", "d")])],
                               f"g {R.TRIPLET_TYPE}, p {R.TRIPLET_TYPE}")
    assert [tuple(x) for x in df.select(R.paired_types("g", "p")).first()[0]] == [("t1", "t2")]
    df2 = spark.createDataFrame([([("a", "t1", "b")], [])], f"g {R.TRIPLET_TYPE}, p {R.TRIPLET_TYPE}")
    assert [tuple(x) for x in df2.select(R.paired_types("g", "p")).first()[0]] == [("t1", None)]
    _ = F


def test_type_histogram_is_one_aggregation(spark):
    from tessera.operators.relations import type_histogram

    df = spark.createDataFrame([("train", "a"), ("train", "a"), ("test", "a"), ("test", None), (None, "b")], "split string, type string")
    h = type_histogram(df)
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Exchange") == 1
    assert sorted(map(tuple, h.collect()), key=str) == sorted(
        [("train", "a", 2), ("test", "a", 1), ("test", None, 1), (None, "b", 1), ("total", "a", 3), ("total", None, 1), ("total", "b", 1)], key=str)


def test_triplets_of_odd_texts_against_a_walk_over_words(spark):
    import random

    def walk(text):
        for a, b in ((">", "> "), ("<", " <"), ("<s>", ""), ("<pad>", ""), ("</s>", "")):
            text = text.replace(a, b)
        out, cur, now = [], "x", {"t": "", "s": "", "o": ""}
        for w in text.split():
            if w in ("<triplet>", "<subj>", "<obj>"):
                cur = w[1]
                if cur in "ts" and now["o"]:
                    out.append((now["t"].strip(), now["o"].strip(), now["s"].strip()))
                now.update({"t": {"t": "", "o": ""}, "s": {"s": ""}, "o": {"o": ""}}[cur])
            elif cur != "x":
                now[cur] += " " + w
        return out + ([(now["t"].strip(), now["o"].strip(), now["s"].strip())] if all(now.values()) else [])

    r = random.Random(4)
    words = ["<triplet>", "<subj>", "<obj>", "<triplet>", "<subj>", "<obj>", "<s>", "</s>", "<pad>", "a", "b\tc", "x > y", "<", "<<obj>", "tri<plet>", "", " "]
    texts = ["".join(r.choice(words) + r.choice([" ", " ", ""]) for _ in range(r.randrange(25))) for _ in range(300)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {x["k"]: [tuple(y) for y in x["v"]] for x in df.select("k", R.extract_triplets("t").alias("v")).collect()}
    assert got == {k: walk(t) for k, t in enumerate(texts)}
