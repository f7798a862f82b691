from pyspark.sql import functions as F

from tessera.operators import lm
from tessera.operators import spans as SP
from tessera.operators.augment import apply_typos


def test_bio_spans_convention(spark):
    tags = ["B-X", "I-X", "I-Y", "O", "I-X", "B-X", "B-X"]
    rows = spark.createDataFrame([(1, i, t, f"w{i}") for i, t in enumerate(tags)], "doc_id int, pos int, tag string, token string")
    got = sorted((r["start"], r["end"], r["type"]) for r in SP.bio_spans(rows).collect())
    assert got == [(0, 1, "X"), (2, 2, "Y"), (4, 4, "X"), (5, 5, "X"), (6, 6, "X")]


def test_positive_runs(spark):
    vals = [1.0, 2.0, -1.0, 0.5, -3.0, 4.0, 4.0]
    rows = spark.createDataFrame([(1, i, f"t{i}", v) for i, v in enumerate(vals)],
                                 "doc_id int, pos int, token string, value double")
    got = sorted((r["start"], r["text"], r["compact"], r["n_tokens"]) for r in SP.positive_runs(rows).collect())
    assert got == [(0, "t0 t1", "t0t1", 2), (3, "t3", "t3", 1), (5, "t5 t6", "t5t6", 2)]


def test_subtoken_policies(spark):
    df = spark.createDataFrame([([None, 0, 0, 1, None], [5, 7])], "w array<int>, l array<int>")
    r = df.select(SP.subtoken_labels("w", "l", "repeat").alias("a"), SP.subtoken_labels("w", "l", "first").alias("b")).first()
    assert r["a"] == [-100, 5, 5, 7, -100] and r["b"] == [-100, 5, -100, 7, -100]


def test_strided_windows_match_loop(spark):
    def ref(n, L=512, s=256):
        out, prev = [], 0
        for b in range(0, n, s):
            e = min(b + L, n)
            out.append((b, e, e - prev))
            prev = e
            if e == n:
                break
        return out
    ns = [0, 1, 255, 256, 512, 513, 700, 1300]
    df = spark.createDataFrame([(n,) for n in ns], "n int")
    got = [[tuple(x) for x in r[0]] for r in df.select(lm.strided_windows(F.col("n"))).collect()]
    assert got == [ref(n) for n in ns]


def test_pack_blocks_drop_only_remainder(spark):
    df = spark.createDataFrame([(i, [f"t{i}_{j}" for j in range(n)]) for i, n in enumerate([100, 90, 77])],
                               "doc_id int, t array<string>")
    b = lm.pack_blocks(df, "doc_id", "t", F.lit(0), 128).collect()
    assert len(b) == 2 and all(len(r["tokens"]) == 128 for r in b)
    first = sorted(b, key=lambda r: r["block_no"])[0]["tokens"]
    assert first[:2] == ["t0_0", "t0_1"] and first[100] == "t1_0"


def test_typos_never_empty(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else "") for i in range(50)], "doc_id int, text string")
    out = df.select("text", apply_typos("text", F.col("doc_id"), 3).alias("o")).collect()
    for r in out:
        assert (len(r["o"]) > 0) == (len(r["text"]) > 0)


def test_bigram_perplexity_formula(spark):
    import math
    train = spark.createDataFrame([(1, ["a", "b", "a", "b"])], "doc_id int, t array<string>")
    test = spark.createDataFrame([(2, ["a", "b", "c"])], "doc_id int, t array<string>")
    lp = {r["pos"]: r["logp"] for r in lm.bigram_logprobs(train, test, "doc_id", "t").collect()}
    assert abs(lp[0] - math.log((2 + 1) / (2 + 2))) < 1e-12
    assert abs(lp[1] - math.log((0 + 1) / (1 + 2))) < 1e-12


def test_pack_blocks_against_python(spark):
    import random

    r = random.Random(5)
    rows = [(k, [f"t{k}_{j}" for j in range(r.choice([0, 1, 3, 10, 40, 300]))]) for k in range(200)] + [(500, None)]
    df = spark.createDataFrame(rows, "doc_id int, t array<string>").repartition(4)
    want = {}
    for b in range(4):
        stream = [t for k, ts in rows if ts and k // 50 == b for t in ts]
        want |= {(b, n): stream[8 * n : 8 * n + 8] for n in range(len(stream) // 8)}
    packed = lm.pack_blocks(df, "doc_id", "t", F.floor(F.col("doc_id") / 50), 8)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    # The only generator makes a row per document and block; one window, over sizes.
    assert plan.count("Generate explode") == 1 and "posexplode" not in plan and plan.count("Window [") == 1
    assert {(r["batch"], r["block_no"]): r["tokens"] for r in packed.collect()} == want


def test_pack_blocks_with_a_repeated_key(spark):
    df = spark.createDataFrame([(1, ["a"] * 5), (1, ["b"] * 5), (1, ["a"] * 5), (2, ["c"] * 3)], "doc_id int, t array<string>")
    got = lm.pack_blocks(df, "doc_id", "t", F.lit(0), 4).collect()
    assert len(got) == 4 and all(len(r["tokens"]) == 4 for r in got)
    assert sum(r["tokens"].count("a") for r in got) + sum(r["tokens"].count("b") for r in got) + sum(r["tokens"].count("c") for r in got) == 16


def _phrases(rows, key_word, levels=3):
    out = {}
    for sent in {r[0] for r in rows}:
        tokens = {i: (text, dep, head) for s, i, text, dep, head in rows if s == sent}
        keys = {i for i, t in tokens.items() if t[0] is not None and key_word in t[0]}
        if not keys:
            continue
        level = {i for i, t in tokens.items() if t[2] in keys and t[1] == "nmod"}
        found = keys | level
        for _ in range(levels):
            level = {i for i, t in tokens.items() if t[2] in level}
            found |= level
        out[sent] = " ".join(tokens[i][0] for i in sorted(found) if tokens[i][0] is not None)
    return out


def test_dependency_phrase_golden_example(spark):
    from tessera.operators.lookup import dependency_phrase

    words = "Мне нужной найти картину с портретом поэта , висящую в зале".split()
    deps = ["iobj", "advmod", "ROOT", "obj", "case", "nmod", "nmod", "punct", "acl", "case", "obl"]
    heads = [2, 2, 2, 2, 5, 3, 5, 8, 3, 10, 8]
    edges = spark.createDataFrame([(1, i, w, d, h) for i, (w, d, h) in enumerate(zip(words, deps, heads))],
                                  "sent_id int, i int, text string, dep string, head_i int")
    assert [tuple(r) for r in dependency_phrase(edges, "картин").collect()] == [(1, "картину с портретом поэта")]


def test_dependency_phrase_against_levels(spark):
    import random

    from tessera.operators.lookup import dependency_phrase

    r = random.Random(4)
    rows = []
    for s in range(60):
        places = sorted(r.sample(range(100, 160), r.randrange(1, 40)))  # places don't start at 0 and have gaps
        for n, i in enumerate(places):
            head = None if n == 0 else r.choice([*places[:n], *places, 99, 160, 10**6])
            rows.append((s, i, r.choice(["key", "mykey", "x", "y", None]), r.choice(["nmod", "nmod", "amod", None]), head))
    edges = spark.createDataFrame(rows, "sent_id int, i int, text string, dep string, head_i int").repartition(5)
    for levels in (0, 1, 3):
        got = dict(map(tuple, dependency_phrase(edges, "key", levels=levels).collect()))
        assert got == _phrases(rows, "key", levels)


def test_dependency_phrase_reads_the_edges_once(spark):
    from tessera.operators.lookup import dependency_phrase

    edges = spark.range(100).selectExpr("id div 10 sent_id", "id % 10 i", "'x' text", "'nmod' dep", "id % 10 - 1 head_i")
    plan = dependency_phrase(edges, "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def _spans(tags):
    out, start, prev = set(), None, "O"
    for i, t in enumerate([*tags, "O"]):
        begins = t.startswith("B-") or (t.startswith("I-") and (prev == "O" or prev[2:] != t[2:]))
        if start is not None and (t == "O" or begins):
            out.add((start, i - 1, tags[start][2:]))
            start = None
        if begins:
            start = i
        prev = t
    return out


def test_sequence_scores_against_python(spark):
    import random

    from tessera.operators.metrics import sequence_scores

    r = random.Random(6)
    tag = lambda: r.choice(["O", "O", "B-X", "I-X", "I-X", "B-Y", "I-Y"])
    rows = []
    for _ in range(80):
        gold = [tag() for _ in range(r.randrange(0, 25))]
        rows.append((gold, [g if r.random() < 0.8 else tag() for g in gold]))
    with_ignored = [([*g, "-100"], [*p, "B-X"]) if k % 3 else (g, p) for k, (g, p) in enumerate(rows)]
    gold, pred = ([(k, s) for k, x in enumerate(rows) for s in _spans(x[n])] for n in (0, 1))
    right = set(gold) & set(pred)
    of = lambda ss, ty: sum(ty in ("overall", s[2]) for _, s in ss)
    n = sum(len(g) for g, _ in rows)
    accuracy = sum(a == b for g, p in rows for a, b in zip(g, p)) / n
    for data, ignore in ((rows, None), (with_ignored, "-100")):
        df = spark.createDataFrame(data, "tags array<string>, ptags array<string>")
        got = {x["entity"]: x for x in sequence_scores(df, "tags", "ptags", ignore=ignore).collect()}
        assert set(got) == {"X", "Y", "overall"}
        for ty, x in got.items():
            assert (x["n_gold"], x["n_pred"], x["n_correct"]) == (of(gold, ty), of(pred, ty), of(right, ty))
            assert abs(x["accuracy"] - accuracy) < 1e-12


def test_slices_are_cut_before_they_are_gathered(spark):
    """What a block gathers, and may spill, are slices, not the whole document once per slice."""
    df = spark.createDataFrame([(1, ["a"] * 40), (2, ["b"] * 7)], "doc_id int, t array<string>")
    packed = lm.pack_blocks(df, "doc_id", "t", F.lit(0), 8)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert all("slice(" not in line for line in plan.split("\n") if "Aggregate(" in line)
    assert [r["tokens"] for r in packed.orderBy("block_no").collect()] == [["a"] * 8] * 5


def test_sequence_scores_of_nulls_and_uneven_rows(spark):
    """Null sides don't count, missing positions are no break, spans end with their row."""
    from tessera.operators.metrics import sequence_scores

    data = [(["B-X", "I-X"], ["B-X", "I-X"]), (["I-X", None, "B-Y"], ["B-X", None, "I-Y"]), (["B-X", "O"], ["B-X"]), (None, None), (None, ["B-X"]), ([], [])]
    df = spark.createDataFrame(data, "tags array<string>, ptags array<string>").coalesce(1)
    got = {x["entity"]: tuple(x)[1:4] + (x["accuracy"],) for x in sequence_scores(df, "tags", "ptags").collect()}
    assert got == {"X": (3, 3, 2, 3 / 7), "Y": (1, 1, 1, 3 / 7), "overall": (4, 4, 3, 3 / 7)}
    empty = sequence_scores(df.where("false"), "tags", "ptags").collect()
    assert [tuple(x)[:4] for x in empty] == [("overall", None, None, None)]
