import math
from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import dates as DT
from tessera.operators import similarity as SM


def test_golden_dates(spark):
    df = spark.createDataFrame([("2021", "сеньбря ", "двеятнадцтое"), ("2022", "прпеля", "шшестого"),
                                ("2023", "2", "30"), ("2020", "02", "29")], "y string, m string, d string")
    out = [r[0] for r in df.select(DT.words_to_date("y", "m", "d")).collect()]
    assert out == ["2021-09-12", "2022-04-06", "Invalid date", "2020-02-29"]
    out2 = sorted(r["date"] for r in DT.words_to_dates(df, "y", "m", "d").collect())
    assert out2 == sorted(out)


def test_nearest_string_ties_first_list(spark):
    df = spark.createDataFrame([("cat",)], "w string")
    r = SM.nearest_string(df, "w", [["bat", "cab"], ["cut"]]).first()
    assert (r["nearest"], r["distance"], r["list_no"], r["list_pos"]) == ("bat", 1, 0, 0)


def _bleu_ref(ref, cand):
    bp = 1 if len(ref) > len(cand) else math.exp(1 - len(ref) / len(cand))
    ps = []
    for n in range(1, 5):
        r = Counter(tuple(ref[i:i + n]) for i in range(len(ref) - n + 1))
        c = Counter(tuple(cand[i:i + n]) for i in range(len(cand) - n + 1))
        ps.append(sum(min(v, c.get(k, 0)) for k, v in r.items()) / sum(r.values()))
    if min(ps) == 0:
        return bp * 0.0
    return bp * math.exp(sum(0.25 * math.log(p) for p in ps))


def test_bleu_rouge_jaccard_against_python(spark):
    ref = "the cat sat on the mat today".split()
    cand = "the cat sat on the mat".split()
    pairs = spark.createDataFrame([(1, 2, ref, cand)], "item_id int, doc_id int, ref array<string>, cand array<string>")
    clip = {r["n"]: r for r in SM.clipped_counts(pairs, ["item_id", "doc_id"], "cand", "ref").collect()}
    assert (clip[1]["cand_total"], clip[1]["ref_total"]) == (len(cand), len(ref))
    ps = [clip[n]["clipped"] / clip[n]["ref_total"] for n in (1, 2, 3, 4)]
    df = spark.createDataFrame([ps + [len(ref), len(cand)]], "p1 double, p2 double, p3 double, p4 double, rl int, cl int")
    r = df.select((SM.brevity_penalty("rl", "cl") * SM.geometric_precision("p1", "p2", "p3", "p4")).alias("b"),
                  SM.rouge1(F.lit(clip[1]["clipped"]), "cl", "rl").alias("r")).first()
    assert abs(r["b"] - _bleu_ref(ref, cand)) < 1e-12
    overlap = sum((Counter(cand) & Counter(ref)).values())
    p, rc = overlap / len(cand), overlap / len(ref)
    assert abs(r["r"] - 2 * p * rc / (p + rc)) < 1e-12
    j = spark.createDataFrame([(cand, ref)], "a array<string>, b array<string>").select(SM.jaccard("a", "b")).first()[0]
    assert abs(j - len(set(cand) & set(ref)) / len(set(cand) | set(ref))) < 1e-12


def test_quantity_extract_branches(spark):
    from tessera.operators.quantity import extract_quantity
    df = spark.createDataFrame([(1, "2,5 тыс рублей"), (2, "три кошки шт"), (3, "красный шар"),
                                (4, "1 234 коробки -")], "id int, line string")
    got = {r["id"]: (r["number"], r["rest"]) for r in extract_quantity(df, "line").collect()}
    assert got[1] == ("2500", "рублей")
    assert got[2] == ("три", "три")
    assert got[3] == ("1", "красный шар")
    assert got[4] == ("1234", "коробки")


def test_bleu_standard_flag(spark):
    ref = "the cat sat on the mat".split()
    cand = "the cat sat on the mat today".split()
    def clip(n):
        r = Counter(tuple(ref[i:i + n]) for i in range(len(ref) - n + 1))
        c = Counter(tuple(cand[i:i + n]) for i in range(len(cand) - n + 1))
        return sum((r & c).values())
    row = [float(clip(n)) for n in (1, 2, 3, 4)] + [len(ref), len(cand)]
    df = spark.createDataFrame([row], "c1 double, c2 double, c3 double, c4 double, rl int, cl int")
    cl = {n: f"c{n}" for n in (1, 2, 3, 4)}
    r = df.select(SM.bleu(cl, "rl", "cl").alias("q"), SM.bleu(cl, "rl", "cl", standard=True).alias("s")).first()
    assert abs(r["q"] - _bleu_ref(ref, cand)) < 1e-12
    ps = [clip(n) / (len(cand) - n + 1) for n in (1, 2, 3, 4)]
    assert abs(r["s"] - math.exp(sum(0.25 * math.log(p) for p in ps))) < 1e-12


def test_listed_spans(spark):
    from tessera.operators.spans import count_listed_spans
    rows = [("['bad word', 'x']",), ('["x", "it\'s"]',), ("['it\\'s', 'a\\\\b']",), ("no list",), ("[]",), (None,)]
    got = dict(count_listed_spans(spark.createDataFrame(rows, "s string"), "s").collect())
    assert got == {"bad word": 1, "x": 2, "it's": 2, "a\\b": 1}
