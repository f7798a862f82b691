from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import lookup, topics
from tessera.sources import files


def _lines(texts, stop, lemmas, n_grams=(2,), least=2):
    """The lines by plain Python: texts are (id, language, cleaned text)."""
    names = {n: code for code, all_ in topics.LIST_LANGUAGES.items() for n in all_}
    out = {}
    for i, lang, text in texts:
        code, kept = names.get((lang or "").lower()), []
        for w in (text or "").lower().split() if code else []:
            if code == "ru" and w.isdigit():
                kept.append(w)
            elif (code, w) not in stop:
                kept.append(lemmas.get((code, w), w))
        kept = [w for w in kept if w != "-"]
        parts = [f"{w}:{c}" for w, c in Counter(kept).items()]
        for n in n_grams:
            grams = Counter("_".join(kept[k : k + n]) for k in range(len(kept) - n + 1))
            parts += [f"{g}:{c}" for g, c in grams.items() if c >= least]
        out[i] = " ".join([f"doc{i}", *parts]) if parts else ""
    return out


def test_topic_lines_against_python(spark, tmp_path):
    texts = [(1, "en", "The cats saw the cats saw THE dog - 12"), (2, "English", "the the"), (3, "RUS", "кот 12 и кот 12 и"), (4, "Русский", "и"),
             (5, "de", "der Hund"), (6, None, "x"), (7, "eng", None), (8, "ru", ""), (9, "en", "a b c a b c a b c")]
    stop = {("en", "the"), ("ru", "и"), ("ru", "12"), ("en", "12")}
    lemmas = {("en", "cats"): "cat", ("ru", "кот"): "кошка", ("ru", "12"): "двенадцать", ("en", "saw"): "-"}
    lists, forms = str(tmp_path / "lists"), str(tmp_path / "forms")
    files.write_word_lists(spark.createDataFrame([*stop, ("en", " the "), ("en", "")], "lang string, word string"), lists)
    files.write_word_lists(spark.createDataFrame([(c, f"{w}\t{m}") for (c, w), m in lemmas.items()] + [("en", "no tab")], "lang string, word string"), forms)
    docs = spark.createDataFrame(texts, "doc_id long, lang string, clean string")
    rows = topics.topic_tokens(docs, files.read_word_lists(spark, lists), files.read_lemmas(spark, forms))
    for n_grams, least in (((2,), 2), ((2, 3), 3), ((), 1)):
        got = {r["doc_id"]: r["line"] for r in topics.vw_lines(rows, which_n_grams=n_grams, min_count=least).collect()}
        assert got == _lines(texts, stop, lemmas, n_grams, least)


def test_word_lists_by_file_name(spark, tmp_path):
    (tmp_path / "en.txt").write_text("the\n a \n\nthe\n", encoding="utf-8")
    (tmp_path / "ru.txt").write_text("и\r\nне\r\n", encoding="utf-8")
    got = sorted(map(tuple, files.read_word_lists(spark, str(tmp_path)).collect()))
    assert got == [("en", "a"), ("en", "the"), ("ru", "и"), ("ru", "не")]


def test_language_table(spark, tmp_path):
    assert len(lookup.LANGUAGES) == 70 and len({r[0] for r in lookup.LANGUAGES}) == 70
    path = str(tmp_path / "languages")
    lookup.write_language_json(lookup.language_table(spark), path)
    back = lookup.read_language_json(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(lookup.LANGUAGES)
    d = spark.createDataFrame([(1, "zh"), (2, "xx"), (3, None)], "id int, lang string")
    got = {r["id"]: (r["alpha3"], r["lang_name"]) for r in lookup.lookup_language(d, "lang", back).collect()}
    assert got == {1: ("zho", "Стандартный Китайский"), 2: (None, None), 3: (None, None)}


def test_counts(spark):
    d = spark.createDataFrame([(1, "a b a b c"), (2, ""), (3, None)], "doc_id int, text string")
    assert {tuple(r) for r in topics.term_counts(d).collect()} == {(1, "a", 2), (1, "b", 2), (1, "c", 1)}
    assert {tuple(r) for r in topics.ngram_counts(d).collect()} == {(1, "a_b", 2)}


def test_profiles_are_top_words(spark):
    d = spark.createDataFrame([("a a b b c", "en"), ("x", "de")], "text string, lang string")
    assert {tuple(r) for r in topics.corpus_stop_words(d, 2).collect()} == {("en", "a"), ("en", "b"), ("de", "x")}
    pred = lookup.detect_language(d.withColumn("doc_id", F.length("text")), topics.corpus_stop_words(d, 2))
    assert {tuple(r) for r in pred.collect()} == {(9, "en", 4), (1, "de", 1)}


def test_lines_of_repeated_places_nulls_and_batches(spark):
    """A key that occurs twice has each place twice: ties go by text.  Nulls inside a text break pairs, and a text may be
    larger than a batch of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(1, p, t) for p, t in enumerate("b a b a".split()) for _ in range(2)] + [(2, -1, None)] + [(2, p, t) for p, t in enumerate("x x x x x x x".split())]
        rows += [(3, 0, "a"), (3, 1, None), (3, 2, "b"), (None, 0, "z"), (4, -1, None)]
        df = spark.createDataFrame(rows, "doc_id long, pos int, tok string").repartition(3)
        got = {r["doc_id"]: r["line"] for r in topics.vw_lines(df, which_n_grams=(2, 3), min_count=1).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[1] == "doc1 b:4 a:4 b_a:2 b_b:2 a_a:2 a_b:1 b_a_a:2 b_b_a:2 a_a_b:1 a_b_b:1"
    assert got[2] == "doc2 x:7 x_x:6 x_x_x:5" and got[3] == "doc3 a:1 b:1 a_b:1" and got[4] == "" and got[None] is None


def test_lines_keep_no_table_of_grams(spark):
    df = spark.createDataFrame([(1, 0, "a")], "doc_id long, pos int, tok string")
    plan = topics.vw_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Exchange") == 1
