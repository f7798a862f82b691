from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.cleaning import phrase_clean
from tessera.operators.topics import clean_text


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_clean_string_and_first_n(spark):
    assert one(spark, T.clean_string("s"), "  a\tb\n\n c  ") == "a b c"
    assert one(spark, T.first_n_tokens("s", 2), " x  y\nz ") == "x y"
    assert one(spark, T.first_n_tokens("s", 300), "") == ""


def test_tokens_unicode_whitespace(spark):
    # Python's str.split() treats NBSP as whitespace; so does rule T.
    assert one(spark, T.tokens("s"), "A b  C") == ["a", "b", "c"]


def test_clean_tweet(spark):
    assert one(spark, T.clean_tweet("s"), "RT  $GE up #win see https://x.y/z tail\nnext") == "up win see next"


def test_collapse_repeats_loses_last(spark):
    from tessera.operators.topics import collapse_repeats

    df = spark.createDataFrame([("a a b b b c c",), ("",), ("x",), ("ab a a ab",)], "t string")
    got = [tuple(r) for r in df.select(collapse_repeats("t"), collapse_repeats("t", keep_last=True)).collect()]
    assert got == [("a b", "a b c"), ("", ""), ("", "x"), ("ab a", "ab a ab")]


def test_cut_at_marker(spark):
    assert one(spark, T.cut_at_marker("s"), "<s>a b</s><pad><pad>") == "<s>a b</s>"
    assert one(spark, T.cut_at_marker("s", "[SEP]", keep_marker=False), "x y [SEP] z") == "x y"
    assert one(spark, T.cut_at_marker("s"), "no marker") == "no marker"


def test_markup_line_clean(spark):
    assert one(spark, T.markup_line_clean("s"), '<a href="/x">kommen</a>\n') == "kommen"
    assert one(spark, T.markup_line_clean("s"), "plain") is None


def test_phrase_clean_quirks(spark):
    # Brackets run to the last reachable closer without crossing ')'; the
    # 'to' prefix loses three characters; block-list substrings vanish.
    assert one(spark, phrase_clean("s"), "to insult [coll.] somebody") == "insult somebody"
    assert one(spark, phrase_clean("s"), "total med. idiot") == "al idiot"


def test_topic_clean_text(spark):
    out = one(spark, clean_text("s"), "Cats 12.5 cats, dogs dogs photo.jpg end")
    assert out == "Cats cats dogs"


def test_quote_like_python(spark):
    from urllib.parse import quote
    for term in ["a b/c*~é+", "Straße", "x&y"]:
        assert one(spark, T.quote("s"), term) == quote(term)


def test_html_text(spark):
    html = "<html><head><title>T</title><script>var a='</p>';</script></head><body><p>A &amp; B</p><!-- c --></body></html>"
    assert one(spark, T.first_n_tokens(T.html_text("s"), 300), html) == "TA & B"


def test_cyrillic(spark):
    assert one(spark, T.is_cyrillic("s"), "слово") is True
    assert one(spark, T.is_cyrillic("s"), "ёё") is False


def test_numeric_references(spark):
    rows = [("a&#39;b &#x41;&#X42; &#128512;",), ("&amp;#39; &#0; &#xD800; &#x110000; &#99999999999999999999;",), ("&#39",), ("&#;",), (None,), ("&#000065;&#65;",)]
    got = [r[0] for r in spark.createDataFrame(rows, "h string").select(T.html_entities("h")).collect()]
    assert got == ["a'b AB \U0001F600", "&#39; \ufffd \ufffd \ufffd \ufffd", "&#39", "&#;", None, "AA"]


def test_html_tables(spark):
    html = ("<p>x<table id=a><tr><td>1</td></tr></table><TABLE><tr><th>K</th><TH class='x'> N <b>o</b></TH></tr>\n"
            "<tr><td>a&amp;b</td><td></td></tr><tr></tr></TABLE>")
    df = spark.createDataFrame([(html,), ("",), (None,)], "h string")
    got = [r[0] for r in df.select(T.html_tables("h")).collect()]
    assert got == [[[["1"]], [["K", "N o"], ["a&b", ""], []]], [], None]
    assert df.select(F.get(T.html_tables("h"), F.lit(5))).first()[0] is None


def test_limit_by_tokens_reports_discards(spark):
    from tessera.operators.cleaning import limit_by_tokens

    a = lambda n: ["w"] * n
    df = spark.createDataFrame([(1, a(2), a(2)), (2, a(4), a(1)), (3, a(1), a(4)), (4, a(4), a(4)), (5, None, a(1)), (6, [], [])], "id int, a array<string>, b array<string>")
    kept, report = limit_by_tokens(df, "a", "b", 3)
    assert sorted(r["id"] for r in kept.collect()) == [1, 6] and kept.columns == df.columns
    assert report.get == {"n_rows": 6, "n_kept": 2, "n_discarded": 4, "n_long_a": 3, "n_long_b": 2}


def test_repair_label(spark):
    df = spark.createDataFrame([("Б-X",), ("True",), ("B-True",), ("ё",), ("O",), (None,)], "t string")
    assert [r[0] for r in df.select(T.repair_label("t")).collect()] == ["O", "1", "B-1", "ё", "O", None]


def test_caller_functions_see_nulls(spark):
    import pandas as pd

    from tessera.operators.udf import apply_column

    @F.pandas_udf("string")
    def shout(s: pd.Series) -> pd.Series:
        return s.str.upper()

    df = spark.createDataFrame([("a",), (None,), ("",)], "t string")
    assert [r[0] for r in apply_column(df, "t", shout).collect()] == ["A", None, ""]
    assert [r["u"] for r in apply_column(df, "t", F.length, out="u").collect()] == [1, None, 0]
