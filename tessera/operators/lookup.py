"""Lookups, set comparisons and reports (JN2, JN6, JN8-JN10, ST1, ST4, AG13, AG14).

Small fixed tables are broadcast; everything that grows with the data is joined
by key with AQE handling skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators import topics

# Language code, alpha-3 code, name and script, as in the reference's language table.
LANGUAGE_TABLE = """
af afr Африканский Latin | am amh Амхарский Ethiopic | ar ara Арабский Arabic | as asm Ассамский - | be be-tarask Белорусский Cyrilic
bg bul Болгарский Cyrilic | bn asm Бенгальский Бенгальский | bs bos Боснийский Latin | ca cat Каталонский Latin | ceb ceb Кебуано Latin
co cos Косиканский Latin | cs ces Чешский Latin | cy cym Вельш Latin | da dan Датский Latin | de deu Немецкий Latin
el ell Современный Греческий Греческий | en eng Английский Latin | eo epo Эсперанто Latin | es spa Испанский Latin | et est Эстонский Latin
eu eus Баскский Latin | fa fas Персидский Arabic | fi fin Финский Latin | fr fra Французский Latin | ga gle Ирландский Latin
gl glg Галийский Latin | gu guj Гуджарати Гуджарати | hi hin Хинди Деванагари | hr hrv Хорватский Latin | hu hun Венгерский Latin
hy hye Армянский Armenian | is isl Исландский Latin | it ita Итальянский Latin | ja jpn Японский Японский | ka kat Грузинский Грузинский
kk kaz Казахский Cyrilic | ko kor Корейский Корейский | ky kir Киргизский Cyrilic | la lat Латинский Латинский | lt lit Литовский Latin
lv lav Латвийский Latin | mai mai Маратхи Деванагари | mk mkd Македонский Cyrilic | mr mai Маратхи Деванагари | ne nep Непальский Деванагари
nl nld Голландский Latin | nn nno Норвежский Latin | no nno Норвежский Latin | oc oci Occitan Latin | om orm Оромо Latin
or orm Оромо Latin | pa pnb Панджаби Панджаби | pl pol Польский Latin | pnb pnb Панджаби Панджаби | pt por Португальский Latin
ro ron Румынский Latin | ru rus Русский Cyrilic | sh sh Сербско-Хорватский Latin | sk slk Словацкий Latin | sl slv Словенский Latin
so som Сомалийский Latin | sq sqi Албанский Latin | sr srp Сербский Latin | sv swe Шведский Latin | th tha Тайский Thai
tr tur Турецкий Latin | uk ukr Украинский Cyrilic | ur urd Урду Arabic | vi vie Вьетнамский Latin | zh zho Стандартный Китайский Cyrilic
"""


def _language_rows() -> list[tuple[str, str, str, str]]:
    words = [entry.split() for line in LANGUAGE_TABLE.strip().split("\n") for entry in line.split("|")]
    return [(w[0], w[1], " ".join(w[2:-1]), w[-1]) for w in words]


LANGUAGES = _language_rows()


def language_table(spark) -> DataFrame:
    return spark.createDataFrame(LANGUAGES, "code string, alpha3 string, lang_name string, script string")


def read_language_json(spark, path: str) -> DataFrame:
    """IO6: a ``{code: [alpha3, name, script]}`` JSON file -> language table."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,array<string>>")
    return raw.select(F.explode(m).alias("code", "v")).select(
        "code", F.col("v")[0].alias("alpha3"), F.col("v")[1].alias("lang_name"), F.col("v")[2].alias("script"))


def write_language_json(languages: DataFrame, path: str) -> None:
    """IO7: a language table as one ``{code: [alpha3, name, script]}`` JSON object; some seventy entries, so one file."""
    entry = F.struct("code", F.array("alpha3", "lang_name", "script"))
    one = languages.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


def lookup_language(df: DataFrame, lang: str, languages: DataFrame) -> DataFrame:
    """JN2: left join to the language table, which Spark broadcasts if it knows it to be small."""
    t = languages.select(F.col("code").alias("_code"), "alpha3", "lang_name")
    return df.join(t, df[lang] == t["_code"], "left").drop("_code")


def language_profiles(docs: DataFrame, k: int = 50, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``k`` most frequent tokens of each language (ties by token)."""
    return topics.corpus_stop_words(docs, k, text, lang)


def detect_language(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """JN10 (re-aimed): the language whose profile the document's tokens hit
    most (ties by language code) -> ``(key, lang_pred, hits)``; without a hit the
    language is null and hits are 0."""
    t = docs.select(key, F.explode_outer(tokens(text)).alias("word"))
    hits = t.join(profiles, "word", "left").groupBy(key, "lang").agg(F.count("lang").alias("hits"))
    best = F.struct((-F.col("hits")).alias("nh"), F.col("lang").alias("l"))
    best = hits.groupBy(key).agg(F.min(F.when(F.col("lang").isNotNull(), best)).alias("_b"))
    return best.select(key, F.col("_b.l").alias("lang_pred"), F.coalesce(-F.col("_b.nh"), F.lit(0)).alias("hits"))


def text_digest(c) -> "F.Column":
    """Shuffle key standing for a whole text: SHA-256 plus length (collisions
    are not a practical concern), so grouping moves 40 bytes instead of the text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.struct(F.sha2(c, 256).alias("h"), F.length(c).alias("n"))


def duplicate_report(df: DataFrame, col: str) -> DataFrame:
    """AG13: ``(n_rows, n_distinct, n_duplicates)``; texts are compared by digest."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(text_digest(col)).alias("n_distinct")).withColumn(
        "n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def correction_report(df: DataFrame, inp: str, response: str) -> DataFrame:
    """AG14: duplicates are removed first; each distinct input is ``clean``
    (response equals input), ``corrected`` (differs) or ``skipped`` (no
    response).  One row of counts."""
    # An input's outcome is decided in its row and the input's digest is the shuffle key; of several
    # responses to one input the best outcome counts (clean, then corrected).
    kind = F.when(F.col(response).isNull(), 2).when(F.col(response) == F.col(inp), 0).otherwise(1)
    uniq = df.select(text_digest(inp).alias("_d"), kind.alias("_k")).groupBy("_d").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_k"))
    of = lambda k: F.count_if(F.col("_k") == k)
    return uniq.agg(F.count(F.lit(1)).alias("n_asked"), (F.sum("_n") - F.count(F.lit(1))).alias("n_duplicates"),
                    of(0).alias("n_clean"), of(1).alias("n_corrected"), of(2).alias("n_skipped"))


def correction_rows(df: DataFrame, inp: str, response: str) -> DataFrame:
    """AG14, the rows behind the report: ``(input, response, outcome)`` of each distinct pair."""
    kind = F.when(F.col(response).isNull(), "skipped").when(F.col(response) == F.col(inp), "clean").otherwise("corrected")
    return df.select(inp, response, kind.alias("outcome")).distinct()


def sentence_tokens(edges: DataFrame, sent: str = "sent_id", i: str = "i", text: str = "text", dep: str = "dep",
                    head: str = "head_i", having: Column | None = None) -> DataFrame:
    """``(sent, lo, t)``: a row per sentence; ``t[k]`` is the token at place ``lo + k`` (null for a place without one)
    as struct(i, text, dep, head).  One exchange of the edge table; a sentence's tokens are one row's array.
    ``having``: only sentences with a token for which this holds."""
    token = F.struct(F.col(i).alias("i"), F.col(text).alias("text"), F.col(dep).alias("dep"), F.col(head).alias("head"))
    s = edges.groupBy(sent).agg(F.array_sort(F.collect_list(token)).alias("_s"), F.bool_or(F.lit(True) if having is None else having).alias("_has")).where("_has")
    after = F.concat(F.slice("_s", 2, F.greatest(F.size("_s") - 1, F.lit(0))), F.array(F.lit(None).cast(s.schema["_s"].dataType.elementType)))
    none = F.lit(None).cast(s.schema["_s"].dataType.elementType)
    # Places without a token between two tokens are filled, so that a head's place is its index.
    filled = F.zip_with("_s", after, lambda x, y: F.concat(F.array(x), F.array_repeat(none, F.coalesce((y["i"] - x["i"] - 1).cast("int"), F.lit(0)))))
    return s.select(sent, F.get("_s", F.lit(0))["i"].alias("lo"), F.flatten(filled).alias("t"))


def dependency_phrase(edges: DataFrame, key_word: str, sent: str = "sent_id", i: str = "i", text: str = "text",
                      dep: str = "dep", head: str = "head_i", levels: int = 3) -> DataFrame:
    """JN8: every token containing ``key_word``, its ``nmod`` children and ``levels`` further generations below them,
    gathered for the whole sentence and output once in token order -> ``(sent, phrase)``; sentences without such a
    token have no row.

    A walk of the tree inside the sentence's row: a token belongs to the phrase if one of its first ``levels + 1``
    heads is a key token and the token on the path just below that head is its ``nmod`` child.  So each token climbs a
    fixed number of heads by index, and nothing is joined."""
    s = sentence_tokens(edges, sent, i, text, dep, head, having=F.col(text).contains(key_word))
    up = lambda x: F.get(F.col("t"), (x["head"] - F.col("lo")).cast("int"))
    is_key = lambda x: F.coalesce(x["text"].contains(key_word), F.lit(False))

    def member(x):
        found = is_key(x)
        for _ in range(levels + 1):
            above = up(x)
            found = found | (is_key(above) & F.coalesce(x["dep"] == "nmod", F.lit(False)))
            x = above
        return found

    return s.select(sent, F.array_join(F.transform(F.filter("t", member), lambda x: x["text"]), " ").alias("phrase"))


def phrase_root(edges: DataFrame, sent: str = "sent_id", i: str = "i", text: str = "text",
                dep: str = "dep") -> DataFrame:
    """JN9: the first token with ``dep = ROOT`` of each sentence."""
    return edges.where(F.col(dep) == "ROOT").groupBy(sent).agg(F.min_by(text, i).alias("root"))
