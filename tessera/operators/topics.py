"""Topic-model data: cleaning, stop words, unigram/n-gram counts, VW lines.

AG10 / TX5-TX8 / WN4, IO6.  Cleaning is regexes inside the row.  Tokens then are
rows: stop lists and lemma tables are joined on (language, word), whatever their
size; one exchange by document serves the line, whose counts are made from the document's rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.sequences import ngrams
from tessera.functions.text import WS, _c, tokens

# The punctuation set deleted by the topic-model cleaner, in the
# reference's order (it repeats a few characters; deletion is unaffected).
TOPIC_PUNCTUATION = ("–.—,€$¶№%£♫♪░▒▓♫│♪╖╣║╕╗╝┤╡╢▸╛�®‰™⏰⌚⌛⏳©¬³°¯²§±‡†¾½¼µ☒☐•!\"#$%&\\'()*+,“”/:;<=>?[\\\\]^_`{|}~’‘«»…")

# Numbers and ranges, and image file names, removed by the cleaner.
NUMBER_PATTERN = "[0-9.]+(-[0-9.]+)?"
IMAGE_PATTERN = "(?i)[\\p{L}\\p{N}_-]*.jpeg|[\\p{L}\\p{N}_-]*.png|[\\p{L}\\p{N}_-]*.jpg"

# The names by which a language with a stop list is called.
LIST_LANGUAGES = {"ru": ("ru", "русский", "russian", "rus"), "en": ("en", "english", "eng")}


def list_language(lang) -> Column:
    """The code of the stop list for a language's code or name in any case; null for a language without one."""
    name = F.lower(_c(lang))
    found = F.lit(None).cast("string")
    for code, names in LIST_LANGUAGES.items():
        found = F.when(name.isin(*names), F.lit(code)).otherwise(found)
    return found


# A run of equal space-separated tokens (whole tokens only), for TX6 on strings.
REPEAT_RUN = "(?<![^ ])([^ ]+)(?: \\1(?![^ ]))+"


def collapse_repeats(text, keep_last: bool = False) -> Column:
    """TX6 on a text of single-spaced tokens: a run of equal tokens becomes one.  The reference compares each token
    with the next and so loses the last one; ``keep_last=True`` keeps it."""
    once = F.regexp_replace(_c(text), REPEAT_RUN, "$1")
    return once if keep_last else F.regexp_replace(once, " ?[^ ]+$", "")


def _collapse_stage(text) -> Column:
    """Numbers, punctuation, whitespace, TX6 repeat collapse (string form)."""
    t = F.regexp_replace(_c(text), WS, " ")
    t = F.regexp_replace(t, NUMBER_PATTERN, "")
    t = F.translate(t, TOPIC_PUNCTUATION, "")
    return collapse_repeats(F.trim(F.regexp_replace(t, WS, " ")))


def _image_stage(t: Column) -> Column:
    """Image names removed, only from texts that can contain one; strip."""
    low = F.lower(t)
    has_image = low.contains("jpeg") | low.contains("jpg") | low.contains("png")
    return F.trim(F.when(has_image, F.regexp_replace(t, IMAGE_PATTERN, "")).otherwise(t))


def clean_text(text) -> Column:
    """TX5 + TX6: collapse whitespace, drop numbers and punctuation, tokenise,
    collapse repeated tokens (last token lost, as in the reference), drop image
    names, strip.  Returns the cleaned string.

    The
    image-name regex only runs on texts that contain ``jpeg``/``jpg``/``png``
    (it cannot match otherwise).  On DataFrames prefer ``clean_texts``, which
    materialises the first stage so that the guard does not re-run it."""
    return _image_stage(_collapse_stage(text))


def clean_texts(df: DataFrame, text: str = "text", out: str = "clean") -> DataFrame:
    """``clean_text`` in two projections: the guard of the second stage reads a
    materialised column instead of re-evaluating the regex chain."""
    staged = df.withColumn("_stage1", _collapse_stage(text))
    return staged.withColumn(out, _image_stage(F.col("_stage1"))).drop("_stage1")


def language_word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, word, n)``; partial aggregation keeps the shuffle at distinct (lang, word) pairs per task."""
    return (docs.select(F.col(lang).alias("lang"), F.explode(tokens(text)).alias("word"))
            .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    """``(lang, word)``: the ``k`` most frequent words of each language (ties by word), a group limit."""
    w = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("word"))
    return counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).select("lang", "word")


def corpus_stop_words(docs: DataFrame, k: int = 50, text: str = "text", lang: str = "lang") -> DataFrame:
    """A stop table ``(lang, word)`` derived by rule: the ``k`` most frequent tokens of each language."""
    return most_frequent(language_word_counts(docs, text, lang), k)


def topic_tokens(docs: DataFrame, stop: DataFrame, lemmas: DataFrame | None = None, key: str = "doc_id", text: str = "clean",
                 lang: str = "lang") -> DataFrame:
    """TX7 + TX8 as rows ``(key, pos, tok)``: the lower-cased tokens of ``text`` that the stop list ``(lang, word)`` of the
    row's language (``list_language``) doesn't hold, replaced by their lemma from ``(lang, form, lemma)`` where there is
    one.  Russian keeps digit tokens as they are; a language without a list has no tokens; ``-`` tokens go.  Each
    document also has one row of pos -1 without a token, so that none is lost.

    Joins on (language, word): Spark broadcasts a list that it knows to be small and otherwise splits hot words."""
    code = list_language(lang)
    words = F.coalesce(F.when(code.isNotNull(), tokens(F.col(text))), F.array().cast("array<string>"))
    places = F.concat(F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("tok"))),
                      F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("tok"))))
    rows = docs.select(key, code.alias("_code"), F.inline(places))
    digits = (F.col("_code") == "ru") & F.col("tok").rlike("^[0-9]+$")
    # A digit token that stays has no word to be looked up by.
    rows = rows.withColumn("_word", F.when(~F.coalesce(digits, F.lit(False)), F.col("tok")))
    listed = stop.select(F.col("lang").alias("_code"), F.col("word").alias("_word")).distinct()
    rows = rows.join(listed, ["_code", "_word"], "left_anti")
    if lemmas is not None:
        table = lemmas.select(F.col("lang").alias("_code"), F.col("form").alias("_word"), F.lower("lemma").alias("_lemma"))
        rows = rows.join(table, ["_code", "_word"], "left").withColumn("tok", F.coalesce("_lemma", "tok"))
    return rows.where(F.col("tok").isNull() | (F.col("tok") != "-")).select(key, "pos", "tok")


def _counted(toks: list, pos: np.ndarray, which_n_grams, min_count: int) -> str:
    """The counts of a document's line, from its tokens in order."""
    rising, parts = bool(np.all(np.diff(pos) > 0)), []
    for kind, n in enumerate((1, *which_n_grams)):
        shifted = [toks[m:] for m in range(n)]
        if None in toks:
            grams = ["_".join(x for x in g if x is not None) if g[0] is not None and g[-1] is not None else None for g in zip(*shifted)]
        else:
            grams = toks if n == 1 else list(map("_".join, zip(*shifted)))
        found = [(g, c) for g, c in Counter(grams).items() if g is not None and (kind == 0 or c >= min_count)]
        if not rising:  # Where places repeat, several grams begin at one: they go by their text.
            first: dict = {}
            for g, p in zip(grams, pos.tolist()):
                first.setdefault(g, p)
            found.sort(key=lambda x: (first[x[0]], f"{x[0]}:{x[1]}"))
        parts += [f"{g}:{c}" for g, c in found]
    return " ".join(parts)


def _lines(which_n_grams, min_count: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, tok, pos, place in the document from 1 on), in this order, as (key, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, toks, pos = None, [], []  # the document that goes on

        def ready(keys: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys).cast(schema[0].type), pa.array(counts, schema[1].type)], schema=schema)

        for batch in batches:
            found, places, keys, counts = batch.column(1).to_numpy(zero_copy_only=False).tolist(), batch.column(2).to_numpy(), [], []
            cuts = [*np.flatnonzero(batch.column(3).to_numpy() == 1).tolist(), len(found)]
            toks += found[: cuts[0]]
            pos.append(places[: cuts[0]])
            for lo, hi in zip(cuts, cuts[1:]):
                if key is not None:
                    keys.append(key)
                    counts.append(_counted(toks[toks[0] is None :], np.concatenate(pos)[toks[0] is None :], which_n_grams, min_count))
                key, toks, pos = batch.column(0).slice(lo, 1), found[lo:hi], [places[lo:hi]]
            if keys:
                yield ready(keys, counts)
        if key is not None:
            yield ready([key], [_counted(toks[toks[0] is None :], np.concatenate(pos)[toks[0] is None :], which_n_grams, min_count)])

    return run


def vw_lines(rows: DataFrame, key: str = "doc_id", which_n_grams=(2,), min_count: int = 2) -> DataFrame:
    """AG10: ``doc<i> tok:count ... ngram:count`` per document from ``(key, pos, tok)`` rows.

    Unigrams in first-occurrence order, then each n-gram size kept when its
    count reaches ``min_count``; a document without tokens gives the empty string.

    One exchange by document at most, and one sort: a document's rows follow each other, and its line is counted from them.
    No table of n-grams is kept, so a task holds a document and a sort, which spills.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    order = Window.partitionBy(key).orderBy("pos")
    # The window deals out and sorts; its row number tells where a document begins.
    placed = rows.select(key, "tok", F.col("pos").cast("long").alias("pos"), F.row_number().over(order).alias("_i"))
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("_counts", StringType())])
    lines = placed.mapInArrow(_lines(tuple(which_n_grams), min_count, to_arrow_schema(schema)), schema)
    line = F.concat(F.lit("doc"), F.col(key).cast("string"), F.lit(" "), F.col("_counts"))
    return lines.select(key, F.when(F.col("_counts") == "", F.lit("")).otherwise(line).alias("line"))


def term_counts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """AG10a: ``(key, token, n)``; counted map-side, so that the exchange holds a document's distinct tokens."""
    rows = df.select(key, F.explode(tokens(text)).alias("token"))
    return rows.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))


def ngram_counts(df: DataFrame, n: int = 2, min_count: int = 2, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """AG10b: ``(key, ngram, n)`` for n-grams occurring at least ``min_count`` times.

    The texts are dealt out by key, not their n-grams, most of which occur once: the only exchange holds each text once,
    and counting needs no other."""
    dealt = df.select(key, text).repartition(F.col(key))
    d = dealt.select(key, tokens(text).alias("_tk")).select(key, F.explode(ngrams(F.col("_tk"), n)).alias("ngram"))
    return d.groupBy(key, "ngram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def vw_dataset(docs: DataFrame, stop: DataFrame, lemmas: DataFrame | None = None, which_n_grams=(2,), min_count: int = 2,
               key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Full topic-model line per document: clean -> stop words and lemmas -> counts -> line; ``key`` is unique."""
    cleaned = clean_texts(docs.select(key, lang, text), text, "clean").select(key, lang, "clean")
    return vw_lines(topic_tokens(cleaned, stop, lemmas, key, "clean", lang), key, which_n_grams, min_count)
