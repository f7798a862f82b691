"""Span operators (WN1, WN2, WN6, WN7, WN10).

Two forms.  The array form (one row per document holding its token and tag
arrays) decodes spans inside the row: no shuffle and no sort, whatever the
corpus size; the queries use it.  The row form ``(doc, pos, ...)`` serves
inputs that arrive as rows: it uses windows partitioned by document, whose
hash exchange also satisfies the per-span ``groupBy(doc, span)`` that follows,
so it shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import _c


def positive_runs(rows: DataFrame, key: str = "doc_id", pos: str = "pos", token: str = "token",
                  value: str = "value") -> DataFrame:
    """WN1 + WN2: runs of consecutive positions with ``value > 0``.

    Returns ``(key, start, text, compact, n_tokens)``: tokens of a run joined by a
    space, the same with all whitespace removed, and the run's token count.
    Island key = ``pos - row_number()`` over the positive positions.
    """
    pos_rows = rows.where(F.col(value) > 0)
    w = Window.partitionBy(key).orderBy(pos)
    isl = pos_rows.withColumn("_isl", F.col(pos) - F.row_number().over(w))
    g = isl.groupBy(key, "_isl").agg(
        F.min(pos).alias("start"),
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(token).alias("t")))).alias("_toks"))
    text = F.array_join(F.transform("_toks", lambda x: x["t"]), " ")
    return (g.select(key, "start", text.alias("text"))
            .where(F.col("text") != "")
            .select(key, "start", "text", F.regexp_replace("text", "(?U)\\s+", "").alias("compact"),
                    F.size(F.filter(F.split("text", "(?U)\\s+"), lambda x: x != "")).alias("n_tokens")))


def _type(tag: Column) -> Column:
    return F.when(tag.startswith("B-") | tag.startswith("I-"), F.substring(tag, 3, 1 << 30))


def bio_spans(rows: DataFrame, key: str = "doc_id", pos: str = "pos", tag: str = "tag",
              token: str | None = "token", carry=()) -> DataFrame:
    """WN6: BIO tags -> ``(key, start, end, type[, text])`` with ``end`` inclusive.

    A span starts at ``B-X``, or at ``I-X`` after ``O`` / another type / the
    start (the usual CoNLL convention).  ``carry`` columns extend the sequence
    key (e.g. gold vs predicted tags of the same document)."""
    w = Window.partitionBy(key, *carry).orderBy(pos)
    t = F.col(tag)
    prev = F.lag(tag).over(w)
    starts = t.startswith("B-") | (t.startswith("I-") & (prev.isNull() | (prev == "O") | (_type(prev) != _type(t))))
    cols = [key, *carry, pos, tag] + ([token] if token else [])
    flagged = rows.select(*cols, F.when(t == "O", 0).otherwise(starts.cast("int")).alias("_s"))
    numbered = flagged.withColumn("_span", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ents = numbered.where(F.col(tag) != "O")
    aggs = [F.min(pos).alias("start"), F.max(pos).alias("end"), F.min_by(_type(F.col(tag)), F.col(pos)).alias("type")]
    if token:
        aggs.append(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(token).alias("t")))).alias("_t"))
    g = ents.groupBy(key, *carry, "_span").agg(*aggs)
    out = [key, *carry, "start", "end", "type"]
    if token:
        g = g.withColumn("text", F.array_join(F.transform("_t", lambda x: x["t"]), " "))
        out.append("text")
    return g.select(*out)


def word_labels_from_pieces(pieces: DataFrame, key: str = "doc_id", word: str = "word",
                            label: str = "label", score: str = "score") -> DataFrame:
    """WN10: a word's label is the label of its highest-scored piece (ties by
    label) -> ``(key, pos, tag)``."""
    best = F.max(F.struct(F.col(score).alias("s"), F.col(label).alias("l")))
    return pieces.groupBy(key, word).agg(best["l"].alias("tag")).withColumnRenamed(word, "pos")


def subtoken_labels(word_ids: Column, labels: Column, policy: str = "repeat") -> Column:
    """WN7: word labels aligned to sub-tokens.

    ``word_ids`` holds each piece's word index (NULL for special tokens).
    ``repeat``: every piece takes its word's label; ``first``: only the first
    piece of a word does, the rest get -100.  NULL word id -> -100."""
    wid = _c(word_ids)
    lab = _c(labels)
    prev = F.slice(F.concat(F.array(F.lit(None).cast("int")), wid), 1, F.size(wid))

    def one(w, p):
        lbl = F.get(lab, w)
        if policy == "first":
            return F.when(w.isNull(), F.lit(-100)).when(p.isNotNull() & (p == w), F.lit(-100)).otherwise(lbl)
        return F.when(w.isNull(), F.lit(-100)).otherwise(lbl)
    return F.zip_with(wid, prev, one)


def _prev(arr: Column) -> Column:
    """``arr`` shifted right by one (NULL first), same length."""
    return F.slice(F.concat(F.array(F.lit(None).cast("string")), arr), 1, F.size(arr))


def with_span_arrays(df: DataFrame, tags: str, out: str) -> DataFrame:
    """``df`` with ``out``: the spans of its tag array, ``array<struct<start, end, type>>``; no shuffle, no sort.

    Span starts are flagged against the previous tag; "breaks" are starts and
    ``O`` positions; each start's span ends one before the next break.  Each
    step is its own column over materialised arrays, so no array is
    re-evaluated inside a lambda."""
    st, br = f"_{out}_st", f"_{out}_b"

    def flag(t, p):
        return (t != "O") & (t.startswith("B-") | (t.startswith("I-") & (
            p.isNull() | (p == "O") | (F.substring(p, 3, 1 << 30) != F.substring(t, 3, 1 << 30)))))
    d1 = df.withColumn(st, F.zip_with(F.col(tags), _prev(F.col(tags)), flag))
    entries = F.zip_with(F.col(tags), F.col(st), lambda t, s: F.struct(
        ((t == "O") | s).alias("brk"), s.alias("st"), F.substring(t, 3, 1 << 30).alias("ty")))
    indexed = F.transform(entries, lambda e, i: F.struct(i.alias("i"), e["brk"].alias("brk"), e["st"].alias("st"),
                                                         e["ty"].alias("ty")))
    d2 = d1.withColumn(br, F.filter(indexed, lambda e: e["brk"])).drop(st)
    sentinel = F.array(F.struct(F.size(tags).alias("i"), F.lit(True).alias("brk"), F.lit(False).alias("st"),
                                F.lit(None).cast("string").alias("ty")))
    nxt = F.concat(F.slice(br, 2, F.greatest(F.size(br) - 1, F.lit(0))), sentinel)
    spans = F.filter(F.zip_with(br, nxt, lambda a, b: F.when(a["st"], F.struct(
        a["i"].alias("start"), (b["i"] - 1).alias("end"), a["ty"].alias("type")))), lambda x: x.isNotNull())
    return d2.withColumn(out, spans).drop(br)


def bio_spans_arrays(df: DataFrame, key: str = "doc_id", tags: str = "tags", tokens: str | None = "tokens",
                     carry=()) -> DataFrame:
    """WN6 on the array form ``(key, tokens, tags)``: no shuffle, no sort.

    Returns ``(key, *carry, start, end, type[, text])``."""
    keep = [key, *carry] + ([tokens] if tokens else [])
    d2 = with_span_arrays(df.select(*keep, tags), tags, "_spans")
    # Outer, so that no filter on the array's size is inferred and evaluated below.
    d3 = d2.select(*keep, F.explode_outer("_spans").alias("_s")).select(*keep, "_s.start", "_s.end", "_s.type").where(F.col("start").isNotNull())
    if tokens:
        d3 = d3.withColumn("text", F.array_join(F.slice(tokens, F.col("start") + 1, F.col("end") - F.col("start") + 1), " "))
        return d3.select(key, *carry, "start", "end", "type", "text")
    return d3.select(key, *carry, "start", "end", "type")


def count_listed_spans(df: DataFrame, col: str) -> DataFrame:
    """AG12: spans stored as a list literal in a string (``"['a', 'it\\'s']"``, either quote, backslash escapes) ->
    ``(span, n)``; a string that is no list of strings has no spans."""
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true", "allowUnquotedControlChars": "true"}
    spans = F.from_json(F.col(col), "array<string>", options)
    return (df.select(F.explode(spans).alias("span")).groupBy("span")
            .agg(F.count(F.lit(1)).alias("n")))
