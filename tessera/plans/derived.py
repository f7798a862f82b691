"""Derived inputs computed by Spark from the driver tables.

* ``tags``: per-token BIO tags of ``documents`` — a capitalised run gives
  ``B-CAP``/``I-CAP``, an all-digit token ``B-NUM``, anything else ``O``.
* ``pred_tags``: the same with ``O`` wherever ``bucket(doc, pos) % 10 = 0``.

Each has an array form (one row per document, no shuffle) and an exploded form
``(doc_id, pos, token, tag)``; the SQL fragments build the same in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.functions.text import tokens


def _tag(x: Column, p: Column) -> Column:
    """The tag of token ``x`` after token ``p``.  Comparisons stand for the first letter, so few tokens meet a pattern."""
    def cap(c):
        return (c >= "A") & (c < "[")
    return (F.when((x >= "0") & (x < ":") & x.rlike("^[0-9]+$"), F.lit("B-NUM"))
            .when(cap(x), F.when(F.coalesce(cap(p), F.lit(False)), F.lit("I-CAP")).otherwise(F.lit("B-CAP")))
            .otherwise(F.lit("O")))


def _before(toks: Column) -> Column:
    return F.slice(F.concat(F.array(F.lit(None).cast("string")), toks), 1, F.size(toks))


def bio_tags(toks: Column) -> Column:
    return F.zip_with(toks, _before(toks), _tag)


def tagged_docs(docs: DataFrame) -> DataFrame:
    """``(doc_id, tokens, tags)`` — array form."""
    t = docs.select("doc_id", tokens("text", lower=False).alias("tokens"))
    return t.select("doc_id", "tokens", bio_tags(F.col("tokens")).alias("tags"))


def tag_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, pos, token, tag)`` — exploded form (pos 0-based).  Tags are made of rows, where code is generated; the
    generator is an outer one, as an inner one infers a filter that makes its array again."""
    t = docs.select("doc_id", tokens("text", lower=False).alias("tokens"))
    z = F.arrays_zip(F.col("tokens").alias("token"), _before(F.col("tokens")).alias("before"))
    rows = t.select("doc_id", F.posexplode_outer(z).alias("pos", "z")).where(F.col("pos").isNotNull())
    return rows.select("doc_id", "pos", "z.token", _tag(F.col("z.token"), F.col("z.before")).alias("tag"))


def pred_tag(tag: Column, doc: Column, pos: Column) -> Column:
    # An O stays one whatever its hash.
    return F.when((tag != "O") & (hash_bucket(doc, pos) % 10 != 0), tag).otherwise(F.lit("O"))


TAGS_SQL = """
tk AS (SELECT doc_id, unnest(tl) AS token, (generate_subscripts(tl, 1) - 1)::INTEGER AS pos
       FROM (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS tl FROM documents)),
tags AS (SELECT doc_id, pos, token,
           CASE WHEN regexp_full_match(token, '[0-9]+') THEN 'B-NUM'
                WHEN regexp_matches(token, '^[A-Z]') AND coalesce(regexp_matches(lag(token) OVER w, '^[A-Z]'), false) THEN 'I-CAP'
                WHEN regexp_matches(token, '^[A-Z]') THEN 'B-CAP' ELSE 'O' END AS tag
         FROM tk WINDOW w AS (PARTITION BY doc_id ORDER BY pos))"""


def pred_tag_sql(tag: str = "tag", doc: str = "doc_id", pos: str = "pos") -> str:
    return (f"CASE WHEN (('0x' || substr(md5('42:' || CAST({doc} AS VARCHAR) || ':' || CAST({pos} AS VARCHAR)), 1, 8))::BIGINT % 1000) % 10 = 0 "
            f"THEN 'O' ELSE {tag} END")


def values(doc: Column, pos: Column) -> Column:
    """Signed per-token values in [-5, 5) from rule H."""
    return (hash_bucket(doc, pos) - 500) / 100.0


def value_sql(doc: str = "doc_id", pos: str = "pos") -> str:
    return (f"(((('0x' || substr(md5('42:' || CAST({doc} AS VARCHAR) || ':' || CAST({pos} AS VARCHAR)), 1, 8))::BIGINT % 1000) - 500) / 100.0)")


def spans_sql(src: str, name: str) -> str:
    """CTEs ``{name}_f`` and ``{name}``: BIO spans of ``src(doc_id, pos, token, tag)``."""
    return f"""
{name}_f AS (SELECT doc_id, pos, tag, token,
   CASE WHEN tag = 'O' THEN 0 WHEN tag LIKE 'B-%' THEN 1
        WHEN tag LIKE 'I-%' AND (lag(tag) OVER w IS NULL OR lag(tag) OVER w = 'O'
                                 OR substr(lag(tag) OVER w, 3) <> substr(tag, 3)) THEN 1 ELSE 0 END AS s
   FROM {src} WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
{name}_n AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS span FROM {name}_f),
{name} AS (SELECT doc_id, min(pos) AS start, max(pos) AS "end", arg_min(substr(tag, 3), pos) AS type,
                  string_agg(token, ' ' ORDER BY pos) AS text
           FROM {name}_n WHERE tag <> 'O' GROUP BY doc_id, span)"""


def token_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, pos, token)`` without tags, for queries that need no tags (the
    tag expression sits inside the generator input of ``tag_rows``, where column
    pruning cannot remove it)."""
    return docs.select("doc_id", F.posexplode(tokens("text", lower=False)).alias("pos", "token"))
