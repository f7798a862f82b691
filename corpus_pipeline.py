"""A training-data pipeline over ``documents``: each stage reads what its predecessor wrote as Parquet.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, host_rules, ngram_join, sparse_suffix
from tessera.llm.shared import discard, stored, table

#: Near copies: words of a shingle and similarity in per cent.
SHINGLE, SIMILAR = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule or their host's verdict rejects go."""
    return host_rules.clean(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return ngram_join.representatives(docs, size=SHINGLE, percent=SIMILAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in one document; n_chars follows the text."""
    done = sparse_suffix.remove(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256) of each document that is left."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"))
    kept = encoded.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return bpe.decode(kept).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

#: Tokenising and the groups of near copies are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        done = stored(stage(spark, docs, sf_dir), name)
        if k:
            discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
