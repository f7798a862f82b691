"""The queries ``opN_<name>`` over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, collision_search, decontaminate, dom_model, host_rules, lookup_clusters, metric_trees, ngram_join, pseudo_lm, reply_trees,
                         sparse_suffix, sql, url_rules, wavelet)
from tessera.llm.shared import stored, table
from tessera.session import scratch_path

Builder = Callable[[SparkSession, str], DataFrame]


def op1_suffix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op2_dom_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom_model.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# Fixed values of the contract.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a url's path is the labelled document's id; of low quality or toxic: bad."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract("url", r"/(\d{1,18})(?:[./?#]|$)", 1).try_cast("long")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = pages.select("url", number.alias("doc_id")).join(labels, "doc_id").where(F.col("bad").isNotNull())
    return url_rules.judge(pages, url_rules.mine(labelled), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op4_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per repeated passage: the document, its words from start to end, and earlier documents with them."""
    found = sparse_suffix.repeats(table(spark, sf_dir, "documents")).select("id", F.explode("spans").alias("s"))
    return found.select(F.col("id").alias("doc_id"), F.col("s.start").alias("start_word"), F.col("s.end").alias("end_word"), F.col("s.of").alias("repeats_of"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write(table(spark, sf_dir, "documents"), path)
    return wavelet.documents(wavelet.read(spark, path)).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_lm.score(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_words", *(F.round(c, 3).alias(c) for c in ("log_likelihood", "mean_log_likelihood")))


def op8_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(said).alias("text"))
    done = stored(reply_trees.format_paths(reply_trees.chains(rows.unionByName(more))), "formatted")
    turns = done.select("root", "formatted", reply_trees.read_back(F.col("formatted")).alias("turns"),
                        reply_trees.masked_text(F.col("formatted"), F.col("loss")).alias("said"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    return turns.select(reply_trees.conversation_id(F.col("root")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                        digest.alias("turns_sha256"), F.length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    encoded = encoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return bpe.decode(encoded).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_lookup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup_clusters.cluster(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def op12_metric_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = metric_trees.compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return metric_trees.label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.search(table(spark, sf_dir, "embeddings"), asks=F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Builder] = {f.__name__: f for f in (op1_suffix_search, op2_dom_model, op3_url_rules, op4_sparse_suffix, op5_ngram_join, op6_wavelet_shards, op7_pseudo_likelihood, op8_reply_trees, op9_byte_bpe, op10_host_rules,
                                                         op11_lookup_clusters, op12_metric_trees, op13_collision_search)}

ORACLES: dict[str, str] = {"op1_suffix_search": sql.OP1, "op5_ngram_join": sql.OP5, "op8_reply_trees": sql.OP8, "op10_host_rules": sql.OP10,
                           "op11_lookup_clusters": sql.OP11, "op12_metric_trees": sql.OP12}
