import pytest

import __spark_entry__ as E


def test_registry_consistent():
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 80
    assert set(sqls) <= set(qs)


def test_queries_and_sql_need_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(E.__file__).parent, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.split(), done.stderr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"doc_id", "score", "pred"}
    assert df.count() >= 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SMALL = "/root/testdata/sf0.001"


def test_hot_paths_have_no_python(spark):
    qs = E.queries()
    for name in ("nb_scores", "term_counts", "vw_lines", "bio_spans", "bleu_pairs", "triplets", "packed_blocks"):
        plan = _plan(qs[name](spark, SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["term_counts"](spark, SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_group_limits_are_planned(spark):
    plan = _plan(E.queries()["table_rows_text"](spark, SMALL))
    assert "WindowGroupLimit" in plan


def test_relation_invariants(spark):
    """TP + FN = distinct gold relations; TP + FP = distinct predicted ones."""
    from pyspark.sql import functions as F

    from tessera.operators import relations as R
    from tessera.plans.relations import KEYS, TYPES, _relation_rows

    rows = _relation_rows(spark, SMALL)
    keys = KEYS + ["type", "head", "tail"]
    s = {r["rel_type"]: r for r in R.set_scores_tagged(rows, "is_gold", keys, TYPES).collect()}
    n_gold = rows.where(F.col("is_gold") & F.col("type").isin(*TYPES)).select(*keys).distinct().count()
    n_pred = rows.where(~F.col("is_gold") & F.col("type").isin(*TYPES)).select(*keys).distinct().count()
    assert s["ALL"]["tp"] + s["ALL"]["fn"] == n_gold
    assert s["ALL"]["tp"] + s["ALL"]["fp"] == n_pred


def test_cluster_needs_a_shared_folder():
    from tessera.session import checkpoint_dir, is_one_jvm

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(dict)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)
    assert is_one_jvm("local[8]") and not is_one_jvm("local-cluster[3,2,3000]") and not is_one_jvm("yarn")


def _scans(df, table):
    """How often the final plan reads a table, once it has run: reused exchanges count once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = _plan(df)
    final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")] if "== Final Plan ==" in plan else plan
    return sum(1 for line in final.split("\n") if "FileScan" in line and f"/{table}.parquet" in line)


def test_tables_are_read_once(spark):
    qs = E.queries()
    for name in ("term_counts", "ngram_counts", "dependency_phrase", "split_ratio", "discard_report", "lang_lookup", "bio_spans"):
        assert _scans(qs[name](spark, SMALL), "documents") <= 1, name
    # Written before: the final plan reads the words or pairs, not the documents.
    for name, most in (("nb_scores", 0), ("nb_accuracy", 0), ("bleu_pairs", 0), ("rouge1_pairs", 0), ("jaccard_pairs", 0),
                       ("bigram_perplexity", 1), ("pseudo_perplexity", 1), ("vw_lines", 2)):
        assert _scans(qs[name](spark, SMALL), "documents") <= most, name


def test_counts_are_made_map_side(spark):
    qs = E.queries()
    for name in ("term_counts", "ngram_counts"):
        plan = _plan(qs[name](spark, SMALL))
        assert plan.count("Exchange") == 1 and "partial_count" in plan, name


def test_ratio_split_has_no_exchange(spark):
    plan = _plan(E.queries()["split_ratio"](spark, SMALL))
    assert "Exchange" not in plan and "Sort" not in plan


def test_llm_package_may_fail_to_import(monkeypatch):
    """A missing library of the optional package takes none of the other queries away."""
    import sys

    import tessera

    monkeypatch.setitem(sys.modules, "tessera.llm.queries", None)
    if hasattr(tessera, "llm"):
        monkeypatch.delattr(tessera.llm, "queries", raising=False)
    assert len(E.queries()) >= 80 and not any(n.startswith("op") or n == "pipeline" for n in E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_sequence_metrics_reads_documents_once(spark):
    assert _scans(E.queries()["sequence_metrics"](spark, SMALL), "documents") == 1


def test_texts_are_dealt_out_not_what_is_made_of_them(spark):
    """The only exchange lies below the rows of n-grams, or of edges."""
    for name in ("ngram_counts", "dependency_phrase"):
        plan = _plan(E.queries()[name](spark, SMALL))
        assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.index("Generate"), name


def test_filters_make_no_arrays_again(spark):
    """A filter that Spark infers or pushes down must not split the lines, or parse the triplets, a second time."""
    for name, work in (("label_repair", "concat_ws"), ("triplets", "aggregate("), ("paired_scores", "aggregate("), ("set_scores_strict", "aggregate(")):
        plan = _plan(E.queries()[name](spark, SMALL))
        assert not [x for x in plan.split("\n") if "Filter" in x and work in x], name


def test_tags_of_rows_are_made_in_generated_code(spark):
    from tessera.plans import derived

    docs = spark.createDataFrame([(1, "The Old 12 a1 12é Été Cat 7 [x Z"), (2, " "), (3, None)], "doc_id long, text string")
    rows = derived.tag_rows(docs)
    assert "zip_with(" not in _plan(rows)
    assert [tuple(r)[1:] for r in rows.orderBy("pos").collect()] == [
        (0, "The", "B-CAP"), (1, "Old", "I-CAP"), (2, "12", "B-NUM"), (3, "a1", "O"), (4, "12é", "O"), (5, "Été", "O"),
        (6, "Cat", "B-CAP"), (7, "7", "B-NUM"), (8, "[x", "O"), (9, "Z", "B-CAP")]
