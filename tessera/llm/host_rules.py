"""Quality rules with host verdicts (DataFrame functions only).

Each document is measured inside its own row.  A host's rate of failing documents is shrunk towards
the corpus by a beta prior fitted to all hosts (method of moments); hosts whose shrunk rate reaches
``host_threshold`` are rejected, and the verdict is joined back to the documents.

Defined results: a null or empty text has no words and fails the base rule; a null host is a host of
its own; repeated rows are judged row by row (each counts in its host's rate); an empty table gives no
rows.  Columns of the input that carry the name of a result are replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import stored

# Fixed values of the contract: word separators and symbol characters.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
HOST_THRESHOLD = 0.8
_P = "__hr_"


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) to each row.

    ``n_repeat_words`` counts the words inside 3-word windows found at least twice in the text: the
    windows' keys are sorted with their positions, equal neighbours give the positions, and the union
    of the windows at these positions is counted from the gaps between them.
    """
    d = docs.drop(*[c for c in MEASURES if c != text])
    t, p = F.coalesce(F.col(text), F.lit("")), _P
    # chains of replace() scan bytes; translate() is several times slower
    flat, plain = t, t
    for c in SPACES[1:]:
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    d = d.withColumns({
        p + "w": F.filter(F.split(flat, " "), lambda x: x != ""),
        p + "lines": F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0),
        "n_symbols": (F.length(t) - F.length(plain)).cast("long"),
    })
    d = d.withColumns({
        "word_chars": F.length(F.array_join(p + "w", "")).cast("long"),
        "n_words": F.size(p + "w").cast("long"),
        "n_lines": F.size(p + "lines").cast("long"),
        "n_dup_lines": (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("long"),
        p + "h": F.transform(p + "w", lambda x: F.xxhash64(x)),
    }).drop(p + "w", p + "lines")
    # slice() past the end is empty, so the pairs are null-padded by zip_with and cut to n - 2 windows
    tail = lambda c, k: F.slice(c, k + 1, F.greatest(F.size(c) - k, F.lit(0)))
    pair = lambda a, b: F.xxhash64(a, b)
    d = d.withColumn(p + "h", F.slice(F.zip_with(F.zip_with(p + "h", tail(p + "h", 1), pair), tail(p + "h", 2), pair),
                                      1, F.greatest(F.size(p + "h") - 2, F.lit(0))))
    # most texts repeat no window: they skip the sort
    d = d.withColumn(p + "s", F.when(F.size(F.array_distinct(p + "h")) < F.size(p + "h"), F.sort_array(
        F.transform(p + "h", lambda k, i: F.struct(k.alias("k"), i.alias("i")))))).drop(p + "h")
    d = d.withColumn(p + "e", F.zip_with(F.slice(p + "s", 1, F.size(p + "s") - 1), tail(p + "s", 1), lambda a, b: a["k"] == b["k"]))
    no = F.array(F.lit(False))
    d = d.withColumn(p + "d", F.zip_with(F.concat(no, p + "e"), F.concat(p + "e", no), lambda a, b: a | b)).drop(p + "e")
    d = d.withColumn(p + "p", F.sort_array(F.filter(F.zip_with(
        p + "s", p + "d", lambda a, b: F.when(b, a["i"])), lambda x: x.isNotNull()))).drop(p + "s", p + "d")
    gaps = F.zip_with(F.slice(p + "p", 1, F.size(p + "p") - 1), tail(p + "p", 1), lambda a, b: F.least(b - a, F.lit(3)))
    return d.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(gaps, F.lit(3).cast("long"), lambda s, g: s + g), F.lit(0).cast("long"))).drop(p + "p")


def rules(measured: DataFrame) -> DataFrame:
    """Adds base_failed and failed (base, symbol or repeated-line rule) to measured rows."""
    n = F.col("n_words")
    base = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    soft = (10 * F.col("n_symbols") > n) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
    return measured.withColumns({"base_failed": base, "failed": base | soft})


def host_verdicts(judged: DataFrame, host: str = "source", threshold: float = HOST_THRESHOLD) -> DataFrame:
    """One row per host: host, docs, failures, shrunk_rate, host_rejected.

    ``judged`` needs the host column and ``failed``.  The prior's mean and strength come from the
    mean and variance of the hosts' rates; where they don't differ, the strength is that of all documents.
    """
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("failed").cast("long")).alias("failures"))
    r = F.col("failures") / F.col("docs")
    prior = hosts.agg(F.avg(r).alias("m"), F.var_pop(r).alias("v"), F.sum("docs").cast("double").alias("all"))
    s = F.greatest(F.when(F.col("v") > 0, F.col("m") * (1 - F.col("m")) / F.col("v") - 1).otherwise(F.col("all")), F.lit(0.0))
    prior = prior.select("m", s.alias("s"))  # one row
    rate = (F.col("failures") + F.col("m") * F.col("s")) / (F.col("docs") + F.col("s"))
    return hosts.crossJoin(F.broadcast(prior)).select(
        "host", "docs", "failures", F.round(rate, 9).alias("shrunk_rate"), (F.round(rate, 9) >= threshold).alias("host_rejected"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", threshold: float = HOST_THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its measures, rules, shrunk_rate, host_rejected and ``kept``.

    The measured rows (with the columns ``keep`` of the input, else all) are written once, so the texts
    are measured in one pass; hosts are counted from that table, with partial counts before the shuffle.
    The written host table has a known size: Spark broadcasts it below its threshold and otherwise joins
    by shuffle, splitting hot hosts.
    """
    d = docs.drop(*[c for c in ("shrunk_rate", "host_rejected", "base_failed", "failed", "kept") if c not in (text, host)])
    m = rules(measure(d, text))
    if keep is not None:
        m = m.select(*dict.fromkeys([*keep, host]), *MEASURES, "base_failed", "failed")
    m = stored(m, "measured")
    v = stored(host_verdicts(m, host, threshold), "hosts").select(F.col("host").alias(_P + "host"), "shrunk_rate", "host_rejected")
    j = m.join(v, m[host].eqNullSafe(v[_P + "host"]), "left").drop(_P + "host")
    return j.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def clean(docs: DataFrame, text: str = "text", host: str = "source", threshold: float = HOST_THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    taken = {c: _P + c for c in docs.columns if c in (*MEASURES, "shrunk_rate", "host_rejected", "base_failed", "failed", "kept") and c not in (text, host)}
    left = judge(docs.withColumnsRenamed(taken), text, host, threshold).where("kept")
    return left.select(*(F.col(taken.get(c, c)).alias(c) for c in docs.columns))
