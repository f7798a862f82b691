"""Reader, writer, streaming and batched-map queries.

Each query function first writes its input (derived from the driver tables) to a fresh folder under the shared
checkpoint folder (``spark.checkpoint.dir``): that job runs when the function is called, as the reader under test needs
files.  The DataFrame that it returns reads them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions.sequences import hash_bucket
from tessera.operators.udf import apply_column, batched_map
from tessera.plans import derived as D
from tessera.plans.bayes import _trained
from tessera.plans import labels as _labels  # noqa: F401  (registers the split queries)
from tessera.plans.registry import ORACLES, QUERIES, query
from tessera.plans.sqlparts import bucket
from tessera.session import scratch_path
from tessera.sources import conll, files
from tessera.sources.tables import table
from tessera.streaming.dedupe import collect, read_sink
from tessera.streaming.scoring import score_stream


@query("conll_read", sql=f"""
WITH {D.TAGS_SQL.strip()}
SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS ordinal, n_tokens, tags FROM (
    SELECT doc_id, count(*)::INTEGER AS n_tokens, string_agg(tag, ' ' ORDER BY pos) AS tags FROM tags GROUP BY doc_id)""")
def q_conll_read(spark, sf):
    """Sentences in file order.  Documents without tokens have no lines in the format."""
    tagged = D.tagged_docs(table(spark, sf, "documents"))
    path = scratch_path(spark, "conll")
    conll.write_conll(tagged.orderBy("doc_id"), path, header=None)
    back = conll.file_ordinal(conll.read_conll(spark, path))
    return back.select("ordinal", F.size("tokens").alias("n_tokens"), F.array_join("tags", " ").alias("tags"))


def _grouped_files(spark, sf, path):
    """Stand-in input: files of two layouts in document order.  Every other file names its columns in another order, ends
    its lines with CRLF and pads its blank lines.  By rule H a line has six fields, a Cyrillic label or ``True`` in one."""
    # Texts are dealt out, not their tokens and tags; one with a token has a character that isn't white space.
    docs = table(spark, sf, "documents").select("doc_id", "text").where(F.col("text").rlike("(?U)\\S"))
    d = D.tagged_docs(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")).withColumn("_id", F.monotonically_increasing_id())
    odd = F.shiftright("_id", 33) % 2 == 1
    d = d.select(F.col("doc_id").cast("string").alias("key"), odd.alias("odd"), "_id", "tokens", "tags").mapInArrow(_grouped_lines, "odd boolean, _id long, lines string")
    odd, eol = F.col("odd"), F.when(F.col("odd"), "\r\n").otherwise("\n")
    head = F.when(F.col("_id").bitwiseAND((1 << 33) - 1) == 0, F.concat(
        F.when(odd, "[token] [num] [cap]").otherwise("[token] [cap] [num]"), eol, F.lit("-- --"), eol)).otherwise("")
    # The writer ends each value with a line feed: that ends the blank line.
    text = F.concat(head, "lines", eol, F.when(odd, " \t\r").otherwise(""))
    d.select(F.when(odd, F.regexp_replace(text, "(?<!\r)\n", "\r\n")).otherwise(text).alias("value")).write.text(path)


#: What follows a token in a line, by its tag and the layout: the fields [cap] [num], or [num] [cap] in odd files.
_FIELDS = {odd: {tag: f" {num} {cap}" if odd else f" {cap} {num}" for tag, cap, num in
                 (("O", "O", "O"), ("B-CAP", "B-CAP", "O"), ("I-CAP", "I-CAP", "O"), ("B-NUM", "O", "B-True"))} for odd in (False, True)}


def _grouped_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, odd, _id, tokens, tags) as (odd, _id, lines), a document at a time; the draw is ``hash_bucket(key, place) % 50``."""
    places: list[bytes] = []
    for batch in batches:
        out = []
        for key, odd, tokens, tags in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), batch.column(4)):
            tokens, tags = (x.values.to_numpy(zero_copy_only=False).tolist() for x in (tokens, tags))
            places += [b"%d" % i for i in range(len(places), len(tokens))]
            seed = b"42:" if key is None else f"42:{key}:".encode()
            heads = b"".join([md5(seed + i).digest()[:4] for i in places[: len(tokens)]])
            draws = np.frombuffer(heads, ">u4") % 1000 % 50
            fields = _FIELDS[odd]
            lines = [token + fields[tag] for token, tag in zip(tokens, tags)]
            for i in np.flatnonzero(draws == 1).tolist():
                cap = tags[i] if tags[i].endswith("CAP") else "O"
                lines[i] = f"{tokens[i]} Б-ЧИС {cap}" if odd else f"{tokens[i]} {cap} Б-ЧИС"
            for i in np.flatnonzero(draws[1:] == 0).tolist():
                lines[i + 1] += " x y z"
            out.append("\n".join(lines))
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out, pa.string())], names=["odd", "_id", "lines"])


@query("conll_groups", sql=f"""
WITH {D.TAGS_SQL.strip()},
l AS (SELECT doc_id, pos, token, {bucket("doc_id || ':' || pos")} % 50 AS draw, tag FROM tags),
s AS (SELECT doc_id, count(*)::INTEGER AS n_tokens, string_agg(token, ' ' ORDER BY pos) AS tokens,
             string_agg(CASE WHEN draw = 1 THEN 'O' WHEN tag = 'B-NUM' THEN 'B-1' ELSE 'O' END, ' ' ORDER BY pos) AS labels
      FROM l WHERE draw <> 0 OR pos = 0 GROUP BY doc_id)
SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS ordinal, n_tokens, md5(tokens) AS tokens, labels FROM s""")
def q_conll_groups(spark, sf):
    """The labels of one group, from files whose headers name it in different columns."""
    path = scratch_path(spark, "conll-groups")
    _grouped_files(spark, sf, path)
    back = conll.file_ordinal(conll.read_conll_group(spark, path, "num"))
    return back.select("ordinal", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens"), F.array_join("tags", " ").alias("labels"))


_LINES = "SELECT line, count(*)::BIGINT AS n FROM (SELECT regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g') AS line FROM {}) GROUP BY line"


@query("line_list", sql=_LINES.format("documents"))
def q_line_list(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return files.read_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("file_texts", sql=_LINES.format("benchmark"))
def q_file_texts(spark, sf):
    """Lines of whole files, each read as one text."""
    path = scratch_path(spark, "files")
    table(spark, sf, "benchmark").select(F.explode(F.split("text", "\n")).alias("value")).repartition(4).write.text(path)
    lines = files.read_files(spark, path).select(F.explode(F.split(F.regexp_replace("text", "\n$", ""), "\n")).alias("line"))
    return lines.groupBy(F.regexp_replace("line", "(?U)^\\s+|\\s+$", "").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query("split_files", sql=ORACLES["split_64_16_20"])
def q_split_files(spark, sf):
    path = scratch_path(spark, "splits")
    files.write_splits(QUERIES["split_64_16_20"](spark, sf), path)
    return spark.read.parquet(path)


@query("json_stats", sql=ORACLES["split_sizes"])
def q_json_stats(spark, sf):
    """The sizes of the splits, written as JSON and read back."""
    path = scratch_path(spark, "stats")
    files.write_json_stats(QUERIES["split_sizes"](spark, sf), path)
    return spark.read.schema("split string, n bigint").json(path)


@query("csv_round_trip", sql="SELECT d.text, l.toxic AS label, d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def q_csv_round_trip(spark, sf):
    lab = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "text", F.col("toxic").alias("label"), "doc_id")
    path = scratch_path(spark, "csv")
    files.write_labelled_csv(lab, path, header=True)
    return files.read_labelled_csv(spark, path, "text string, label int, doc_id bigint", header=True)


# Stand-in input: two arrivals of files.  By rule H some documents arrive in both; event times are minutes of a rule-H
# value of the text, so the copies of a text in one arrival have one time.  The delay is shorter than an arrival's span.
_DELAY = 12015  # seconds
_FIRST_SPAN, _SECOND_START, _SECOND_SPAN = 1000, 700, 600  # minutes


def _arrivals(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", hash_bucket("doc_id").alias("b"), F.md5("text").alias("m"))
    first = hash_bucket("m") % _FIRST_SPAN * 60
    second = _SECOND_START * 60 + 30 + hash_bucket("m", seed=43) % _SECOND_SPAN * 60
    of = lambda run, seconds: docs.select("doc_id", "text", F.timestamp_seconds(F.lit(1_700_000_000) + seconds).alias("ts"), F.lit(run).alias("run"), "b")
    return of(1, first).where("b < 600").drop("b"), of(2, second).where("b >= 400").drop("b")


_ARRIVALS = f"""
docs AS (SELECT doc_id, md5(text) AS m, {bucket('doc_id')} AS b FROM documents),
a1 AS (SELECT doc_id, m, {bucket('m')} % {_FIRST_SPAN} * 60 AS ts FROM docs WHERE b < 600),
a2 AS (SELECT doc_id, m, {_SECOND_START * 60 + 30} + {bucket('m', seed=43)} % {_SECOND_SPAN} * 60 AS ts FROM docs WHERE b >= 400),
mark AS (SELECT max(ts) - {_DELAY} AS w FROM a1),
state AS (SELECT DISTINCT m FROM a1, mark WHERE ts + {_DELAY} > w),
late AS (SELECT doc_id FROM a2, mark WHERE ts <= w)"""


def _collected(spark, sf):
    """Both runs over the arriving files -> (sink, late rows' folder, the runs' reports)."""
    source, sink, late, progress = (scratch_path(spark, f"stream-{name}") for name in ("source", "kept", "late", "progress"))
    schema, reports = "doc_id bigint, text string, ts timestamp, run int", []
    for arrival in _arrivals(spark, sf):
        arrival.write.mode("append").parquet(source)
        reports.append(collect(spark, source, schema, "text", "ts", f"{_DELAY} seconds", sink, late, progress))
    return read_sink(spark, sink, schema), read_sink(spark, late, schema), reports


@query("stream_dedupe", sql=f"""WITH {_ARRIVALS.strip()}
SELECT DISTINCT 1 AS run, m AS digest FROM a1
UNION ALL SELECT DISTINCT 2, m FROM a2, mark WHERE ts > w AND m NOT IN (SELECT m FROM state)""")
def q_stream_dedupe(spark, sf):
    """What the two runs keep: the second knows the texts of the first that its state still holds."""
    return _collected(spark, sf)[0].select("run", F.md5("text").alias("digest"))  # which copy stays depends on arrival


@query("stream_late", sql=f"WITH {_ARRIVALS.strip()} SELECT doc_id, 2 AS run FROM late")
def q_stream_late(spark, sf):
    """The rows of the second run that are older than the watermark left by the first."""
    return _collected(spark, sf)[1].select("doc_id", "run")


@query("stream_report", sql=f"""WITH {_ARRIVALS.strip()}
SELECT 1 AS run, (SELECT count(*) FROM a1)::BIGINT AS n_rows, 0::BIGINT AS n_late
UNION ALL SELECT 2, (SELECT count(*) FROM a2)::BIGINT, (SELECT count(*) FROM late)::BIGINT""")
def q_stream_report(spark, sf):
    """Rows read and rows too late of each run, as the stream's own metrics have them."""
    reports = _collected(spark, sf)[2]
    rows = [(k, sum(b["n_rows"] for b in r), sum(b["n_late"] for b in r)) for k, r in enumerate(reports, 1)]
    return spark.createDataFrame(rows, "run int, n_rows bigint, n_late bigint")


@query("stream_scores", sql=ORACLES["nb_scores"])
def q_stream_scores(spark, sf):
    lab, _, model, prior = _trained(spark, sf)
    src = scratch_path(spark, "score-src")
    table(spark, sf, "documents").join(lab.where(F.col("is_test")).select("doc_id"), "doc_id").select(
        "doc_id", "text").write.mode("overwrite").parquet(src)
    sink, ck = scratch_path(spark, "score-sink"), scratch_path(spark, "score-ckpt")
    score_stream(spark, src, "doc_id bigint, text string", model, prior, sink, ck)
    return spark.read.parquet(sink).select("doc_id", F.round("score", 6).alias("score"), "pred")


def _count_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
    """A batch function: whitespace token counts of a pandas batch."""
    # Words are counted text by text: a batch's words are never held together.
    n = pdf["text"].map(lambda t: 0 if pd.isna(t) else len(t.split())).astype("int64")
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n})


@query("batched_map", sql="SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))::BIGINT AS n_tokens FROM documents")
def q_batched_map(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return batched_map(d, _count_tokens, "doc_id long, n_tokens long")


@F.pandas_udf(StringType())  # a name of a type would need a session at import
def _reversed_words(texts: pd.Series) -> pd.Series:
    """A caller's vectorised augmenter: the words of each text backwards; null stays null."""
    return texts.map(lambda t: None if t is None else " ".join(t.split()[::-1]))


@query("applied_udf", sql="""
SELECT doc_id, CASE WHEN doc_id % 10 > 0 THEN array_to_string(list_reverse(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')), ' ') END AS text FROM documents""")
def q_applied_udf(spark, sf):
    """Every tenth text is null."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 10 > 0, F.col("text")).alias("text"))
    return apply_column(d, "text", _reversed_words)
