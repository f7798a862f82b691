"""SS1: incremental collection with checkpointed progress and dedupe.

Files arriving in a folder are read as a stream.  ``collect`` is one run over what has arrived since the last run: rows
that repeat a key within the watermark delay are dropped, rows older than the watermark are written to a folder of their
own, and the run ends.  The state holds digests of keys, and each leaves when the watermark passes its row's time plus the
delay, so the state's size is that of one delay's rows.  Progress, watermark and state are in the checkpoint folder: a run
that was stopped, or the next run, resumes there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.lookup import text_digest


def dedupe_stream(spark: SparkSession, source: str, schema: str, key: str, event_time: str, delay: str,
                  sink: str, checkpoint: str, fmt: str = "parquet") -> list[dict]:
    """One run; -> a record per micro-batch: its number, rows read, rows too late, rows of state kept and removed."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    # The state holds digests, never whole texts.
    out = (stream.withColumn("_digest", text_digest(key)).withWatermark(event_time, delay)
           .dropDuplicatesWithinWatermark(["_digest"]).drop("_digest"))
    q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()  # availableNow ends by itself
    return [{"batch": p["batchId"], "n_rows": p["numInputRows"], "n_late": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
             "n_state": sum(s["numRowsTotal"] for s in p["stateOperators"]), "n_removed": sum(s["numRowsRemoved"] for s in p["stateOperators"])}
            for p in q.recentProgress]


def watermark(spark: SparkSession, checkpoint: str) -> int | None:
    """The watermark (milliseconds) that a run from this checkpoint starts with: that of the last planned batch; None
    before the first run."""
    try:
        log = spark.read.text(f"{checkpoint}/offsets")
    except AnalysisException:
        return None
    return log.agg(F.max(F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")).alias("w")).first()["w"]


def collect(spark: SparkSession, source: str, schema: str, key: str, event_time: str, delay: str, sink: str, late: str,
            checkpoint: str, fmt: str = "parquet") -> list[dict]:
    """One run over the files that arrived: deduplicated rows go to ``sink``, rows too late for it to ``late``.

    The late rows are those at or below the watermark with which the run starts; both streams read the same new files,
    in one micro-batch each, and resume from their own part of the checkpoint."""
    start = watermark(spark, f"{checkpoint}/kept")
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    behind = F.lit(False) if start is None else F.col(event_time) <= F.timestamp_millis(F.lit(start))
    q = (stream.where(behind).writeStream.format("parquet").option("path", late).option("checkpointLocation", f"{checkpoint}/late")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return dedupe_stream(spark, source, schema, key, event_time, delay, sink, f"{checkpoint}/kept", fmt)


def read_sink(spark: SparkSession, sink: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(sink)
