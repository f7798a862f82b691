"""SS2: score arriving texts with a trained Naive Bayes model.

Each micro-batch is scored with the batch operator (``foreachBatch``): the
model is a static DataFrame joined to the batch's words, so the streaming plan
holds no state; results are appended idempotently per batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import bayes
from tessera.session import scratch_path


def score_stream(spark: SparkSession, source: str, schema: str, model: DataFrame, prior: DataFrame, sink: str,
                 checkpoint: str, key: str = "doc_id", text: str = "text") -> None:
    # Trained and written once; each micro-batch reads the stored tables.
    stored = {}
    for name, df in (("model", model), ("prior", prior)):
        path = scratch_path(spark, f"nb-{name}")
        df.write.parquet(path)
        stored[name] = spark.read.parquet(path)
    stream = spark.readStream.schema(schema).parquet(source)
    words = stream.select(key, bayes.classifier_tokens(text).alias("words"))

    def score(batch: DataFrame, batch_id: int) -> None:
        scored = bayes.predict(batch, stored["model"], stored["prior"], key=key)
        # One folder per batch id: a re-run of a batch overwrites its own output.
        scored.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (words.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()  # availableNow ends by itself
