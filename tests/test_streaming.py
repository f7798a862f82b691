from pyspark.sql import functions as F

from tessera.streaming.dedupe import collect, dedupe_stream, read_sink, watermark

SCHEMA = "id int, text string, ts timestamp"
BASE = 1_700_000_000


def _arrive(spark, rows, src):
    df = spark.createDataFrame(rows, "id int, text string, s int").select("id", "text", F.timestamp_seconds(F.lit(BASE) + F.col("s")).alias("ts"))
    df.coalesce(1).write.mode("append").parquet(src)


def test_dedupe_within_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    _arrive(spark, [(1, "a", 0), (2, "a", 60), (3, "b", 120)], src)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    dedupe_stream(spark, src, SCHEMA, "text", "ts", "1 hour", sink, ck)
    assert sorted(r["text"] for r in read_sink(spark, sink).collect()) == ["a", "b"]


def test_two_runs_with_a_short_delay(spark, tmp_path):
    src, sink, late, ck = (str(tmp_path / n) for n in ("src", "sink", "late", "ck"))
    run = lambda: collect(spark, src, SCHEMA, "text", "ts", "100 seconds", sink, late, ck)
    ids = lambda path: sorted(r["id"] for r in read_sink(spark, path, SCHEMA).collect())
    assert watermark(spark, f"{ck}/kept") is None
    _arrive(spark, [(1, "old", 0), (2, "new", 450), (3, "new", 450), (4, "last", 500)], src)
    first = run()
    assert len(ids(sink)) == 3 and ids(late) == [] and sum(b["n_rows"] for b in first) == 4
    assert watermark(spark, f"{ck}/kept") == (BASE + 400) * 1000
    # The state of "old" has left, that of "new" hasn't; times up to 400 are too late.
    _arrive(spark, [(5, "old", 410), (6, "new", 420), (7, "early", 399), (8, "on time", 401), (9, "at it", 400)], src)
    second = run()
    assert ids(late) == [7, 9] and sum(b["n_late"] for b in second) == 2
    assert set(ids(sink)) - {1, 2, 3, 4} == {5, 8}
    assert sum(b["n_removed"] for b in first + second) >= 1
    # Nothing new arrived: a third run changes nothing.
    run()
    assert ids(late) == [7, 9] and len(ids(sink)) == 5
