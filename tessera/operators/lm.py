"""Language-model data preparation and count-based perplexity
(AG22-AG24, WN8, WN9, SF11).

The neural models of the reference are replaced by n-gram models counted by
Spark (partial aggregation, then equi-joins on the context); the data
preparation (strided windows, packing, masking) is array work inside rows plus
one bounded window per packing batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sequences import shifted
from tessera.functions.text import _c
from tessera.session import scratch_path, stored


def bigram_rows(df: DataFrame, key: str, toks: str) -> DataFrame:
    """``(key, pos, w1, w2)`` for consecutive token pairs; a text without pairs keeps one row of nulls."""
    pairs = F.zip_with(F.col(toks), shifted(toks), lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))
    return (df.select(key, F.posexplode_outer(F.filter(pairs, lambda p: p["w2"].isNotNull())).alias("pos", "p"))
            .select(key, "pos", "p.w1", "p.w2"))


def trigram_rows(df: DataFrame, key: str, toks: str) -> DataFrame:
    """``(key, pos, l, w, r)``: each interior token with its neighbours; a text without any keeps one row of nulls."""
    t = F.zip_with(F.zip_with(F.col(toks), shifted(toks), lambda a, b: F.struct(a.alias("l"), b.alias("w"))),
                   shifted(toks, 2), lambda s, c: F.struct(s["l"].alias("l"), s["w"].alias("w"), c.alias("r")))
    return (df.select(key, F.posexplode_outer(F.filter(t, lambda x: x["r"].isNotNull())).alias("pos", "x"))
            .select(key, "pos", "x.l", "x.w", "x.r"))


def bigram_model(train: DataFrame, key: str, toks: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``((w1, w2, _c12), (w1, _c1), (_V))``: pair counts, context counts and the number of distinct words, all from one
    counted and written pass: every word is once the first of a pair, the last one of a text with nothing behind it."""
    after = F.concat(shifted(toks), F.array(F.lit(None).cast("string")))
    rows = train.select(F.inline(F.zip_with(F.col(toks), after, lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))))
    counts = stored(rows.where(F.col("w1").isNotNull()).groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("_c12")), "bigram-counts")
    # c(w1, *) is the sum of c(w1, w2): aggregate the aggregate, not the rows again.
    ctx = counts.groupBy("w1").agg(F.sum(F.when(F.col("w2").isNotNull(), F.col("_c12")).otherwise(0)).alias("_c1"))
    return counts.where(F.col("w2").isNotNull()), ctx, ctx.agg(F.count(F.lit(1)).alias("_V"))


def bigram_logprobs(train: DataFrame, test: DataFrame, key: str, toks: str) -> DataFrame:
    """``(key, pos, logp)`` of each test bigram under an add-one bigram model of
    ``train``: ``p(w2|w1) = (c(w1,w2) + 1) / (c(w1,*) + V)``."""
    bi, ctx, vocab = bigram_model(train, key, toks)
    te = bigram_rows(test, key, toks)
    # Count tables are vocabulary-sized: shuffle joins, never a static broadcast.
    j = te.join(bi.hint("merge"), ["w1", "w2"], "left").join(ctx.hint("merge"), "w1", "left").crossJoin(
        F.broadcast(vocab))
    p = (F.coalesce(F.col("_c12"), F.lit(0)) + 1) / (F.coalesce(F.col("_c1"), F.lit(0)) + F.col("_V"))
    return j.select(key, "pos", F.when(F.col("pos").isNotNull(), F.ln(p)).alias("logp"))


def trigram_model(train: DataFrame, key: str, toks: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``((l, w, r, _cw), (l, r, _cc), (_V))`` from one counted and written pass over every word with its neighbours, null at the
    ends of a text."""
    null = F.array(F.lit(None).cast("string"))
    before, after = F.slice(F.concat(null, toks), 1, F.size(toks)), F.concat(shifted(toks), null)
    t = F.zip_with(F.zip_with(before, F.col(toks), lambda a, b: F.struct(a.alias("l"), b.alias("w"))), after,
                   lambda s, c: F.struct(s["l"].alias("l"), s["w"].alias("w"), c.alias("r")))
    counts = train.select(F.inline(t)).where(F.col("w").isNotNull()).groupBy("l", "w", "r").agg(F.count(F.lit(1)).alias("_cw"))
    counts = stored(counts, "trigram-counts")
    inner = counts.where(F.col("l").isNotNull() & F.col("r").isNotNull())
    words = counts.groupBy("w").agg(F.count(F.lit(1)).alias("_n"))
    return inner, inner.groupBy("l", "r").agg(F.sum("_cw").alias("_cc")), words.agg(F.count(F.lit(1)).alias("_V"))


def pseudo_logprobs(train: DataFrame, test: DataFrame, key: str, toks: str) -> DataFrame:
    """AG24: ``(key, pos, logp)`` of each interior test token given both
    neighbours: ``(c(l,w,r) + 1) / (c(l,*,r) + V)``."""
    tri, ctx, vocab = trigram_model(train, key, toks)
    te = trigram_rows(test, key, toks)
    j = te.join(tri.hint("merge"), ["l", "w", "r"], "left").join(ctx.hint("merge"), ["l", "r"], "left").crossJoin(
        F.broadcast(vocab))
    p = (F.coalesce(F.col("_cw"), F.lit(0)) + 1) / (F.coalesce(F.col("_cc"), F.lit(0)) + F.col("_V"))
    return j.select(key, "pos", F.when(F.col("pos").isNotNull(), F.ln(p)).alias("logp"))


def perplexity(logps: DataFrame, key: str | None = None) -> DataFrame:
    """``exp(-mean(logp))`` per key (or overall), with the count; null for a text without any."""
    g = logps.groupBy(key) if key else logps
    return g.agg(F.count("logp").alias("n"), F.exp(-F.avg("logp")).alias("perplexity"))


def mean_loss_perplexity(losses: DataFrame, loss: str = "loss") -> DataFrame:
    """AG22: ``exp(mean loss)``."""
    return losses.agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("mean_loss"),
                      F.exp(F.avg(loss)).alias("perplexity"))


def strided_windows(n, max_length: int = 512, stride: int = 256) -> Column:
    """WN8: ``array<struct<begin, end, trg_len>>``: windows begin every
    ``stride``, span ``max_length``, ``trg_len = end - previous end``, and stop
    after the window that reaches the end."""
    n = _c(n)
    begins = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride)), lambda b: b < n)
    w = F.transform(begins, lambda b: F.struct(
        b.alias("begin"), F.least(b + max_length, n).alias("end"),
        (F.least(b + max_length, n)
         - F.when(b == 0, F.lit(0)).otherwise(F.least(b - stride + max_length, n))).alias("trg_len"),
        F.when(b == 0, F.lit(0)).otherwise(F.least(b - stride + max_length, n)).alias("prev_end")))
    return F.transform(F.filter(w, lambda x: x["prev_end"] < n),
                       lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), x["trg_len"].alias("trg_len")))


def pack_blocks(df: DataFrame, key: str, toks: str, batch: Column, block: int = 128) -> DataFrame:
    """WN9: concatenate the token streams of a batch in key order and cut them
    into blocks of ``block`` tokens, dropping the batch's remainder.  Returns ``(batch, block_no, tokens)``.

    Prefix sums over ``(key, size)`` give each document the interval of the stream that it covers; an interval is cut
    into one slice of the document's array per block that it meets, and a block joins its slices.  No row per token:
    a row per document and block.  The window sees no texts; rows of an equal key follow in the order in which they
    were read (the rows are written with it first)."""
    d = df.select(batch.alias("batch"), F.col(key).alias("_key"), F.col(toks).alias("_t"), F.size(toks).alias("_n"),
                  F.monotonically_increasing_id().alias("_id"))
    path = scratch_path(df.sparkSession, "streams")
    d.where(F.col("_n") > 0).write.parquet(path)
    d = df.sparkSession.read.parquet(path)
    before = F.sum("_n").over(Window.partitionBy("batch").orderBy("_key", "_id")) - F.col("_n")
    d = d.select("batch", "_t", "_n", "_id").join(d.select("_id", before.alias("_off")), "_id")
    first, last = F.floor(F.col("_off") / block), F.floor((F.col("_off") + F.col("_n") - 1) / block)

    def part(b):
        start = F.greatest(b * block - F.col("_off"), F.lit(0))
        size = (b + 1) * block - F.col("_off") - start
        return F.struct(b.alias("block_no"), F.struct("_off", F.slice("_t", (start + 1).cast("int"), size.cast("int")).alias("s")).alias("_p"))

    # A document's slices are one array, then rows: no row of a slice holds the whole document.
    d = d.select("batch", F.explode(F.transform(F.sequence(first, last), part)).alias("_x")).select("batch", "_x.block_no", "_x._p")
    g = d.groupBy("batch", "block_no").agg(F.array_sort(F.collect_list("_p")).alias("_b"))
    return g.select("batch", "block_no", F.flatten(F.transform("_b", lambda x: x["s"])).alias("tokens")).where(F.size("tokens") == block)


MASK = "[MASK]"


def _draw(key: Column, i: Column, k: int, seed: int) -> Column:
    """Draw ``k`` (0, 1 or 2) of token ``i``: an 8-hex-digit slice of one md5."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), i.cast("string")))
    return F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("bigint") % 1000


def mask_tokens(df: DataFrame, key: str, toks: str, rate_per_mille: int = 150, seed: int = 11) -> DataFrame:
    """SF11: masked-LM inputs.  A token is chosen with probability 15 % (rule H
    on ``(key, pos)``); a chosen token becomes ``[MASK]`` 80 % of the time, a
    token drawn from the same row 10 %, and stays 10 %.  Adds ``masked`` (the
    inputs) and ``labels`` (the original token where chosen, else NULL).

    Two projections: the chosen flags (one hash per token), then the inputs,
    which hash again only for chosen tokens; each lambda reads the previous
    stage's materialised arrays instead of recomputing them."""
    k = F.col(key)
    d1 = df.withColumn("_chosen", F.transform(toks, lambda t, i: _draw(k, i, 0, seed) < rate_per_mille))
    t = F.col(toks)
    n = F.size(t)

    def inp(c, i):
        r = _draw(k, i, 1, seed) % 10
        other = F.get(t, (_draw(k, i, 2, seed) % n).cast("int"))
        return F.when(~c, F.get(t, i)).when(r < 8, F.lit(MASK)).when(r == 8, other).otherwise(F.get(t, i))
    d2 = d1.withColumn("masked", F.transform("_chosen", inp)).withColumn(
        "labels", F.zip_with(toks, "_chosen", lambda x, c: F.when(c, x)))
    return d2.drop("_chosen")
