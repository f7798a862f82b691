"""Exact Jaccard self-join of documents on word shingles, and the groups that its links make.

Equal sets are one class and are joined once.  A class's shingles are ordered by frequency (counted over
the whole corpus in ``CELLS`` cells by hash, so that the table has a fixed size), rarest first, and its
prefix is listed by shingle.  Two sets over the threshold share a shingle of the smaller one's index prefix
and the larger one's probe prefix; pairs of a list must also pass the length and the positional filter.

No list is paired in full.  First each list's most typical member (whose rarest shingle is the most
frequent) is paired with the others; verified links give groups.  Then pairs of a list are formed between
members of different groups only: links inside a group don't change it.  Pairs that a suffix filter (the
sets cut at fixed hash bounds; the sum of the parts' smaller sizes bounds the overlap) lets pass are
verified once, on the shingles of the whole texts.

Sets are compared as 64-bit hashes.  Defined results: a null text or one without words has no shingles and
is linked with nothing; ties of frequency are broken by hash; repeated rows are of one class, each with its
row in the result; a null id is never a group's name unless it has no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import discard, stored
from tessera.llm.shingles import Shingles, common, shingles
from tessera.llm.words import blocks

SIZE, PERCENT = 4, 85
#: Cells in which shingles are counted for their order; any order gives the same links.
CELLS = 1 << 18
PARTS = 64
_48 = np.uint64((1 << 48) - 1)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def frequencies(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """How often shingles of each cell occur, as 16-bit logarithms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(CELLS, np.int64)
        for b in batches:
            for _, block in blocks(b.column(0)):
                n += np.bincount(_cell(shingles(block, size).hash), minlength=CELLS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["cell", "n"])

    cells = docs.select(text).mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CELLS, np.float64)
    out[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.float64)
    return np.minimum(np.log2(out + 1) * 1000, 65535).astype(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def signed(docs: DataFrame, text: str, size: int, compressed: bool = False) -> DataFrame:
    """``docs`` with its text compressed and sig; or only (sig, text), each task's copies left out."""
    at, names = docs.columns.index(text), [*docs.columns, "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for first, block in blocks(b.column(at)):
                s = shingles(block, size)
                sig = s.signatures().view(np.int64)
                if compressed:
                    new = [k for k, g in enumerate(sig.tolist()) if s.n[k] and g not in seen and not seen.add(g)]
                    cols, out = [pa.array(sig[new], pa.int64()), pa.array([pack(block[k]) for k in new], pa.binary())], ["sig", "text"]
                else:
                    cols, out = [*b.slice(first, len(block)).columns, pa.array(sig, pa.int64())], names
                    there = cols[at].is_valid().to_pylist()
                    cols[at] = pa.array([pack(t) if v else None for t, v in zip(block, there)], pa.binary())
                yield pa.RecordBatch.from_arrays(cols, names=out)

    fields = "sig long, text binary" if compressed else ", ".join(f"`{n}` {'binary' if n == text else t}" for n, t in [*docs.dtypes, ("sig", "long")])
    return docs.mapInArrow(run, fields)


def postings(docs: DataFrame, doc_id: str, text: str, size: int, percent: int, freq: np.ndarray) -> DataFrame:
    """Rows (doc_id, sig, n) of all documents, and rows (gram, sig, n, pos, typ) of their prefixes.

    ``gram`` sorts like its shingle's frequency; ``typ`` is the frequency of the rarest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, seen = shared.value, set()
        for b in batches:
            for first, block in blocks(b.column(1)):
                s = shingles(block, size)
                sig = s.signatures().view(np.int64)
                none = pa.nulls(len(block), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, pa.array(sig, pa.int64()), pa.array(s.n, pa.int64()), none, none, b.column(0).slice(first, len(block)), pa.array([True] * len(block))],
                    names=["gram", "sig", "n", "pos", "typ", "doc_id", "member"])
                new = np.array([g not in seen and not seen.add(g) for g in sig.tolist()], bool)
                key = (f[_cell(s.hash)] << np.uint64(48) | s.hash & _48) ^ np.uint64(1 << 63)
                key = key.view(np.int64)  # signed, same order
                o = np.argsort(key)
                o = o[np.argsort(s.text[o], kind="stable")]
                key, text_of = key[o], s.text
                start = np.cumsum(s.n) - s.n
                pos, n = np.arange(len(key)) - start[text_of], s.n[text_of]
                keep = (pos < n + (-percent * n // 100) + 1) & new[text_of]
                rarest = ((key[start[text_of[keep]]] ^ np.int64(-1 << 63)).view(np.uint64) >> np.uint64(48)).astype(np.int64)
                m = int(keep.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[keep]), pa.array(sig[text_of[keep]]), pa.array(n[keep]), pa.array(pos[keep]), pa.array(rarest),
                     pa.nulls(m, pa.int64()), pa.array(np.zeros(m, bool))], names=["gram", "sig", "n", "pos", "typ", "doc_id", "member"])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(run, "gram long, sig long, n long, pos long, typ long, doc_id long, member boolean")


def _ceil(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def may_link(a: str, b: str, percent: int) -> Column:
    """Of two members of a list: the length filter, the smaller one's index prefix, the positional filter."""
    na, nb, pa_, pb = F.col(a + "n"), F.col(b + "n"), F.col(a + "pos"), F.col(b + "pos")
    first = (na < nb) | ((na == nb) & (F.col(a + "sig") < F.col(b + "sig")))
    index = lambda n, p: p < n - _ceil(2 * percent * n, 100 + percent) + 1
    need = _ceil(percent * (na + nb), 100 + percent)
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & F.when(first, index(na, pa_)).otherwise(index(nb, pb))
            & (1 + F.least(na - 1 - pa_, nb - 1 - pb) >= need))


def _parts(s: Shingles) -> np.ndarray:
    """How many shingles of each text lie in each part of the hashes' range."""
    at = s.text * PARTS + (s.hash >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64)
    return np.bincount(at, minlength=len(s.n) * PARTS).reshape(-1, PARTS)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of signatures whose sets reach the threshold."""
    t = lambda c: texts.select(F.col("sig").alias(c), F.col("text").alias("text_" + c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for x in range(0, whole.num_rows, 256):
                b = whole.slice(x, 256)
                one, two = ([unpack(v) for v in b.column(c).to_pylist()] for c in ("text_a", "text_b"))
                s, z = shingles(one, size), shingles(two, size)
                total = s.n + z.n
                close = np.minimum(_parts(s), _parts(z)).sum(1) * (100 + percent) >= percent * total  # suffix filter
                both = np.zeros(len(one), np.int64)
                k = np.flatnonzero(close)
                if k.size:
                    here = lambda y: np.isin(y.text, k)
                    both = common(*(Shingles(y.hash[here(y)], y.text[here(y)], y.n) for y in (s, z)))
                yield b.select(["a", "b"]).filter(pa.array(both * (100 + percent) >= percent * total))

    return pairs.join(t("b"), "b").join(t("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp, was) of all nodes of the links (a, b): ``comp`` is the smallest node that each reaches.

    Each round takes the smallest label among neighbours, then the label's own label; it is written.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")).withColumn("was", F.col("node")), "labels")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = label.select("node", "comp").join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = label.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        step = step.join(jump, "comp").select("node", "was", F.least("comp", "far").alias("comp"))
        step = stored(step, "labels")
        discard(label)
        label = step
        if step.where("was <> comp").isEmpty():
            discard(both)
            return label


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, sig, n_shingles, comp, component_id), a row for each document; ``comp`` tells groups apart."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(postings(d, "doc_id", "text", size, percent, frequencies(d, "text", size)), "postings")
    members = stored(rows.where("member").select("doc_id", "sig", F.col("n").alias("n_shingles")), "members")
    # a member's rank in its lists: the most typical has the highest; lists are dealt out once, and lists of one go
    rank = F.col("typ") * (1 << 47) + F.col("sig").bitwiseAND((1 << 47) - 1)
    listed = rows.where("not member").select("gram", "sig", "n", "pos", rank.alias("rank")).repartition("gram").dropDuplicates(["gram", "sig"])
    inside = Window.partitionBy("gram").orderBy(F.desc("rank"))
    lists = listed.withColumns({"center": F.lag("rank").over(inside).isNull(), "last": F.lead("rank").over(inside).isNull()}).where("not (center and last)")
    lists = stored(lists.select("gram", "sig", "n", "pos", "center"), "lists")
    discard(rows)
    wanted = lists.select("sig").distinct()
    texts = signed(d.select("text"), "text", size, compressed=True).join(wanted, "sig", "left_semi")
    texts = stored(texts.groupBy("sig").agg(F.first("text").alias("text")), "texts")

    pair = lambda a: lists.select("gram", *(F.col(c).alias(a + c) for c in ("sig", "n", "pos", "center")))
    centers = pair("a_").where("a_center").drop("a_center")
    star = pair("b_").where("not b_center").join(centers, "gram").where(may_link("a_", "b_", percent))
    star = star.select(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct()
    links = stored(verified(star, texts, size, percent), "links")
    comp = components(links)

    # the rest: pairs of a list whose groups differ, its center aside
    group_of = lambda: comp.select(F.col("node").alias("sig"), "comp")
    rest = lists.where("not center").join(group_of(), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    mixed = rest.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gram")
    rest = stored(rest.join(mixed, "gram", "left_semi").select("gram", "sig", "n", "pos", "comp"), "rest")
    discard(lists)
    side = lambda a: rest.select("gram", *(F.col(c).alias(a + c) for c in ("sig", "n", "pos", "comp")))
    a, b = side("a_"), side("b_").withColumnRenamed("gram", "b_gram")
    cross = a.join(b, (F.col("gram") == F.col("b_gram")) & (F.col("a_comp") < F.col("b_comp")) & may_link("a_", "b_", percent))
    cross = cross.select(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct()
    more = stored(verified(cross, texts, size, percent), "links")
    discard(rest, texts)
    if not more.isEmpty():
        discard(comp)
        comp = components(links.unionByName(more))
    discard(links, more)

    linked = members.where("n_shingles > 0")
    classes = linked.groupBy("sig").agg(F.min("doc_id").alias("least")).join(group_of(), "sig", "left")
    classes = stored(classes.select("sig", "least", F.coalesce("comp", "sig").alias("comp")), "classes")
    named = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    names = stored(classes.join(named, "comp").select("sig", "comp", "component_id"), "names")
    discard(classes, comp)
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return members.join(names, "sig", "left").select("doc_id", "sig", "n_shingles", F.coalesce("comp", "sig").alias("comp"), alone.alias("component_id"))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One document of each group with its own columns: that of the smallest id.  Rows of one id in a group
    are one document; of these the first by text stays."""
    kept = groups(docs, doc_id, text, size, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    known = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63))).alias("__nj_id")
    kept = stored(kept.groupBy(known("doc_id"), "comp").agg(F.min("sig").alias("sig")).select("__nj_id", "sig"), "kept")
    taken = {c: "__nj_" + c for c in docs.columns if c == "sig"}
    rows = signed(docs.withColumnsRenamed(taken), text, size).select("*", known(doc_id))
    rows = rows.join(kept, ["__nj_id", "sig"], "left_semi").dropDuplicates(["__nj_id", "sig"])
    at, names = docs.columns.index(text), docs.columns

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for x in range(0, whole.num_rows, 256):
                cols = list(whole.slice(x, 256).columns)
                cols[at] = pa.array([None if t is None else unpack(t) for t in cols[at].to_pylist()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.select(*(F.col(taken.get(c, c)).alias(c) for c in names)).mapInArrow(plain, docs.schema)
