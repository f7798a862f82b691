"""Line and CoNLL readers and writer (IO1, IO2, IO4, WN5, TX13, TX14).

Files are read in parallel by blocks.  A block's place in its file (``_metadata.file_block_start``) and a line's place
in its block give every line its number in its file: only one row per block is ordered, no line is shuffled.
Sentences end at blank lines (also with CRLF or white space on them), wherever blocks begin and end.  For them files are
read once: a sentence knows its first line's place in its block, and lines are numbered when all blocks are known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import WS, repair_label
from tessera.session import stored

#: A character that isn't white space: a line without one is blank.
_FULL = "(?U)\\S"


def _offsets(blocks: DataFrame, count: str, out: str) -> DataFrame:
    """``blocks`` with ``out``: the sum of ``count`` over the blocks before it in its file."""
    w = Window.partitionBy("file").orderBy("block")
    return blocks.withColumn(out, F.sum(count).over(w) - F.col(count))


def block_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, value)``: each line of the files; ``\\n``, ``\\r\\n`` and ``\\r`` end a line.  The lines of a block
    stay in one task, in order."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, value, block)``: each line of the files with its 0-based number in its file; ``\\n``, ``\\r\\n``
    and ``\\r`` end a line.  The lines of a block stay in one task, in order: the blocks' offsets (one row each) are
    broadcast to the lines."""
    raw = block_lines(spark, path).withColumn("_id", F.monotonically_increasing_id())
    # A block's lines are read by one task, one after the other: their ids follow each other.
    blocks = raw.groupBy("file", "block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    blocks = _offsets(blocks, "_lines", "_before").select("file", "block", "_first", "_before")
    return raw.join(F.broadcast(blocks), ["file", "block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), "value", "block")


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, value, blank) as runs of lines that aren't blank in a block: (file, block, place of the run in
    its block, place of its first line, number of its lines, lines).  A block's first line is a row of its own, at -1, with
    the number of the block's lines.  No line is an object of Python's: runs are cut from the columns."""
    names = ["file", "block", "k", "at", "n", "lines"]
    types = [pa.string(), *[pa.int64()] * 4, pa.list_(pa.string())]
    file = block = first = None
    k = place = 0  # in the block: the next run, the next line
    going: list[pa.Array] = []  # the run that the last batch's end cut

    def rows(ks, ats, ns, lines) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file] * len(ks), types[0]), *(pa.array(x, types[1]) for x in ([block] * len(ks), ks, ats, ns)), lines], names=names)

    def lists(values: pa.Array, sizes) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)

    def cut() -> Iterator[pa.RecordBatch]:
        """The run that goes on ends here."""
        nonlocal k, going
        if going:
            values = pa.concat_arrays(going)
            yield rows([k], [place - len(values)], [len(values)], lists(values, [len(values)]))
            k, going = k + 1, []

    def part(values: pa.Array, blank: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The next lines of the block."""
        nonlocal k, place, going
        if blank[0]:
            yield from cut()
        full = np.flatnonzero(~blank)
        if len(full):
            starts = np.flatnonzero(np.append(True, np.diff(full) > 1))
            sizes = np.diff(np.append(starts, len(full)))
            if going:  # The first run here is that one.
                going.append(values.slice(0, int(sizes[0])))
                if sizes[0] == len(blank):
                    place += len(blank)
                    return
                place += int(sizes[0])
                yield from cut()
                place -= int(sizes[0])
                starts, sizes, full = starts[1:] - sizes[0], sizes[1:], full[sizes[0] :]
            if len(full) and full[-1] == len(blank) - 1:  # The last one may go on.
                going = [values.slice(int(full[starts[-1]]))]
                starts, sizes, full = starts[:-1], sizes[:-1], full[: starts[-1]]
            if len(starts):
                yield rows(np.arange(k, k + len(starts)), place + full[starts], sizes, lists(values.take(pa.array(full)), sizes))
                k += len(starts)
        place += len(blank)

    def end() -> Iterator[pa.RecordBatch]:
        """The block ends here."""
        yield from cut()
        if place:
            yield rows([-1], [0], [place], lists(first, [1]))

    for batch in batches:
        files, blocks, values, blank = batch.columns
        n = batch.num_rows
        if not n:
            continue
        blank = blank.to_numpy(zero_copy_only=False)
        starts = blocks.to_numpy()
        # A block's lines follow each other: with the same at both ends there is no other between them.
        changes = np.zeros(n - 1, bool)
        if files[0] != files[n - 1] or starts[0] != starts[-1]:
            changes = (np.diff(files.dictionary_encode().indices.to_numpy()) != 0) | (np.diff(starts) != 0)
        for lo, hi in zip([0, *(np.flatnonzero(changes) + 1).tolist()], [*(np.flatnonzero(changes) + 1).tolist(), n]):
            here = files[lo].as_py(), int(starts[lo])
            if here != (file, block):
                yield from end()
                (file, block), k, place, going, first = here, 0, 0, [], values.slice(lo, 1)
            yield from part(values.slice(lo, hi - lo), blank[lo:hi])
    yield from end()


def sentences(lines: DataFrame, skip: int = 0) -> tuple[DataFrame, DataFrame]:
    """WN5: ``(file, rec, lines)`` from ``block_lines`` (in the order in which they were read): ``rec`` is a sentence's
    0-based number in its file; its lines are in order.  Blank lines, however many in a row, end a sentence; a sentence
    without lines is none.  The first ``skip`` lines of a file are blank ones, whatever they hold.  Second: each file's
    first line, ``(file, value)``.

    Each task gathers the sentences of its blocks as it reads them, and they are written once.  A row per block tells how
    many lines and sentences start before it and whether it goes on with the last one of the block before (no line lies
    between them): only sentences that a block's end cuts are shuffled."""
    rows = lines.select("file", "block", "value", (~F.col("value").rlike(_FULL)).alias("_blank"))
    # A task holds a sentence, not its blocks: a few tasks per core do, however many blocks there are.
    rows = rows.coalesce(4 * lines.sparkSession.sparkContext.defaultParallelism)
    runs = stored(rows.mapInArrow(_gather, "file string, block long, k long, at long, n long, lines array<string>"), "sentences")
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = _offsets(runs.where("k < 0").select("file", "block", F.col("n").alias("_lines")), "_lines", "_line")
    # A row per block, few enough to be written and read again: offsets of lines come before those of sentences.
    blocks = stored(blocks.select("file", "block", "_line"), "blocks")
    first = runs.where("k < 0").join(F.broadcast(blocks.where("_line = 0")), ["file", "block"]).select("file", F.col("lines")[0].alias("value"))
    runs = runs.where("k >= 0").join(F.broadcast(blocks), ["file", "block"]).withColumn("line_no", F.col("_line") + F.col("at"))
    if skip:
        over = F.greatest(F.lit(skip) - F.col("line_no"), F.lit(0)).cast("int")
        runs = runs.where(F.col("line_no") + F.col("n") > skip).select(
            "file", "block", "k", (F.col("line_no") + over).alias("line_no"), (F.col("n") - over).alias("n"),
            F.when(over > 0, F.slice("lines", over + 1, F.size("lines"))).otherwise(F.col("lines")).alias("lines"))
    counts = runs.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("k").alias("_k"), F.min("line_no").alias("_first"),
                                               F.max(F.col("line_no") + F.col("n")).alias("_end"))
    counts = counts.withColumn("_on", F.coalesce(F.col("_first") == F.lag("_end").over(in_file), F.lit(False)).cast("int"))
    counts = counts.withColumn("_goes_on", F.lead("_on", 1, 0).over(in_file)).withColumn("_new", F.col("_n") - F.col("_on"))
    counts = _offsets(counts, "_new", "_before").select("file", "block", "_n", "_k", "_on", "_goes_on", "_before")
    # A run that was skipped has no number in its block.
    placed = runs.join(F.broadcast(counts), ["file", "block"]).withColumn("k", F.col("k") - F.col("_k"))
    placed = placed.withColumn("rec", F.col("_before") + F.col("k") - F.col("_on"))
    cut = ((F.col("k") == 0) & (F.col("_on") == 1)) | ((F.col("k") == F.col("_n") - 1) & (F.col("_goes_on") == 1))
    parts = placed.where(cut).groupBy("file", "rec").agg(F.array_sort(F.collect_list(F.struct("line_no", "lines"))).alias("_l"))
    return placed.where(~cut).select("file", "rec", "lines").unionByName(
        parts.select("file", "rec", F.flatten(F.transform("_l", lambda x: x["lines"])).alias("lines"))), first


def file_ordinal(df: DataFrame, file: str = "file", rec: str = "rec", out: str = "ordinal") -> DataFrame:
    """Adds ``out``: the 0-based number of each record over all files in the order of their paths, when every number
    ``rec`` of a file occurs.  A row per file is ordered, no record is."""
    counts = df.groupBy(file).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(file, (F.sum("_n").over(Window.orderBy(file)) - F.col("_n")).alias("_before"))
    return df.join(F.broadcast(offsets), file).withColumn(out, F.col("_before") + F.col(rec)).drop("_before")


def _fields(line: Column) -> Column:
    return F.filter(F.split(line, WS), lambda x: x != "")


def read_conll(spark: SparkSession, path: str, docstart: str = "-DOCSTART-") -> DataFrame:
    """IO1: 4-column CoNLL (``token -X- _ TAG``) -> ``(file, rec, tokens, tags)``, sentences numbered in file order;
    header sentences and empty ones are dropped (and have no number)."""
    lines = block_lines(spark, path)
    # A header line ends like a blank one: what follows it is a sentence of its own.
    lines = lines.withColumn("value", F.when(F.col("value").startswith(docstart), "").otherwise(F.col("value")))
    s, _ = sentences(lines)
    fields = F.transform("lines", lambda l: _fields(F.replace(l, F.lit(" -X- _ "), F.lit(" "))))
    s = s.select("file", "rec", fields.alias("_f"))
    return s.select("file", "rec", F.transform("_f", lambda f: F.get(f, F.lit(0))).alias("tokens"),
                    F.transform("_f", lambda f: F.element_at(f, -1)).alias("tags"))


def read_conll_group(spark: SparkSession, path: str, group: str, max_fields: int = 5) -> DataFrame:
    """IO2: N-column CoNLL -> ``(file, rec, tokens, tags)``.  Each file's first line names its columns
    (``[name] [name] ...``) and its second line is skipped; lines with more than ``max_fields`` fields are skipped;
    labels are repaired (TX13).  A file whose header doesn't name the group has no rows."""
    s, first = sentences(block_lines(spark, path), skip=2)
    named = F.transform(_fields(F.col("value")), lambda h: F.regexp_replace(h, "^\\[|\\]$", ""))
    header = first.select("file", F.array_position(named, group).alias("_at")).where(F.col("_at") > 0)
    # A line that is skipped for its fields is not a blank one: it doesn't end its sentence.
    s = s.join(F.broadcast(header), "file")  # a row per file
    short = lambda f: F.size(f) <= max_fields
    # Mostly a sentence's first line tells that it stays; a filter on all fields would make them twice, and for counts too.
    s = s.where(F.exists("lines", lambda l: short(_fields(l))))
    s = s.select("file", "rec", F.filter(F.transform("lines", _fields), short).alias("_f"), (F.col("_at") - 1).cast("int").alias("_at"))
    return s.select("file", "rec", F.transform("_f", lambda f: F.get(f, F.lit(0))).alias("tokens"),
                    F.transform("_f", lambda f: repair_label(F.get(f, F.col("_at")))).alias("tags"))


def write_conll(df: DataFrame, path: str, tokens: str = "tokens", tags: str = "tags",
                header: str | None = "-DOCSTART- -X- -X- O") -> None:
    """IO7: one ``token -X- _ TAG`` line per token, a blank line between sentences."""
    body = F.array_join(F.zip_with(tokens, tags, lambda t, g: F.concat(t, F.lit(" -X- _ "), g)), "\n")
    out = df.select(F.concat(body, F.lit("\n")).alias("value"))
    if header:
        out = df.sparkSession.createDataFrame([(header + "\n",)], "value string").unionByName(out)
    out.write.mode("overwrite").text(path)
