"""Evaluation metrics as grouped conditional sums (AG15-AG18).

Gold and predicted items of a row are compared inside it; the counts per class
are sums over rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prf(correct: Column, guessed: Column, gold: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1 with 0 for empty denominators."""
    p = F.coalesce(F.try_divide(correct.cast("double"), guessed), F.lit(0.0))
    r = F.coalesce(F.try_divide(correct.cast("double"), gold), F.lit(0.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return p, r, f


def _span_counts() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (gold tags, predicted tags) -> (type, g, p, c, eq, n): spans of each type on either side and on both, and
    a row without a type with the equal and all positions.  Rows where a side is null don't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pc.and_(b.column(0).is_valid(), b.column(1).is_valid()))
            if not b.num_rows:
                continue
            gold, pred = b.column(0), b.column(1)
            sizes = pc.list_value_length(gold).to_numpy(zero_copy_only=False).astype(np.int64)
            n = int(sizes.sum())
            if not pc.all(pc.equal(pc.list_value_length(gold), pc.list_value_length(pred))).as_py():  # the shorter one is filled with nulls
                pairs = [(x, y, max(len(x), len(y))) for x, y in zip(gold.to_pylist(), pred.to_pylist())]
                gold, pred = (pa.array([x[k] + [None] * (x[2] - len(x[k])) for x in pairs], pa.list_(pa.string())) for k in (0, 1))
                sizes = np.array([x[2] for x in pairs], np.int64)
            codes = pa.concat_arrays([gold.flatten(), pred.flatten()]).dictionary_encode()
            tags = codes.dictionary.to_pylist()
            kinds = sorted({t[2:] for t in tags})
            # The last entry stands for a null.
            kind = np.array([kinds.index(t[2:]) for t in tags] + [-1])
            outside, begins, inside = (np.array([f(t) for t in tags] + [False], bool) for f in (
                lambda t: t == "O", lambda t: t.startswith("B-"), lambda t: t.startswith("I-")))
            code = codes.indices.fill_null(len(tags)).to_numpy(zero_copy_only=False).reshape(2, -1)
            ends = np.cumsum(sizes)
            first = np.zeros(code.shape[1], bool)
            first[(ends - sizes)[sizes > 0]] = True

            def marks(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Per position: does a span end before it, does one start at it."""
                before = np.roll(c, 1)
                starts = begins[c] | (inside[c] & (first | (before == len(tags)) | outside[before] | (kind[before] != kind[c])))
                return outside[c] | starts, starts

            (gold_breaks, gold_starts), (pred_breaks, pred_starts) = marks(code[0]), marks(code[1])
            both = gold_breaks & pred_breaks
            at = np.flatnonzero(gold_breaks | pred_breaks)
            after = np.append(at[1:], 0)
            row = np.searchsorted(ends, at, "right")
            last = np.append(row[1:] != row[:-1], True)[:len(at)]
            right = at[gold_starts[at] & pred_starts[at] & (kind[code[0][at]] == kind[code[1][at]]) & (last | both[after[:len(at)]])]
            count = [np.bincount(kind[x], minlength=len(kinds)).astype(np.int64) for x in (code[0][gold_starts], code[1][pred_starts], code[0][right])]
            seen = np.flatnonzero(count[0] + count[1])
            equal = int(((code[0] == code[1]) & (code[0] < len(tags))).sum())
            columns = [[*x[seen].tolist(), 0] for x in count] + [[0] * len(seen) + [equal], [0] * len(seen) + [n]]
            yield pa.RecordBatch.from_arrays([pa.array([*(kinds[k] for k in seen), None], pa.string()), *(pa.array(x, pa.int64()) for x in columns)],
                                             names=["type", "g", "p", "c", "eq", "n"])

    return run


def sequence_scores(df: DataFrame, tags: str, ptags: str, overall: str = "overall", ignore: str | None = None) -> DataFrame:
    """AG17 on aligned gold and predicted tag arrays: per type and overall P/R/F1 of spans, and the tokens' accuracy.
    ``ignore``: positions with this gold tag are left out of both arrays.

    Only places where either side breaks matter.  A span is right if both sides start the same type there and both break
    at the next such place.  Whole batches of rows are compared as arrays; what leaves a task are sums per type.  The
    arrays are read once: the few sums become one row, and types, total and accuracy come from it."""
    d = df.select(tags, ptags)
    if ignore is not None:
        both = F.filter(F.arrays_zip(F.col(tags).alias("g"), F.col(ptags).alias("p")), lambda z: z["g"] != ignore)
        d = d.select(both.alias("_z")).select(F.col("_z.g").alias(tags), F.col("_z.p").alias(ptags))
    sums = [F.sum(c).alias(c) for c in ("g", "p", "c", "eq", "n")]
    per = d.mapInArrow(_span_counts(), "type string, g long, p long, c long, eq long, n long").groupBy("type").agg(*sums)
    total = per.agg(F.collect_list(F.struct(F.col("type").alias("entity"), "g", "p", "c")).alias("_per"), *sums)
    rows = F.concat(F.filter("_per", lambda x: x["entity"].isNotNull()), F.array(F.struct(F.lit(overall).alias("entity"), "g", "p", "c")))
    rows = total.select(F.try_divide(F.col("eq").cast("double"), F.col("n")).alias("accuracy"), F.inline(rows))
    pr, rc, f1 = prf(F.col("c"), F.col("p"), F.col("g"))
    return rows.select("entity", F.col("g").alias("n_gold"), F.col("p").alias("n_pred"), F.col("c").alias("n_correct"),
                       pr.alias("precision"), rc.alias("recall"), f1.alias("f1"), "accuracy")


def argmax_first(logits) -> Column:
    """0-based index of the first maximum of an array."""
    logits = F.col(logits) if isinstance(logits, str) else logits
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def binary_scores(df: DataFrame, pred: str, label: str) -> DataFrame:
    """AG18: accuracy and F1 of the positive class."""
    p, y = F.col(pred), F.col(label)
    tp = F.sum(((p == 1) & (y == 1)).cast("int"))
    fp = F.sum(((p == 1) & (y == 0)).cast("int"))
    fn = F.sum(((p == 0) & (y == 1)).cast("int"))
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.avg((p == y).cast("double")).alias("accuracy"),
                 tp.alias("_tp"), fp.alias("_fp"), fn.alias("_fn"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("_tp"), 2 * F.col("_tp") + F.col("_fp") + F.col("_fn")), F.lit(0.0))
    return agg.select("n", "accuracy", f1.alias("f1"))
