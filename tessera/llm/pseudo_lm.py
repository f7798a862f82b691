"""Document scores by masked pseudo-likelihood: every word is predicted from the words on both sides.

Words fall into ``CELLS`` cells by hash; cells are counted over the whole corpus and cut by falling
frequency into ``CLASSES`` classes of equal mass.  A small network (a table per place in the window, a tanh
layer, a softmax) predicts the class of a word from the two words before and the two after it (the most
frequent ``OWN`` cells by themselves, others by their class); within its class a cell has its share of the
corpus.  Each task trains the network in numpy on all words of
its rows from a common start; the parameters are averaged by words (a sum per parameter, with a fixed
number of them).  What comes to the driver has a fixed size; what is counted and trained on grows with the
corpus.

Defined results: a null text or one without words has 0 words, log-likelihood 0 and a null mean; repeated
rows are counted and scored row by row; an empty table gives no rows.  Columns named like a result are
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import SPACED, blocks, words

CELLS, CLASSES, OWN, HIDDEN, REACH = 1 << 16, 64, 192, 32, 2
NONE = CLASSES + OWN
BATCH = 4096
RATE = 0.01


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


@dataclass
class Lexicon:
    """Of each cell: its class, its number as context and the logarithm of its share of the class."""

    of: np.ndarray
    context: np.ndarray
    share: np.ndarray
    prior: np.ndarray

    @classmethod
    def count(cls, docs: DataFrame, text: str) -> Lexicon:
        """From the words of all rows."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(CELLS, np.int64)
            for b in batches:
                for _, block in blocks(b.column(0)):
                    n += np.bincount(_cell(words(block, SPACED).hash), minlength=CELLS)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["cell", "n"])

        found = docs.select(text).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        n = np.zeros(CELLS, np.float64)
        n[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
        return cls.of_counts(n)

    @classmethod
    def of_counts(cls, n: np.ndarray) -> Lexicon:
        n = n + 1e-3  # a cell that the corpus doesn't have
        order = np.argsort(-n, kind="stable")
        middle = np.cumsum(n[order]) - n[order] / 2
        of = np.zeros(CELLS, np.uint8)
        of[order] = np.minimum(middle / n.sum() * CLASSES, CLASSES - 1).astype(np.uint8)
        mass = np.bincount(of, n, CLASSES) + 1e-9
        context = of.astype(np.int16)
        context[order[:OWN]] = CLASSES + np.arange(OWN)
        return cls(of, context, np.log(n / mass[of]), np.log(mass / mass.sum()))


class Network:
    """Parameters: ``table`` (place, context, hidden), ``bias``, ``out`` (hidden, class), ``prior``."""

    SHAPES = ((2 * REACH, NONE + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))

    def __init__(self, parts: list[np.ndarray]):
        self.table, self.bias, self.out, self.prior = self.parts = parts

    @classmethod
    def start(cls, prior: np.ndarray) -> Network:
        r = np.random.default_rng(11)
        return cls([(r.normal(0, 0.3, cls.SHAPES[0])).astype(np.float32), np.zeros(HIDDEN, np.float32),
                    r.normal(0, 0.05, cls.SHAPES[2]).astype(np.float32), prior.astype(np.float32)])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        ends = np.cumsum([int(np.prod(s)) for s in cls.SHAPES])
        return cls([x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, ends[:-1]), cls.SHAPES)])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts]).astype(np.float64)

    def log_probs(self, context: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(hidden, log-probability of each class) for the contexts at each place of the window."""
        z = self.bias + self.table[0][context[0]]
        for t, c in zip(self.table[1:], context[1:]):
            z += t[c]
        hidden = np.tanh(z)
        score = hidden @ self.out
        score += self.prior
        score -= score.max(1, keepdims=True)
        score -= np.log(np.exp(score).sum(1, keepdims=True))
        return hidden, score

    def learn(self, context: list[np.ndarray], target: np.ndarray, state: dict) -> None:
        """One step of Adam on the mean log-loss."""
        n = len(target)
        hidden, score = self.log_probs(context)
        d = np.exp(score)
        d[np.arange(n), target] -= 1
        d /= n
        back = (d @ self.out.T) * (1 - hidden * hidden)
        table = np.zeros_like(self.table)
        for k, c in enumerate(context):
            o = np.argsort(c, kind="stable")
            at = np.flatnonzero(np.diff(c[o], prepend=-1))
            table[k, c[o][at]] = np.add.reduceat(back[o], at, axis=0)
        state["t"] = t = state.get("t", 0) + 1
        for k, (p, g) in enumerate(zip(self.parts, (table, back.sum(0), hidden.T @ d, d.sum(0)))):
            m = state[k, "m"] = 0.9 * state.get((k, "m"), 0) + 0.1 * g
            v = state[k, "v"] = 0.99 * state.get((k, "v"), 0) + 0.01 * g * g
            p -= (RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)


def windows(block: list[bytes], lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, cell of each word, its place in the line, line of contexts with gaps between texts)."""
    w = words(block, SPACED)
    cell = _cell(w.hash)
    place = np.arange(len(cell)) + (w.text_of() + 1) * REACH
    line = np.full(len(cell) + (len(block) + 1) * REACH, NONE, np.int16)
    line[place] = lexicon.context[cell]
    return w.counts(), cell, place, line


def _context(line: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    return [line[place + k] for k in range(-REACH, REACH + 1) if k]


def train(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> Network:
    """The average of the networks that the tasks train on all words of their rows."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, state, seen = shared.value, {}, 0
        net = Network.start(lex.prior)
        for b in batches:
            for _, block in blocks(b.column(0)):
                _, cell, place, line = windows(block, lex)
                for x in range(0, len(place), BATCH):
                    p = place[x:x + BATCH]
                    net.learn(_context(line, p), lex.of[cell[x:x + BATCH]], state)
                seen += len(place)
        if seen:
            flat = net.flat() * seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat), pa.array(np.full(len(flat), seen))], names=["at", "value", "n"])

    mean = docs.select(text).mapInArrow(run, "at int, value double, n long").groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value"))
    mean = mean.toPandas().sort_values("at")["value"].to_numpy(np.float64)
    return Network.of(mean) if len(mean) else Network.start(lexicon.prior)


def score(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, log_likelihood and mean_log_likelihood."""
    new = ("n_words", "log_likelihood", "mean_log_likelihood")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    lexicon = Lexicon.count(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, train(docs, lexicon, text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, net = shared.value
        for b in batches:
            for first, block in blocks(b.column(len(kept))):
                n, cell, place, line = windows(block, lex)
                each = np.zeros(len(place))
                for x in range(0, len(place), BATCH):
                    p = place[x:x + BATCH]
                    _, s = net.log_probs(_context(line, p))
                    each[x:x + BATCH] = s[np.arange(len(p)), lex.of[cell[x:x + BATCH]]] + lex.share[cell[x:x + BATCH]]
                total = np.bincount(np.repeat(np.arange(len(n)), n), each, len(n))
                mean = pa.array(np.divide(total, n, out=np.zeros(len(n)), where=n > 0), pa.float64(), mask=n == 0)
                rows = b.slice(first, len(block))
                yield pa.RecordBatch.from_arrays([*rows.columns[:len(kept)], pa.array(n, pa.int64()), pa.array(total), mean], names=[*kept, *new])

    types = dict(docs.dtypes)
    fields = [*(f"`{c}` {types[c]}" for c in kept), "n_words long", "log_likelihood double", "mean_log_likelihood double"]
    return docs.select(*kept, F.col(text).alias("__pl_text")).mapInArrow(run, ", ".join(fields))
