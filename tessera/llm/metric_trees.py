"""Vector code compression: codebooks of the parts of integer vectors, fitted with metric trees.

Vectors are cut into equal parts, and each part position has a codebook.  Blocks of vectors get one metric tree per
part position, built middle-out by the anchors hierarchy: some sqrt(n) anchors share the points out (a new anchor is the
point farthest from its anchor, and takes over the points that are nearer to it; only points farther away than half the
distance of two anchors need a look), anchors are joined in pairs to balls up to the root, and each anchor is refined
downwards in the same way.  Every ball caches the count and the sum of its points.  The trees are built once, written to
the shared folder, and read in every round.

A round walks down each tree with a list of candidate entries.  A ball drops those that are farther than its nearest
entry from all of its points: |c-e|^2 - |c-f|^2 > 2 r |e-f| for centre c and radius r.  What is left is inherited by its
balls.  A ball with one candidate is wholly owned: its cached count and sum go to that entry, and its points aren't
looked at.  Leaves compare their points with the candidates left, in integers.  So all results are exact, whatever the
blocks are.  A task sends a count and a sum per entry; Spark adds them and the driver gets the entries' rows.

Defined cases: rows whose vector is null, holds a null or non-finite component, or hasn't the most frequent length that
the number of parts divides are left out.  Null keys come last and repeated ones in the order of their vectors when the
first entries are taken; with fewer vectors than entries there are as many entries as vectors.  Of equal entries only
the first owns parts.  An integer beyond 2^27 counts as 2^27; a sum of errors that no long holds is null.  Null labels
are one label.  Columns other than the key's, the vector's and the label's are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType

from tessera.llm.dense import kind_of, lists, many, runs, schema, usual_length, vectors, whole
from tessera.llm.shared import stored

#: Vectors of a block, and points of a ball that isn't split any more.
BLOCK, LEAF = 4096, 64


def apart(points: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    return ((points - other) ** 2).sum(-1)


def anchors(points: np.ndarray, index: np.ndarray, k: int) -> list[np.ndarray]:
    """At most ``k`` anchors' points (places in ``points``), the farthest of each first; the first anchor is the first point."""
    far = np.sqrt(apart(points[index], points[index[0]]))
    order = np.argsort(-far, kind="stable")
    pivots, owned, reach = [index[0]], [index[order]], [far[order]]
    while len(owned) < k:
        widest = max(range(len(owned)), key=lambda a: reach[a][0])
        if reach[widest][0] == 0:
            break  # only copies of the anchors are left
        pivot = owned[widest][0]
        gaps = np.sqrt(apart(points[pivots], points[pivot]))
        taken, near = [], []
        for a, gap in enumerate(gaps):
            some = int(np.searchsorted(-reach[a], -gap / 2))  # points that are nearer to their anchor stay
            if not some:
                continue
            mine = np.sqrt(apart(points[owned[a][:some]], points[pivot]))
            moves = mine < reach[a][:some]
            if moves.any():
                taken.append(owned[a][:some][moves])
                near.append(mine[moves])
                stay = np.concatenate([~moves, np.ones(len(owned[a]) - some, bool)])
                owned[a], reach[a] = owned[a][stay], reach[a][stay]
        taken, near = np.concatenate(taken), np.concatenate(near)
        order = np.argsort(-near, kind="stable")
        pivots.append(pivot)
        owned.append(taken[order])
        reach.append(near[order])
    return owned


def paired(points: np.ndarray, owned: list[np.ndarray]) -> list[tuple[int, int]]:
    """Joins balls in pairs, those of the smallest common ball first; ball number len(owned) + n is the n-th pair."""
    n = len(owned)
    centre = np.array([points[o].mean(0) for o in owned] + [np.zeros(points.shape[1])] * (n - 1))
    radius = np.array([np.sqrt(apart(points[o], c).max()) for o, c in zip(owned, centre)] + [0.0] * (n - 1))
    weight = np.array([len(o) for o in owned] + [0] * (n - 1), float)
    size = np.full((2 * n - 1, 2 * n - 1), np.inf)  # of the ball around two balls

    def measure(a: int, others: np.ndarray) -> None:
        both = (np.sqrt(apart(centre[others], centre[a])) + radius[a] + radius[others]) / 2
        size[a, others] = size[others, a] = np.maximum(both, np.maximum(radius[a], radius[others]))

    for a in range(1, n):
        measure(a, np.arange(a))
    live, pairs = list(range(n)), []
    for new in range(n, 2 * n - 1):
        a, b = divmod(int(size.argmin()), 2 * n - 1)
        pairs.append((a, b))
        weight[new] = weight[a] + weight[b]
        centre[new] = (centre[a] * weight[a] + centre[b] * weight[b]) / weight[new]
        radius[new] = max(np.sqrt(apart(centre[c], centre[new])) + radius[c] for c in (a, b))
        size[[a, b], :] = size[:, [a, b]] = np.inf
        live = [x for x in live if x not in (a, b)]
        if live:
            measure(new, np.array(live))
        live.append(new)
    return pairs


class Tree:
    """Balls as arrays: their points are ``points[start:end]``; ``child`` is -1 for leaves; totals and widths of points."""

    def __init__(self, points: np.ndarray, order: np.ndarray, balls: np.ndarray, total: np.ndarray, wide: np.ndarray):
        self.points, self.order, self.balls, self.total, self.wide = points, order, balls, total, wide
        self.centre = total // (balls[:, 1] - balls[:, 0])[:, None]

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        children, members, open_ = [None], [np.arange(len(points))], [0]
        while open_:
            ball = open_.pop()
            index = members[ball]
            owned = anchors(points, index, round(len(index) ** 0.5)) if len(index) > LEAF else []
            if len(owned) < 2:
                continue
            number = []  # of the anchors' balls and the pairs
            for o in owned:
                number.append(len(members))
                open_.append(len(members))
                members.append(o)
                children.append(None)
            pairs = paired(points, owned)
            for n, (a, b) in enumerate(pairs):
                at = ball if n == len(pairs) - 1 else len(members)
                if at != ball:
                    members.append(None)
                    children.append(None)
                children[at] = (number[a], number[b])
                number.append(at)
            members[ball] = None
        start, end, order, at, walk = {}, {}, [], 0, [(0, False)]
        while walk:
            ball, done = walk.pop()
            if done or children[ball] is None:
                start.setdefault(ball, at)
                if children[ball] is None:
                    order.append(members[ball])
                    at += len(members[ball])
                end[ball] = at
            else:
                start[ball] = at
                walk += [(ball, True), (children[ball][1], False), (children[ball][0], False)]
        order = np.concatenate(order)
        points = points[order]
        balls = np.array([[start[b], end[b], *(c or (-1, -1))] for b, c in enumerate(children)])
        sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), points.cumsum(0)])
        total = sums[balls[:, 1]] - sums[balls[:, 0]]
        tree = cls(points, order, balls, total, np.zeros(len(balls), np.int64))
        tree.wide = np.array([apart(points[s:e], c).max() for (s, e, _, _), c in zip(balls, tree.centre)])
        return tree

    def owners(self, entries: np.ndarray, own, compare) -> int:
        """Calls ``own(ball, entry)`` for wholly owned balls and ``compare(ball, entries)`` for leaves that aren't; -> distances taken."""
        gaps = np.sqrt(apart(entries[:, None], entries[None]).astype(float))
        same = np.argmax(gaps == 0, axis=1)  # the first entry equal to this one
        walk, taken = [(0, np.flatnonzero(same == np.arange(len(entries))))], 0
        while walk:
            ball, left = walk.pop()
            if len(left) > 1:
                far = apart(entries[left], self.centre[ball])
                taken += len(left)
                first = far.argmin()
                # A margin above the rounding of the roots: never drops an entry that could own a point.
                bound = 2 * np.sqrt(float(self.wide[ball])) * gaps[left[first], left] * (1 + 1e-9)
                left = left[(far - far[first]).astype(float) <= bound]
            if len(left) == 1:
                own(ball, left[0])
            elif self.balls[ball, 2] < 0:
                taken += len(left) * (self.balls[ball, 1] - self.balls[ball, 0])
                compare(ball, left)
            else:
                walk += [(self.balls[ball, 2], left), (self.balls[ball, 3], left)]
        return taken

    def leaf(self, ball: int, entries: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The nearest of the entries left, the smallest index of equally near ones, for each point of a leaf."""
        s, e = self.balls[ball, :2]
        few = entries[left]
        return left[((few**2).sum(1) - 2 * self.points[s:e] @ few.T).argmin(1)]

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of the points of each entry."""
        n, total = np.zeros(len(entries), np.int64), np.zeros_like(entries)

        def own(ball: int, entry: int) -> None:
            n[entry] += self.balls[ball, 1] - self.balls[ball, 0]
            total[entry] += self.total[ball]

        def compare(ball: int, left: np.ndarray) -> None:
            found = self.leaf(ball, entries, left)
            np.add.at(n, found, 1)
            np.add.at(total, found, self.points[slice(*self.balls[ball, :2])])

        self.owners(entries, own, compare)
        return n, total

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point, in the order in which the points came."""
        code = np.zeros(len(self.points), np.int64)

        def own(ball: int, entry: int) -> None:
            code[slice(*self.balls[ball, :2])] = entry

        def compare(ball: int, left: np.ndarray) -> None:
            code[slice(*self.balls[ball, :2])] = self.leaf(ball, entries, left)

        self.owners(entries, own, compare)
        back = np.empty_like(code)
        back[self.order] = code
        error = np.empty_like(code)
        error[self.order] = apart(self.points, entries[code])
        return back, error

    def packed(self) -> list[bytes]:
        return [self.points.astype(np.int32).tobytes(), self.order.astype(np.int32).tobytes(), self.balls.astype(np.int32).tobytes(),
                self.total.tobytes(), self.wide.tobytes()]

    @classmethod
    def read(cls, packed: list[bytes], width: int) -> Tree:
        points, order, balls = (np.frombuffer(b, np.int32).astype(np.int64) for b in packed[:3])
        return cls(points.reshape(-1, width), order, balls.reshape(-1, 4), np.frombuffer(packed[3], np.int64).reshape(-1, width), np.frombuffer(packed[4], np.int64))


def integers(df: DataFrame, key: str, vector: str, label: str, length: int, scale: int) -> DataFrame:
    """(key, label, v) of the vectors that take part."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = vectors(batch.column(2), length)
            some = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some), lists(whole(x, scale), pa.int32())], ["key", "label", "v"])

    kinds = schema(key=kind_of(df, key), label=kind_of(df, label), v=ArrayType(IntegerType()))
    return df.select(F.col(key).alias("key"), F.col(label).alias("label"), vector).mapInArrow(convert, kinds)


def planted(ints: DataFrame, length: int, parts: int) -> DataFrame:
    """(keys, labels, trees) of each block: the trees' arrays by part position."""
    width = length // parts

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, BLOCK):
                x = run.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.int64)
                trees = [t for p in range(parts) for t in Tree.build(x[:, p * width : (p + 1) * width]).packed()]
                whole_run = lambda c: pa.ListArray.from_arrays(pa.array([0, run.num_rows], pa.int32()), pa.concat_arrays([c]))
                yield pa.RecordBatch.from_arrays([whole_run(run.column(0)), whole_run(run.column(1)), pa.array([trees], pa.list_(pa.binary()))], ["keys", "labels", "trees"])

    return ints.mapInArrow(plant, schema(keys=many(kind_of(ints, "key")), labels=many(kind_of(ints, "label")), trees=many(BinaryType())))


def grown(column: pa.Array, n: int, parts: int, width: int) -> list[Tree]:
    packed = column[n].as_py()
    return [Tree.read(packed[5 * p : 5 * p + 5], width) for p in range(parts)]


def sums(blocks: DataFrame, books: np.ndarray) -> list:
    """(part, entry, n, total of each position) of each entry that owns a part."""
    parts, size, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                for p, tree in enumerate(grown(batch.column(0), k, parts, width)):
                    more, s = tree.sums(books[p])
                    n[p] += more
                    total[p] += s
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), lists(total[part, entry], pa.int64())], ["part", "entry", "n", "total"])

    each = F.array(*[F.sum(F.col("total")[d]) for d in range(width)])
    found = blocks.select("trees").mapInArrow(add, schema(part=IntegerType(), entry=IntegerType(), n=LongType(), total=ArrayType(LongType())))
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), each.alias("total")).collect()


def fit(ints: DataFrame, blocks: DataFrame, length: int, parts: int, size: int, rounds: int) -> np.ndarray:
    """(part, entry, position): the codebooks after the rounds."""
    start = ints.orderBy(F.col("key").asc_nulls_last(), "v").limit(size).select("v").collect()
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(start) else 0):
        moved = books.copy()
        for r in sums(blocks, books):
            moved[r["part"], r["entry"]] = [t // r["n"] for t in r["total"]]
        books = moved
    return books


def encode(blocks: DataFrame, books: np.ndarray, digits: int) -> DataFrame:
    """(key, label, code, error) of each vector of the blocks."""
    parts, size, width = books.shape
    hexes = [f"{e:0{digits}x}" for e in range(size)]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = [tree.codes(books[p]) for p, tree in enumerate(grown(batch.column(2), k, parts, width))]
                text = ["".join(hexes[c] for c in row) for row in np.stack([c for c, _ in found], 1).tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[k].values, batch.column(1)[k].values, pa.array(text, pa.string()), pa.array(sum(e for _, e in found))], ["key", "label", "code", "error"])

    kinds = schema(key=kind_of(blocks, "keys").elementType, label=kind_of(blocks, "labels").elementType, code=StringType(), error=LongType())
    return blocks.mapInArrow(write, kinds)


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 1024, parts: int = 4,
             size: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """((key, label, code, error), codebooks as an array (part, entry, position)) of the vectors that take part.

    Components are floor(scale * x).  The parts of the ``size`` smallest keys' vectors are the first entries; each round
    assigns all parts and moves the entries to the floors of the means.  A code is an index per part, in hexadecimal.
    """
    length = usual_length(df, vector, parts)
    ints = integers(df, key, vector, label, length, scale)
    blocks = stored(planted(ints, length, parts) if length else planted(ints, parts, parts), "metric-trees")
    books = fit(ints, blocks, length or parts, parts, size, rounds)
    codes = encode(blocks, books, max(2, len(f"{size - 1:x}"))) if books.shape[1] else blocks.limit(0).select(
        F.explode("keys").alias("key"), F.lit(None).cast(kind_of(ints, "label")).alias("label"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    return codes.withColumnsRenamed({"key": key, "label": label}), books


def label_errors(codes: DataFrame, label: str = "label") -> DataFrame:
    """Adds label_error: the errors of all rows of equal label, nulls together."""
    codes = stored(codes, "codes")
    totals = codes.groupBy(F.col(label).alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    # Written first: a hot label's rows can then be split between tasks, and a small side be broadcast.
    totals = stored(totals, "label-errors")
    return codes.join(totals, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
