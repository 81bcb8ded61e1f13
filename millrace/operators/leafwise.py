"""Boosted trees that grow leaf by leaf, from histograms of gradients that Spark adds up.

The rows are cut into bins once and written. A pass over them counts, for every leaf that may be split
next in any class's tree, how many rows and how much gradient fall into each bin of each column;
tasks send one row per (tree, leaf, column), these are added up where a leaf's best cut is found, and
a few numbers per leaf reach the driver. The driver splits the leaf that gains most, again and again. Leaves that may come up are expanded ahead of their turn, all in one pass, so a tree
of 63 leaves takes about as many passes as it is deep, and is the tree that single splits would give.

Gradients are rounded to multiples of 2**-24 of the largest row weight and added as whole numbers, so
the trees do not depend on how rows are dealt to tasks or on the order of sums.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import as_double, chunks, in_parallel
from millrace.sources.scratch import write_table

#: Whole numbers per unit of gradient or hessian.
SCALE = float(1 << 24)
#: Bytes of the arrays that a task works on at a time, and cells (leaf, column, bin) that it counts in one pass.
BLOCK_BYTES, CELLS = 32 << 20, 4 << 20
#: Bytes of a row besides its bins: for each score (itself, its probability and both derivatives, with what is between), and in all.
SCORE_BYTES, ROW_BYTES = 80, 160
#: Rows that bins are taken from, about; columns whose bins one job finds, and jobs at once.
SAMPLED, COLUMNS_PER_JOB, JOBS_AT_ONCE = 200_000, 8, 4
#: Rounds after which the rows' scores are written; in between they are the written ones plus the newest trees.
WRITTEN_EVERY = 10
#: The least sum of hessians in a leaf.
LEAST_HESSIAN = 1e-3
ROWS = "bins binary, target int, weight double, draw bigint, scores binary"
FOUND = "gain double, cut int, gaps_left boolean, g_left bigint, h_left bigint, n_left bigint, g bigint, h bigint, n bigint"


@dataclass
class Tree:
    """Nodes as arrays; a node with column -1 is a leaf. Bins up to ``cut`` go left, missing values as ``gaps_left`` says."""

    column: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    gaps_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def leaf(self, value: float = 0.0) -> int:
        for name, x in (("column", -1), ("cut", 0), ("gaps_left", False), ("left", 0), ("right", 0), ("value", value), ("gain", 0.0)):
            getattr(self, name).append(x)
        return len(self.column) - 1

    def split(self, node: int, column: int, cut: int, gaps_left: bool, gain: float) -> tuple[int, int]:
        self.left[node], self.right[node] = self.leaf(), self.leaf()
        self.column[node], self.cut[node], self.gaps_left[node], self.gain[node] = column, cut, gaps_left, gain
        return self.left[node], self.right[node]

    def leaves(self) -> int:
        return sum(c < 0 for c in self.column)

    def route(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        column, cut, gaps, left, right = (np.array(x) for x in (self.column, self.cut, self.gaps_left, self.left, self.right))
        node = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if column[0] >= 0 else np.empty(0, np.int64)
        while len(moving):
            at = node[moving]
            x = bins[moving, column[at]]
            goes_left = np.where(x == missing[column[at]], gaps[at], x <= cut[at])
            node[moving] = np.where(goes_left, left[at], right[at])
            moving = moving[column[node[moving]] >= 0]
        return node


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Per column the number of edges below each value; one more than there are edges, plus one, for a gap."""
    widest = max((len(e) for e in edges), default=0) + 2
    out = np.empty((len(x), len(edges)), np.uint8 if widest <= 256 else np.uint16)
    for i, e in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), len(e) + 1, np.searchsorted(e, x[:, i], side="left"))
    return out


def missing_bins(edges: list[np.ndarray]) -> np.ndarray:
    return np.array([len(e) + 1 for e in edges], np.int64)


def probabilities(scores: np.ndarray) -> np.ndarray:
    """One score per row (of the second of two classes) or one per class, as probabilities of the classes."""
    if scores.shape[1] == 1:
        p = 1 / (1 + np.exp(-scores))
        return np.hstack((1 - p, p))
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(scores: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the rows' log loss by each score, as whole numbers."""
    p = probabilities(scores)
    if scores.shape[1] == 1:
        p, hit, factor = p[:, 1:], (target == 1)[:, None], 1.0
    else:
        hit, factor = target[:, None] == np.arange(scores.shape[1]), scores.shape[1] / (scores.shape[1] - 1)
    w = weight[:, None] * SCALE
    return np.rint((p - hit) * w), np.rint(factor * p * (1 - p) * w)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits depend on all bits of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def drawn(draw: np.ndarray, turn: int, seed: int, share: float) -> np.ndarray:
    """Which rows this round learns from: by each row's own number, so alike on any cluster."""
    if share >= 1:
        return np.ones(len(draw), bool)
    salt = mixed(np.array([((seed & 0xFFFFFFFF) << 32) + turn + 1], np.uint64))
    return mixed(draw ^ salt) < np.uint64(int(share * float(1 << 64)))


@dataclass(frozen=True)
class Limits:
    """What a cut must leave on both sides, and the weight of the leaves' values in the loss."""

    rows: int
    hessian: float
    l2: float


def best_cut(sums: np.ndarray, limits: Limits) -> tuple | None:
    """The best cut of one column of one leaf: gain, cut, gaps_left, and g, h, n on the left.

    ``sums`` holds g, h and n per bin, the last bin counts the gaps. Gaps go to the side where they
    gain more, right on a tie; where the leaf has none, later ones go to the side of more rows. Of
    equal gains the lowest cut is taken.
    """
    sums = sums.astype(np.float64)
    sums[:2] /= SCALE
    total, gaps = sums.sum(axis=1, keepdims=True), sums[:, -1:]
    below = np.cumsum(sums[:, :-1], axis=1)

    def worth(part: np.ndarray) -> np.ndarray:
        return np.where(part[1] > 0, part[0] ** 2 / np.maximum(part[1] + limits.l2, 1e-300), 0.0)

    best = None
    for gaps_left in (False, True) if gaps[2, 0] else (None,):
        left = below + gaps if gaps_left else below
        right = total - left
        able = (np.minimum(left[2], right[2]) >= limits.rows) & (np.minimum(left[1], right[1]) >= limits.hessian)
        gain = np.where(able, worth(left) + worth(right) - worth(total), -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > 1e-12 and (best is None or gain[at] > best[0]):
            side = bool(left[2, at] > right[2, at]) if gaps_left is None else gaps_left
            best = (float(gain[at]), at, side, left[:, at])
    return best


class _Growing:
    """A tree of one class while it grows: what is known of its leaves, and which are expanded ahead."""

    def __init__(self, columns: np.ndarray, n_leaves: int, max_depth: int):
        self.columns, self.n_leaves, self.max_depth = columns, n_leaves, max_depth
        self.tree = Tree()
        self.depth = {self.tree.leaf(): 0}
        self.best: dict[int, tuple] = {}  # node: (gain, column, cut, gaps_left)
        self.sums: dict[int, tuple] = {}  # node: (g, h)
        self.halves: dict[int, tuple] = {}  # node: (g, h) left of its best cut
        self.asked = [0]  # leaves whose histograms the next pass counts

    def learn(self, node: int, row: dict | None) -> None:
        if row is None:  # no column can cut it
            self.best[node] = (0.0,)
            return
        self.sums[node] = (row["g"], row["h"])
        deep = self.max_depth > 0 and self.depth[node] >= self.max_depth
        self.best[node] = (0.0,) if deep else (row["gain"], row["column"], row["cut"], row["gaps_left"])
        self.halves[node] = (row["g_left"], row["h_left"])

    def replay(self) -> tuple[list[int], list[int]]:
        """Splits in the order of their gains as far as leaves are known: split nodes, and open leaves by gain."""
        heap, split = [(-self.best[0][0], 0)], []
        while heap and len(split) < self.n_leaves - 1:
            gain, node = heap[0]
            if gain >= 0 or self.tree.column[node] < 0:
                break
            heapq.heappop(heap)
            split.append(node)
            for child in (self.tree.left[node], self.tree.right[node]):
                heapq.heappush(heap, (-self.best[child][0], child))
        return split, [n for g, n in sorted(heap) if g < 0]

    def expand(self, at_most: int) -> None:
        """Split, ahead of their turn, the open leaves that may still come up."""
        self.asked = []
        split, open_ = self.replay()
        left = self.n_leaves - 1 - len(split)
        for node in [n for n in open_[:left] if self.tree.column[n] < 0][:at_most]:
            gain, column, cut, gaps_left = self.best[node]
            children = self.tree.split(node, column, cut, gaps_left, gain)
            g, h = self.sums[node]
            g_left, h_left = self.halves[node]
            for child, sums in zip(children, ((g_left, h_left), (g - g_left, h - h_left)), strict=True):
                self.depth[child], self.sums[child] = self.depth[node] + 1, sums
            self.asked += children

    def finished(self, rate: float, l2: float) -> Tree:
        """The tree of the splits that came up, with the leaves' values."""
        split = set(self.replay()[0])
        out = Tree()

        def copy(node: int, to: int) -> None:
            if node in split:
                t = self.tree
                left, right = out.split(to, t.column[node], t.cut[node], t.gaps_left[node], t.gain[node])
                copy(t.left[node], left)
                copy(t.right[node], right)
            elif node in self.sums:
                g, h = (x / SCALE for x in self.sums[node])
                out.value[to] = -rate * g / (h + l2) if h + l2 > 0 else 0.0

        copy(0, out.leaf())
        return out


def _fixed(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A column of byte strings of one length as rows of numbers, not copied."""
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    start = int(np.frombuffer(offsets, wide, 1, column.offset * np.dtype(wide).itemsize)[0])
    return np.frombuffer(data, kind, len(column) * width, start).reshape(len(column), width)


class _Block:
    """Some of the written rows as arrays."""

    def __init__(self, batches: list[pa.RecordBatch], columns: int, wide: bool, trees: int):
        part = pa.concat_batches(batches) if len(batches) > 1 else batches[0]
        self.bins = _fixed(part.column("bins"), np.uint16 if wide else np.uint8, columns)
        self.target = part.column("target").to_numpy()
        self.weight = part.column("weight").to_numpy()
        self.draw = part.column("draw").to_numpy().view(np.uint64)
        self.scores = _fixed(part.column("scores"), np.float64, trees)

    def scored(self, newest: list[list[Tree]], missing: np.ndarray) -> np.ndarray:
        scores = self.scores.copy()
        for trees in newest:
            for k, t in enumerate(trees):
                scores[:, k] += np.array(t.value)[t.route(self.bins, missing)]
        return scores


def _gathered(batches: Iterator[pa.RecordBatch], columns: int, wide: bool, trees: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches of rows that take about BLOCK_BYTES with all that is worked out for them, so a task's memory does not grow with its rows."""
    size, held, rows = max(1_024, BLOCK_BYTES // ((2 if wide else 1) * columns + SCORE_BYTES * trees + ROW_BYTES)), [], 0
    for b in batches:
        for start in range(0, b.num_rows, size):
            part = b.slice(start, size)
            if rows and rows + part.num_rows > size:
                yield held
                held, rows = [], 0
            held.append(part)
            rows += part.num_rows
    if held:
        yield held


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _binned_rows(df: DataFrame, columns: list[str], target: Column, weight: Column, draw: Column, edges, base: list[float]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [b.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(columns))]
            scores = np.tile(np.array(base), (b.num_rows, 1))
            yield pa.RecordBatch.from_arrays(
                [_bytes(binned(np.column_stack(x), edges)), b.column("target"), b.column("weight"), b.column("draw"), _bytes(scores)],
                names=[c.split()[0] for c in ROWS.split(", ")],
            )

    return df.select(
        target.cast("int").alias("target"),
        weight.cast("double").alias("weight"),
        draw.alias("draw"),
        *[as_double(c).alias(f"x{i}") for i, c in enumerate(columns)],
    ).mapInArrow(run, ROWS)


def _histograms(growing: list[_Growing], newest: list[list[Tree]], missing: np.ndarray, turn: int, seed: int, share: float):
    """Per task: g, h and n of every bin, one row per (tree, leaf asked for, column)."""
    width = int(missing.max()) + 1
    asked = {k: g for k, g in enumerate(growing) if g.asked}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((3, len(g.columns), len(g.asked) * width), np.int64) for k, g in asked.items()}
        for part in _gathered(batches, len(missing), width > 256, len(growing)):
            block = _Block(part, len(missing), width > 256, len(growing))
            rows = np.flatnonzero(drawn(block.draw, turn, seed, share))
            g_all, h_all = gradients(block.scored(newest, missing), block.target, block.weight)
            bins, g_all, h_all = block.bins[rows], g_all[rows], h_all[rows]
            for k, own in asked.items():
                slot = np.full(len(own.tree.column), -1)
                slot[own.asked] = np.arange(len(own.asked))
                at = slot[own.tree.route(bins, missing)]
                inside = np.flatnonzero(at >= 0)
                first, g, h = at[inside] * width, g_all[inside, k], h_all[inside, k]
                size = len(own.asked) * width
                for i, c in enumerate(own.columns):
                    cell = first + bins[inside, c]
                    # sums of whole numbers below 2**53: exact
                    sums[k][0, i] += np.bincount(cell, g, size).astype(np.int64)
                    sums[k][1, i] += np.bincount(cell, h, size).astype(np.int64)
                    sums[k][2, i] += np.bincount(cell, minlength=size)
        for k, own in asked.items():
            for j, node in enumerate(own.asked):
                part = sums[k][:, :, j * width : (j + 1) * width]
                if not part[2].any():
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k] * len(own.columns), pa.int32()),
                        pa.array([node] * len(own.columns), pa.int32()),
                        pa.array(own.columns, pa.int32()),
                        pa.array([np.ascontiguousarray(part[:, i]).tobytes() for i in range(len(own.columns))], pa.binary()),
                    ],
                    names=["tree", "node", "column", "sums"],
                )

    return run


def _cuts(missing: np.ndarray, limits: Limits):
    """Adds up the rows of a (tree, leaf, column), which come together; the best cut per leaf of the columns in a task."""
    width = int(missing.max()) + 1
    names = ["tree", "node", "column", *[c.split()[0] for c in FOUND.split(", ")]]
    kinds = [pa.int32()] * 3 + [pa.float64(), pa.int32(), pa.bool_()] + [pa.int64()] * 6

    def found(key: tuple, total: np.ndarray) -> dict:
        own = total[:, : missing[key[2]] + 1]
        gain, cut, side, left = best_cut(own, limits) or (0.0, 0, False, np.zeros(3))
        row = (*key, gain, cut, side, round(left[0] * SCALE), round(left[1] * SCALE), int(left[2]), *(int(x) for x in own.sum(axis=1)))
        return dict(zip(names, row, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, schema = None, None, pa.schema(list(zip(names, kinds, strict=True)))
        best: dict[tuple, dict] = {}  # per leaf, of the columns seen here

        def close() -> None:
            row = found(key, total)
            known = best.get(key[:2])
            if known is None or row["gain"] > known["gain"]:  # columns come in order: of equal ones the first stays
                best[key[:2]] = row

        for batch in batches:
            if not batch.num_rows:
                continue
            sums = _fixed(batch.column("sums"), np.int64, 3 * width)
            keys = zip(*[batch.column(n).to_pylist() for n in ("tree", "node", "column")], strict=True)
            for new, own in zip(keys, sums, strict=True):
                if new == key:
                    total += own.reshape(3, width)
                    continue
                if key is not None:
                    close()
                key, total = new, own.reshape(3, width).copy()
        if key is not None:
            close()
            yield pa.RecordBatch.from_pylist(list(best.values()), schema=schema)

    return run


def _advanced(newest: list[list[Tree]], missing: np.ndarray, trees: int):
    """The rows with the newest trees added to their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = _Block([batch], len(missing), int(missing.max()) + 1 > 256, trees).scored(newest, missing)
                yield batch.set_column(batch.schema.get_field_index("scores"), "scores", _bytes(scores))

    return run


class LeafwiseModel:
    """Fitted rounds of trees, one per class (one in all for two classes), with the edges of the columns' bins."""

    def __init__(self, edges: list[np.ndarray], base: list[float], rounds: list[list[Tree]]):
        self.edges, self.base, self.rounds = edges, base, rounds

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of values; a gap is NaN."""
        bins, missing = binned(x, self.edges), missing_bins(self.edges)
        out = np.tile(np.array(self.base), (len(x), 1))
        for trees in self.rounds:
            for k, t in enumerate(trees):
                out[:, k] += np.array(t.value)[t.route(bins, missing)]
        return out

    def probability(self, columns: list[Column]) -> Column:
        """The classes' probabilities as a column."""
        model = self

        @F.pandas_udf("array<double>")
        def scored(*own: pd.Series) -> pd.Series:
            x = np.column_stack([s.to_numpy(dtype=float, na_value=np.nan) for s in own])
            return pd.Series(list(probabilities(model.scores(x))))

        return scored(*columns)

    def importances(self) -> np.ndarray:
        """Each column's share of all gains."""
        out = np.zeros(len(self.edges))
        for trees in self.rounds:
            for t in trees:
                for c, g in zip(t.column, t.gain, strict=True):
                    if c >= 0:
                        out[c] += g
        return out / out.sum() if out.sum() > 0 else out

    def save(self, path: str) -> None:
        """As tables: edges, base scores, nodes (at most rounds x classes x 2 leaves rows)."""
        spark = SparkSession.active()
        edges = [(i, j, float(v)) for i, e in enumerate(self.edges) for j, v in enumerate(e)]
        edges += [(i, -1, 0.0) for i in range(len(self.edges))]  # a column without edges too
        spark.createDataFrame(edges, "column int, place int, edge double").write.parquet(f"{path}/edges")
        spark.createDataFrame(list(enumerate(self.base)), "tree int, score double").write.parquet(f"{path}/base")
        nodes = [
            (r, k, i, *values)
            for r, trees in enumerate(self.rounds)
            for k, t in enumerate(trees)
            for i, values in enumerate(zip(t.column, t.cut, t.gaps_left, t.left, t.right, t.value, t.gain, strict=True))
        ]
        kinds = "round int, tree int, node int, column int, cut int, gaps_left boolean, left int, right int, value double, gain double"
        spark.createDataFrame(nodes, kinds).write.parquet(f"{path}/nodes")

    @classmethod
    def load(cls, path: str) -> LeafwiseModel:
        spark = SparkSession.active()
        by: dict[int, list[float]] = {}
        for r in spark.read.parquet(f"{path}/edges").orderBy("column", "place").collect():
            by.setdefault(r["column"], [])
            if r["place"] >= 0:
                by[r["column"]].append(r["edge"])
        base = [r["score"] for r in spark.read.parquet(f"{path}/base").orderBy("tree").collect()]
        rounds: list[list[Tree]] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "tree", "node").collect():
            if r["round"] == len(rounds):
                rounds.append([])
            if r["node"] == 0:
                rounds[-1].append(Tree())
            own = rounds[-1][-1]
            for name in ("column", "cut", "gaps_left", "left", "right", "value", "gain"):
                getattr(own, name).append(r[name])
        return cls([np.array(by[i]) for i in sorted(by)], base, rounds)


def column_edges(df: DataFrame, columns: list[str], max_bins: int, draw: Column, rows: int) -> list[np.ndarray]:
    """Each column's quantiles, at most ``max_bins`` distinct ones without the largest, of all rows or about ``SAMPLED`` of many.

    ``draw`` decides which rows are read, so the edges don't depend on how these are dealt to tasks.
    """
    if rows > SAMPLED:
        df = df.filter(F.pmod(F.xxhash64(draw), F.lit(1 << 20)) < F.lit((1 << 20) * SAMPLED // rows))
    shares = "array(" + ", ".join(f"{i / max_bins!r}D" for i in range(max_bins)) + ", 1D)"

    def found(part: list[str]) -> list[np.ndarray]:
        # the values of one column in an aggregation: bounded by the sample
        row = df.agg(*[F.percentile(as_double(c), F.expr(shares)).alias(f"q{i}") for i, c in enumerate(part)]).first()
        return [np.array(sorted(set(q or []))[:-1], float) for q in row]

    jobs = [lambda part=part: found(list(part)) for part in chunks(columns, COLUMNS_PER_JOB)]
    return [e for part in in_parallel(df.sparkSession, jobs, JOBS_AT_ONCE) for e in part]


def fit_leafwise(
    df: DataFrame,
    columns: list[str],
    target: Column,
    counts: list[int],
    weights: list[float],
    draw: Column,
    *,
    rounds: int,
    rate: float,
    n_leaves: int,
    max_depth: int,
    least_rows: int,
    l2: float,
    subsample: float,
    colsample: float,
    max_bins: int,
    seed: int,
) -> LeafwiseModel:
    """Boosted rounds of one tree per class (softmax), or of one tree for two classes.

    ``target`` is the class's number, ``counts`` and ``weights`` hold the rows and the row weight of
    each class, ``draw`` is a 64-bit number of a row that decides in which rounds it is learned from.
    Missing values are a bin of their own, which goes to the side of a cut where it gains more.
    """
    edges = column_edges(df, columns, max_bins, draw, sum(counts))
    missing = missing_bins(edges)
    largest = max(weights)
    shares = np.array(counts) * np.array(weights) / np.dot(counts, weights)
    base = [math.log(shares[1] / shares[0])] if len(counts) == 2 else np.log(shares).tolist()
    trees = len(base)
    of_class = F.element_at(F.array(*[F.lit(w / largest) for w in weights]), target.cast("int") + 1)
    table, _ = write_table(_binned_rows(df, columns, target, of_class, draw, edges, base))
    # the rows' weights are shares of the largest one, and so are their sums
    limits = Limits(max(1, least_rows), LEAST_HESSIAN / largest, l2 / largest)

    done: list[list[Tree]] = []
    written = 0
    n_columns = max(1, math.ceil(colsample * len(columns)))
    per_pass = max(2, CELLS // (n_columns * (int(missing.max()) + 1) * trees))
    for turn in range(rounds):
        if turn - written >= WRITTEN_EVERY:
            table, _ = write_table(table.mapInArrow(_advanced(done[written:], missing, trees), ROWS))
            written = turn
        rng = np.random.default_rng((seed & 0xFFFFFFFF, turn))
        growing = [_Growing(np.sort(rng.choice(len(columns), n_columns, replace=False)), n_leaves, max_depth) for _ in range(trees)]
        while any(g.asked for g in growing):
            task = _histograms(growing, done[written:], missing, turn, seed, subsample)
            key = ["tree", "node", "column"]
            cuts = (
                table.mapInArrow(task, "tree int, node int, column int, sums binary")
                .repartition(*key)
                .sortWithinPartitions(*key)
                .mapInArrow(_cuts(missing, limits), f"tree int, node int, column int, {FOUND}")
            )
            rows: dict[tuple, dict] = {}
            for r in cuts.collect():  # per leaf asked for one row of each task that had columns of it
                known = rows.get((r["tree"], r["node"]))
                if known is None or (r["gain"], -r["column"]) > (known["gain"], -known["column"]):
                    rows[r["tree"], r["node"]] = r.asDict()
            for k, g in enumerate(growing):
                for node in g.asked:
                    g.learn(node, rows.get((k, node)))
                g.expand(per_pass // 2)
        done.append([g.finished(rate, limits.l2) for g in growing])
    return LeafwiseModel(edges, base, done)
