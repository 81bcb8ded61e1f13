"""Exact, interpolated quantiles without gathering a column anywhere.

``percentile`` keeps every distinct value of a column in one aggregation buffer.
Here each task keeps a summary of a column: its distinct values with their rows while these
are few, else points at equal steps of rank, with the rank error that this can have made.
Columns of few values are settled by the first pass. For the others the summary brackets each
wanted rank, and the next pass counts the rows against the bracket's ends and summarises the
values strictly between them, which are few enough to be kept as they are; of very long columns
they may not be, and the bracket is narrowed again. A value that fills a third of the rows is a
single point, or a bracket's end, which is counted.

Summaries are merged per group of tasks, so that no single task has to take in those of a whole
cluster; each group hands the driver summaries of bounded length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_double, chunks, in_parallel

#: Points of a summary in the first pass, and of all summaries of a job together in a later one.
ACCURACY = 16_384
GATHER_ROWS = 200_000
LEAST_POINTS = 50
#: Values that a task sorts at a time, and summaries that it holds of one level before they become one of the next.
CHUNK = 1 << 18
FOLDED = 16
SUMMARY_GROUPS = 16
COLUMNS_PER_JOB = 4
JOBS_AT_ONCE = 4
SUMMARIES = "i int, below long, low long, high long, error double, points binary, weights binary"


@dataclass
class _Bracket:
    """Ranks around ``position`` of one column lie between ``low`` and ``high``, or anywhere."""

    column: str
    probability: float
    low: float | None = None
    high: float | None = None
    value: float | None = None


@dataclass
class _Summary:
    """Sorted points, the rows that each stands for, and how far any value's rank may be off."""

    points: np.ndarray
    weights: np.ndarray
    error: float = 0.0

    def at_least(self, rank: float) -> float | None:
        """The largest point that the value of this rank cannot be below."""
        before = np.cumsum(self.weights) - self.weights
        place = int(np.searchsorted(before, rank - self._slack(), side="right")) - 1
        return float(self.points[place]) if place >= 0 else None

    def at_most(self, rank: float) -> float | None:
        """The smallest point that the value of this rank cannot be above."""
        place = int(np.searchsorted(np.cumsum(self.weights), rank + 1 + self._slack(), side="left"))
        return float(self.points[place]) if place < len(self.points) else None

    def nearest(self, rank: float) -> float:
        place = int(np.searchsorted(np.cumsum(self.weights), rank, side="right"))
        return float(self.points[min(place, len(self.points) - 1)])

    def _slack(self) -> float:
        return self.error + 1 if self.error else 0.0


def _merged(parts: list[_Summary]) -> _Summary:
    points = np.concatenate([p.points for p in parts]) if parts else np.empty(0)
    weights = np.concatenate([p.weights for p in parts]) if parts else np.empty(0)
    order = np.argsort(points, kind="stable")
    points, weights = points[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], points[1:] != points[:-1]))) if len(points) else np.empty(0, int)
    return _Summary(points[first], np.add.reduceat(weights, first) if len(first) else weights, sum(p.error for p in parts))


def _reduced(s: _Summary, points: int) -> _Summary:
    """At most so many points, at equal steps of rank: no rank is off by more than half a step."""
    if len(s.points) <= points:
        return s
    upto = np.cumsum(s.weights)
    step = upto[-1] / points
    places = np.searchsorted(upto, (np.arange(points) + 0.5) * step, side="right")
    chosen, times = np.unique(np.minimum(places, len(s.points) - 1), return_counts=True)
    return _Summary(s.points[chosen], times * step, s.error + step / 2)


class _Growing:
    """A task's summary of the values seen so far; every level is reduced once, so errors do not pile up."""

    def __init__(self, points: int):
        self.points, self.held, self.n, self.levels = points, [], 0, []

    def add(self, x: np.ndarray) -> None:
        if len(x):
            self.held.append(x)
            self.n += len(x)
            if self.n >= CHUNK:
                self._fold()

    def _fold(self) -> None:
        points, rows = np.unique(np.concatenate(self.held), return_counts=True)
        self.held, self.n = [], 0
        found, level = _reduced(_Summary(points + 0.0, rows.astype(float)), self.points), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(found)
            if len(self.levels[level]) < FOLDED:
                return
            found = _reduced(_merged(self.levels[level]), self.points)
            self.levels[level] = []
            level += 1

    def finished(self) -> _Summary:
        if self.held:
            self._fold()
        return _reduced(_merged([s for level in self.levels for s in level]), self.points)


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    *,
    approx: bool = False,
    accuracy: int = ACCURACY,
    gather_rows: int = GATHER_ROWS,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of every column; all-null columns give nulls.

    ``approx`` stops after the first pass. ``accuracy`` is the number of points that a summary has
    there, ``gather_rows`` that of all summaries of a later pass.
    """

    def run(part):
        return _quantiles(df, list(part), probs, approx, max(accuracy, LEAST_POINTS), gather_rows)

    # few columns per job: the scan is columnar, and short generated code stays compiled
    jobs = [lambda part=part: run(part) for part in chunks(columns, COLUMNS_PER_JOB)]
    out: dict[str, list[float | None]] = {}
    for found in in_parallel(df.sparkSession, jobs, JOBS_AT_ONCE):
        out.update(found)
    return out


def _quantiles(df, columns, probs, approx, accuracy, gather_rows):
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    rows: dict[str, int] = {}
    brackets: dict[tuple[str, int], _Bracket] = {}
    for c, (_, _, _, summary) in zip(columns, _summaries(df, [_Bracket(c, 0.0) for c in columns], accuracy), strict=True):
        rows[c] = round(float(summary.weights.sum()))
        for j, p in enumerate(probs if rows[c] else []):
            brackets[c, j] = b = _Bracket(c, p)
            if approx:
                b.value = summary.nearest(p * (rows[c] - 1))
            else:
                _narrow(b, rows[c], 0, 0, 0, summary)
    while open_ := [b for b in brackets.values() if b.value is None]:
        points = max(LEAST_POINTS, gather_rows // len(open_))
        for b, located in zip(open_, _summaries(df, open_, points), strict=True):
            _narrow(b, rows[b.column], *located)
    for (c, j), b in brackets.items():
        out[c][j] = b.value
    return out


def _summaries(df: DataFrame, brackets: list[_Bracket], points: int) -> list[tuple[int, int, int, _Summary]]:
    """Per bracket the rows below it, at its low and at its high end, and the summary of the values inside.

    Each task compares its Arrow batches with all brackets at once.
    """
    columns = list(dict.fromkeys(b.column for b in brackets))
    ends = [(columns.index(b.column), b.low, b.high) for b in brackets]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        i, below, low, high, summaries = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(i, pa.int32()),
                *[pa.array(x, pa.int64()) for x in (below, low, high)],
                pa.array([s.error for s in summaries], pa.float64()),
                pa.array([s.points.tobytes() for s in summaries], pa.binary()),
                pa.array([s.weights.tobytes() for s in summaries], pa.binary()),
            ],
            names=[c.split()[0] for c in SUMMARIES.split(", ")],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(ends), 3), np.int64)
        inside = [_Growing(points) for _ in ends]
        for batch in batches:
            arrays = [c.drop_null().to_numpy(zero_copy_only=False) for c in batch.columns]
            for i, (c, low, high) in enumerate(ends):
                x = arrays[c]
                if low is None:
                    inside[i].add(x)
                    continue
                totals[i] += np.count_nonzero(x < low), np.count_nonzero(x == low), np.count_nonzero(x == high)
                inside[i].add(x[(x > low) & (x < high)])
        yield rows([(i, *totals[i].tolist(), inside[i].finished()) for i in range(len(ends))])

    def group(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["task"])  # sums in one order
        merged = _reduced(_merged([_read(r) for r in found]), points)
        return pa.Table.from_batches([rows([(found[0]["i"], *[sum(r[k] for r in found) for k in ("below", "low", "high")], merged)])])

    found = (
        df.select(*[as_double(c).alias(f"x{j}") for j, c in enumerate(columns)])
        .mapInArrow(task, SUMMARIES)
        .withColumn("task", F.spark_partition_id())
        # no session setting: the answer of ``approx`` must not depend on one
        .groupBy("i", F.pmod("task", F.lit(SUMMARY_GROUPS)).alias("of"))
        .applyInArrow(group, SUMMARIES)
        .collect()  # one row of bounded size per bracket and group
    )
    out = []
    for i in range(len(ends)):
        own = [r for r in found if r["i"] == i]
        own.sort(key=lambda r: (r["error"], bytes(r["points"]), bytes(r["weights"])))
        out.append((*[sum(r[k] for r in own) for k in ("below", "low", "high")], _merged([_read(r) for r in own])))
    return out


def _read(r) -> _Summary:
    return _Summary(np.frombuffer(r["points"]), np.frombuffer(r["weights"]), r["error"])


def _narrow(b: _Bracket, rows: int, below: int, at_low: int, at_high: int, inside: _Summary) -> None:
    """The bracket's value, if its summary is exact; else closer ends around the wanted ranks."""
    position = b.probability * (rows - 1)
    first, last = math.floor(position), math.ceil(position)
    before = below + at_low
    upto = before + round(float(inside.weights.sum()))
    if b.low is not None and not below <= first <= last < upto + at_high:
        b.low = b.high = None  # rows that were not the same in both passes: from the start
        return
    if inside.error == 0:

        def at(rank: int) -> float:
            return b.low if rank < before else inside.nearest(rank - before) if rank < upto else b.high

        low, high = at(first), at(last)
    else:
        low, high = b.low, b.high
        if first >= before:
            found = inside.at_least(first - before)
            low = found if found is not None else -math.inf if low is None else low
        if last < upto:
            found = inside.at_most(last - before)
            high = found if found is not None else math.inf if high is None else high
        b.low, b.high = low, high
        if low != high:
            return
    b.value = low if low == high else low + (high - low) * (position - first)  # two infinities have no difference
