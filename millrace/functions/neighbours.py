"""Mutual information of number columns with a label from nearest neighbours, over ranges of sorted values.

The estimate is psi(n) + mean psi(k) - mean psi(rows of the own class) - mean psi(m): m counts the rows
nearer than a row's k-th neighbour of its own class. Values of all columns are cut into ranges once. A
range finds k-th neighbours alone once it knows, per class, the k values before and after it, and
counts by two ranks per row; the ranks of bounds that fall inside another range are found there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import as_double, chunks, class_counts, class_index, col
from millrace.sources.scratch import write_table

ROWS_PER_RANGE = 250_000
COLUMNS_PER_JOB = 100
NEIGHBOURS, NOISE = 3, 1e-10
EULER = 0.5772156649015329
BOUNDS = "c int, row bigint, n bigint, low double, low_range int, low_rank bigint, high double, high_range int, high_rank bigint"


def psi(m: Column) -> Column:
    """The digamma function of a whole number from 1 on."""
    exact = F.array(*[F.lit(sum(1 / j for j in range(1, i)) - EULER) for i in range(1, 20)])
    x = m.cast("double")
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)
    return F.when(m < 20, F.element_at(exact, F.least(m, F.lit(19)).cast("int"))).otherwise(series)


def _psi(m: int) -> float:
    if m < 20:
        return sum(1 / j for j in range(1, m)) - EULER
    return math.log(m) - 1 / (2 * m) - 1 / (12 * m**2) + 1 / (120 * m**4) - 1 / (252 * m**6)


def _normal(key: Column, i: int) -> Column:
    """A standard normal number that hangs on the row's key and the column alone."""
    even = [(F.xxhash64(key, F.lit(2 * i + j)).bitwiseAND(F.lit((1 << 53) - 1)) + F.lit(0.5)) / float(1 << 53) for j in (0, 1)]
    return F.sqrt(-2 * F.log(even[0])) * F.cos(2 * math.pi * even[1])


def _facts(df: DataFrame, columns: list[str], y: Column, n_classes: int) -> tuple[np.ndarray, list[float], list[float]]:
    """Values per (column, class), and each column's deviation and mean absolute value."""
    counts = np.zeros((len(columns), n_classes), np.int64)
    spread, size = [], []
    for part in chunks(list(enumerate(columns)), COLUMNS_PER_JOB):
        for r in df.groupBy(y.cast("int").alias("y")).agg(*[F.count(as_double(c)).alias(f"n{i}") for i, c in part]).collect():
            for i, _ in part:
                counts[i, r["y"]] = r[f"n{i}"]
        row = df.agg(*[f(as_double(c)).alias(f"{k}{i}") for i, c in part for k, f in (("s", F.stddev_pop), ("a", lambda x: F.avg(F.abs(x))))]).first()
        spread += [row[f"s{i}"] or 0.0 for i, _ in part]
        size += [row[f"a{i}"] or 0.0 for i, _ in part]
    return counts, spread, size


def _ends(k: int):
    """Per task, column, range and class: the k smallest and the k largest values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            c, r, y, x = (b.column(n).to_numpy() for n in ("c", "range", "y", "x"))
            order = np.lexsort((x, y, r, c))
            c, r, y, x = c[order], r[order], y[order], x[order]
            if not len(x):
                continue
            new = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (r[1:] != r[:-1]) | (y[1:] != y[:-1]))))
            for a, e in zip(new.tolist(), [*new[1:].tolist(), len(x)], strict=True):
                key = (int(c[a]), int(r[a]), int(y[a]))
                own = x[a:e]
                if key in held:
                    own = np.sort(np.concatenate((held[key], own)))
                held[key] = own if len(own) <= 2 * k else np.concatenate((own[:k], own[-k:]))
        rows = [{"c": c, "range": r, "y": y, "ends": x.tolist()} for (c, r, y), x in held.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("c", pa.int32()), ("range", pa.int32()), ("y", pa.int32()), ("ends", pa.list_(pa.float64()))]))

    return run


def _halos(cells: DataFrame, k: int) -> DataFrame:
    """Rows for each range: the k values of each of its classes that come before it and after it in the column."""
    ends = (
        cells.mapInArrow(_ends(k), "c int, range int, y int, ends array<double>")
        .groupBy("c", "range", "y")
        .agg(F.sort_array(F.flatten(F.collect_list("ends"))).alias("ends"))  # k ends of each task that read the range
    )
    # every row holds one value of the class at least, so the k rows next to a range have all that are needed
    near = Window.partitionBy("c", "y").orderBy("range")
    before = F.slice(F.sort_array(F.flatten(F.collect_list("ends").over(near.rowsBetween(-k, -1))), asc=False), 1, k)
    after = F.slice(F.sort_array(F.flatten(F.collect_list("ends").over(near.rowsBetween(1, k)))), 1, k)
    around = ends.select("c", "range", "y", F.concat(before, after).alias("around"))
    return around.select("c", "range", "y", F.explode("around").alias("x"))


def _kth_distance(own: np.ndarray, k: int) -> np.ndarray:
    """Distance of each of the sorted values to its k-th nearest other one (all of the others may be fewer)."""
    n = len(own)
    best = np.full(n, np.inf)
    for j in range(k + 1):  # j of the k neighbours are smaller
        i = np.arange(j, n - (k - j))
        best[i] = np.minimum(best[i], np.maximum(own[i] - own[i - j], own[i + (k - j)] - own[i]))
    return best


def _reach(x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest number whose difference from x, as it is rounded, is within the radius.

    x - radius itself may be rounded onto a value that is farther away; a step or two mend that.
    """
    low, high = x - radius, x + radius
    for _ in range(3):
        low = np.where(x - low > radius, np.nextafter(low, np.inf), low)
        high = np.where(high - x > radius, np.nextafter(high, -np.inf), high)
    for _ in range(3):
        below, above = np.nextafter(low, -np.inf), np.nextafter(high, np.inf)
        low = np.where(x - below <= radius, below, low)
        high = np.where(above - x <= radius, above, high)
    return low, high


class _Ranges:
    """Where each column's ranges begin and end, and how many values come before them."""

    def __init__(self, rows: list, n_columns: int):
        by: list[list] = [[] for _ in range(n_columns)]
        for r in sorted(rows, key=lambda r: (r["c"], r["range"])):
            by[r["c"]].append(r)
        self.number = [np.array([r["range"] for r in own], np.int64) for own in by]
        self.low = [np.array([r["low"] for r in own], float) for own in by]
        self.high = [np.array([r["high"] for r in own], float) for own in by]
        self.upto = [np.cumsum([0, *[r["n"] for r in own]]) for own in by]

    def rank(self, c: int, at: int, xs: np.ndarray, bounds: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
        """For each bound its rank, if this range (the ``at``-th, values ``xs``) or the ends tell it; else -1 and the range that does."""
        target = np.searchsorted(self.low[c], bounds, side=side) - 1
        rank = np.full(len(bounds), -1, np.int64)
        rank[target < 0] = 0
        own = target == at
        rank[own] = self.upto[c][at] + np.searchsorted(xs, bounds[own], side=side)
        known = np.maximum(target, 0)
        over = (rank < 0) & ((bounds > self.high[c][known]) | ((side == "right") & (bounds >= self.high[c][known])))
        rank[over] = self.upto[c][known[over] + 1]
        return rank, self.number[c][known]


def _counted(ranges: _Ranges, sizes: np.ndarray, k: int):
    """Per range: for every value and class its rows and the ranks of both bounds, or the bounds that other ranges must place."""

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}

    def run(table: pa.Table) -> pa.Table:
        c_all, y_all, x_all, halo = (table[n].to_numpy() for n in ("c", "y", "x", "halo"))
        number = int(table["range"][0].as_py())
        out: list[tuple] = []
        for c in np.unique(c_all[~halo]).tolist():
            inside = (c_all == c) & ~halo
            x, y = x_all[inside], y_all[inside]
            order = np.lexsort((y, x))
            xs, ys = x[order], y[order]
            # equal values of a class have equal distances, bounds and ranks: one row stands for them
            first = np.flatnonzero(np.concatenate(([True], (xs[1:] != xs[:-1]) | (ys[1:] != ys[:-1]))))
            x, y, rows = xs[first], ys[first], np.diff(np.append(first, len(xs)))
            distance = np.empty(len(x))
            for label in np.unique(y).tolist():
                around = x_all[(c_all == c) & halo & (y_all == label)]
                own = np.flatnonzero(y == label)
                values = np.sort(np.concatenate((around, xs[ys == label])))
                places = np.searchsorted(values, x[own])
                distance[own] = _kth_distance(values, min(k, int(sizes[c, label]) - 1))[places]
            low, high = _reach(x, np.nextafter(distance, 0))
            at = int(np.searchsorted(ranges.number[c], number))
            row = (np.int64(number) << np.int64(32)) + np.flatnonzero(inside)[order[first]]
            (low_rank, low_range), (high_rank, high_range) = ranges.rank(c, at, xs, low, "left"), ranges.rank(c, at, xs, high, "right")
            out.append((np.full(len(x), c, np.int32), row, rows, low, low_range.astype(np.int32), low_rank, high, high_range.astype(np.int32), high_rank))
        schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in BOUNDS.split(", "))])
        parts = [pa.RecordBatch.from_arrays([pa.array(v) for v in part], schema=schema) for part in out]
        return pa.Table.from_batches(parts, schema=schema)

    return run


def _placed(ranges: _Ranges):
    """Ranks of bounds that come among a range's values, all sorted: before equal values for the lower side, behind for the upper."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            c, r, side = (b.column(n).to_numpy() for n in ("c", "range", "side"))
            value = side == 0
            new = np.concatenate(([True], (c[1:] != c[:-1]) | (r[1:] != r[:-1])))
            running = np.cumsum(value)
            first = np.flatnonzero(new)
            carried = seen if last == (int(c[0]), int(r[0])) else 0
            start = (running - value)[first]
            start[0] -= carried
            inside = running - start[np.cumsum(new) - 1]
            last, seen = (int(c[-1]), int(r[-1])), int(inside[-1])
            asked = np.flatnonzero(~value)
            before = [ranges.upto[i][np.searchsorted(ranges.number[i], j)] for i, j in zip(c[asked].tolist(), r[asked].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n).take(pa.array(asked)) for n in ("c", "row", "n", "side")], pa.array(inside[asked] + np.array(before, np.int64))],
                names=["c", "row", "n", "side", "rank"],
            )

    return run


def neighbour_information(
    df: DataFrame,
    columns: list[str],
    label: str,
    *,
    k: int = NEIGHBOURS,
    noise: float = NOISE,
    id_col: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> dict[str, float]:
    """Mutual information (nats) of each column's values, as they are, with the label.

    Equal values are set apart by ``noise``: normal numbers of that share of the column's deviation
    (or of its mean absolute value, if that is larger), drawn from the row's id, or without an id
    column from all its values; 0 leaves values as they are. Rows without a label are left out. A
    column's missing values tell what the share of classes among them tells, and its other values
    the rest. A class with one value in a column is left out there.
    """
    labelled = df.filter(col(label).isNotNull())
    classes = [c for c, _ in class_counts(labelled, label)]
    y = class_index(col(label), classes)
    sizes, spread, size = _facts(labelled, columns, y, len(classes))
    all_rows = _facts_of_label(labelled, y, len(classes))
    key = col(id_col) if id_col else F.xxhash64(*[col(c) for c in df.columns])
    values = []
    for i, c in enumerate(columns):
        x = as_double(c)
        amplitude = noise * (max(spread[i], size[i]) if spread[i] else max(1.0, size[i]))
        if amplitude:
            x = x + F.lit(amplitude) * _normal(key, i)
        values.append(F.struct(F.lit(i).alias("c"), x.alias("x")))
    alone = [(i, j) for i, j in zip(*np.nonzero(sizes == 1), strict=True)]
    cells = labelled.select(y.cast("int").alias("y"), F.explode(F.array(*values)).alias("v")).select("v.c", "y", "v.x").where("x IS NOT NULL")
    if alone:
        singles = df.sparkSession.createDataFrame([(int(i), int(j)) for i, j in alone], "c int, y int")
        cells = cells.join(F.broadcast(singles), ["c", "y"], "left_anti")
    used = np.where(sizes > 1, sizes, 0)
    n_ranges = max(1, -(-int(used.sum()) // rows_per_range))
    # equal values may be dealt to several ranges
    spreading = F.xxhash64(F.monotonically_increasing_id())
    dealt = cells.withColumn("spreading", spreading).repartitionByRange(n_ranges, "c", "x", "spreading")
    ranged, _ = write_table(dealt.select("c", "y", "x", F.spark_partition_id().alias("range")))
    found = ranged.groupBy("c", "range").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("n"))
    ranges = _Ranges(found.collect(), len(columns))  # columns + ranges rows at most
    inside = ranged.withColumn("halo", F.lit(False)).unionByName(_halos(ranged, k).withColumn("halo", F.lit(True)))
    bounds, _ = write_table(inside.groupBy("range").applyInArrow(_counted(ranges, sizes, k), BOUNDS))
    told = (F.col("low_rank") >= 0) & (F.col("high_rank") >= 0)
    near = bounds.where(told).select("c", (F.col("high_rank") - F.col("low_rank")).alias("m"), "n")
    sides = [F.struct(F.lit(side).cast("tinyint").alias("side"), *[F.col(f"{end}{of}").alias(name) for of, name in (("", "value"), ("_range", "range"), ("_rank", "rank"))]) for side, end in ((-1, "low"), (1, "high"))]
    halves = bounds.where(~told).select("c", "row", "n", F.explode(F.array(*sides)).alias("half")).select("c", "row", "n", "half.*")
    strays = halves.where("rank < 0").select("c", "range", "value", "side", "row", "n")
    met = strays.unionByName(
        ranged.join(strays.select("c", "range").distinct(), ["c", "range"], "left_semi").select(
            "c", "range", F.col("x").alias("value"), F.lit(0).cast("tinyint").alias("side"), *[F.lit(-1).cast("bigint").alias(n) for n in ("row", "n")]
        )
    )
    placed = met.repartition("c", "range").sortWithinPartitions("c", "range", "value", "side").mapInArrow(_placed(ranges), "c int, row bigint, n bigint, side tinyint, rank bigint")
    ranks = halves.where("rank >= 0").select("c", "row", "n", "side", "rank").unionByName(placed)
    far = ranks.groupBy("c", "row").agg(F.sum(F.col("side") * F.col("rank")).alias("m"), F.max("n").alias("n")).select("c", "m", "n")
    within = near.unionByName(far).groupBy("c", "m").agg(F.sum("n").alias("n"))
    sums = {r["c"]: r["total"] for r in within.groupBy("c").agg(F.sum(F.col("n") * psi(F.col("m"))).alias("total")).collect()}
    return {c: _information(used[i], sizes[i], all_rows, sums.get(i), k) for i, c in enumerate(columns)}


def _facts_of_label(df: DataFrame, y: Column, n_classes: int) -> np.ndarray:
    counts = np.zeros(n_classes, np.int64)
    for r in df.groupBy(y.cast("int").alias("y")).count().collect():
        counts[r["y"]] = r["count"]
    return counts


def _information(used: np.ndarray, present: np.ndarray, rows: np.ndarray, psi_sum: float | None, k: int) -> float:
    """The estimate for one column from its counts per class and the sum of psi(m)."""
    n, total = int(used.sum()), int(rows.sum())
    own = 0.0
    if n:
        of_k = sum(int(c) * _psi(min(k, int(c) - 1)) for c in used if c) / n
        of_class = sum(int(c) * _psi(int(c)) for c in used if c) / n
        own = max(0.0, _psi(n) + of_k - of_class - psi_sum / n)
    gaps = 0.0
    for side in (present, rows - present):
        for j, c in enumerate(side.tolist()):
            if c:
                gaps += c / total * math.log(c * total / (int(side.sum()) * int(rows[j])))
    return max(0.0, gaps) + own * int(present.sum()) / total
