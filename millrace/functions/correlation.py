"""Pairwise-complete Pearson and Spearman correlation."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_double, col
from millrace.functions.ordered import ROWS_PER_BUCKET, running_total
from millrace.functions.values import BROADCAST_BYTES, BROADCAST_ROWS, long_form, look_up, row_salt, value_table
from millrace.sources.scratch import write_table

Pair = tuple[str, str]


def all_pairs(columns: list[str]) -> list[Pair]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def correlations(df: DataFrame, columns: list[str], method: str = "pearson") -> dict[Pair, float | None]:
    """Correlation of every pair over the rows where both are present; null if undefined."""
    if len(columns) < 2:
        return {}
    if method == "pearson":
        return pearson(df, {c: as_double(c) for c in columns}, all_pairs(columns))
    if method == "spearman":
        return spearman(df, columns)
    raise ValueError(f"method must be 'pearson' or 'spearman', not {method!r}")


def pearson(df: DataFrame, columns: dict[str, Column], pairs: list[Pair]) -> dict[Pair, float | None]:
    """One method for any number of pairs: moments about each pair's own means.

    A task keeps, for every pair, the number of common rows, their means and the sums of squares and
    products about these, and merges its Arrow batches by the parallel update; the tasks' cells are
    written and merged the same way, about the means of all. No sum about a distant point is taken,
    so neither a large offset nor rows outside a pair cost accuracy.
    """
    names = list(columns)
    k = len(names)
    plain = df.select(*[columns[c].cast("double").alias(f"x{i}") for i, c in enumerate(names)])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            total = _merged(total, _batch_moments(x))
        i, j = np.triu_indices(k, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in total]],
            names=["i", "j", *MOMENTS],
        )

    schema = "i int, j int, " + ", ".join(f"{m} double" for m in MOMENTS)
    cells, _ = write_table(plain.mapInArrow(moments, schema).where("n > 0"))
    means = cells.groupBy("i", "j").agg(
        F.sum("n").alias("rows"), (F.sum(F.col("n") * F.col("mx"))/ F.sum("n")).alias("ax"), (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("ay")
    )
    off_x, off_y = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    merged = (
        cells.join(F.broadcast(means), ["i", "j"])  # a row per pair
        .groupBy("i", "j")
        .agg(
            F.first("rows").alias("rows"), F.first("ax").alias("ax"), F.first("ay").alias("ay"),
            F.sum(F.col("xx") + F.col("n") * off_x * off_x).alias("xx"),
            F.sum(F.col("yy") + F.col("n") * off_y * off_y).alias("yy"),
            F.sum(F.col("xy") + F.col("n") * off_x * off_y).alias("xy"),
        )
        .collect()  # a row per pair
    )
    at = {(names[r["i"]], names[r["j"]]): r for r in merged}
    out: dict[Pair, float | None] = {}
    for a, b in pairs:
        r = at.get((a, b)) or at.get((b, a))
        if r is None or _constant(r["xx"], r["rows"], r["ax"]) or _constant(r["yy"], r["rows"], r["ay"]):
            out[a, b] = None
        else:
            out[a, b] = _clip(r["xy"] / (np.sqrt(r["xx"]) * np.sqrt(r["yy"])))
    return out


#: Common rows, means, sums of squares about them, and the sum of products.
MOMENTS = ["n", "mx", "my", "xx", "yy", "xy"]


def _constant(squares: float, rows: float, mean: float) -> bool:
    """Whether a spread is no more than the rounding of the mean."""
    return not squares > rows * (4 * np.finfo(float).eps * abs(mean)) ** 2


def _clip(r: float | None) -> float | None:
    return None if r is None or np.isnan(r) else float(min(1.0, max(-1.0, r)))


def _batch_moments(x: np.ndarray) -> np.ndarray:
    """MOMENTS of every pair of columns over the rows that have both."""
    k = x.shape[1]
    there = ~np.isnan(x)
    out = np.zeros((6, k, k))
    whole = np.flatnonzero(there.all(axis=0)) if len(x) else np.empty(0, int)
    if len(whole):
        mean = x[:, whole].mean(axis=0)
        d = x[:, whole] - mean
        d -= d.mean(axis=0)
        products = d.T @ d
        at = np.ix_(whole, whole)
        out[0][at] = len(x)
        out[1][at], out[2][at] = mean[:, None], mean[None, :]
        out[3][at], out[4][at] = np.diag(products)[:, None], np.diag(products)[None, :]
        out[5][at] = products
    gappy = set(range(k)) - set(whole.tolist())
    for i in range(k):
        for j in range(i + 1, k):
            if i in gappy or j in gappy:
                both = there[:, i] & there[:, j]
                n = int(both.sum())
                if n:
                    a, b = x[both, i], x[both, j]
                    da, db = a - a.mean(), b - b.mean()
                    out[:, i, j] = n, a.mean(), b.mean(), da @ da, db @ db, da @ db
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    both = a[0] * share
    return np.stack(
        [n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both]
    )


def gap_patterns(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """For each column with nulls the first column that is null in the same rows; None without nulls.

    One pass: a column's pattern is the exclusive or of 128-bit numbers of the rows where it is null.
    """
    row = F.monotonically_increasing_id()
    rows = df.select(*[as_double(c).isNull().alias(f"g{i}") for i, c in enumerate(columns)], *[F.xxhash64(row, F.lit(j)).alias(f"u{j}") for j in (0, 1)])
    marks = [F.count_if(f"g{i}").alias(f"n{i}") for i in range(len(columns))]
    marks += [F.bit_xor(F.when(F.col(f"g{i}"), F.col(f"u{j}"))).alias(f"x{i}_{j}") for i in range(len(columns)) for j in (0, 1)]
    found = rows.agg(*marks).first()
    first: dict[tuple, str] = {}
    out: dict[str, str | None] = {}
    for i, c in enumerate(columns):
        out[c] = first.setdefault((found[f"n{i}"], found[f"x{i}_0"], found[f"x{i}_1"]), c) if found[f"n{i}"] else None
    return out


def rankings(columns: list[str], patterns: dict[str, str | None]) -> dict[Pair, str]:
    """The ranking of a column that a pair (column, partner) reads: of all its rows, or of those of the partner's pattern."""
    own = {(a, b): patterns[b] if patterns[b] != patterns[a] else None for a in columns for b in columns if a != b}
    return {pair: json.dumps([pair[0]] if p is None else [pair[0], p]) for pair, p in own.items()}


def spearman(df: DataFrame, columns: list[str]) -> dict[Pair, float | None]:
    """Pearson correlation of average ranks.

    Ranks are taken over each pair's common rows. A partner without nulls, or with nulls in the same
    rows, does not change a column's ranks, so one ranking serves all such pairs; each other pattern
    of nulls among the partners adds one ranking of the column, restricted to its rows.
    """
    of = rankings(columns, gap_patterns(df, columns))
    pairs = all_pairs(columns)
    ranked: dict[str, Column] = {}
    for r in of.values():
        x, *partner = json.loads(r)
        ranked[r] = F.when(as_double(partner[0]).isNotNull(), as_double(x)) if partner else as_double(x)
    names = {r: f"rank{i}" for i, r in enumerate(ranked)}
    with_ranks = average_ranks(df, {names[r]: x for r, x in ranked.items()})
    wanted = {(names[of[a, b]], names[of[b, a]]): (a, b) for a, b in pairs}
    found = pearson(with_ranks, {n: col(n) for n in names.values()}, list(wanted))
    return {wanted[p]: r for p, r in found.items()}


def average_ranks(
    df: DataFrame,
    columns: dict[str, Column],
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Rows with the average rank of every named expression (null stays null).

    Rows are told apart by a number of their own, never by a column of the caller's.
    """
    counts = value_table(df, columns)
    table = running_total(
        counts.table.filter(F.col("value").isNotNull()),
        counts.rows,
        "column",
        "value",
        F.col("n"),
        "before",
        rows_per_bucket=rows_per_bucket,
    )
    ranks = table.withColumn("rank", F.col("before") + (F.col("n") + 1) / 2)
    code = {"rank": F.col("rank")}
    if counts.rows <= broadcast_rows and counts.n_bytes <= BROADCAST_BYTES:  # as look_up decides
        ranks, _ = write_table(ranks)
        out = df.select(*[x.alias(n) for n, x in columns.items()])
        for name in columns:
            out = look_up(out, counts.with_table(ranks), name, col(name), {f"__{name}": F.col("rank")}, F.lit(0))
        return out.select(*[col(f"__{n}").alias(n) for n in columns])

    # many distinct values: rank narrow (row, column, value) cells, then bring each row together
    numbered = df.select(*[x.alias(n) for n, x in columns.items()])
    rows, _ = write_table(numbered.withColumn("__row", F.monotonically_increasing_id()))
    cells = long_form(rows, {n: col(n) for n in columns}, {"__row": col("__row")}).filter(F.col("value").isNotNull())
    tagged = cells.withColumn("value", F.struct("column", "value"))
    keyed = ranks.withColumn("value", F.struct("column", "value")).withColumn("column", F.lit("cell"))
    ranked = look_up(tagged, counts.with_table(keyed), "cell", F.col("value"), code, row_salt(tagged, "__row"))
    return ranked.groupBy("__row").agg(
        *[F.max(F.when(F.col("column") == n, F.col("rank"))).alias(n) for n in columns]
    ).drop("__row")
