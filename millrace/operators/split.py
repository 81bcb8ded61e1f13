"""Exact stratified splits and folds that move no rows.

Rows of a class are ordered by ``md5(id:seed)``. The hash of the row at each wanted rank
is found by counting hash prefixes; after that the split is a comparison of every row's
hash with its class's threshold, evaluated where the row is.
"""

from __future__ import annotations

import logging
import math
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import class_counts, col

DIGITS = 3
LISTED_ROWS = 2_000
HASH_LENGTH = 32

log = logging.getLogger(__name__)


def row_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", col(id_col).cast("string"), F.lit(str(seed))))


def test_quotas(counts: list[tuple[Any, int]], fraction: float) -> dict[Any, int]:
    """Test rows per class: ``ceil(n * fraction)`` shared out by largest remainder."""
    total = sum(n for _, n in counts)
    wanted = math.ceil(round(total * fraction, 9))
    exact = [(c, n * wanted / total) for c, n in counts] if total else []
    quotas = {c: math.floor(x) for c, x in exact}
    by_remainder = sorted(exact, key=lambda cx: -(cx[1] - math.floor(cx[1])))
    for c, _ in by_remainder[: wanted - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def hash_thresholds(
    df: DataFrame, label_col: str, hashed: Column, ranks: list[tuple[Any, int]], *, listed_rows: int = LISTED_ROWS
) -> dict[tuple[Any, int], str]:
    """The hash of the row at each (class, 1-based rank) in the class's hash order.

    Each pass counts the next three hex digits within the prefix a rank is known to lie in,
    which divides the rows in question by 4096; a short remainder is listed.
    """
    spark = df.sparkSession
    rows = df.select(col(label_col).alias("label"), hashed.alias("hash")).filter("label is not null")
    label_type = rows.schema["label"].dataType.simpleString()
    schema = f"label {label_type}, prefix string, rank long, wanted long"
    open_ranks = [(label, "", rank, rank) for label, rank in ranks]
    found: dict[tuple[Any, int], str] = {}
    while open_ranks:
        length = len(open_ranks[0][1])
        targets = F.broadcast(spark.createDataFrame(open_ranks, schema))  # one row per wanted rank
        areas = F.broadcast(
            spark.createDataFrame(sorted({(o[0], o[1]) for o in open_ranks}), f"label {label_type}, prefix string")
        )
        within = rows.withColumn("prefix", F.substring("hash", 1, length)).join(areas, ["label", "prefix"])
        counts = within.groupBy("label", "prefix", F.substring("hash", 1, length + DIGITS).alias("next")).agg(
            F.count(F.lit(1)).alias("n")
        )
        # at most 4096 rows per wanted rank
        upto = F.sum("n").over(Window.partitionBy("label", "prefix").orderBy("next"))
        cells = counts.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n"))
        hits = (
            cells.join(targets, ["label", "prefix"])
            .filter("below < rank and rank <= upto")
            .select("label", "next", "n", (F.col("rank") - F.col("below")).alias("rank"), "wanted")
            .collect()
        )
        open_ranks = []
        listed: dict[tuple[Any, str], list[tuple[int, int]]] = {}
        for h in hits:
            if len(h["next"]) == HASH_LENGTH:
                found[h["label"], h["wanted"]] = h["next"]
            elif h["n"] <= listed_rows:
                listed.setdefault((h["label"], h["next"]), []).append((h["rank"], h["wanted"]))
            else:
                open_ranks.append((h["label"], h["next"], h["rank"], h["wanted"]))
        if listed:
            found.update(_list_hashes(rows, listed, length + DIGITS, label_type))
    return found


def _list_hashes(rows, listed, length, label_type):
    spark = rows.sparkSession
    areas = F.broadcast(spark.createDataFrame(list(listed), f"label {label_type}, prefix string"))
    short = (
        rows.withColumn("prefix", F.substring("hash", 1, length))
        .join(areas, ["label", "prefix"])
        .groupBy("label", "prefix")
        .agg(F.sort_array(F.collect_list("hash")).alias("hashes"))
        .collect()  # counted above: a bounded list per wanted rank
    )
    out = {}
    for r in short:
        for rank, wanted in listed[r["label"], r["prefix"]]:
            out[r["label"], wanted] = r["hashes"][rank - 1]
    return out


def _choose(label: Column, branches: dict[Any, Column], default: Column) -> Column:
    out = None
    for c, x in branches.items():
        out = F.when(label == F.lit(c), x) if out is None else out.when(label == F.lit(c), x)
    return default if out is None else out.otherwise(default)


def with_test_flag(
    df: DataFrame, id_col: str, label_col: str, *, test_size: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Flag exactly the test quota of every class; rows without a label get null."""
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must lie between 0 and 1, not {test_size}")
    hashed = row_hash(id_col, seed)
    quotas = test_quotas(class_counts(df, label_col), test_size)
    last = hash_thresholds(df, label_col, hashed, [(c, q) for c, q in quotas.items() if q])
    inside = {c: hashed <= F.lit(last[c, q]) if q else F.lit(False) for c, q in quotas.items()}
    return df.withColumn(out, _choose(col(label_col), inside, F.lit(None).cast("boolean")))


def labelled(df: DataFrame, label_col: str) -> DataFrame:
    """The rows that have a label; says how many have none."""
    without = df.filter(col(label_col).isNull()).count()
    if without:
        log.warning("%d rows have no '%s': left out", without, label_col)
    return df.filter(col(label_col).isNotNull())


def stratified_split(
    df: DataFrame, id_col: str, label_col: str, *, test_size: float = 0.2, seed: int = 42, unlabelled: str = "raise"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with every class's share kept.

    Rows without a label belong to no class: they are an error, or with ``unlabelled="leave out"``
    they are counted in a warning and are on neither side.
    """
    if unlabelled not in ("raise", "leave out"):
        raise ValueError(f"unlabelled must be 'raise' or 'leave out', not {unlabelled!r}")
    if unlabelled == "raise":
        without = df.filter(col(label_col).isNull()).count()
        if without:
            raise ValueError(f"{without} rows have no '{label_col}'; drop them or pass unlabelled='leave out'")
    else:
        df = labelled(df, label_col)
    flagged = with_test_flag(df, id_col, label_col, test_size=test_size, seed=seed, out="__test")
    return flagged.filter("not __test").drop("__test"), flagged.filter("__test").drop("__test")


def split_summary(train: DataFrame, test: DataFrame, label_col: str) -> DataFrame:
    """Rows and shares per class on both sides."""
    spark = train.sparkSession
    sides = [dict(class_counts(side, label_col)) for side in (train, test)]
    totals = [sum(s.values()) for s in sides]
    kind = train.schema[label_col].dataType.simpleString()
    rows = []
    for c in sorted(set(sides[0]) | set(sides[1])):
        n = [s.get(c, 0) for s in sides]
        rows.append((c, n[0], n[0] / totals[0] if totals[0] else 0.0, n[1], n[1] / totals[1] if totals[1] else 0.0))
    return spark.createDataFrame(
        rows, f"label {kind}, n_train long, pct_train double, n_test long, pct_test double"
    )


def with_folds(
    df: DataFrame, id_col: str, label_col: str, *, n_splits: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Number the folds 0..n-1; sizes differ by one row at most within every class."""
    if n_splits < 2:
        raise ValueError(f"n_splits must be at least 2, not {n_splits}")
    hashed = row_hash(id_col, seed)
    counts = class_counts(df, label_col)
    # fold j ends after row ceil(n * (j + 1) / k): the last of equal shares of the hash order
    ends = {c: [math.ceil(n * (j + 1) / n_splits) for j in range(n_splits - 1)] for c, n in counts}
    last = hash_thresholds(df, label_col, hashed, sorted({(c, e) for c, es in ends.items() for e in es}))
    folds = {}
    for c, es in ends.items():
        fold = F.lit(0)
        for e in es:
            fold = fold + (hashed > F.lit(last[c, e])).cast("int")
        folds[c] = fold
    return df.withColumn(out, _choose(col(label_col), folds, F.lit(None).cast("int")))
