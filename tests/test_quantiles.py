import random

import numpy as np
import pytest

from millrace.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("partitions", [1, 7])
def test_matches_linear_interpolation(frame, partitions):
    rng = random.Random(1)
    rows = [(rng.gauss(0, 1), float(rng.randint(0, 5)), 0.0 if rng.random() < 0.4 else rng.random()) for _ in range(5000)]
    df = frame(rows, "a double, b double, c double", partitions)
    got = exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.9, 1.0])
    for i, c in enumerate("abc"):
        want = np.quantile([r[i] for r in rows], [0.0, 0.25, 0.5, 0.9, 1.0])
        assert got[c] == pytest.approx(list(want), abs=1e-12)


def test_narrowing_passes_give_the_same_ranks(frame):
    rng = random.Random(2)
    # a third of all rows share one value, and a low accuracy forces several passes
    rows = [(1.5 if rng.random() < 0.34 else rng.expovariate(1.0),) for _ in range(40000)]
    df = frame(rows, "a double", 5)
    got = exact_quantiles(df, ["a"], [0.01, 0.3, 0.5, 0.75, 0.999], accuracy=50, gather_rows=100)
    want = np.quantile([r[0] for r in rows], [0.01, 0.3, 0.5, 0.75, 0.999])
    assert got["a"] == pytest.approx(list(want), abs=1e-12)


def test_all_distinct_narrowing(frame):
    rows = [(float(i * 7919 % 30011),) for i in range(30011)]
    got = exact_quantiles(frame(rows, "a double", 6), ["a"], [0.0, 0.1, 0.5, 1.0], accuracy=40, gather_rows=100)
    assert got["a"] == pytest.approx([0.0, 3001.0, 15005.0, 30010.0])


def test_infinite_values(frame):
    df = frame([(1.0,), (2.0,), (float("inf"),), (float("inf"),), (float("inf"),)], "a double")
    assert exact_quantiles(df, ["a"], [0.5, 0.75, 1.0])["a"] == [float("inf")] * 3


def test_estimate_does_not_depend_on_session_settings(spark, frame):
    df = frame([(float(i * 37 % 1000),) for i in range(1000)], "a double", 6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(exact_quantiles(df, ["a"], [0.5], approx=True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_nulls_and_nans_are_left_out(frame):
    df = frame([(1.0, None), (3.0, None), (None, None), (float("nan"), None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.0], "b": [None]}


def test_single_pass_estimate(frame):
    df = frame([(float(i),) for i in range(1001)], "a double")
    assert exact_quantiles(df, ["a"], [0.5], approx=True)["a"][0] == pytest.approx(500, abs=1)


def _rows_read(spark, rows, schema, probs):
    """Rows that the quantiles' passes read in all, and the quantiles."""
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, schema).repartition(4).mapInArrow(counting, schema)
    return exact_quantiles(df, ["a"], probs)["a"], read.value


def test_few_values_take_one_pass_and_many_take_two(spark):
    n = 60_000
    few, read = _rows_read(spark, [(float(i * 7919 % 50),) for i in range(n)], "a double", [0.25, 0.5, 0.75])
    assert few == [12.0, 24.5, 37.0]
    assert read == n
    many, read = _rows_read(spark, [(float(i * 7919 % n),) for i in range(n)], "a double", [0.25, 0.5])
    assert many == [14999.75, 29999.5]
    assert read <= 2 * n


def test_tasks_of_many_chunks_and_levels(frame, monkeypatch):
    from millrace.functions import quantiles

    rng = np.random.default_rng(3)
    x = np.where(rng.random(50_000) < 0.3, 2.0, rng.standard_cauchy(50_000))
    growing = quantiles._Growing(60)
    monkeypatch.setattr(quantiles, "CHUNK", 100)
    for part in np.array_split(x, 500):
        growing.add(part)
    found = growing.finished()
    assert len(growing.levels) == 3 and found.weights.sum() == pytest.approx(len(x))
    for rank in range(0, len(x), 997):
        low, high, value = found.at_least(rank), found.at_most(rank), np.sort(x)[rank]
        assert (low is None or low <= value) and (high is None or high >= value)
    assert found.error < 4 * len(x) / 120 + 1
