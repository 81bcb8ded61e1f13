import math
import random

import numpy as np
import pytest

from millrace.functions.neighbours import _normal, _psi, _reach, neighbour_information, psi
from millrace.operators.select import MutualInformation
from pyspark.sql import functions as F


def plain(x, y, k):
    """The estimate with every pair of rows looked at."""
    sizes = {c: y.count(c) for c in set(y)}
    rows = [(a, b) for a, b in zip(x, y, strict=True) if sizes[b] > 1]
    total = 0.0
    for a, b in rows:
        near = sorted(abs(a - c) for c, d in rows if d == b)[min(k, sizes[b] - 1)]  # the first is the row itself
        r = math.nextafter(near, 0) if near > 0 else 0.0
        m = sum(abs(a - c) <= r for c, _ in rows)
        total += _psi(min(k, sizes[b] - 1)) - _psi(sizes[b]) - _psi(m)
    return max(0.0, _psi(len(rows)) + total / len(rows))


def rows(n=240):
    rng = random.Random(2)
    out = []
    for i in range(n):
        label = rng.choice("aaabbc")
        out.append((i, rng.gauss(2 * "abc".index(label), 0.7), rng.gauss(0, 1), float(rng.randint(0, 5)), label))
    return out + [(n, 0.3, 0.1, 2.0, "single"), (n + 1, 5.0, 5.0, 5.0, None)]


SCHEMA = "id long, near double, far double, tied double, y string"


@pytest.mark.parametrize(("k", "rows_per_range", "partitions"), [(3, 1_000_000, 1), (3, 25, 5), (1, 9, 3)])
def test_equals_every_pair(frame, k, rows_per_range, partitions):
    data = rows()
    df = frame(data, SCHEMA, partitions)
    got = neighbour_information(df, ["near", "far", "tied"], "y", k=k, noise=0.0, id_col="id", rows_per_range=rows_per_range)
    known = [r for r in data if r[4] is not None]
    for i, c in enumerate(("near", "far", "tied")):
        assert got[c] == pytest.approx(plain([r[i + 1] for r in known], [r[4] for r in known], k), abs=1e-9)
    if k == 3:
        assert got["near"] > 0.3 > got["far"]


def test_noise_hangs_on_rows_not_on_partitions(frame):
    data = [(i, float(i % 4), "ab"[i % 2]) for i in range(200)]
    got = [
        neighbour_information(frame(data, "id long, x double, y string", n), ["x"], "y", id_col="id", rows_per_range=r)["x"]
        for n, r in ((1, 1_000), (6, 17))
    ]
    assert got[0] == pytest.approx(got[1], abs=1e-12)
    assert got[0] == pytest.approx(math.log(2), abs=0.1)  # the value tells the class


def test_reach_counts_what_is_near():
    rng = np.random.default_rng(3)
    for size, spread in ((1.0, 1e-10), (1e6, 1e-7), (1e-9, 1.0), (0.0, 1.0)):
        values = size + spread * rng.normal(size=400)
        x = values[rng.integers(0, 400, 300)]
        radius = np.nextafter(np.abs(x - values[rng.integers(0, 400, 300)]), 0)
        low, high = _reach(x, radius)
        got = ((values[None, :] >= low[:, None]) & (values[None, :] <= high[:, None])).sum(axis=1)
        assert (got == (np.abs(values[None, :] - x[:, None]) <= radius[:, None]).sum(axis=1)).all()


def test_gaps_tell_what_they_tell(frame):
    rng = random.Random(3)
    data = [(i, None if i % 2 else rng.gauss(0, 1), "ab"[i % 2]) for i in range(200)]
    got = neighbour_information(frame(data, "id long, x double, y string", 3), ["x"], "y", id_col="id")
    assert got["x"] == pytest.approx(math.log(2), abs=1e-9)
    empty = neighbour_information(frame([(i, None, "ab"[i % 2]) for i in range(8)], "id long, x double, y string"), ["x"], "y")
    assert empty == {"x": 0.0}


def test_digamma_and_noise(spark):
    df = spark.range(1, 60).select("id", psi(F.col("id")).alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(sum(1 / j for j in range(1, r["id"])) - 0.5772156649015329, abs=1e-12)
        assert r["p"] == pytest.approx(_psi(r["id"]), abs=1e-12)
    z = np.array([r[0] for r in spark.range(20_000).select(_normal(F.col("id"), 3)).collect()])
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03


def test_stage_keeps_the_best(frame):
    model = MutualInformation(idCol="id", labelCol="y", k=1, estimator="neighbours").fit(frame(rows(), SCHEMA, 2))
    assert model.learned["keep"] == ["near"] and set(model.learned["scores"]) == {"near", "far", "tied"}


def test_equal_values_of_a_range_are_one_row():
    """A range hands on a row per value and class with its count, however many rows are equal."""
    import pyarrow as pa

    from millrace.functions.neighbours import _counted, _Ranges

    n = 10_000
    x, y = np.arange(n) % 5, np.arange(n) % 2
    table = pa.table({"c": pa.array(np.zeros(n), pa.int32()), "range": pa.array(np.zeros(n), pa.int32()), "y": pa.array(y, pa.int32()), "x": pa.array(x.astype(float)), "halo": pa.array([False] * n)})
    out = _counted(_Ranges([{"c": 0, "range": 0, "low": 0.0, "high": 4.0, "n": n}], 1), np.array([[n // 2, n // 2]]), 3)(table)
    assert out.num_rows == 10 and sum(out["n"].to_pylist()) == n
    assert {h - low for low, h in zip(out["low_rank"].to_pylist(), out["high_rank"].to_pylist(), strict=True)} == {n // 5}
