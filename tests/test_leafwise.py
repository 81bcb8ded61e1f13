import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from millrace.operators import leafwise
from millrace.operators.leafwise import SCALE, Tree, binned, column_edges, drawn, missing_bins
from millrace.operators.models import ClassifierModel, LeafLimitedTrees
from pyspark.sql import functions as F

SCHEMA = "id long, a double, b double, c double, y string"


def rows(n=300, classes="abc"):
    rng = random.Random(4)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), float(rng.randint(0, 3))
        y = classes[min(len(classes) - 1, int((a + b * (c > 1) > 0.2) + (a > 1)))] if rng.random() < 0.9 else rng.choice(classes)
        out.append((i, a if rng.random() < 0.85 else None, b, c, y))
    return out


def plainly(x, y, weights, draws, edges, *, rounds, rate, leaves, least, l2, max_depth, subsample, seed):
    """Scores of every row after boosting whose trees split one leaf at a time, each cut found by trying all."""
    bins = [[(len(e) + 1 if v is None else sum(t < v for t in e)) for v, e in zip(r, edges, strict=True)] for r in x]
    classes = sorted(set(y))
    w = [weights[c] / max(weights.values()) for c in y]
    mass = {c: sum(a for a, b in zip(w, y, strict=True) if b == c) for c in classes}
    logs = [math.log(mass[c] / sum(mass.values())) for c in classes]
    base = [logs[1] - logs[0]] if len(classes) == 2 else logs
    scores = [list(base) for _ in x]
    unit = max(weights.values())
    for turn in range(rounds):
        learned = drawn(np.array(draws, np.int64).view(np.uint64), turn, seed, subsample)
        changes = []
        for k in range(len(base)):
            g, h = [], []
            for s, c, v in zip(scores, y, w, strict=True):
                if len(base) == 1:
                    p, hit, factor = 1 / (1 + math.exp(-s[0])), c == classes[1], 1.0
                else:
                    e = [math.exp(t - max(s)) for t in s]
                    p, hit, factor = e[k] / sum(e), c == classes[k], len(base) / (len(base) - 1)
                g.append(round((p - hit) * v * SCALE) / SCALE)
                h.append(round(factor * p * (1 - p) * v * SCALE) / SCALE)

            def worth(part, g=g, h=h):
                low = sum(h[i] for i in part)
                return sum(g[i] for i in part) ** 2 / (low + l2 / unit) if low > 0 else 0.0

            def best(part, depth, h=h, worth=worth):
                found = (0.0, None)
                if 0 < max_depth <= depth:
                    return found
                seen = [i for i in part if learned[i]]
                for f, e in enumerate(edges):
                    gaps = any(bins[i][f] == len(e) + 1 for i in seen)
                    for gaps_left in (False, True) if gaps else (None,):
                        for cut in range(len(e) + 1):
                            side = [bins[i][f] <= cut if bins[i][f] <= len(e) else bool(gaps_left) for i in seen]
                            left = [i for i, s in zip(seen, side, strict=True) if s]
                            right = [i for i, s in zip(seen, side, strict=True) if not s]
                            if min(len(left), len(right)) < least or min(sum(h[i] for i in left), sum(h[i] for i in right)) < 1e-3 / unit:
                                continue
                            gain = worth(left) + worth(right) - worth(seen)
                            if gain > found[0] + 1e-12:
                                found = (gain, (f, cut, len(left) > len(right) if gaps_left is None else gaps_left))
                return found

            parts = [(list(range(len(x))), 0)]
            options = [best(*parts[0])]
            while len(parts) < leaves and max(o[0] for o in options) > 0:
                at = max(range(len(options)), key=lambda j: options[j][0])
                (part, depth), (_, (f, cut, gaps_left)) = parts.pop(at), options.pop(at)
                goes = [bins[i][f] <= cut if bins[i][f] <= len(edges[f]) else gaps_left for i in part]
                for side in (True, False):
                    parts.append(([i for i, s in zip(part, goes, strict=True) if s == side], depth + 1))
                    options.append(best(*parts[-1]))
            change = [0.0] * len(x)
            for part, _ in parts:
                seen = [i for i in part if learned[i]]
                low = sum(h[i] for i in seen) + l2 / unit
                for i in part:
                    change[i] = -rate * sum(g[j] for j in seen) / low if low > 0 else 0.0
            changes.append(change)
        for i, s in enumerate(scores):
            for k in range(len(base)):
                s[k] += changes[k][i]
    return scores


@pytest.mark.parametrize(
    ("classes", "more"),
    [
        ("abc", {"num_leaves": 7}),
        ("ab", {"num_leaves": 9, "subsample": 0.7, "reg_lambda": 0.5}),
        ("abc", {"num_leaves": 8, "max_depth": 2, "class_weight": None}),
    ],
)
def test_equals_single_splits(frame, classes, more):
    data = rows(160, classes)
    df = frame(data, SCHEMA, 3)
    made = {"n_estimators": 3, "learning_rate": 0.3, "min_child_samples": 4, "max_bins": 12, "subsample": 1.0, "colsample_bytree": 1.0, **more}
    model = LeafLimitedTrees(idCol="id", labelCol="y", **made).fit(df)
    ys = [r[4] for r in data]
    names = sorted(set(ys))
    balanced = {c: len(ys) / (len(names) * ys.count(c)) for c in names}
    draws = {r["id"]: r["d"] for r in df.select("id", F.xxhash64("id").alias("d")).collect()}
    x = [r[1:4] for r in data]
    want = plainly(
        x, ys, balanced if made.get("class_weight", "balanced") else dict.fromkeys(names, 1.0), [draws[r[0]] for r in data], model.inner.edges,
        rounds=3, rate=0.3, leaves=made["num_leaves"], least=4, l2=made.get("reg_lambda", 0.0), max_depth=made.get("max_depth", -1),
        subsample=made["subsample"], seed=42,
    )
    got = model.inner.scores(np.array([[np.nan if v is None else v for v in r] for r in x], float))
    assert np.allclose(got, want, atol=1e-9)
    assert max(t.leaves() for trees in model.inner.rounds for t in trees) > 3


def test_leaves_are_unequal_and_up_to_the_limit(frame):
    df = frame([(i, math.exp(i / 40), 0.0, 0.0, "ab"[(i // 5) % 2 if i > 250 else i > 100]) for i in range(400)], SCHEMA, 4)
    model = LeafLimitedTrees(idCol="id", labelCol="y", n_estimators=1, num_leaves=63, min_child_samples=1, subsample=1.0, max_bins=400).fit(df)
    (tree,) = model.inner.rounds[0]
    depth = {0: 0}
    for i, c in enumerate(tree.column):
        if c >= 0:
            depth[tree.left[i]] = depth[tree.right[i]] = depth[i] + 1
    deep = [depth[i] for i, c in enumerate(tree.column) if c < 0]
    assert 20 < tree.leaves() <= 63 and max(deep) > min(deep) + 2


def test_gaps_carry_the_label_without_an_indicator(frame):
    rng = random.Random(1)
    df = frame([(i, None if i % 3 == 0 else rng.gauss(0, 1), rng.gauss(0, 1), 0.0, "gap" if i % 3 == 0 else "value") for i in range(150)], SCHEMA, 2)
    model = LeafLimitedTrees(idCol="id", labelCol="y", n_estimators=5, num_leaves=4, learning_rate=0.5).fit(df)
    assert model.features == ["a", "b", "c"] and max(model.importances().items(), key=lambda kv: kv[1])[0] == "a"
    assert all(r["prediction"] == r["y"] for r in model.transform(df).collect())


def test_same_model_on_other_partitions_and_after_saving(frame, tmp_path, monkeypatch):
    monkeypatch.setattr(leafwise, "WRITTEN_EVERY", 2)
    data = rows(200)
    made = {"n_estimators": 5, "num_leaves": 5, "min_child_samples": 5, "colsample_bytree": 0.67}
    one, two = (LeafLimitedTrees(idCol="id", labelCol="y", **made).fit(frame(data, SCHEMA, n)) for n in (1, 7))
    assert [[t.__dict__ for t in trees] for trees in one.inner.rounds] == [[t.__dict__ for t in trees] for trees in two.inner.rounds]
    path = str(tmp_path / "model")
    PipelineModel([one]).write().save(path)
    loaded = PipelineModel.load(path).stages[0]
    assert isinstance(loaded, ClassifierModel)
    df = frame(data, SCHEMA)
    want = {r["id"]: r["probability"] for r in one.transform(df).collect()}
    assert {r["id"]: r["probability"] for r in loaded.transform(df).collect()} == want


def test_bins_and_routes(frame):
    df = frame([(i, float(i % 50), None, 1.0, "x") for i in range(200)], SCHEMA, 3)
    edges = column_edges(df, ["a", "b", "c"], 8, F.col("id"), 200)
    assert [len(e) for e in edges] == [8, 0, 0] and list(edges[0]) == sorted(set(edges[0]))
    few = column_edges(df.union(df), ["a"], 8, F.col("id"), 400_000_000)  # a share of nearly none
    assert len(few[0]) == 0
    bins = binned(np.array([[0.0, np.nan, 1.0], [49.0, 3.0, np.nan]]), edges)
    assert bins.tolist() == [[0, 1, 0], [8, 0, 1]] and missing_bins(edges).tolist() == [9, 1, 1]
    tree = Tree()
    left, right = tree.split(tree.leaf(), 1, 0, False, 1.0)
    assert tree.route(bins, missing_bins(edges)).tolist() == [right, left]
    many = drawn(np.arange(20_000, dtype=np.uint64), 3, 42, 0.8)
    assert abs(many.mean() - 0.8) < 0.02 and (many != drawn(np.arange(20_000, dtype=np.uint64), 4, 42, 0.8)).any()


def test_memory_of_a_pass_does_not_grow_with_a_tasks_rows():
    """Blocks are bounded by all that is worked out for their rows, not by their bins alone."""
    import tracemalloc

    import pyarrow as pa

    n, classes = 10_000, 3
    rng = np.random.default_rng(1)
    batch = pa.RecordBatch.from_arrays(
        [
            leafwise._bytes(rng.integers(0, 5, (n, 1)).astype(np.uint8)),
            pa.array(rng.integers(0, classes, n), pa.int32()),
            pa.array(np.ones(n)),
            pa.array(rng.integers(0, 1 << 60, n)),
            leafwise._bytes(np.zeros((n, classes))),
        ],
        names=["bins", "target", "weight", "draw", "scores"],
    )
    task = leafwise._histograms([leafwise._Growing(np.array([0]), 4, -1) for _ in range(classes)], [], np.array([6]), 0, 1, 1.0)
    peaks, counted = [], []
    for batches in (20, 80):
        tracemalloc.start()
        found = list(task(batch for _ in range(batches)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        counted.append(np.frombuffer(found[0].column("sums")[0].as_py(), np.int64).reshape(3, -1)[2].sum())
    assert counted == [20 * n, 80 * n]
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 2 * leafwise.BLOCK_BYTES


def test_fixed_reads_slices():
    import pyarrow as pa

    rows = np.arange(12, dtype=np.float64).reshape(6, 2)
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array([r.tobytes() for r in rows], kind)
        assert (leafwise._fixed(column.slice(2, 3), np.float64, 2) == rows[2:5]).all()


def test_cuts_take_empty_batches():
    import pyarrow as pa

    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("column", pa.int32()), ("sums", pa.binary())])
    empty = pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
    sums = np.array([[-1 << 24, 1 << 24, 0], [1 << 24, 1 << 24, 0], [5, 5, 0]])
    full = pa.RecordBatch.from_arrays([pa.array([0], pa.int32())] * 3 + [pa.array([sums.tobytes()], pa.binary())], schema=schema)
    run = leafwise._cuts(np.array([2]), leafwise.Limits(1, 1e-3, 0.0))
    found = [r for b in run(iter([empty, full, empty])) for r in b.to_pylist()]
    assert [(r["cut"], r["n_left"], r["n"]) for r in found] == [(0, 5, 10)]
