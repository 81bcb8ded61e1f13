import math
import random

import numpy as np
import pytest

from millrace.operators.select import (
    CorrelationThreshold,
    MutualInformation,
    TreeImportance,
    VarianceThreshold,
    mutual_information,
    percentile,
)


def test_variance(frame):
    df = frame([(1, 5.0, 1.0, "a"), (2, 5.0, 2.0, "b"), (3, 5.0, 3.0, "a"), (4, 5.0, 4.0, "b")], "id int, constant double, varied double, cat string")
    model = VarianceThreshold(idCol="id").fit(df)
    assert model.transform(df).columns == ["id", "varied", "cat"]
    assert model.transform(df.drop("constant")).columns == ["id", "varied", "cat"]


def test_variance_is_population_variance_and_strict(frame):
    df = frame([(1.0, 0.0), (2.0, 10.0), (3.0, 0.0), (4.0, 10.0)], "a double, b double")
    assert VarianceThreshold(threshold=2.0).fit(df).transform(df).columns == ["b"]
    assert VarianceThreshold(threshold=1.25).fit(df).transform(df).columns == ["b"]
    with pytest.raises(ValueError, match="variance"):
        VarianceThreshold(threshold=100.0).fit(df)
    with pytest.raises(ValueError):
        VarianceThreshold(threshold=-1.0)


@pytest.mark.parametrize("partitions", [1, 7])
def test_correlation(frame, partitions):
    rng = random.Random(0)
    rows = [(i, float(i), float(i) ** 2, rng.gauss(0, 1), "t") for i in range(1, 51)]
    df = frame(rows, "id int, a double, b double, c double, t string", partitions)
    assert CorrelationThreshold(idCol="id").fit(df).transform(df).columns == ["id", "a", "c", "t"]
    assert CorrelationThreshold(threshold=0.99, method="pearson", idCol="id").fit(df).transform(df).columns == ["id", "a", "b", "c", "t"]
    with pytest.raises(ValueError):
        CorrelationThreshold(threshold=1.5)


def test_a_dropped_column_drops_no_other(frame):
    # b is close to a and to c, a is not close to c
    rows = [(float(i), float(i) + (i % 5), float(i % 5) * 10 + i) for i in range(40)]
    df = frame(rows, "a double, b double, c double")
    r = np.corrcoef(np.array(rows).T)
    threshold = min(r[0, 1], r[1, 2]) - 1e-9
    assert r[0, 2] < threshold
    assert CorrelationThreshold(threshold=threshold, method="pearson").fit(df).transform(df).columns == ["a", "c"]


@pytest.fixture
def three_classes(frame):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1), (i % 3) * 10 + rng.gauss(0, 0.1), "t", i % 3) for i in range(60)]
    return frame(rows, "id int, noise double, informative double, cat string, y int", 3)


def test_mutual_information_keeps_the_best(three_classes):
    model = MutualInformation(k=1, idCol="id", labelCol="y").fit(three_classes)
    assert model.transform(three_classes).columns == ["id", "y", "informative", "cat"]
    assert model.transform(three_classes.drop("y")).columns == ["id", "informative", "cat"]
    both = MutualInformation(k=100, idCol="id", labelCol="y").fit(three_classes)
    assert both.transform(three_classes).columns == ["id", "y", "informative", "noise", "cat"]


def test_mutual_information_value(frame):
    rows = [("a", 0.0, None), ("a", 0.0, 1.0), ("b", 1.0, None), ("b", 1.0, 1.0), (None, 5.0, 5.0)]
    df = frame(rows, "y string, x double, z double")
    scores = mutual_information(df, ["x", "z"], "y")
    assert scores["x"] == pytest.approx(math.log(2))
    assert scores["z"] == pytest.approx(0.0)


@pytest.mark.parametrize("label", ["int", "string"])
def test_tree_importance(frame, label):
    rng = random.Random(4)
    rows = [(i, rng.gauss(0, 1), i % 2 + rng.gauss(0, 0.05), "t", i % 2 if label == "int" else "ny"[i % 2]) for i in range(80)]
    df = frame(rows, f"id int, noise double, signal double, cat string, y {label}", 2)
    model = TreeImportance(percentile_cutoff=50.0, n_estimators=3, max_depth=2, idCol="id", labelCol="y").fit(df)
    assert model.transform(df).columns == ["id", "y", "signal", "cat"]


def test_tree_importance_keeps_column_order_and_checks_type(frame):
    rows = [(i, float(i % 2), float(i % 4), i % 2) for i in range(40)]
    df = frame(rows, "id int, b double, a double, y int")
    model = TreeImportance(percentile_cutoff=0.0, n_estimators=2, max_depth=2, idCol="id", labelCol="y").fit(df)
    assert model.transform(df).columns == ["id", "y", "b", "a"]
    with pytest.raises(ValueError):
        TreeImportance(importance_type="weight")


def test_percentile():
    data = [0.3, 0.1, 0.9, 0.5]
    for q in (0, 10, 33.3, 50, 100):
        assert percentile(data, q) == pytest.approx(np.percentile(data, q))
